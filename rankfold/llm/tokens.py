"""Token ids of whole texts by the ``tokenizers`` library, fast.

``Encoder`` returns exactly ``Tokenizer.from_file(path).encode(text,
add_special_tokens=False).ids``.  For a tokenizer that drops white space and
never merges across it (the word-end BPE kind) each white-space-delimited word
is encoded once per worker and remembered; other kinds are encoded text by
text.  The memory has two generations of about ``MAX_WORDS`` words: when the
young one is full it becomes the old one, and words that are met again move
back, so rare words leave and common ones stay.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_WORDS, MAX_TAILS = 250_000, 10_000
GROUP_BYTES = 4_000_000  # of the texts whose distinct words are looked up together
# Words that are one letters-only pre-token and that normalization only lower-cases:
# letters below U+0250 but for U+0130, whose lower case is not a letter sequence.
_EASY = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch
# Marks behind a word: one pre-token, split from the letters before it.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_ENCODERS: dict[str, "Encoder"] = {}


def _byte_chars() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return [rest.get(b, chr(b)) for b in range(256)]


def _words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, the place in them of every word, offsets of the texts
    in those); words end at ASCII white space only."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
    ends = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    distinct, place = coded.dictionary.view(pa.binary()).to_pylist(), coded.indices.to_numpy()
    if b"" in distinct:  # white space at a text's start or end, or no word
        none = distinct.index(b"")
        real = place != none
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        place = place[real]
        place = place - (place > none)
        del distinct[none]
    return distinct, place, ends


class Encoder:
    """One tokenizer in one Python worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(path)
        self.vocab_size = self.exact.get_vocab_size()
        spec = json.loads(self.exact.to_str())
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.plain = None
        norm, pre, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
        steps = [n.get("type") for n in norm.get("normalizers", [])]
        splits = pre.get("pretokenizers") or [{}]
        if (steps == ["NFC", "Replace", "Lowercase"] and splits[0].get("type") == "Split"
                and splits[0].get("behavior") == "Removed" and model.get("end_of_word_suffix") == "</w>"):
            spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
            self.plain = Tokenizer.from_str(json.dumps(spec))
            self.added = [t.content.encode().lower() for t in self.exact.get_added_tokens_decoder().values()]
            self.ends = np.zeros(self.vocab_size + 1, bool)
            for token, i in model["vocab"].items():
                self.ends[i] = token.endswith("</w>")
            del spec, model
            self.chars = dict(enumerate(_byte_chars())) | {32: " "}
            self.tails: dict[bytes, bytes] = {}  # ids of final marks

    def _tail(self, marks: bytes) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > MAX_TAILS:
                self.tails.clear()
            self.tails[marks] = self._direct(marks.decode())
        return self.tails[marks]

    def _learn(self, missing: list[bytes]) -> None:
        """Encode unseen words: letters-only ones, with or without final marks,
        many at a time without normalization; all others one by one."""
        words = self.words
        plain = list(filter(bytes.isalpha, missing))  # bytes: ASCII letters only
        wide, hard, marked = [], [], []
        for w in filterfalse(bytes.isalpha, missing):
            body = w.rstrip(_MARKS)
            if body.isalpha():
                plain.append(body)
            elif _EASY(body.decode()):
                wide.append(body)
            else:
                hard.append(w)
                continue
            if len(body) < len(w):
                marked.append((w, body, w[len(body):]))
        for some in (plain, wide):
            some = [w for w in dict.fromkeys(some) if w not in words]
            for at in range(0, len(some), 2000):
                part = some[at:at + 2000]
                text = b" ".join(part).decode()
                if not text.isascii():
                    text = text.lower().encode().decode("latin-1").translate(self.chars)
                ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
                if len(cuts) != len(part):
                    raise ValueError("a word was not one pre-token")
                words.update(zip(part, map(ids.tobytes().__getitem__, map(slice, [0, *cuts[:-1]], cuts))))
        words.update((w, words[body] + self._tail(marks)) for w, body, marks in marked)
        if hard:
            for w, e in zip(hard, self.exact.encode_batch_fast([w.decode() for w in hard], add_special_tokens=False)):
                words[w] = np.array(e.ids, "<u4").tobytes()

    def _direct(self, text: str) -> bytes:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text (null: none)."""
        if self.plain is None:
            return [self._direct(t.decode()) if t else b"" for t in texts]
        out: list[bytes | None] = [None] * len(texts)
        at = 0
        while at < len(texts):  # groups of texts
            group, raws, size = [], [], 0
            while at < len(texts) and size < GROUP_BYTES:
                raw = (texts[at] or b"").lower()  # A-Z only
                if any(t in raw for t in self.added):
                    out[at] = self._direct(texts[at].decode())
                else:
                    raws.append(raw)
                    group.append(at)
                size += len(raw)
                at += 1
            if not group:
                continue
            distinct, place, ends = _words(raws)
            ids, length = self._ids_of(distinct)
            first = np.cumsum(length) - length
            n = length[place]
            to = np.cumsum(n)
            found = ids[np.arange(n.sum()) + np.repeat(first[place] - (to - n), n)].tobytes()
            cuts = (4 * np.concatenate([[0], to])[ends]).tolist()
            for i, lo, hi in zip(group, cuts[:-1], cuts[1:]):
                out[i] = found[lo:hi]
        return out

    def _ids_of(self, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after another, number of ids of each)."""
        if len(self.words) > MAX_WORDS:
            self.old, self.words = self.words, {}
        words, old = self.words, self.old
        found = list(map(words.get, distinct))
        holes = [k for k, ids in enumerate(found) if ids is None]
        unseen = [distinct[k] for k in holes]
        again = {w: old[w] for w in unseen if w in old}
        words.update(again)
        self._learn([w for w in unseen if w not in again] if again else unseen)
        for k, w in zip(holes, unseen):
            found[k] = words[w]
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


def encoder(path: str) -> Encoder:
    """The worker's encoder of the tokenizer file ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    return encoder(path).vocab_size


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              dtype: str = "<u4", piece: int | None = None) -> DataFrame:
    """(doc_id, ids): ids of the whole text, then ``end_id``, as little-endian
    unsigned integers.  A null text gives ``end_id`` alone.

    With ``piece``, documents are cut every ``piece`` ids: (doc_id, piece,
    start, length, ids)."""
    end, size = np.array([end_id], "<u4").tobytes(), 4
    names = ["doc_id", "ids"] if piece is None else ["doc_id", "piece", "start", "length", "ids"]

    def narrow(ids: bytes) -> bytes:
        return ids if dtype == "<u4" else np.frombuffer(ids, "<u4").astype(dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            sizes = np.cumsum(pc.binary_length(b.column(1)).fill_null(0).to_numpy())
            to = 0
            while to < b.num_rows:
                at, to = to, max(to + 1, int(np.searchsorted(sizes, (sizes[to - 1] if to else 0) + GROUP_BYTES, "right")))
                part = b.slice(at, to - at)
                ids = [x + end for x in enc.encode(part.column(1).to_pylist())]
                if piece is None:
                    yield pa.record_batch([part.column(0), pa.array(map(narrow, ids), pa.binary())], names=names)
                    continue
                cut = [(i, k, x[p:p + size * piece]) for i, x in enumerate(ids) for k, p in enumerate(range(0, len(x), size * piece))]
                where = pa.array([c[0] for c in cut], pa.int64())
                no = np.array([c[1] for c in cut], np.int32)
                yield pa.record_batch([
                    part.column(0).take(where), pa.array(no), pa.array(no.astype(np.int64) * piece),
                    pa.array([len(c[2]) // size for c in cut], pa.int64()), pa.array([narrow(c[2]) for c in cut], pa.binary())],
                    names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary" if piece is None
                          else "doc_id long, piece int, start long, length long, ids binary")

"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of two neighbouring chunks of ``CHUNK`` words.  Their
hashed TF-IDF vectors (document frequencies over the whole corpus) are folded
into a latent space: a distributed randomised SVD of the passages of all
documents gives its axes, and every passage of every document is projected.  Passages near a benchmark item by cosine are candidates; a
candidate counts when the longest common subsequence of words with the item
covers ``verbatim`` of the item, or ``paraphrase`` of it and the item's answer
(its last ``ANSWER_WORDS`` words unless a column gives it) is found too.  The
item's words that occur in the region at all bound that length from above, so
candidates which the bound rules out are left before the subsequence is found.
An item longer than a window is cut into passages of a window's length and is
near if one of them is; an item of fewer than ``CHUNK`` words meets smaller
windows, of chunks of the largest power of two up to its length.

A passage's vector is a sum over its words, so chunk sums are added once and
shared by both windows.  The benchmark is the query set: it is read in blocks
of ``ITEM_BLOCK`` items, each block one pass over the corpus.

Edge cases: null and empty texts match nothing; items without words match
nothing; rows that share a doc_id are judged each; repeated items are reported
each; empty tables give no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.matrices import matrix_sum
from rankfold.llm.store import stored

FEATURES, RANK, EXTRA, SEED = 16_384, 96, 16, 11
CHUNK = 16
NEAR, VERBATIM, PARAPHRASE, ANSWER_WORDS, ANSWER = 0.35, 0.8, 0.5, 8, 0.75
ITEM_BLOCK = 2_000
PAIR_WORDS, PAIR_PAIRS = 1 << 18, 4_096  # of one step of the bound
RUN_BYTES, RUN_WORDS = 1 << 20, 1 << 17  # of the texts that are worked on at once
BREAKS = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(BREAKS).split()


def _features(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh32_intdigest
    return np.fromiter(map(xxh32_intdigest, words), np.int64, len(words)) % FEATURES


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words, offsets of the texts in them)."""
    words = [words_of(t) for t in texts]
    return _features([w for ws in words for w in ws]).astype(np.uint16), np.concatenate([[0], np.cumsum([len(ws) for ws in words], dtype=np.int64)])


def _text_runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[str | None]]:
    """The texts in groups of about ``RUN_BYTES``; a longer text alone."""
    for b in batches:
        texts = b.column(column)
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + RUN_BYTES, "right")))
            yield texts.slice(at, end - at).to_pylist()
            at = end


def featured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(features): the words' features of every text, little-endian u16, kept
    for the passes that fit a space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _text_runs(batches, 0):
            f, ends = _hashed(texts)
            raw, cut = f.astype("<u2").tobytes(), (2 * ends).tolist()
            yield pa.record_batch([pa.array([raw[lo:hi] for lo, hi in zip(cut[:-1], cut[1:])], pa.binary())], names=["features"])

    return stored(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "features binary"), "features")


def _feature_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, offsets) of the rows of ``featured`` in groups of about
    ``RUN_WORDS``; a longer text alone."""
    for b in batches:
        raw = b.column(0).to_pylist()
        sizes = np.cumsum([len(x) // 2 for x in raw])
        at = 0
        while at < len(raw):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + RUN_WORDS, "right")))
            yield (np.frombuffer(b"".join(raw[at:end]), "<u2"),
                   np.concatenate([[0], sizes[at:end] - (sizes[at - 1] if at else 0)]))
            at = end


def document_frequencies(features: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and the number of documents, from
    ``featured``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES + 1, np.int64)
        for f, ends in _feature_runs(batches):
            df[FEATURES] += len(ends) - 1
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
                here = np.sort(f[lo:hi])
                df[here[np.flatnonzero(here[1:] != here[:-1])]] += 1
                df[here[-1:]] += 1
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(df[some])], names=["feature", "n"])

    rows = (features.mapInArrow(run, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())  # at most FEATURES + 1 rows
    out = np.zeros(FEATURES + 1, np.int64)
    for r in rows:
        out[r["feature"]] = r["n"]
    return out[:FEATURES], int(out[FEATURES])


@dataclass
class Chunks:
    """Texts one after another, each cut every ``size`` words."""
    words: np.ndarray  # chunks x size features, FEATURES behind a text's last word
    text: np.ndarray  # of each chunk
    number: np.ndarray  # of each chunk in its text
    more: np.ndarray  # whether the text goes on behind the chunk

    @property
    def windows(self) -> np.ndarray:
        """Which chunks start a window: all that another one follows, and those
        that are a text's only one."""
        return self.more | (self.number == 0)


def _chunks(features: np.ndarray, ends: np.ndarray, size: int = CHUNK) -> Chunks:
    sizes = np.diff(ends)
    count = -(-sizes // size)
    first = np.cumsum(count) - count
    words = np.full(int(count.sum()) * size, FEATURES, np.uint16)
    words[np.arange(len(features)) + np.repeat(first * size - ends[:-1], sizes)] = features
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - first[text]
    return Chunks(words.reshape(-1, size), text, number, number + 1 < count[text])


def _row_sums(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row of ``rows`` the sum of the table's rows that it names."""
    out = np.empty((len(rows), table.shape[1]), table.dtype)
    part = np.empty((min(len(rows), 512), table.shape[1]), table.dtype)
    for lo in range(0, len(rows), 512):
        index = rows[lo:lo + 512].T.astype(np.intp, order="C")
        total = out[lo:lo + 512]
        total[:] = table[index[0]]
        for at in index[1:]:
            np.take(table, at, axis=0, out=part[:len(total)], mode="clip")
            total += part[:len(total)]
    return out


def _add_rows(out: np.ndarray, to: np.ndarray, rows: np.ndarray, table: np.ndarray) -> None:
    """Add the table's rows ``rows`` to the rows ``to`` (sorted) of ``out``; a
    row's parts are added by eights first."""
    while len(to):
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        n = np.diff(np.append(first, len(to)))
        eights = n // 8 * 8
        for k in range(7):
            some = n - eights > k
            out[to[first[some]]] += table[rows[first[some] + eights[some] + k]]
        n, first = eights[eights > 0], first[eights > 0]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        table = _row_sums(rows[at].reshape(-1, 8), table)
        to, rows = to[at[::8]], np.arange(len(table))


def _with_blank(table: np.ndarray) -> np.ndarray:
    """The table with a row of zeros for FEATURES."""
    return np.concatenate([table, np.zeros((1, *table.shape[1:]), table.dtype)])


@dataclass
class Space:
    table: np.ndarray  # FEATURES x rank: a word's part of a passage's latent vector
    idf: np.ndarray


def _square_norms(pairs: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Squared length of each window's TF-IDF vector: a feature that occurs n
    times counts n * n = n + 2 * (its pairs) times its squared idf."""
    f = np.sort(pairs, axis=1)
    out = squares[f].sum(axis=1)
    row, at = np.nonzero((f[:, 1:] == f[:, :-1]) & (f[:, 1:] < FEATURES))
    lag = 1
    while len(row):
        out += 2 * np.bincount(row, weights=squares[f[row, at]], minlength=len(f))
        lag += 1
        ok = at + lag < f.shape[1]
        row, at = row[ok], at[ok]
        ok = f[row, at] == f[row, at + lag]
        row, at = row[ok], at[ok]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], table: np.ndarray, squares: np.ndarray) -> Iterator[tuple]:
    """(words of chunks, the product of the window that each starts with the
    table, that window's squared length, the chunks that start one, and those
    of them that another chunk of the text follows), in blocks."""
    for f, ends in _feature_runs(batches):
        c = _chunks(f, ends)
        for lo in range(0, len(c.words), RUN_WORDS // CHUNK):
            here = slice(lo, lo + RUN_WORDS // CHUNK + 1)
            words, more, starts = c.words[here], c.more[here].copy(), c.windows[here].copy()
            if len(words) > RUN_WORDS // CHUNK:  # a chunk that only ends the last window; its own is the next block's
                more[-1] = starts[-1] = False
            y = _row_sums(words, table)
            after = np.flatnonzero(more)
            y[after] += y[after + 1]  # two chunks, as they were before
            pairs = np.full((len(words), 2 * CHUNK), FEATURES, np.uint16)
            pairs[:, :CHUNK] = words
            pairs[after, CHUNK:] = words[after + 1]
            yield words, y, np.maximum(_square_norms(pairs[starts], squares), 1e-12), np.flatnonzero(starts), after


def _tables(features: DataFrame, idf: np.ndarray, basis: np.ndarray):
    return features.sparkSession.sparkContext.broadcast((_with_blank((idf[:, None] * basis).astype(np.float32)), _with_blank(idf ** 2)))


def _normal_product(features: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the matrix A of all passages, rows of length 1; the
    partitions' products are added before they reach the driver."""
    held = _tables(features, idf, basis)

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(held.value[0].shape, np.float32)
        for words, g, norms, starts, after in _blocks(batches, *held.value):
            scale = np.zeros(len(g), np.float32)
            scale[starts] = 1 / norms
            g *= scale[:, None]
            y = g[after]
            g[after + 1] += y  # sum over the windows that hold the chunk
            words = words.ravel()
            order = np.argsort(words, kind="stable")
            order = order[:len(order) - int((words == FEATURES).sum())]
            _add_rows(out, words[order], order // CHUNK, g)
        return out[:FEATURES]

    total = matrix_sum(features, part, basis.shape, np.float32)
    held.destroy()
    return idf[:, None] * total


def _small_product(features: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(A basis)'(A basis): ``basis.T @ _normal_product``, by one product."""
    held = _tables(features, idf, basis)
    width = basis.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((width, width))
        for _, y, norms, starts, _ in _blocks(batches, *held.value):
            y = y[starts] / np.sqrt(norms)[:, None].astype(np.float32)
            out += y.T @ y
        return out

    total = matrix_sum(features, part, (width, width))
    held.destroy()
    return total


def fit(docs: DataFrame, text_col: str = "text", rank: int = RANK) -> Space:
    """Document frequencies and axes from the passages of the whole corpus."""
    features = featured(docs, text_col)
    df, count = document_frequencies(features)
    idf = np.log((1 + count) / (1 + df)) + 0.05
    width = rank + EXTRA
    basis, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((FEATURES, width)))
    for _ in range(2):  # power steps
        basis, _ = np.linalg.qr(_normal_product(features, idf, basis))
    small = _small_product(features, idf, basis)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-value)[:rank]
    keep = keep[value[keep] > 1e-9 * max(value.max(initial=0), 1e-30)]
    axes = basis @ vector[:, keep] / np.sqrt(value[keep])
    return Space((idf[:, None] * axes).astype(np.float32), idf.astype(np.float32))


def common_subsequence(words: list[bytes], masks: dict[bytes, int], size: int) -> int:
    """Length of the longest common subsequence of ``words`` and an item whose
    word positions are ``masks``; bit-parallel."""
    full = (1 << size) - 1
    row = full
    for w in words:
        m = masks.get(w, 0)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Items:
    ids: list
    words: list[list[bytes]]
    masks: list[dict[bytes, int]]
    answers: list[tuple[dict[bytes, int], int]]
    scales: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # of each chunk size: items, their passages' vectors, first passages
    sizes: np.ndarray  # words of each item
    counts: np.ndarray  # items x FEATURES + 1, how many of the item's words have the feature
    answer_sizes: np.ndarray
    answer_counts: np.ndarray


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _items(rows: list, space: Space) -> Items:
    ids, words, answers, answer_words = [], [], [], []
    for item, text, answer in rows:
        w = words_of(text)
        if w:
            a = words_of(answer) if answer is not None else w[-ANSWER_WORDS:]
            ids.append(item)
            words.append(w)
            answers.append((_masks(a), len(a)))
            answer_words.append(a)
    features = [_features(w) for w in words]
    sizes, answer_sizes = (np.array([len(w) for w in x], np.int64) for x in (words, answer_words))
    return Items(ids, words, [_masks(w) for w in words], answers, _scales(features, space), sizes, _counts(features), answer_sizes,
                 _counts([_features(a) for a in answer_words]))


def _scales(features: list[np.ndarray], space: Space) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    chunk = [min(CHUNK, 1 << len(f).bit_length() - 1) for f in features]
    out = []
    for size in sorted(set(chunk)):
        mine = [i for i, c in enumerate(chunk) if c == size]
        vectors, first = [], []
        for i in mine:
            f, last = features[i], max(0, len(features[i]) - 2 * size)
            first.append(len(vectors))
            vectors += [space.table[f[a:a + 2 * size]].sum(axis=0) for a in sorted({*range(0, last, size), last})]
        out.append((size, np.array(mine), _unit(np.array(vectors, np.float32)), np.array(first)))
    return out


def _counts(features: list[np.ndarray]) -> np.ndarray:
    most = max((len(f) for f in features), default=0)
    out = np.zeros((len(features), FEATURES + 1), np.min_scalar_type(most))
    for i, f in enumerate(features):
        np.add.at(out[i], f, 1)
    return out


def _previous(features: np.ndarray) -> np.ndarray:
    """Where each position's feature occurred last before it, or -1."""
    order = np.argsort(features, kind="stable")
    out = np.full(len(features), -1, np.int64)
    again = features[order[1:]] == features[order[:-1]]
    out[order[1:][again]] = order[:-1][again]
    return out


def _held(features: np.ndarray, previous: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray,
          counts: np.ndarray) -> np.ndarray:
    """For each (region, item): how many of the item's words, by ``counts``,
    occur in the region."""
    out = np.zeros(len(item), np.int64)
    flat, width = counts.ravel(), counts.shape[1]
    order = np.argsort(end - start, kind="stable")
    at = 0
    while at < len(order):
        here = order[at:at + max(1, PAIR_WORDS // int((end - start)[order[min(at + PAIR_PAIRS, len(order)) - 1]]))][:PAIR_PAIRS]
        at += len(here)
        place = start[here, None] + np.arange((end[here] - start[here]).max())
        ok = place < end[here, None]
        place = np.minimum(place, len(features) - 1)
        ok &= previous[place] < start[here, None]  # a word counts once
        f = np.where(ok, features[place], FEATURES)
        out[here] = flat[item[here, None] * width + f].sum(axis=1, dtype=np.int64)
    return out


def _bounds(features: np.ndarray, previous: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray,
            items: Items) -> tuple[np.ndarray, np.ndarray]:
    """For each (region, item): how many of the item's words, and of its
    answer's, occur in the region; at least their common subsequence."""
    return tuple(_held(features, previous, start, end, item, c) for c in (items.counts, items.answer_counts))


def item_blocks(benchmark: DataFrame, space: Space, id_col: str = "item_id", text_col: str = "text",
                answer_col: str | None = None) -> Iterator[Items]:
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"), answer.alias("answer"))
    parts = max(1, -(-rows.count() // ITEM_BLOCK))
    for p in range(parts):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p
        yield _items([tuple(r) for r in rows.where(mine).orderBy("item_id", "text").collect()], space)


def _near(chunks: Chunks, vectors: np.ndarray, first: np.ndarray, table: np.ndarray, near: float) -> Iterator[tuple]:
    """(chunk that starts a window, place of an item) of the windows near an
    item, in blocks of bounded size."""
    step = max(64, min(4096, (1 << 23) // len(vectors)))
    for lo in range(0, len(chunks.words), step):
        sums = _row_sums(chunks.words[lo:lo + step + 1], table)
        start = np.flatnonzero(chunks.windows[lo:lo + step])
        windows = sums[start]
        two = chunks.more[lo:lo + step][start]
        windows[two] += sums[start[two] + 1]
        at, passage = np.nonzero(_unit(windows) @ vectors.T >= near)
        item = np.searchsorted(first, passage, "right") - 1
        once = np.concatenate([[True], (at[1:] != at[:-1]) | (item[1:] != item[:-1])])[:len(at)]  # an item's passages are neighbours
        yield start[at[once]] + lo, item[once]


def found_in(texts: list[str | None], items: Items, space: Space, near: float = NEAR, verbatim: float = VERBATIM,
             paraphrase: float = PARAPHRASE) -> list[list[tuple]]:
    """For each text (item index, share of the item, share of the answer, first
    word, words) of the items found in it, best window each."""
    best: list[dict[int, tuple]] = [{} for _ in texts]
    features, ends = _hashed(texts)
    if not len(features) or not items.ids:
        return [[] for _ in texts]
    table = _with_blank(space.table)
    previous = _previous(features)
    words, of = [], -1
    for chunk, mine, vectors, first in items.scales:
        chunks = _chunks(features, ends, chunk)
        for at, item in _near(chunks, vectors, first, table, near):
            item = mine[item]
            text, number = chunks.text[at], chunks.number[at]
            size = items.sizes[item]
            around = size + CHUNK - chunk  # regions have the same length at each chunk size
            start = ends[text] + np.maximum(0, number * chunk - around)
            end = np.minimum(ends[text + 1], ends[text] + (number + 2) * chunk + around)
            whole = _held(features, previous, start, end, item, items.counts)
            ok = np.flatnonzero(whole >= paraphrase * size)
            part = _held(features, previous, start[ok], end[ok], item[ok], items.answer_counts)
            ok = ok[(whole[ok] >= verbatim * size[ok]) | (part >= ANSWER * items.answer_sizes[item[ok]])]
            start, end = start - ends[text], end - ends[text]
            for t, i, n, a, b, most in zip(*(x[ok].tolist() for x in (text, item, size, start, end, whole))):
                if i in best[t] and best[t][i][1] >= most / n:
                    continue
                if t != of:
                    words, of = words_of(texts[t]), t
                region = words[a:b]
                share = common_subsequence(region, items.masks[i], n) / n
                if share < paraphrase or i in best[t] and best[t][i][1] >= share:
                    continue
                amasks, size_ = items.answers[i]
                answer = common_subsequence(region, amasks, size_) / size_ if size_ else 1.0
                if share >= verbatim or answer >= ANSWER:
                    best[t][i] = (i, share, answer, a, len(region))
    return [list(b.values()) for b in best]


def matches(text: str | None, items: Items, space: Space, near: float = NEAR, verbatim: float = VERBATIM,
            paraphrase: float = PARAPHRASE) -> list[tuple]:
    """The items found in one text, as in ``found_in``."""
    return found_in([text], items, space, near, verbatim, paraphrase)[0]


def contaminated(docs: DataFrame, benchmark: DataFrame, space: Space | None = None, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None) -> DataFrame:
    """(doc_id, item_id, share, answer_share, first_word, words) of every
    document and benchmark item found in it."""
    space = space or fit(docs, text_col)
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, share double, answer_share double, first_word long, words long"
    out = None
    for items in item_blocks(benchmark, space, item_col, item_text, answer_col):
        held = sc.broadcast((items, space))  # ITEM_BLOCK items and FEATURES x RANK floats

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items, space = held.value
            for b in batches:
                found = [m for texts in _text_runs(iter([b]), 1) for m in found_in(texts, items, space)]
                rows = [(doc, items.ids[m[0]], *m[1:]) for doc, ms in zip(b.column(0).to_pylist(), found) for m in ms]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["doc_id", "item_id", "share", "answer_share", "first_word", "words"])

        found = src.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, space: Space | None = None, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None) -> DataFrame:
    """``docs`` without the rows in which a benchmark item is found."""
    space = space or fit(docs, text_col)
    at, out = docs.columns.index(text_col), docs
    for items in item_blocks(benchmark, space, item_col, item_text, answer_col):
        held = docs.sparkSession.sparkContext.broadcast((items, space))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items, space = held.value
            for b in batches:
                yield b.filter(pa.array([not m for texts in _text_runs(iter([b]), at) for m in found_in(texts, items, space)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out

"""Word-wise encoding equals the tokenizer library's."""

from __future__ import annotations

import numpy as np
import pytest

from rankfold.llm import tokens
from rankfold.llm.queries import tokenizer_path

MARKS = [".", ",", "...", "***", "&&&", ".$$$", "'", "''", "')", "\"'", "_", "{}~", "!!", "<|", "|>", "@", "`", "^\\"]
BODIES = ["word", "Word", "straße", "ÄRGER", "ciónnar", "don't", "we'll", "x1", "1", "a.b", "éa", "漢字", "İz", "o'", ""]


@pytest.mark.parametrize("group", [1, 40, 2_000_000])
def test_words_with_final_marks_equal_the_library(monkeypatch, group):
    monkeypatch.setattr(tokens, "GROUP_BYTES", group)
    enc = tokens.Encoder(tokenizer_path())
    texts = [b + m for b in BODIES for m in MARKS] + [" ".join(b + m for b in BODIES) for m in MARKS] + ["", " \n", "a <|endoftext|> b."]
    want = [np.array(enc.exact.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode([t.encode() for t in texts]) == want
    assert enc.encode([None, *[t.encode() for t in texts]]) == [b"", *want]


def test_words_with_final_marks_are_not_encoded_one_by_one(monkeypatch):
    enc = tokens.Encoder(tokenizer_path())
    asked = []

    class Counting:
        def encode(self, text, **kw):
            return exact.encode(text, **kw)

        def encode_batch_fast(self, some, **kw):
            asked.extend(some)
            return exact.encode_batch_fast(some, **kw)

    exact, enc.exact = enc.exact, Counting()
    enc.encode([b"plain*** wide&&& other.$$$ one! 12 a.b"])
    assert sorted(asked) == ["12", "a.b"]


def test_rare_words_leave_and_the_ids_stay(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 20)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 64)
    enc = tokens.Encoder(tokenizer_path())
    texts = [" ".join(f"{'abcdefghij'[(k * j) % 10]}{'klmnopqrst'[(k + j) % 10]}en." for j in range(12)) for k in range(60)]
    want = [np.array(enc.exact.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode([t.encode() for t in texts]) == want


def test_words_of_a_group_end_at_ascii_white_space_only():
    texts = [b" a b\x0b\x0ca ", b"", b"\t\n", "b c\u0085 \x1c a".encode(), b"a"]
    words, place, ends = tokens._words(texts)
    assert sorted(words) == sorted({w for t in texts for w in t.split()})
    assert [[words[k] for k in place[lo:hi]] for lo, hi in zip(ends[:-1], ends[1:])] == [t.split() for t in texts]
    assert tokens._words([b"", b" "])[0] == [] and tokens._words([b"x"])[1].tolist() == [0]

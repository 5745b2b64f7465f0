"""Language vectors against a plain count of every n-gram."""

import numpy as np

from rankfold.llm import langid as L


def _plain(text: str) -> np.ndarray:
    raw = b" " + text.lower().encode("utf-8", "replace").translate(L.FOLD) + b" "
    out = np.zeros(L.DIMS, np.int64)
    for n in L.GRAMS:
        for at in range(len(raw) - n + 1):
            if raw[at:at + 2] == b"  ":
                continue
            h = 0
            for i in range(n):
                h = (h * 0x01000193 + raw[at + i] + i + 1) % 2**32
            out[(h * 0x9E3779B1 % 2**32) >> 20] += 1
    return out


def test_vectors_and_their_sums_equal_plain_ones():
    texts = ["Ein Satz, noch ein Satz.", "", "aaaa " * 40, "été  à   Paris", "Ж"]
    idf = np.linspace(0.1, 2, L.DIMS).astype(np.float32)
    want = np.array([_plain(t) for t in texts])
    assert (np.concatenate([L.counts([t]) for t in texts]) == want).all()
    v = np.log1p(want).astype(np.float32) * idf
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    assert np.allclose(np.concatenate([L.vectors([t], idf) for t in texts]), v, rtol=1e-6, atol=0)
    which, sums = np.array([2, 0, 2, 1, 2]), np.zeros((4, L.DIMS))
    np.add.at(sums, which, v)
    assert (L._sums_by(which, v, 4) == sums).all()

"""Decontamination over runs of texts gives what one text at a time gives."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from rankfold.llm import decontam

SIZES = [0, 1, 15, 16, 17, 31, 32, 33, 48, 200, 0, 5, 700]


def texts() -> list[str | None]:
    rng = np.random.default_rng(3)
    out = [" ".join(f"w{k}" for k in rng.zipf(1.3, n) % 400) for n in SIZES]
    return [None, "Ärger, İstanbul; a_b\tc!", *out, "again " * 90, " ... "]


def rows_of_windows(text: str | None, idf: np.ndarray) -> list[np.ndarray]:
    f = decontam._features(decontam.words_of(text))
    starts = range(0, max(1, len(f) - decontam.CHUNK), decontam.CHUNK) if len(f) else []
    rows = [np.bincount(f[a:a + 2 * decontam.CHUNK], minlength=decontam.FEATURES) * idf for a in starts]
    return [r / np.linalg.norm(r) for r in rows]


@pytest.mark.parametrize("run_words", [16, 64, 1 << 17])
def test_products_equal_the_dense_matrix(monkeypatch, run_words):
    monkeypatch.setattr(decontam, "RUN_WORDS", run_words)
    features = [decontam._features(decontam.words_of(t)).astype("<u2").tobytes() for t in texts()]
    batches = [pa.record_batch([pa.array(part, pa.binary())], names=["features"]) for part in (features[:6], features[6:])]
    monkeypatch.setattr(decontam, "matrix_sum", lambda rows, part, shape, dtype=None: part(iter(batches)))
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value, destroy=lambda: None))
    frame = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context))
    rng = np.random.default_rng(4)
    idf, basis = rng.random(decontam.FEATURES) + 0.5, rng.standard_normal((decontam.FEATURES, 5))
    a = np.array([r for t in texts() for r in rows_of_windows(t, idf)])
    assert np.allclose(decontam._normal_product(frame, idf, basis), a.T @ (a @ basis), rtol=1e-4, atol=1e-3)
    assert np.allclose(decontam._small_product(frame, idf, basis), (a @ basis).T @ (a @ basis), rtol=1e-4, atol=1e-3)


def test_document_frequencies_count_every_text_once(spark):
    all_texts = texts()
    df, count = decontam.document_frequencies(decontam.featured(spark.createDataFrame([(t,) for t in all_texts], "text string")))
    want = np.zeros(decontam.FEATURES, np.int64)
    for t in all_texts:
        want[np.unique(decontam._features(decontam.words_of(t)))] += 1
    assert count == len(all_texts) and (df == want).all()


def test_items_found_in_a_run_are_those_found_in_each_text():
    rng = np.random.default_rng(5)
    table = rng.standard_normal((decontam.FEATURES, 24)).astype(np.float32)
    space = decontam.Space(table, np.ones(decontam.FEATURES, np.float32))
    rows = [(k, " ".join(f"i{k}x{j}" for j in range(n)), None) for k, n in enumerate([3, 9, 24, 40, 90])]
    items = decontam._items(rows, space)
    around = texts()
    some = [t if k % 3 else f"{t or ''} {rows[k % len(rows)][1]} {around[-3]}" for k, t in enumerate(around * 2)]
    together = decontam.found_in(some, items, space)
    assert together == [decontam.matches(t, items, space) for t in some]
    assert all(k % len(rows) in {m[0] for m in together[k]} for k in range(0, len(some), 3))

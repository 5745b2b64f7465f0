"""Models are fitted on every row that they may learn from."""

import zlib

import numpy as np

from rankfold.llm import decontam, langid, packing
from rankfold.llm.matrices import matrix_sum


def test_matrix_sum_adds_every_partition(spark):
    def part(batches):
        out = np.zeros((130, 3))
        for b in batches:
            for x in b.column(0).to_pylist():
                out[x % 130] += [1, x, x * x]
        return out

    want = np.zeros((130, 3))
    for x in range(1000):
        want[x % 130] += [1, x, x * x]
    assert np.array_equal(matrix_sum(spark.range(1000).repartition(7), part, (130, 3)), want)
    assert not matrix_sum(spark.range(0), part, (130, 3)).any()


def test_language_model_learns_from_every_labelled_row(spark):
    rows = [(i, f"{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8 % 8]} {'stuvwxyz'[i // 64 % 8]}", "en") for i in range(3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, rounds=1)
    learned = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    df = sum((langid.counts(learned[at:at + 64]) > 0).sum(axis=0) for at in range(0, len(learned), 64))
    assert len(learned) > 2400
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + df)) + 0.1, atol=1e-5)


def test_axes_come_from_every_document(spark):
    rare = [f"rare{i}" for i in range(40)]
    texts = [f"alpha beta gamma {i % 15}" for i in range(4460)] + [f"alpha {w}" for w in rare]
    space = decontam.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    table = space.table[decontam._features([w.encode() for w in rare])]
    assert (np.abs(table).max(axis=1) > 1e-6).all()  # a word that the fit has not met has no part of a vector


def test_configuration_program_covers_every_piece():
    rnd = np.random.default_rng(5)
    hist = {int(n): int(k) for n, k in zip(rnd.choice(np.arange(1, 400), 120, replace=False), rnd.integers(1, 500, 120))}
    program = packing.fractional(hist, 400, rounds=50)
    cover = dict.fromkeys(hist, 0.0)
    for pattern, x in program:
        assert x > 0 and sum(n * k for n, k in pattern.items()) <= 400
        for n, k in pattern.items():
            cover[n] += k * x
    assert all(abs(cover[n] - k) < 1e-6 * k for n, k in hist.items())
    placed = sum(int(x + 1e-6) * sum(p.values()) for p, x in program)
    assert placed > 0.9 * sum(hist.values())
    assert sum(c for _, c in packing.plan(hist, 400, rounds=50)) <= sum(c for _, c in packing.best_fit(hist, 400))
    even = {n: 300 + n for n in range(5, 300)}
    made = sum(c for _, c in packing.plan(even, 400))
    assert made <= 1.0005 * sum(n * k for n, k in even.items()) / 400

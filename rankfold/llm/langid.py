"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (letters lower-cased, everything
else a blank), weighted by tf-idf and normalised.  Every language has several
centroids, clustered by cosine (spherical k-means) over all labelled rows; a
text takes the language of the nearest centroid.  A text is rejected when it is farther from that centroid than ``slack`` times the
distance that ``QUANTILE`` of the centroid's own rows stays within, or has
no letters.

Every labelled row that is not held out is learned from, in every round; the
model (idf and centroids) is all that reaches the driver.

Edge cases: a null text or one without letters is ``und`` with score 0 and
rejected; with no labelled rows every text is ``und``; a null doc_id is never
learned from; empty tables give no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.matrices import matrix_sum
from rankfold.llm.store import stored

DIMS, GRAMS = 4096, (1, 2, 3, 4)
CLUSTERS, ROUNDS, SEED = 3, 5, 17
QUANTILE, SLACK = 0.99, 1.25
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Blank out ASCII that is not a letter; bytes of other characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Model:
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIMS, np.float32))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS), np.float32))
    langs: list[str] = field(default_factory=list)  # of each centroid
    reach: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))  # largest distance accepted


def counts(texts: list[str]) -> np.ndarray:
    """n-gram counts of each text, one row per text."""
    raw = [b" " + t.lower().encode("utf-8", "replace").translate(FOLD) + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    size = np.array([len(r) for r in raw], np.int64)
    owner = np.repeat(np.arange(len(raw), dtype=np.int64) * DIMS, size)
    slots = []
    blank = np.r_[(data[:-1] == 32) & (data[1:] == 32), False]  # runs of blanks count once
    h = np.zeros(len(data), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        h = h[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1:] + np.uint32(n)
        if n in GRAMS:
            mixed = h * np.uint32(0x9E3779B1)
            same = (owner[: len(h)] == owner[n - 1:]) & ~blank[: len(h)]
            slot = owner[: len(h)] + (mixed >> np.uint32(32 - 12)).astype(np.int64)
            slots.append(slot[same])
    return np.bincount(np.concatenate(slots), minlength=len(raw) * DIMS).reshape(len(raw), DIMS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    n = counts(texts)
    v = np.log1p(np.arange(n.max(initial=0) + 1)).astype(np.float32)[n] * idf  # few counts differ
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _sums_by(which: np.ndarray, v: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of ``v`` that share a number below ``rows``."""
    out = np.zeros((rows, v.shape[1]))
    for k in np.unique(which):
        out[k] = v[which == k].sum(axis=0, dtype=np.float64)
    return out


def _groups(texts: list[str]) -> Iterator[slice]:
    """Runs of up to 64 texts and about a megabyte."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and to - at < 64 and size < 1_000_000:
            size += len(texts[to])
            to += 1
        yield slice(at, to)
        at = to


def held_out(doc_id: Column) -> Column:
    """Rows kept for measuring: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of the rows to learn from, written once for all rounds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    labelled = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    return stored(labelled.where(F.col("text").rlike(r"\p{L}")).select("lang", "text"), "lang-rows")


def _sums(labelled: DataFrame, per_group, rows: int) -> np.ndarray:
    """Sum over the labelled rows of ``per_group(langs, texts)`` (rows x DIMS)."""
    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((rows, DIMS))
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for g in _groups(texts):
                total += per_group(langs[g], texts[g])
        return total

    return matrix_sum(labelled.select("lang", "text"), part, (rows, DIMS))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Model:
    labelled = _labelled(docs, id_col, text_col, lang_col)
    size = labelled.count()
    if not size:
        return Model()
    df = _sums(labelled, lambda _, texts: (counts(texts) > 0).sum(axis=0, keepdims=True), 1)[0]
    idf = (np.log((1 + size) / (1 + df)) + 0.1).astype(np.float32)
    # First centroids: some texts of each language.
    seeds = labelled.groupBy("lang").agg(*[
        F.min_by("text", F.xxhash64("text", F.lit(SEED + i))).alias(f"t{i}") for i in range(clusters)])
    langs, texts = [], []
    for r in sorted(seeds.collect(), key=lambda r: r["lang"]):
        for t in sorted({r[f"t{i}"] for i in range(clusters)}):
            langs.append(r["lang"])
            texts.append(t)
    centroids = np.concatenate([vectors(texts[g], idf) for g in _groups(texts)])
    names = np.array(langs)

    def nearest(own: list[str], v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cos = v @ c.T
        cos[np.array(own)[:, None] != names[None, :]] = -1  # centroids of its own language
        return cos.argmax(axis=1), cos.max(axis=1)

    for _ in range(rounds):
        def add(own: list[str], texts: list[str], c=centroids) -> np.ndarray:
            v = vectors(texts, idf)
            return _sums_by(nearest(own, v, c)[0], v, len(names))

        total = _sums(labelled, add, len(names))
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(norm > 0, total / np.maximum(norm, 1e-12), centroids).astype(np.float32)

    def spread(own: list[str], texts: list[str]) -> np.ndarray:
        which, cos = nearest(own, vectors(texts, idf), centroids)
        out = np.zeros((len(names), DIMS))  # histogram of the distances
        np.add.at(out, (which, np.clip((1 - cos) * DIMS, 0, DIMS - 1).astype(int)), 1)
        return out

    hist = _sums(labelled, spread, len(names)).cumsum(axis=1)
    far = (hist < QUANTILE * hist[:, -1:]).sum(axis=1) + 1
    return Model(idf, centroids, langs, np.minimum(SLACK * far / DIMS, 0.98).astype(np.float32))


def judge(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text; score is the cosine."""
    langs, score, out = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    at = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    if model.langs:
        full = [texts[i] for i in at]
        for g in _groups(full):
            cos = vectors(full[g], model.idf) @ model.centroids.T
            best = cos.argmax(axis=1)
            for i, k, s in zip(at[g], best, cos.max(axis=1)):
                langs[i], score[i] = model.langs[k], min(1.0, max(0.0, float(s)))
                out[i] = 1 - s > model.reach[k]
    return langs, score, out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x DIMS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, score, out = judge(held.value, b.column(1).to_pylist())
            yield pa.record_batch([b.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(out)],
                                  names=["doc_id", "lang_pred", "score", "rejected"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~judge(held.value, b.column(at).to_pylist())[2]))

    return docs.mapInArrow(run, docs.schema)

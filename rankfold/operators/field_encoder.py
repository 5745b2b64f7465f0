"""Fit/transform of many fields by one vocabulary table and one join (E3, E19),
as a Spark ML estimator, and sparse vectors from its ids (L4, L5).

All categorical and sequence fields share one vocabulary table (field, token,
id), ids 1..n of a field by descending count then token.  The vocabulary is a
table from fit to saved model: the driver holds its size per field, and the
tokens of the fields of ``LOOKUP`` tokens at most.

A row stays one row: the tokens of those fields become ids where the row is,
packed in 16 bits; every other field is one join of the rows with its
vocabulary, broadcast up to ``BROADCAST`` tokens.  Rows of one key are folded
into one at the end (largest id of a field, sequences merged by position, the
rest from the first).  Only where a sequence has a larger vocabulary are rows
unpivoted to (row key, field, position, token), joined with the table once and
folded back by row key.

A null or unseen category gets the field's OOV id (n + 1); in a sequence a null
or empty token is PAD (0).  Ids leave room for them, so that field f with
vocabulary size s takes s + 1 slots of the sparse vector.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from rankfold.functions.lists import pad_sequence, split_tokens
from rankfold.operators.index import global_index
from rankfold.session import ensure_checkpoint_dir

LOOKUP = 4_096  # tokens of a field that every task may hold; ids fit 16 bits
BROADCAST = 500_000  # tokens of a field whose vocabulary may be broadcast

def _exploded(df: DataFrame, key: Sequence[str], categorical: Sequence[str], sequences: dict, keep: Sequence[str] = (),
              cut: bool = False) -> DataFrame:
    """(key, _f, _p, _t[, _keep]): one row per category or sequence element.
    ``cut`` leaves the last ``max_len`` elements of a sequence only."""
    empty = F.lit(None).cast("string")
    one = [F.struct(F.lit(i).alias("_f"), F.lit(0).alias("_p"), F.col(c).cast("string").alias("_t")) for i, c in enumerate(categorical)]
    cells = F.array(*one) if one else F.array().cast("array<struct<_f:int,_p:int,_t:string>>")
    for j, (c, opt) in enumerate(sequences.items(), len(categorical)):
        items = split_tokens(F.col(c), opt.get("splitter", " "))
        if cut:
            n = int(opt["max_len"])
            items = F.slice(items, F.greatest(F.lit(1), F.size(items) - n + 1), n)
        cells = F.concat(cells, F.coalesce(F.transform(items, _cell(j)), F.array().cast("array<struct<_f:int,_p:int,_t:string>>")))
    if not keep:
        return df.select(*key, F.inline(cells))
    # The first row of a key carries the columns that are not encoded.
    first = F.array(F.struct(F.lit(-1).alias("_f"), F.lit(0).alias("_p"), empty.alias("_t")))
    rows = df.select(*key, F.struct(*keep).alias("_rest"), F.inline(F.concat(first, cells)))
    return rows.withColumn("_rest", F.when(F.col("_f") == -1, F.col("_rest")))


def _cell(field: int):
    # two arguments exactly: transform() looks at the signature
    return lambda token, place: F.struct(F.lit(field).alias("_f"), place.alias("_p"), token.alias("_t"))


def _packed_rows(small: list[str], seqs: list[str], tokens: dict[str, pa.Array]):
    """Ids of the small fields, two bytes each in one column, and of every
    sequence's elements in another; the other columns stay."""
    def ids(column: pa.Array, known: pa.Array) -> pa.Array:
        place = pc.index_in(column.cast(pa.string()), value_set=known)
        return pc.cast(pc.fill_null(pc.add(place, 1), len(known) + 1), pa.uint16())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            rest = [(name, b.column(name)) for name in b.schema.names if name not in small and name not in seqs]
            cells = np.stack([ids(b.column(c), tokens[c]).to_numpy() for c in small], axis=1) if small else np.zeros((n, 0), np.uint16)
            ends = [pa.py_buffer((np.arange(n + 1) * 2 * len(small)).astype(np.int32))]
            columns = [pa.Array.from_buffers(pa.binary(), n, [None, *ends, pa.py_buffer(np.ascontiguousarray(cells))])]
            for c in seqs:
                flat = b.column(c).flatten()
                blank = pc.or_kleene(pc.is_null(flat), pc.fill_null(pc.equal(flat, ""), True))
                found = pc.if_else(blank, pa.scalar(0, pa.uint16()), ids(flat, tokens[c])).to_numpy()
                sizes = pc.fill_null(pc.list_value_length(b.column(c)), 0).to_numpy()
                at = pa.py_buffer(np.r_[0, 2 * sizes.cumsum(dtype=np.int64)].astype(np.int32))
                columns.append(pa.Array.from_buffers(pa.binary(), n, [None, at, pa.py_buffer(np.ascontiguousarray(found))]))
            yield pa.RecordBatch.from_arrays([*[x for _, x in rest], *columns], names=[*[x for x, _ in rest], "_small", *[f"_seq_{c}" for c in seqs]])

    return run


def _one_row_a_key(key: list[str], rest: list[str], cats: list[str], small: list[str], seqs: list[str]):
    """Folds the rows of a key, which lie side by side, and unpacks the ids."""
    def changes(table: pa.Table) -> np.ndarray:
        """Where a row's key is not that of the row before."""
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in key:
            column = table.column(k).combine_chunks()
            a, b = column[1:], column[:-1]
            same = pc.fill_null(pc.equal(a, b), False)
            same = pc.or_(same, pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True)))
            new[1:] |= ~same.to_numpy(zero_copy_only=False)
        return new

    def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """16-bit numbers of a binary column, and how many each row has."""
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        return np.frombuffer(data, np.uint16)[ends[0] // 2:ends[-1] // 2] if data else np.zeros(0, np.uint16), np.diff(ends) // 2

    def fold(table: pa.Table) -> pa.RecordBatch:
        starts = np.flatnonzero(changes(table))
        many, n = len(starts) < table.num_rows, table.num_rows
        group = np.searchsorted(starts, np.arange(n), side="right") - 1 if many else None
        top = (lambda x: np.maximum.reduceat(x, starts)) if many else (lambda x: x)
        cells = words(table.column("_small").combine_chunks())[0].reshape(n, len(small)).astype(np.int64)
        firsts = table.select([*key, *rest]).take(pa.array(starts)) if many else table.select([*key, *rest])
        out = [x.combine_chunks() for x in firsts.columns]
        for c in cats:
            out.append(pa.array(top(cells[:, small.index(c)] if c in small else table.column(c).to_numpy())))
        for c in seqs:
            found, sizes = words(table.column(f"_seq_{c}").combine_chunks())
            if many:
                place = np.arange(len(found)) - np.repeat(sizes.cumsum() - sizes, sizes)
                found = found[np.lexsort((found, place, np.repeat(group, sizes)))]
                sizes = np.add.reduceat(sizes, starts)
            out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, sizes.cumsum()].astype(np.int32)), pa.array(found.astype(np.int64))))
        return pa.RecordBatch.from_arrays(out, names=[*key, *rest, *cats, *seqs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # rows of the last key so far
        for b in batches:
            if not b.num_rows:
                continue
            seen = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), b] if held else [b])
            last = int(np.flatnonzero(changes(seen))[-1]) - bool(held)
            if held and last < 0:  # all of the key that is held
                held.append(b)
                continue
            if held or last > 0:
                yield fold(pa.Table.from_batches([*held, b.slice(0, last)]))
            held = [b.slice(last)]
        if held:
            yield fold(pa.Table.from_batches(held))

    return run


class _FieldParams(Params):
    keyCols = Param(Params._dummy(), "keyCols", "columns that identify a row", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "categorical fields", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "numeric fields, scaled to [0, 1] of the fitted rows", TypeConverters.toListString)
    sequences = Param(Params._dummy(), "sequences", "JSON: sequence field -> splitter, max_len", TypeConverters.toString)
    minCount = Param(Params._dummy(), "minCount", "least count of a token", TypeConverters.toInt)

    def _specs(self) -> tuple[list[str], list[str], list[str], dict]:
        return (self.getOrDefault(self.keyCols), self.getOrDefault(self.categorical), self.getOrDefault(self.numeric),
                json.loads(self.getOrDefault(self.sequences)))


class FieldEncoder(Estimator, _FieldParams):
    """Fits one vocabulary table for all fields and the range of every number."""

    def __init__(self, keyCols: Sequence[str] = (), categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                 sequences: dict | None = None, minCount: int = 1) -> None:
        super().__init__()
        self._setDefault(keyCols=[], categorical=[], numeric=[], sequences="{}", minCount=1)
        self._set(keyCols=list(keyCols), categorical=list(categorical), numeric=list(numeric),
                  sequences=json.dumps(sequences or {}), minCount=minCount)

    def _fit(self, dataset: DataFrame) -> FieldEncoderModel:
        spark = dataset.sparkSession
        key, cats, nums, seqs = self._specs()
        # Longest sequence where none is given, and the ranges: one aggregate.
        asked = [c for c, o in seqs.items() if not o.get("max_len")]
        aggs = [F.max(F.size(split_tokens(F.col(c), seqs[c].get("splitter", " ")))).alias(f"len_{c}") for c in asked]
        aggs += [e for c in nums for e in (F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}"))]
        row = dataset.agg(*aggs).first() if aggs else {}
        for c in asked:
            seqs[c]["max_len"] = max(1, int(row[f"len_{c}"] or 1))
        ranges = {c: [row[f"lo_{c}"], row[f"hi_{c}"]] for c in nums}
        counts = (_exploded(dataset, [], cats, seqs).where("_t IS NOT NULL").groupBy("_f", "_t")
                  .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= self.getOrDefault(self.minCount)))
        if seqs:
            counts = counts.where((F.col("_f") < len(cats)) | (F.col("_t") != ""))
        placed = global_index(counts, ["_f", F.desc("_n"), "_t"], "_i", 0)
        starts = {r["_f"]: (r["first"], r["n"]) for r in
                  placed.groupBy("_f").agg(F.min("_i").alias("first"), F.count(F.lit(1)).alias("n")).collect()}  # one row per field
        start = F.create_map(*[F.lit(x) for f, (first, _) in starts.items() for x in (f, first)]) if starts else F.create_map(
            F.lit(-1), F.lit(0)).cast("map<int,bigint>")
        vocab = placed.select("_f", "_t", (F.col("_i") - F.coalesce(F.element_at(start, F.col("_f")), F.lit(0)) + 1).alias("_id"), "_n")
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fields/{uuid.uuid4().hex}"
        vocab.write.parquet(path)
        sizes = {c: int(starts.get(i, (0, 0))[1]) for i, c in enumerate([*cats, *seqs])}
        model = FieldEncoderModel(spark.read.schema(vocab.schema).parquet(path), sizes, ranges)
        model._set(keyCols=key, categorical=cats, numeric=nums, sequences=json.dumps(seqs), minCount=self.getOrDefault(self.minCount))
        return model


class FieldEncoderModel(Model, _FieldParams, MLWritable, MLReadable):
    """``vocab`` (_f, _t, _id, _n), the vocabulary size of every field and the
    range of every numeric column."""

    def __init__(self, vocab: DataFrame, sizes: dict[str, int], ranges: dict[str, list]) -> None:
        super().__init__()
        self._setDefault(keyCols=[], categorical=[], numeric=[], sequences="{}", minCount=1)
        self.vocab, self.sizes, self.ranges = vocab, sizes, ranges

    def _lookups(self, fields: list[str]) -> dict[str, pa.Array]:
        """Tokens in order of their ids, of fields with few."""
        _, cats, _, seqs = self._specs()
        place = {i: c for i, c in enumerate([*cats, *seqs]) if c in fields}
        found = {c: [] for c in fields}
        for r in self.vocab.where(F.col("_f").isin(list(place))).select("_f", "_t", "_id").collect() if place else []:
            found[place[r["_f"]]].append((r["_id"], r["_t"]))
        return {c: pa.array([t for _, t in sorted(rows)], pa.string()) for c, rows in found.items()}

    def _folded(self, dataset: DataFrame) -> DataFrame:
        """Keys, columns that are not encoded and ids, one row a key."""
        key, cats, _, seqs = self._specs()
        rest = [c for c in dataset.columns if c not in key and c not in cats and c not in seqs]
        joined = [c for c in cats if self.sizes[c] > LOOKUP] or sorted(cats, key=self.sizes.get)[-1:]
        small = [c for c in cats if c not in joined]
        items = {}
        for c, opt in seqs.items():
            n, parts = int(opt["max_len"]), split_tokens(F.col(c), opt.get("splitter", " "))
            items[c] = F.slice(parts, F.greatest(F.lit(1), F.size(parts) - n + 1), n)
        rows = dataset.select(*key, *rest, *[F.col(c).cast("string").alias(c) for c in cats], *[i.alias(c) for c, i in items.items()])
        kept = [f for f in rows.schema if f.name not in small and f.name not in seqs]
        packed = [StructField(name, BinaryType()) for name in ["_small", *[f"_seq_{c}" for c in seqs]]]
        rows = rows.mapInArrow(_packed_rows(small, list(seqs), self._lookups([*small, *seqs])), StructType([*kept, *packed]))
        for c in joined:
            known = self.vocab.where(F.col("_f") == cats.index(c)).select(F.col("_t").alias("_vt"), F.col("_id").alias("_vid"))
            known = known.hint("broadcast" if self.sizes[c] <= BROADCAST else "shuffle_hash")
            rows = (rows.join(known, F.col(c) == F.col("_vt"), "left")
                    .withColumn(c, F.coalesce("_vid", F.lit(self.sizes[c] + 1).cast("long"))).drop("_vt", "_vid"))
        kinds = {f.name: f for f in rows.schema}
        out = [*[kinds[c] for c in [*key, *rest]], *[StructField(c, LongType()) for c in cats],
               *[StructField(c, ArrayType(LongType())) for c in seqs]]
        return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(
            _one_row_a_key(key, rest, cats, small, list(seqs)), StructType(out))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, cats, nums, seqs = self._specs()
        plain = key and all(self.sizes[c] <= LOOKUP for c in seqs)
        out = self._folded(dataset) if plain else self._by_cells(dataset)
        out = out.withColumns({c: pad_sequence(c, int(o["max_len"]), 0, padding="pre") for c, o in seqs.items()})
        scaled = {}
        for c in nums:
            lo, hi = self.ranges[c]
            width = (hi - lo) if lo is not None and hi is not None and hi != lo else 1.0
            scaled[c] = (F.col(c).cast("double") - F.lit(lo if lo is not None else 0.0)) / F.lit(width)
        return out.withColumns(scaled).select(*dataset.columns)

    def _by_cells(self, dataset: DataFrame) -> DataFrame:
        """As ``_folded``, by one row a category and sequence element."""
        key, cats, nums, seqs = self._specs()
        fields = [*cats, *seqs]
        rest = [c for c in dataset.columns if c not in key and c not in fields]
        cells = _exploded(dataset, key, cats, seqs, rest or key, cut=True)
        known = self.vocab.select(F.col("_f").alias("_vf"), F.col("_t").alias("_vt"), F.col("_id"))
        joined = cells.join(known, (F.col("_f") == F.col("_vf")) & (F.col("_t") == F.col("_vt")), "left")
        oov = F.create_map(*[x for i, c in enumerate(fields) for x in (F.lit(i), F.lit(self.sizes[c] + 1).cast("long"))])
        blank = (F.col("_f") >= len(cats)) & (F.col("_t").isNull() | (F.col("_t") == ""))
        value = F.when(blank, F.lit(0).cast("long")).otherwise(F.coalesce(F.col("_id"), F.element_at(oov, F.col("_f"))))
        joined = joined.withColumn("_e", value)
        aggs = [F.max(F.when(F.col("_f") == i, F.col("_e"))).alias(c) for i, c in enumerate(cats)]
        aggs += [F.array_sort(F.collect_list(F.when(F.col("_f") == j, F.struct("_p", "_e")))).alias(c)  # max_len elements at most
                 for j, c in enumerate(seqs, len(cats))]
        folded = joined.groupBy(*key).agg(F.first("_rest", ignorenulls=True).alias("_rest"), *aggs)
        return folded.select(*key, *([f"_rest.{c}" for c in rest]), *cats, *[F.transform(c, lambda x: x["_e"]).alias(c) for c in seqs])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: FieldEncoderModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        key, cats, nums, seqs = m._specs()
        meta = json.dumps({"key": key, "categorical": cats, "numeric": nums, "sequences": seqs, "sizes": m.sizes, "ranges": m.ranges,
                           "min_count": m.getOrDefault(m.minCount)})
        m.vocab.write.parquet(f"{path}/vocab")
        m.vocab.sparkSession.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/meta")


class _Reader(MLReader):
    def load(self, path: str) -> FieldEncoderModel:
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        vocab = spark.read.schema("_f int, _t string, _id long, _n long").parquet(f"{path}/vocab")
        model = FieldEncoderModel(vocab, meta["sizes"], meta["ranges"])
        model._set(keyCols=meta["key"], categorical=meta["categorical"], numeric=meta["numeric"],
                   sequences=json.dumps(meta["sequences"]), minCount=meta["min_count"])
        return model


def _vector_rows(cats: list[str], starts: list[int], numeric: Sequence[str], size: int, out: str):
    """Every row's sparse vector: the slots of its ids, then the numbers that are not 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [pc.cast(b.column(f"_id_{c}"), pa.int64()).to_numpy(zero_copy_only=False) + s for c, s in zip(cats, starts)]
            nums = [b.column(f"_num_{c}").to_numpy(zero_copy_only=False) for c in numeric]
            if any(np.isnan(x).any() for x in nums):
                raise ValueError("a number of the vector is NaN")
            n = b.num_rows
            at = [*ids, *[np.full(n, size - len(numeric) + i) for i in range(len(numeric))]]
            value = [*[np.ones(n) for _ in cats], *nums]
            at = np.stack(at, axis=1).astype(np.int32) if at else np.zeros((n, 0), np.int32)
            value = np.stack(value, axis=1) if value else np.zeros((n, 0))
            kept = value != 0
            ends = pa.array(np.r_[0, kept.sum(axis=1).cumsum()].astype(np.int32))
            vector = pa.StructArray.from_arrays([
                pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), pa.ListArray.from_arrays(ends, pa.array(at[kept])),
                pa.ListArray.from_arrays(ends, pa.array(value[kept]))], names=["type", "size", "indices", "values"])
            rest = [(name, b.column(name)) for name in b.schema.names if not name.startswith(("_id_", "_num_"))]
            yield pa.RecordBatch.from_arrays([*[c for _, c in rest], vector], names=[*[name for name, _ in rest], out])

    return run


def field_vectors(encoded: DataFrame, model: FieldEncoderModel, numeric: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Sparse one-hot vector of the categorical ids (column offsets in field
    order, one slot per id, PAD and OOV included) and the numeric columns.

    The column says how many slots there are and nothing about each: a name a
    slot, as Spark's one-hot encoder and assembler keep, would put the whole
    vocabulary into the plan."""
    _, cats, _, _ = model._specs()
    slots = [model.sizes[c] + 2 for c in cats]  # ids 0 .. size + 1
    starts = [sum(slots[:i]) for i in range(len(slots))]
    size = sum(slots) + len(numeric)
    source = encoded.drop(out).withColumns({f"_id_{c}": F.col(c).cast("long") for c in cats}
                                           | {f"_num_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric})
    rest = [f for f in source.schema if not f.name.startswith(("_id_", "_num_"))]
    field = StructField(out, VectorUDT(), True, {"ml_attr": {"num_attrs": size}})
    return source.mapInArrow(_vector_rows(cats, starts, list(numeric), size, out), StructType([*rest, field]))

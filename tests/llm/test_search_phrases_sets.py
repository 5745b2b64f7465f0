"""Ranked lexical search, phrase collocations and the Jaccard join against
SQL and brute force, and their edge cases."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from rankfold.llm import bitmaps, collocation, jaccard, lexical
from rankfold.llm.queries import ORACLE, QUERIES
from rankfold.llm.quotient import Grams
from rankfold.llm.store import ship

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"
CLASHING = ("item", "key", "class", "row", "n", "ids", "lang_", "salt", "rank", "score", "f", "a", "l", "r", "component_id", "filter")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.mark.parametrize("name", ["op11_lexical", "op12_collocations", "op13_jaccard"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and a.equals(b.astype(a.dtypes.to_dict()))


# --- ranked lexical search ------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k):
    counts = [(d, collections.Counter(terms_of(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            n, score = sum(c.values()), 0
            for t in set(terms_of(text)):
                if c[t]:
                    m = 100 - 50 + (50 * n * n_docs) // length
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))


def search(spark, docs, items, k=3):
    d = spark.createDataFrame([(i, t, "en") for i, t in docs], DOCS).withColumns({c: F.lit(7) for c in CLASHING})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(7) for c in ("doc_id", "item", "terms", "rank")})
    got = [tuple(r) for r in lexical.search(d, i, k).collect()]
    return sorted(got, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))


def fixture_docs():
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma7", "ünïcode", "漢字", "x", "delta-eps"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "... !!"), (103, "Alpha," * 5000), (5, docs[5][1]), (104, docs[7][1]),
                   (None, docs[7][1]), (105, "w" * 3_000_000 + " alpha")]


ITEMS = [(1, "alpha BETA beta"), (2, None), (3, "nothing here"), (3, "漢字 x, ünïcode"), (None, "gamma7 delta eps"), (4, "")]


def test_search_equals_brute_force(spark):
    docs = fixture_docs()
    assert search(spark, docs, ITEMS, 4) == brute_search(docs, ITEMS, 4)


def test_search_in_several_passes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PASS_TERMS", 3)
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 2)
    docs = fixture_docs()
    assert search(spark, docs, ITEMS, 4) == brute_search(docs, ITEMS, 4)


def test_search_of_empty_tables(spark):
    assert search(spark, [], ITEMS) == [] and search(spark, fixture_docs(), []) == []
    assert search(spark, [(1, None), (2, "")], ITEMS) == []


def test_search_arithmetic_stays_exact():
    big = np.array([4_000_000_000, 7], np.int64)
    assert lexical.length_norm(big, 10**12, 10**15).tolist() == [50 + 50 * int(x) * 10**12 // 10**15 for x in big]
    weights = np.full(10**6, 30_000, np.int64)
    assert lexical.tile_width(weights) * 30_000 * 1_000_000 < 2**53
    assert lexical.tile_width(np.array([2**45])) == 1


def test_best_keeps_ties_by_document():
    score = np.array([5, 9, 5, 5, 1])
    doc = np.array([40, 7, 30, 10, 1])
    assert doc[lexical._best(score, doc, 3)].tolist() == [7, 10, 30]


def test_runs_of_long_texts_cut_between_terms():
    text = ("Ab,c " * 1000).encode()
    whole = [t for run in lexical.runs(text, lexical._TABLE, size=7) for t in run.split()]
    assert whole == [b"ab", b"c"] * 1000


# --- phrase collocations -----------------------------------------------------------

@pytest.mark.parametrize("n,width", [(2, 3), (2, 17), (3, 11), (3, 32), (4, 8), (4, 16), (4, 17), (4, 32)])
def test_quotient_filters_give_every_key_and_count_back(n, width):
    rnd = np.random.default_rng(n * 100 + width)
    grams = Grams(n, width)
    top = (1 << width) - 1
    ids = [rnd.integers(0, min(top, 40) + 1, 5000) for _ in range(n)]
    ids[0][:50] = top
    a, b = grams.permute(ids)
    assert all((x == y).all() for x, y in zip(grams.restore(a, b), ids))
    want = collections.Counter(zip(*(x.tolist() for x in ids)))
    parts = []
    for half in (slice(0, 3000), slice(3000, None)):  # two shards' filters, merged
        x, y, c = grams.count(*grams.permute([i[half] for i in ids]))
        bits = grams.shard_bits(4)
        shard = grams.shard_of(x, bits)
        for s in np.unique(shard):
            at = shard == s
            got = grams.entries(grams.filter(x[at], y[at], c[at], bits), int(s), bits)
            assert (got[0] == x[at]).all() and (got[1] == y[at]).all() and (got[2] == c[at]).all()
            parts.append(got)
    x, y, c = grams.count(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
    got = dict(zip(zip(*(v.tolist() for v in grams.restore(x, y))), c.tolist()))
    assert got == dict(want)


def test_quotient_counters_beyond_a_byte():
    grams = Grams(2, 10)
    a, b = grams.permute([np.arange(4), np.arange(4)])
    a, b, c = grams.count(a, b, np.array([1, 255, 300, 2**40]))
    x, y, n = grams.entries(grams.filter(a, b, c, 0), 0, 0)
    assert sorted(n.tolist()) == [1, 255, 300, 2**40] and (x == a).all() and (y == b).all()


def brute_phrases(rows, min_count, top, cover=80):
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in (1, 2, 3, 4):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= min_count}
    longer = collections.Counter()
    for (lang, w), a in often.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i:i + m]] = max(longer[lang, w[i:i + m]], a)
    out = []
    for lang in n:
        rows = []
        for (lg, w), a in often.items():
            if lg == lang and 100 * longer[lg, w] < cover * a:
                score, k = min(((2_000_000 * a) // (f[lg, w[:k]] + f[lg, w[k:]]), k) for k in range(1, len(w)))
                rows.append((-score, -a, " ".join(w).encode(), f[lg, w[:k]], f[lg, w[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rnd = random.Random(9)
    vocab = ["New", "york", "city", "the", "of", "é", "漢", "\x1c", "a-b"]
    rows = [("".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\t", "  ", ". ", "\n", "; "]) for _ in range(rnd.randint(0, 60))),
             rnd.choice(["en", "de", None])) for _ in range(150)]
    return rows + [(None, "en"), ("", "en"), ("  ..  ", None), ("solo", "fr"), ("new york city " * 20_000, "en"),
                   (rows[0][0], rows[0][1]), (rows[0][0], rows[0][1]), ("in one piece " * 40, "xx")]


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_collocations_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(collocation, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocation, "SHARD_WORDS", 1 << 12)
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], DOCS).withColumns(
        {c: F.lit(7) for c in CLASHING if c != "ids"}).repartition(5)
    got = sorted(tuple(r) for r in collocation.collocations(df, top=40, min_count=5).collect())
    assert got == brute_phrases(rows, 5, 40)


def test_collocations_of_empty_tables(spark):
    assert collocation.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocation.collocations(spark.createDataFrame([(1, None, None), (2, "a b", "en")], DOCS)).collect() == []


def test_bitmap_holds_every_key(spark):
    rnd = np.random.default_rng(1)
    keys = rnd.integers(-2**63, 2**63 - 1, 3000)
    table = bitmaps.bitmap(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", bits=20)
    assert bitmaps.holds(table, keys).all()
    other = rnd.integers(-2**63, 2**63 - 1, 3000)
    assert bitmaps.holds(table, other).mean() < 0.02


# --- Jaccard join ---------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=lambda r: tuple((x is None, x or 0) for x in r))


def set_rows():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    common = [rnd.choice(vocab) for _ in range(30)]
    rows, i = [], 0
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 160))]
        for _ in range(rnd.randint(1, 14)):  # families of copies with growing numbers of edits
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                w = w + common  # a passage that many texts share
            rows.append((i, " ".join(w)))
            i += 3
    for n in range(1, 14):  # short sets, where one shingle decides
        w = vocab[:n + 4]
        rows += [(i, " ".join(w)), (i + 1, " ".join(w + ["z"])), (i + 2, " ".join(w[1:]))]
        i += 3
    return rows + [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (9005, "One"), (9006, "one two"),
                   (9004, "one two"), (None, rows[0][1]), (None, "only null id"), (9007, "word " * 30_000), (9008, "word " * 5),
                   (9009, " ".join(f"t{k}" for k in range(20_000))), (9010, " ".join(f"t{k}" for k in range(500, 20_400)))]


@pytest.mark.parametrize("limit,block", [(256, 512), (2, 3)])
def test_jaccard_equals_brute_force(spark, monkeypatch, limit, block):
    monkeypatch.setattr(jaccard, "GROUP_LIMIT", limit)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = set_rows()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS).withColumns(
        {c: F.lit(7) for c in CLASHING}).repartition(6)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=lambda r: tuple((x is None, x or 0) for x in r))
    assert got == brute_components(rows)


def test_jaccard_of_empty_tables(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    got = jaccard.near_duplicates(spark.createDataFrame([(2, None, "en"), (1, " ", "en")], DOCS)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def test_sketch_distance_bounds_the_difference():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n = int(rnd.integers(1, 300))
        a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) > 0.2], rnd.integers(0, 2**63, int(rnd.integers(1, 60))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        assert jaccard._differ(jaccard.folded(a), jaccard.folded(b)) <= len(a) + len(b) - 2 * both
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(a) + len(b) - 2 * both <= jaccard.budget(len(a), len(b))


def test_shared_keys_across_batches():
    import pyarrow as pa
    rows = [(1, 5), (1, 5), (2, 1), (2, 2), (2, 2), *[(3, c) for c in range(9)], (4, 1), (5, 1), (5, 9)]
    for size in (1, 2, 3, 50):
        batches = [pa.record_batch([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64())],
                                   names=["key", "class"]) for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        got = sorted(tuple(r.values()) for b in jaccard._shared(4)(iter(batches)) for r in b.to_pylist())
        assert got == sorted([(2, 1, 1, False), (2, 2, 1, False), *[(3, c, 0, True) for c in range(9)], (5, 1, 1, False), (5, 9, 1, False)])

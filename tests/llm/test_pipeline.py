"""The corpus pipeline against its stages by brute force, on the smallest input."""

import collections

import corpus_pipeline as pipeline
from rankfold.llm import decontam, langid, linededup
from rankfold.llm.queries import tokenizer_path
from rankfold.llm.store import ship, stored

from .test_ops import SF, brute_components, brute_fingerprint


def lines_by_hand(texts, min_count):
    lines = collections.defaultdict(list)
    for i, t in sorted(texts.items()):
        for no, line in enumerate(t.split("\n")):
            if len(line.strip()) >= linededup.MIN_CHARS:
                lines[line.strip()].append((i, no))
    names = sorted(lines, key=len)
    root = {n: n for n in names}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if len(b) - len(a) > 2:
                break
            if linededup.edit_within(a, b, min(2, len(a) // 20)):
                root[top(a)] = top(b)
    classes = collections.defaultdict(list)
    for n in names:
        classes[top(n)] += lines[n]
    gone = {p for places in classes.values() if len(places) >= min_count for p in sorted(places)[1:]}
    out = {i: "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in gone) for i, t in texts.items()}
    return {i: t for i, t in out.items() if t.strip() or t == texts[i]}


def test_pipeline_equals_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = list(texts)
    out = langid.judge(langid.fit(docs), [texts[i] for i in names])[2]
    texts = {i: texts[i] for i, gone in zip(names, out) if not gone}
    seen, got = docs, []
    for name, stage in pipeline.STAGES:
        seen = stored(stage(spark, seen, SF), "test-stage")
        got.append(seen)
    column = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    assert column(got[0]) == texts
    texts = lines_by_hand(texts, pipeline.LINE_COUNT)
    assert column(got[1]) == texts
    assert all(len(r["text"]) == r["n_chars"] for r in got[1].collect() if r["n_chars"] is not None)
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    comp, first = brute_components(fps.values(), 2), {}
    for i in sorted(texts):
        first.setdefault(comp[fps[i]], i)
    texts = {i: texts[i] for i in first.values()}
    assert column(got[2]) == texts
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    space = decontam.fit(got[2])
    items = list(decontam.item_blocks(bench, space))
    texts = {i: t for i, t in texts.items() if not any(decontam.matches(t, b, space) for b in items)}
    assert column(got[3]) == texts
    assert all(df.columns == docs.columns for df in got[:4])
    rows = got[4].collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    assert sum(r["length"] for r in rows) == sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for x in texts.values())


def test_stages_take_odd_rows(spark):
    ship(spark)
    rows = [(1, None, None, None, None), (None, "some words of a text without an id", "en", None, 3), (2, "", "de", "s", 0),
            (3, "the same text as another one", "en", "s", 28), (3, "the same text as another one", "en", "s", 28)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_line_stage_drops_passages_of_two_documents(spark):
    ship(spark)
    passage = " ".join(f"passage{i}" for i in range(60))
    texts = [f"first document\nits own words {'a ' * 40}\n{passage}", f"{passage}\nanother one with {'other ' * 40}", "a third without it"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {0: texts[0], 1: texts[1].split("\n")[1], 2: texts[2]}

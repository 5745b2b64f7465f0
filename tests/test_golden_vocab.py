"""Tokenizer vocabulary (E5) of a small table, against ids worked out by hand:
descending count, then token; the cut to the most frequent comes before the
minimum count and the removal of the missing value; lower-casing comes last."""

from rankfold.operators import encode as E


def _vocab(spark, words, **options):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    return {r["token"]: r["id"] for r in E.frequency_vocab(E.token_counts(df, "w"), **options).collect()}


def test_ids_by_count_then_token(spark):
    words = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + [""] * 4 + [None] * 9 + ["d"]
    assert _vocab(spark, words, na_value="") == {"c": 1, "a": 2, "b": 3, "d": 4}
    assert _vocab(spark, words, na_value="", max_features=3) == {"c": 1, "a": 2}
    assert _vocab(spark, words, na_value="", min_count=3) == {"c": 1, "a": 2, "b": 3}


def test_lower_casing_follows_counting(spark):
    words = ["New York"] * 3 + ["new york"] * 2 + ["Rome"] * 4
    assert _vocab(spark, words, lower=True) == {"rome": 1, "new york": 3}
    assert _vocab(spark, words) == {"Rome": 1, "New York": 2, "new york": 3}

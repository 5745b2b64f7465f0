"""Shuffle partitions follow the input; one-hot vectors name no slots."""

import pytest
from pyspark.ml.functions import vector_to_array

from rankfold import session
from rankfold.operators.field_encoder import FieldEncoder, field_vectors
from rankfold.sources import staging as st
from tests.conftest import SF_SMALL

PARTITIONS = "spark.sql.shuffle.partitions"


def test_partitions_grow_with_the_facts(spark, monkeypatch):
    before = spark.conf.get(PARTITIONS)
    try:
        plain = sorted(map(tuple, st.candidate_lines(spark, SF_SMALL).collect()))
        monkeypatch.setattr(session, "PARTITION_ROWS", 500)
        rows = st.table(spark, SF_SMALL, "lineitem").count()
        assert int(spark.conf.get(PARTITIONS)) == max(int(before), -(-rows // 500)) > int(before)
        assert sorted(map(tuple, st.candidate_lines(spark, SF_SMALL).collect())) == plain
        spark.conf.set(PARTITIONS, "900")
        st.table(spark, SF_SMALL, "lineitem")
        assert spark.conf.get(PARTITIONS) == "900"  # never lowered
    finally:
        spark.conf.set(PARTITIONS, before)
        spark.conf.unset(session.ADVISORY)


@pytest.mark.parametrize("named, want", [(None, "16m"), ("64MB", "16m"), ("256m", "16m"), ("8m", "8m"), ("4096", "4096")])
def test_partitions_are_merged_to_a_bound_where_there_are_enough(spark, monkeypatch, named, want):
    before = spark.conf.get(PARTITIONS)
    monkeypatch.setattr(session, "PARTITION_ROWS", 500)
    try:
        spark.conf.set(PARTITIONS, "900")  # none has to be added
        if named:
            spark.conf.set(session.ADVISORY, named)
        st.table(spark, SF_SMALL, "lineitem")
        assert spark.conf.get(session.ADVISORY, None) == want and spark.conf.get(PARTITIONS) == "900"
    finally:
        spark.conf.set(PARTITIONS, before)
        spark.conf.unset(session.ADVISORY)


@pytest.mark.parametrize("named, want", [(None, "16m"), ("128MB", "16m"), ("8m", "8m")])
def test_facts_are_read_in_bounded_splits(spark, monkeypatch, tmp_path, named, want):
    before = {name: spark.conf.get(name, None) for name in (PARTITIONS, session.ADVISORY, session.SPLIT)}
    monkeypatch.setattr(session, "PARTITION_ROWS", 500)
    try:
        spark.conf.unset(session.SPLIT)
        if named:
            spark.conf.set(session.SPLIT, named)
        st.table(spark, SF_SMALL, "customer")
        assert spark.conf.get(session.SPLIT) == (named or "134217728b")
        st.table(spark, SF_SMALL, "lineitem")
        assert spark.conf.get(session.SPLIT) == want
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_vectors_keep_no_name_of_a_slot(spark):
    df = spark.createDataFrame([(i, f"u{i}", float(i)) for i in range(50)], "id long, u string, price double")
    enc = FieldEncoder(keyCols=["id"], categorical=["u"], numeric=["price"]).fit(df)
    coded = enc.transform(df)
    made = field_vectors(coded, enc, ["price"])
    assert made.schema["features"].metadata == {"ml_attr": {"num_attrs": 53}}
    assert made.columns == [*df.columns, "features"]
    for r in made.withColumn("a", vector_to_array("features")).collect():
        assert [i for i, x in enumerate(r["a"][:52]) if x] == [r["u"]] and r["a"][r["u"]] == 1.0
        assert r["a"][52] == pytest.approx(r["price"])


def test_a_number_that_is_not_one_fails(spark):
    df = spark.createDataFrame([(1, "a", float("nan"))], "id long, u string, price double")
    enc = FieldEncoder(keyCols=["id"], categorical=["u"]).fit(df)
    with pytest.raises(Exception, match="NaN"):
        field_vectors(enc.transform(df), enc, ["price"]).collect()

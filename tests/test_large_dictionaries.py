"""Dictionaries beyond what metadata lists and the driver holds."""

from __future__ import annotations

import re

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from labelloom import IndexToLabel, LabelIndexer, LabelIndexerModel, num_features
from labelloom.plans import dictionary as dictionaries
from labelloom.session import SHARED_DIR, shared_folder

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def numbers(spark, n):
    return spark.range(n).select(F.format_string("v%05d", "id").alias("v"))


@pytest.mark.parametrize("n", [1_001, 10_001, 20_000])
def test_pipeline_there_and_back(spark, tmp_path, n):
    df = numbers(spark, n)
    stages = [
        LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep"),
        IndexToLabel(inputCol="i", outputCol="back"),
    ]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    more = df.union(spark.createDataFrame([("new",)], df.schema))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        got = m.transform(more)
        assert got.where("v = back").count() == n
        assert [r.back for r in got.where("v = 'new'").collect()] == ["__unknown"]
        assert "vals" not in got.schema["i"].metadata["ml_attr"]


def test_a_column_does_not_change_another(spark):
    df = numbers(spark, 300).select("v", F.concat("v", F.lit("x")).alias("w"))
    alone = LabelIndexer(inputCol="v", outputCol="i", localLabelLimit=300).fit(df)
    both = LabelIndexer(inputCols=["v", "w"], outputCols=["i", "j"], localLabelLimit=300).fit(df)
    assert both.labels_array() == [*alone.labels_array(), [f"v{k:05d}x" for k in range(300)]]


def test_given_labels_have_the_same_limits_before_and_after_loading(spark, tmp_path):
    labels = [f"v{k:05d}" for k in range(12_000)]
    model = LabelIndexerModel.from_labels(labels, inputCol="v", outputCol="i")
    model.write().save(str(tmp_path / "m"))
    for m in (model, LabelIndexerModel.load(str(tmp_path / "m"))):
        assert "vals" not in m.transform(numbers(spark, 5)).schema["i"].metadata["ml_attr"]
        with pytest.raises(ValueError, match="has 12000 labels and the limit is 10000"):
            m.labels_array()
        assert m.labels_array(limit=12_000) == [labels]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_repeated_label_of_a_stored_dictionary(spark, tmp_path, limit):
    model = LabelIndexerModel.from_labels(
        ["a", "b", "a"], inputCol="v", outputCol="i", handleInvalid="keep", localLabelLimit=2
    )
    model.write().save(str(tmp_path / "m"))
    loaded = LabelIndexerModel.load(str(tmp_path / "m"))
    loaded = loaded.copy({loaded.broadcastLimit: limit})
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "v string")
    got = loaded.transform(df)
    assert sorted((r.v, r.i) for r in got.collect()) == [("a", 2.0), ("b", 1.0), ("z", 3.0)]
    places = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    back = loaded.inverse_transform(places, {"i": "back"}).orderBy("i").collect()
    assert [r.back for r in back] == ["a", "b", "a"]


@pytest.mark.parametrize("policy", ["keep", "skip"])
def test_later_filters_reach_the_scan(spark, policy):
    lines = spark.read.parquet(LINEITEM)
    model = LabelIndexer(
        inputCol="l_orderkey", outputCol="i", handleInvalid=policy, localLabelLimit=0, broadcastLimit=0
    ).fit(lines)
    indexed = model.transform(lines).where("l_partkey < 10")
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_partkey,10)" in plan
    assert indexed.count() == lines.where("l_partkey < 10").count()


def test_hot_labels_keep_to_the_limit(spark):
    lines = spark.read.parquet(LINEITEM)
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    model = LabelIndexer(
        inputCols=columns, outputCols=["a", "b", "c"], localLabelLimit=0, broadcastLimit=0
    ).fit(lines)
    plan = model.transform(lines)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Broadcast(Hash|Exchange)", plan)


def test_nothing_is_left_of_a_fit_but_the_dictionary(spark, monkeypatch):
    folder = f"{shared_folder(spark)}/labelloom"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def names():
        found = files.listStatus(place) if files.exists(place) else []
        return {f.getPath().getName() for f in found}

    before = names()
    LabelIndexer(inputCol="v", outputCol="i", localLabelLimit=0).fit(numbers(spark, 50))
    assert [n.split("-")[0] for n in names() - before] == ["dictionary"]


def test_the_shared_folder_has_to_be_named(spark):
    session = spark.newSession()
    session.conf.set(SHARED_DIR, "/elsewhere/")
    assert shared_folder(session) == shared_folder(spark)  # the context's own setting comes first


def test_widths_that_differ(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "a array<double>").coalesce(1)
    with pytest.raises(ValueError, match="1 to 2 features"):
        num_features(df, "a")
    assert num_features(df, "a", first_row=True) == 2


def test_counts_are_kept_in_arrays(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    model = LabelIndexer(inputCol="v", outputCol="i").fit(df)
    model.write().option("layout", "labelsArray").save(str(tmp_path / "m"))
    rows = LabelIndexerModel.load(str(tmp_path / "m")).dictionary_table().orderBy("idx").collect()
    assert [(r.label, r.n) for r in rows] == [("a", 2), ("b", 1)]

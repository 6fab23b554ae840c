"""Saved models, streams and vector columns."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from labelloom import (
    ColumnRenamer,
    IndexToLabel,
    LabelIndexer,
    LabelIndexerModel,
    num_features,
    num_features_from_schema,
    transform_stream,
)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("a", 1), ("b", 2), ("a", 3), ("c", 1), (None, None)], "s string, k int"
    )


def indexer(**settings):
    return LabelIndexer(
        inputCols=["s", "k"], outputCols=["si", "ki"], handleInvalid="keep", **settings
    )


@pytest.mark.parametrize("layout", ["table", "labelsArray"])
def test_model_round_trip(df, tmp_path, layout):
    model = indexer().fit(df)
    model.write().option("layout", layout).save(f"{tmp_path}/m")
    loaded = LabelIndexerModel.load(f"{tmp_path}/m")
    assert loaded.uid == model.uid
    assert loaded.getHandleInvalid() == "keep"
    assert loaded.labels_array() == model.labels_array()
    assert loaded.transform(df).collect() == model.transform(df).collect()
    stored = df.sparkSession.read.parquet(f"{tmp_path}/m/data")
    if layout == "table":
        assert stored.columns == ["column", "label", "n", "idx"]
    else:
        assert stored.dtypes == [
            ("labelsArray", "array<array<string>>"),
            ("countsArray", "array<array<bigint>>"),
        ]
        assert stored.count() == 1
    with pytest.raises(Exception, match="already exists"):
        model.save(f"{tmp_path}/m")
    model.write().overwrite().save(f"{tmp_path}/m")


def test_model_of_large_dictionaries_round_trip(df, tmp_path):
    model = indexer(localLabelLimit=0, broadcastLimit=0).fit(df)
    path = f"{tmp_path}/m"
    model.save(path)
    loaded = LabelIndexerModel.load(path)
    assert loaded.num_labels() == [3, 3]
    assert loaded.dictionary_table().orderBy("col_name", "idx").collect() == (
        model.dictionary_table().orderBy("col_name", "idx").collect()
    )
    assert loaded.transform(df).orderBy("s", "k").collect() == (
        model.transform(df).orderBy("s", "k").collect()
    )
    plan = loaded.dictionaries[1].stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(column,1)" in plan
    with pytest.raises(ValueError, match="save it elsewhere"):
        loaded.write().overwrite().save(path)
    loaded.save(f"{tmp_path}/copy")
    with pytest.raises(ValueError, match="dictionary_table"):
        loaded.write().option("layout", "labelsArray").save(f"{tmp_path}/row")
    with pytest.raises(ValueError, match="Unknown layout"):
        loaded.write().option("layout", "csv").save(f"{tmp_path}/csv")


def test_mixed_model_round_trip(df, tmp_path):
    small_and_large = df.withColumn("k", F.coalesce("k", F.lit(9)))
    model = indexer(localLabelLimit=3).fit(small_and_large)
    assert [d.labels is None for d in model.dictionaries] == [False, True]
    model.save(f"{tmp_path}/m")
    loaded = LabelIndexerModel.load(f"{tmp_path}/m")
    assert [d.labels is None for d in loaded.dictionaries] == [False, True]
    assert sorted(loaded.transform(df.na.drop()).collect()) == sorted(
        model.transform(df.na.drop()).collect()
    )


def test_model_without_labels_round_trip(spark, tmp_path):
    empty = spark.createDataFrame([(None, 1)], "s string, k int")
    for layout in ("table", "labelsArray"):
        indexer().fit(empty).write().option("layout", layout).save(f"{tmp_path}/{layout}")
        loaded = LabelIndexerModel.load(f"{tmp_path}/{layout}")
        assert loaded.labels_array() == [[], ["1"]]


def test_loads_a_model_saved_by_spark(df, tmp_path):
    known = df.na.drop()
    stock = StringIndexer(inputCols=["s", "k"], outputCols=["si", "ki"]).fit(known)
    stock.save(f"{tmp_path}/m")
    loaded = LabelIndexerModel.load(f"{tmp_path}/m")
    assert loaded.labels_array() == [list(labels) for labels in stock.labelsArray]
    assert loaded.transform(known).collect() == stock.transform(known).collect()


def test_loads_the_single_column_layout(df, tmp_path):
    path = f"{tmp_path}/old"
    LabelIndexerModel.from_labels(["x"], inputCol="s", outputCol="si").save(path)
    meta = next(f for f in os.listdir(f"{path}/metadata") if f.startswith("part-"))
    with open(f"{path}/metadata/{meta}") as file:
        saved = json.load(file)
    os.makedirs(f"{tmp_path}/v2/metadata")
    os.makedirs(f"{tmp_path}/v2/data")
    with open(f"{tmp_path}/v2/metadata/part-00000", "w") as file:
        json.dump({**saved, "sparkVersion": "2.4.8"}, file)
    rows = pa.table({"labels": pa.array([["b", "a", "c"]], pa.list_(pa.string()))})
    pq.write_table(rows, f"{tmp_path}/v2/data/part-0.parquet")
    loaded = LabelIndexerModel.load(f"{tmp_path}/v2")
    assert loaded.labels_array() == [["b", "a", "c"]]
    assert [r.si for r in loaded.transform(df.na.drop()).collect()] == [1.0, 0.0, 1.0, 2.0]


@pytest.mark.parametrize(
    "stage",
    [
        LabelIndexer(inputCol="s", outputCol="i", handleInvalid="skip", localLabelLimit=7),
        IndexToLabel(inputCol="i", outputCol="s", labels=["a", "b"]),
        ColumnRenamer(inputCol="s", outputCol="t"),
    ],
    ids=lambda s: type(s).__name__,
)
def test_unfitted_stages_round_trip(spark, tmp_path, stage):
    stage.save(f"{tmp_path}/s")
    loaded = type(stage).load(f"{tmp_path}/s")
    assert loaded.uid == stage.uid
    assert {p.name: v for p, v in loaded.extractParamMap().items()} == {
        p.name: v for p, v in stage.extractParamMap().items()
    }


@pytest.mark.parametrize("settings", [{}, {"localLabelLimit": 0, "broadcastLimit": 0}])
def test_stream(spark, df, tmp_path, settings):
    model = indexer(**settings).fit(df)
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    query = transform_stream(
        model, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(got.collect(), key=str) == sorted(model.transform(df).collect(), key=str)


def test_stream_stops_on_an_unseen_label(spark, df, tmp_path):
    model = LabelIndexer(inputCol="s", outputCol="i").fit(df.where("s = 'a'"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    query = transform_stream(
        model, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True
    )
    with pytest.raises(Exception, match="Unseen label|NULL"):
        query.awaitTermination()


def test_inverse_on_a_stream(spark, df, tmp_path):
    df.na.drop().write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    stage = IndexToLabel(inputCol="k", outputCol="back", labels=["w", "x", "y", "z"])
    query = transform_stream(
        stage, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("k", "s").collect()
    assert [r.back for r in got] == ["x", "x", "y", "z"]


def test_vector_width_from_metadata(spark):
    vectors = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)], ["v"])
    declared = vectors.withMetadata("v", {"ml_attr": {"num_attrs": 7}})
    assert num_features_from_schema(declared.schema["v"]) == 7
    assert num_features(declared, "v") == 7
    listed = {"ml_attr": {"attrs": {"numeric": [{"idx": 0}, {"idx": 2}], "nominal": [{"idx": 1}]}}}
    assert num_features(vectors.withMetadata("v", listed), "v") == 3


def test_vector_width_from_rows(spark):
    rows = [(None,), (Vectors.sparse(5, [1], [1.0]),)]
    vectors = spark.createDataFrame(rows, StructType([StructField("v.w", VectorUDT())]))
    assert num_features_from_schema(vectors.schema["v.w"]) is None
    assert num_features(vectors, "`v.w`") == 5
    assert num_features(vectors.where("`v.w` is null"), "v.w") is None


def test_width_of_other_columns(spark):
    df = spark.sql("select array(1f, 2f, 3f) as a, array('x') as s, 1 as k")
    assert num_features_from_schema(df.schema["a"]) is None
    assert num_features(df, "a") == 3
    for name in ("s", "k"):
        with pytest.raises(ValueError, match="vector or an array of numbers"):
            num_features(df, name)
    with pytest.raises(ValueError, match="does not exist"):
        num_features(df, "nope")


def test_small_batches_read_the_buckets_they_need(spark, tmp_path):
    labels = spark.range(6_000).select(F.format_string("k%05d", "id").alias("v"))
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.files.maxPartitionBytes": "1k"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        model = LabelIndexer(
            inputCol="v", outputCol="i", handleInvalid="keep", localLabelLimit=0, broadcastLimit=5_000
        ).fit(labels)
        batch = spark.createDataFrame([("k00007", 1), ("k04000", 2), ("new", 3), (None, 4)], "v string, n int")
        small = model.for_table(batch)
        whole, part = (m.dictionaries[0].stored for m in (model, small))
        files = lambda df: df.select(F.input_file_name()).distinct().count()
        assert files(whole) == 32 and files(part) <= 3
        # a partition of the scan is a piece of a file; files of other buckets have none
        assert part.rdd.getNumPartitions() < whole.rdd.getNumPartitions() / 8
        text = small.transform(batch)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
        want = [("k00007", 7.0), ("k04000", 4000.0), ("new", 6000.0), (None, 6000.0)]
        got = [(r["v"], r["i"]) for r in small.transform(batch).orderBy("n").collect()]
        assert got == want
        assert model.for_table(batch, most_labels=2).dictionaries == model.dictionaries
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("by_batch", [False, True])
def test_stream_with_a_large_dictionary(spark, tmp_path, by_batch):
    labels = spark.range(3_000).select(F.format_string("k%05d", "id").alias("v"), "id")
    model = LabelIndexer(
        inputCol="v", outputCol="i", handleInvalid="keep", localLabelLimit=0, broadcastLimit=0
    ).fit(labels.where("id < 2500"))
    stages = PipelineModel([ColumnRenamer(inputCol="id", outputCol="row"), model])
    labels.repartitionByRange(3, "id").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(labels.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        query = transform_stream(
            stages, stream, f"{tmp_path}/out", f"{tmp_path}/c", available_now=True, by_batch=by_batch
        )
        query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert ("batch_id" in got.columns) == by_batch
    rows = {r["row"]: r["i"] for r in got.collect()}
    assert got.count() == 3_000 and rows == {k: float(min(k, 2_500)) for k in range(3_000)}


def test_a_batch_that_is_repeated_replaces_its_folder(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "v string, n int")
    model = LabelIndexer(inputCol="v", outputCol="i").fit(df)
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    for checkpoint in ("c", "d"):  # as if the first one had not been noted
        transform_stream(
            model, stream, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", available_now=True, by_batch=True
        ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2

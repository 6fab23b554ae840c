"""What Spark makes of the queries: joins, shuffles and what is read from files."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from labelloom import LabelIndexer, LabelIndexerModel, label_counts, transform_stream
from labelloom.operators import counts as counts_module
from labelloom.operators import lookup

LARGE = {"localLabelLimit": 0, "broadcastLimit": 0}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")


def test_few_labels_need_no_join(lineitem):
    model = LabelIndexer(inputCol="l_returnflag", outputCol="i").fit(lineitem)
    text = plan(model.transform(lineitem))
    assert "Join" not in text and "Exchange" not in text


def test_skip_filters_in_the_scan(lineitem):
    model = LabelIndexerModel.from_labels(
        ["A", "N"], inputCol="l_returnflag", outputCol="i", handleInvalid="skip"
    )
    assert "In(l_returnflag, [A,N])" in plan(model.transform(lineitem))
    numbers = LabelIndexerModel.from_labels(
        ["1", "02", "x", "99999999999999999999"],
        inputCol="l_linenumber",
        outputCol="i",
        handleInvalid="skip",
    )
    got = numbers.transform(lineitem)
    assert "EqualTo(l_linenumber,1)" in plan(got)
    assert got.count() == lineitem.where("l_linenumber = 1").count()


def test_numbers_are_not_cast_to_strings_for_a_lookup(lineitem):
    model = LabelIndexer(inputCols=["l_partkey"], outputCols=["i"], handleInvalid="keep").fit(
        lineitem
    )
    text = plan(model.transform(lineitem).select("l_orderkey", "i"))
    assert "BroadcastHashJoin [l_partkey" in text
    assert "as string" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_large_dictionary_stays_in_its_buckets_and_nulls_are_spread(spark, lineitem):
    model = LabelIndexer(
        inputCol="l_orderkey", outputCol="i", handleInvalid="keep", **LARGE
    ).fit(lineitem)
    for used in (model, model.copy()):
        text = plan(used.transform(lineitem))
        shuffles = [line for line in text.splitlines() if "Exchange" in line]
        assert len(shuffles) == 1 and "_open" in shuffles[0]
        assert "Bucketed: true" in text and "SelectedBucketsCount: 4 out of 4" in text
        assert "ShuffledHashJoin" in text and "Sort [" not in text
    spark.conf.set("spark.sql.shuffle.partitions", "9")  # the table is dealt into the buckets there are
    try:
        assert plan(model.transform(lineitem)).count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_loaded_model_can_be_put_into_buckets(spark, lineitem, tmp_path):
    settings = {"inputCol": "l_orderkey", "outputCol": "i", "handleInvalid": "keep", **LARGE}
    model = LabelIndexer(**settings).fit(lineitem)
    model.write().save(f"{tmp_path}/m")
    loaded = LabelIndexerModel.load(f"{tmp_path}/m")
    assert plan(loaded.transform(lineitem)).count("Exchange") == 2
    bucketed = loaded.in_buckets()
    assert plan(bucketed.transform(lineitem)).count("Exchange") == 1
    both = model.transform(lineitem).exceptAll(bucketed.transform(lineitem))
    assert both.isEmpty() and bucketed.num_labels() == model.num_labels()
    assert bucketed.in_buckets().dictionaries == bucketed.dictionaries


def test_nulls_reach_all_tasks(spark):
    fit_on = spark.range(100).select(F.col("id").cast("string").alias("v"))
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **LARGE).fit(fit_on)
    nulls = spark.range(0, 4_000, 1, 16).select(F.lit(None).cast("string").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = model.transform(nulls.withColumn("w", F.rand(1)))
        tasks = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in tasks) == 4_000
    assert len(tasks) > 1


def test_counting_scans_once_and_combines_before_the_shuffle(lineitem):
    text = plan(label_counts(lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"]))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text
    assert "struct<l_linenumber:int,l_returnflag:string,l_linestatus:string>" in text


def test_filter_before_the_stage_reaches_the_scan(lineitem):
    model = LabelIndexer(inputCol="l_suppkey", outputCol="i", handleInvalid="keep").fit(lineitem)
    text = plan(model.transform(lineitem.where("l_orderkey < 100")))
    assert "LessThan(l_orderkey,100)" in text


def test_stream_of_large_dictionary_has_no_state(spark, lineitem, tmp_path):
    model = LabelIndexer(
        inputCol="l_orderkey", outputCol="i", handleInvalid="keep", **LARGE
    ).fit(lineitem)
    stream = spark.readStream.schema(lineitem.schema).parquet(
        "/root/testdata/sf0.001/lineitem*.parquet"
    )
    query = transform_stream(
        model, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []
    assert spark.read.parquet(f"{tmp_path}/out").count() == lineitem.count()


def test_broadcasts_stay_within_the_limit_together(spark):
    df = spark.range(60).select(
        F.col("id").cast("string").alias("a"), "id", (F.col("id") % 40).alias("c")
    )
    settings = {"inputCols": ["a", "id", "c"], "outputCols": ["i", "j", "k"]}
    model = LabelIndexer(**settings, broadcastLimit=7_000).fit(df)
    text = plan(model.transform(df))
    # one of the two larger ones fits beside the smallest
    assert len(set(re.findall(r"__labelloom_(\d)_value", text))) == 2
    # the third has no room for its hot labels either
    assert not re.findall(r"__labelloom_(\d)_hot_value", text)
    assert model.transform(df).columns[-3:] == ["i", "j", "k"]
    assert model.transform(df).where("i <> j").count() == 0


def test_wide_tables(spark):
    """Sixty columns, some looked up by expression and some by a join, in one stage."""
    columns = [
        (F.col("id") % (3 + 60 * (i % 2))).cast("string" if i % 3 else "int").alias(f"c{i}")
        for i in range(60)
    ]
    df = spark.range(500).select("id", *columns)
    names = df.columns[1:]
    model = LabelIndexer(
        inputCols=names, outputCols=[f"{n}_i" for n in names], stringOrderType="alphabetAsc"
    ).fit(df)
    got = model.transform(df)
    assert "Exchange hashpartitioning" not in plan(got)
    checks = [F.max(F.col(f"{n}_i")).alias(n) for n in names]
    assert got.agg(*checks).first().asDict() == {
        f"c{i}": 2.0 + 60 * (i % 2) for i in range(60)
    }


@pytest.fixture
def not_adaptive(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def _rows_of_tasks(df) -> list[int]:
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


@pytest.mark.parametrize("broadcast", [0, 128 << 20])
@pytest.mark.parametrize("known", [True, False])
@pytest.mark.parametrize("counts", [True, False])
def test_a_hot_value_is_spread_without_adaptive_execution(spark, not_adaptive, broadcast, known, counts):
    """A third of the rows have one value, seen or not, for models with and without counts."""
    hot = "k7" if known else "unseen"
    settings = {"inputCol": "v", "outputCol": "i", "handleInvalid": "keep", "broadcastLimit": broadcast}
    labels = spark.range(9_000).select(F.concat(F.lit("k"), "id").alias("v"))
    model = LabelIndexer(localLabelLimit=0, **settings).fit(labels)
    (dictionary,) = model.dictionaries
    # as if the dictionary were too large for a broadcast
    changes = {"text_bytes": 200 << 20} | ({} if counts else {"occurrences": 0})
    model.dictionaries = [replace(dictionary, **changes)]
    table = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("k"), F.col("id") % 9_000)).alias("v"),
        "id",
    )
    got = model.transform(table)
    rows = _rows_of_tasks(got)
    assert sum(rows) == 60_000 and len(rows) == 8
    assert rows[-1] <= 2 * rows[len(rows) // 2]
    place = {r["v"]: r["i"] for r in labels.join(model.dictionary_table(), F.col("v") == F.col("label")).select("v", F.col("idx").alias("i")).collect()}
    for r in got.collect():
        assert r["i"] == place.get(r["v"], 9_000.0)


def test_many_hot_values_are_broadcast_or_cut_to_a_few(spark, not_adaptive):
    labels = spark.range(9_000).select(F.concat(F.lit("k"), "id").alias("v"))
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="skip", localLabelLimit=0).fit(labels)
    model.dictionaries = [replace(model.dictionaries[0], text_bytes=200 << 20)]
    table = spark.range(0, 40_000, 1, 6).select(F.concat(F.lit("k"), F.col("id") % 100).alias("v"), "id")
    text = plan(model.transform(table))
    assert "BroadcastHashJoin" in text and "array_position" not in text
    assert model.transform(table).count() == 40_000
    few = model.copy({model.broadcastLimit: 0})
    text = plan(few.transform(table))
    assert "BroadcastHashJoin" not in text and "array_position" in text
    assert few.transform(table).exceptAll(model.transform(table)).isEmpty()
    none = model.copy({model.hotValues: "none"})
    assert not re.search("BroadcastHashJoin|array_position", plan(none.transform(table)))
    by_counts = model.copy({model.hotValues: "counts"})
    assert "BroadcastHashJoin" in plan(by_counts.transform(table))


def test_a_hot_long_label_is_split_and_not_moved_twice(spark, not_adaptive):
    long = F.repeat(F.lit("x"), 10_000)
    labels = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("v")).union(
        spark.range(2_000).select(long.alias("v"))
    )
    settings = {"inputCol": "v", "outputCol": "i", "handleInvalid": "keep", "localLabelLimit": 0}
    for source in ("table", "counts"):
        model = LabelIndexer(hotValues=source, **settings).fit(labels)
        model.dictionaries = [replace(model.dictionaries[0], text_bytes=200 << 20)]
        table = spark.range(0, 6_000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, long).otherwise(F.concat(F.lit("k"), F.col("id") % 3_000)).alias("v"),
            "id",
        )
        got = model.transform(table)
        rows = _rows_of_tasks(got)
        assert len(rows) == 8 and rows[-1] <= 2 * rows[4]
        assert got.where("length(v) = 10000 AND i = 0").count() == 2_000
        # what is dealt out is the hash, beside the columns of the table
        (shuffle,) = [x for x in plan(got).splitlines() if "Exchange hashpartitioning" in x]
        assert re.search(r"hashpartitioning\(__labelloom_0_open#\d+L, 8\)", shuffle)
        assert not re.search(r"__labelloom_0_open#\d+[^L\d]", shuffle)


def test_labels_with_one_hash_are_told_apart(spark):
    """As if another label had the hash of `a`."""
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **LARGE).fit(
        spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    )
    (dictionary,) = model.dictionaries
    same = F.xxhash64(F.when(F.col("label") == "c", "a").otherwise(F.col("label")))
    model.dictionaries = [replace(dictionary, stored=dictionary.stored.withColumn("hash", same))]
    table = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    for used in (model, model.copy({model.hotValues: "none"})):
        got = sorted((r["v"] or "", r["i"]) for r in used.transform(table).collect())
        assert got == [("", 3.0), ("a", 0.0), ("b", 1.0), ("z", 3.0)]


def test_a_check_of_its_own_lets_filters_reach_the_scan(spark, lineitem):
    for way in ({}, LARGE, {"localLabelLimit": 0}):
        model = LabelIndexer(inputCol="l_orderkey", outputCol="i", checkFirst=True, **way).fit(lineitem)
        got = model.transform(lineitem).where("l_partkey < 10")
        text = plan(got)
        assert "LessThan(l_partkey,10)" in text and "raise_error" not in text
        assert got.count() == lineitem.where("l_partkey < 10").count()
        odd = lineitem.withColumn("l_orderkey", F.when(F.col("l_partkey") > 5, F.col("l_orderkey")))
        with pytest.raises(ValueError, match="null has no label"):
            model.transform(odd)
        with pytest.raises(ValueError, match="Unseen label: -"):
            model.transform(lineitem.withColumn("l_orderkey", -F.col("l_orderkey")))
        late = model.copy({model.checkFirst: False}).transform(odd).where("l_partkey < 3")
        assert "raise_error" in plan(late)


@pytest.mark.parametrize("kind", ["string", "int", "double", "decimal(9,2)"])
def test_wide_tables_are_counted_column_by_column(spark, kind):
    columns = [(F.col("id") % (2 + i % 7)).cast(kind).alias(f"c{i}") for i in range(500)]
    df = spark.range(0, 3_000, 1, 4).select("id", *columns)
    if kind == "double":
        df = df.withColumn("c0", F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(-0.0)))
    df = df.withColumn("c1", F.when(F.col("id") % 3 > 0, F.col("c1")))
    names = df.columns[1:]
    counts = label_counts(df, names)
    text = plan(counts)
    assert "Generate" not in text and "Expand" not in text and text.count("Exchange") == 1
    got = {(r["col_name"], r["label"]): r["n"] for r in counts.collect()}
    plain = {}
    for part in range(0, 500, 20):  # the other way of counting, a few columns at a time
        own = label_counts(df, names[part : part + 20])
        plain |= {(r["col_name"], r["label"]): r["n"] for r in own.collect()}
    assert got == plain


def test_wide_counts_are_handed_on_when_a_task_holds_too_many(spark, monkeypatch):
    monkeypatch.setattr(counts_module, "HELD_LABELS", 700)
    monkeypatch.setattr(counts_module, "WIDE_COLUMNS", 1)
    monkeypatch.setattr(counts_module, "_batch_counts", counts_module._batch_counts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        df = spark.range(0, 5_000, 1, 3).select(
            (F.col("id") % 4_000).alias("a"), (F.col("id") % 9).cast("string").alias("b")
        )
        got = {(r["col_name"], r["label"]): r["n"] for r in label_counts(df, ["a", "b"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    plain = {("a", str(k)): 2 if k < 1_000 else 1 for k in range(4_000)}
    plain |= {("b", str(k)): len(range(k, 5_000, 9)) for k in range(9)}
    assert got == plain


def test_numbers_of_labels_follow_the_order_over_partitions(spark):
    """Several large columns, sorted together: partitions begin and end inside of columns."""
    df = spark.range(0, 4_000, 1, 5).select(
        F.format_string("a%05d", "id").alias("a"), (F.col("id") % 3).cast("string").alias("b"),
        (F.col("id") * 7 % 1_999).alias("c"),
    )
    model = LabelIndexer(
        inputCols=["a", "b", "c"], outputCols=["x", "y", "z"], stringOrderType="alphabetDesc", localLabelLimit=0
    ).fit(df)
    for name, dictionary in zip("abc", model.dictionaries, strict=True):
        rows = dictionary.rows(spark).orderBy("idx").collect()
        assert [r["idx"] for r in rows] == [float(k) for k in range(len(rows))]
        labels = sorted({str(r[0]) for r in df.select(name).collect()}, reverse=True)
        assert [r["label"] for r in rows] == labels

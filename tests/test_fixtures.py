"""Small literal tables with known results."""

from __future__ import annotations

import math
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from labelloom import (
    ColumnRenamer,
    IndexToLabel,
    LabelIndexer,
    LabelIndexerModel,
    flatten,
    label_counts,
)

GOLDEN = [1.0, 0.0, 2.0, 3.0, 0.0]


@pytest.fixture
def nested(spark):
    schema = (
        StructType()
        .add(
            "location",
            StructType().add("longitude", IntegerType()).add("latitude", IntegerType()),
        )
        .add("salary", IntegerType())
    )
    rows = [
        ((10, 12), 1000),
        ((12, 14), 4300),
        ((37, 891), 1400),
        ((8902, 12), 4000),
        ((12, 89), 1000),
    ]
    return spark.createDataFrame(rows, schema)


def numbered(spark, values, kind):
    rows = pa.array(range(len(values)), pa.int32())
    return spark.createDataFrame(pa.table({"row": rows, "v": pa.array(values, kind)}))


def strings(spark, *values):
    return numbered(spark, values, pa.string())


def doubles(spark, *values):
    return numbered(spark, values, pa.float64())


def indices(model, df, column="i"):
    return [r[column] for r in model.transform(df).orderBy("row").collect()]


@pytest.mark.parametrize("name", ["`location.longitude`", "location.longitude"])
def test_golden_on_dotted_column(nested, name):
    flat = flatten(nested)
    assert flat.dtypes == [
        ("location.longitude", "int"),
        ("location.latitude", "int"),
        ("salary", "int"),
    ]
    stages = Pipeline(stages=[LabelIndexer(inputCol=name, outputCol="longitude_idx")])
    result = stages.fit(flat).transform(flat)
    assert result.columns == [*flat.columns, "longitude_idx"]
    assert [r.longitude_idx for r in result.collect()] == GOLDEN


def test_golden_after_rename(nested, tmp_path):
    flat = flatten(nested)
    stages = Pipeline(
        stages=[
            ColumnRenamer(inputCol="location.longitude", outputCol="location_longitude"),
            LabelIndexer(inputCol="location_longitude", outputCol="longitude_idx"),
        ]
    )
    stages.write().overwrite().save(f"{tmp_path}/stages")
    fitted = Pipeline.load(f"{tmp_path}/stages").fit(flat)
    fitted.write().overwrite().save(f"{tmp_path}/fitted")
    result = PipelineModel.load(f"{tmp_path}/fitted").transform(flat)
    assert result.columns == ["location_longitude", "location.latitude", "salary", "longitude_idx"]
    assert [r.longitude_idx for r in result.collect()] == GOLDEN


@pytest.mark.parametrize(
    "order, labels",
    [
        ("frequencyDesc", "abcd"),
        ("frequencyAsc", "dabc"),
        ("alphabetDesc", "dcba"),
        ("alphabetAsc", "abcd"),
    ],
)
@pytest.mark.parametrize("limit", [10_000, 0])
def test_label_orders(spark, order, labels, limit):
    df = strings(spark, *"bbaaccd")
    indexer = LabelIndexer(
        inputCol="v", outputCol="i", stringOrderType=order, localLabelLimit=limit
    )
    model = indexer.fit(df)
    rows = model.dictionary_table().orderBy("idx").collect()
    assert [r.label for r in rows] == list(labels)
    assert [r.idx for r in rows] == [0.0, 1.0, 2.0, 3.0]
    if limit:
        assert model.labels_array() == [list(labels)]
    else:
        with pytest.raises(ValueError, match="has 4 labels and the limit is 0"):
            model.labels_array()


def test_strings_are_ordered_by_utf8_bytes(spark):
    df = strings(spark, "\U0001f600", "�", "é", "z")
    model = LabelIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc").fit(df)
    assert model.labels_array() == [["z", "é", "�", "\U0001f600"]]


# the ways a dictionary is looked up: expression, broadcast, broadcast table, shuffle
WAYS = {
    "inline": {},
    "broadcast": {},
    "table": {"localLabelLimit": 0},
    "shuffle": {"localLabelLimit": 0, "broadcastLimit": 0},
}


@pytest.fixture(params=WAYS)
def way(request, monkeypatch, spark):
    if request.param != "inline":
        from labelloom.operators import inverse, lookup

        monkeypatch.setitem(lookup.index_column.__kwdefaults__, "inline_labels", -1)
        monkeypatch.setitem(inverse.label_column.__kwdefaults__, "array_labels", -1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield WAYS[request.param]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keep_null(spark, way):
    df = strings(spark, "a", "b", "a", None, "c")
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(df)
    assert indices(model, df) == [0.0, 1.0, 0.0, 3.0, 2.0]


def test_keep_unseen(spark, way):
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(
        strings(spark, "a", "b", "a")
    )
    assert indices(model, strings(spark, "x", None, "b", "a")) == [2.0, 2.0, 1.0, 0.0]


def test_nan_and_null_doubles(spark, way):
    df = doubles(spark, 1.0, math.nan, 1.0, 2.5, None)
    model = LabelIndexer(inputCol="v", outputCol="i", **way).fit(df)
    assert [r.label for r in model.dictionary_table().orderBy("idx").collect()] == ["1.0", "2.5"]
    assert indices(model.copy().setHandleInvalid("keep"), df) == [0.0, 2.0, 0.0, 1.0, 2.0]
    assert indices(model.copy().setHandleInvalid("skip"), df) == [0.0, 0.0, 1.0]
    with pytest.raises(Exception, match="Unseen label: NaN"):
        model.transform(df.where("row < 2")).collect()


def test_zero_and_negative_zero_are_two_labels(spark, way):
    df = doubles(spark, 0.0, -0.0, 0.0, 1.0, -0.0, 0.0)
    model = LabelIndexer(inputCol="v", outputCol="i", **way).fit(df)
    assert [r.label for r in model.dictionary_table().orderBy("idx").collect()] == [
        "0.0",
        "-0.0",
        "1.0",
    ]
    assert indices(model, df) == [0.0, 1.0, 0.0, 2.0, 1.0, 0.0]


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "decimal(5,2)"])
def test_numeric_types(spark, way, kind):
    df = strings(spark, "3", "12", "3", "-7", None).withColumn("v", F.col("v").cast(kind))
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(df)
    labels = {"float": ["3.0", "-7.0", "12.0"], "decimal(5,2)": ["3.00", "-7.00", "12.00"]}
    found = [r.label for r in model.dictionary_table().orderBy("idx").collect()]
    assert found == labels.get(kind, ["3", "-7", "12"])
    assert indices(model, df) == [0.0, 2.0, 0.0, 1.0, 3.0]


def test_floats_that_are_no_doubles(spark, way):
    df = doubles(spark, 0.1, 0.3, 0.1).withColumn("v", F.col("v").cast("float"))
    model = LabelIndexer(inputCol="v", outputCol="i", **way).fit(df)
    assert [r.label for r in model.dictionary_table().orderBy("idx").collect()] == ["0.1", "0.3"]
    assert indices(model, df) == [0.0, 1.0, 0.0]


def test_numbers_match_labels_as_printed(spark, way):
    """A model learned on strings finds a number only if it prints as the label."""
    df = strings(spark, "1", "01", " 2", "3.0", "1", "x", "NaN")
    model = LabelIndexer(
        inputCol="v", outputCol="i", handleInvalid="keep", stringOrderType="alphabetAsc", **way
    ).fit(df)
    # " 2", "01", "1", "3.0", "NaN", "x"
    numbers = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "row int, v int")
    assert indices(model, numbers) == [2.0, 6.0, 6.0]
    assert indices(model, doubles(spark, 1.0, 3.0, math.nan)) == [6.0, 3.0, 4.0]
    assert indices(model.copy().setHandleInvalid("skip"), numbers) == [2.0]
    assert indices(model.copy().setHandleInvalid("skip"), doubles(spark, 3.0, math.nan)) == [3.0]


def test_all_null(spark, way):
    df = strings(spark, None, None)
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(df)
    assert model.labels_array() == [[]]
    assert indices(model, df) == [0.0, 0.0]
    assert indices(model.copy().setHandleInvalid("skip"), df) == []


def test_empty_table(spark):
    df = strings(spark, "a").where("false")
    model = LabelIndexer(inputCol="v", outputCol="i").fit(df)
    assert model.labels_array() == [[]]
    assert model.transform(df).collect() == []


def test_decimal_label(spark):
    df = spark.createDataFrame([(0, Decimal("1.50"))], "row int, v decimal(5,2)")
    assert LabelIndexer(inputCol="v", outputCol="i").fit(df).labels_array() == [["1.50"]]


def test_skip_drops_a_row_bad_in_any_column(spark, way):
    fit_on = spark.createDataFrame([("a", 1), ("b", 2)], "s string, k int")
    model = LabelIndexer(
        inputCols=["s", "k"], outputCols=["si", "ki"], handleInvalid="skip", **way
    ).fit(fit_on)
    rows = [("a", 1), ("a", None), (None, 2), ("x", 1), ("b", 9), ("b", 2)]
    got = model.transform(spark.createDataFrame(rows, "s string, k int"))
    assert got.columns == ["s", "k", "si", "ki"]
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0.0, 0.0), ("b", 2, 1.0, 1.0)]


def test_errors_name_the_cause(spark, way):
    model = LabelIndexer(inputCol="v", outputCol="i", **way).fit(strings(spark, "a", "b"))
    with pytest.raises(Exception, match="null has no label"):
        model.transform(strings(spark, "a", None)).collect()
    with pytest.raises(Exception, match="Unseen label: x"):
        model.transform(strings(spark, "a", "x")).collect()


def test_later_filter_does_not_hide_an_error(spark, way):
    model = LabelIndexer(inputCol="v", outputCol="i", **way).fit(strings(spark, "a", "b"))
    bad = strings(spark, "a", "x", None)
    with pytest.raises(Exception, match="Unseen label|null has no label"):
        model.transform(bad).where("v = 'a'").collect()


def test_one_label_in_most_rows(spark, way):
    """A third of the rows hold one label, another third is null."""
    df = spark.range(30_000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("v"),
    )
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(df)
    size = model.num_labels()[0]
    assert size == 10_001
    got = model.transform(df)
    assert got.count() == 30_000
    assert got.where("v = 'hot'").select("i").distinct().collect() == [(0.0,)]
    assert got.where("v is null").select("i").distinct().collect() == [(float(size),)]
    tail = got.where("v like 'k%'").agg(F.countDistinct("i"), F.min("i"), F.max("i")).first()
    assert tuple(tail) == (10_000, 1.0, 10_000.0)
    back = model.inverse_transform(got, {"i": "back"})
    assert back.count() == 30_000
    assert back.where("back <> coalesce(v, '__unknown')").count() == 0


def test_ranks_over_several_partitions(spark):
    df = spark.range(20_000).select((F.col("id") % 5_000).cast("string").alias("v"), "id")
    model = LabelIndexer(
        inputCols=["v", "id"], outputCols=["a", "b"], localLabelLimit=0
    ).fit(df)
    rows = model.dictionary_table()
    for name, size in (("v", 5_000), ("id", 20_000)):
        mine = rows.where(F.col("col_name") == name)
        listed = [r.label for r in mine.orderBy("idx").collect()]
        assert listed == sorted(listed)
        assert mine.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).first() == (
            0.0,
            size - 1.0,
            size,
        )


def test_inverse_truncates(spark):
    stage = IndexToLabel(inputCol="v", outputCol="back", labels=["x", "y"])
    assert indices(stage, doubles(spark, 1.9, -0.5, None, 0.0), "back") == ["y", "x", None, "x"]


@pytest.mark.parametrize("index", [-1.0, 2.0, math.nan, math.inf, -math.inf, 1e300])
def test_inverse_out_of_range(spark, way, index):
    model = LabelIndexer(inputCol="s", outputCol="v", **way).fit(
        spark.createDataFrame([("x",), ("y",)], "s string")
    )
    df = doubles(spark, 1.0, index)
    stage = IndexToLabel(inputCol="v", outputCol="back", labels=["x", "y"])
    for run in (
        lambda: stage.transform(df).collect(),
        lambda: model.inverse_transform(df, {"v": "back"}).collect(),
    ):
        with pytest.raises(Exception, match="Unseen index"):
            run()


def test_inverse_of_integers_and_decimals(spark, way):
    stage = IndexToLabel(inputCol="v", outputCol="back", labels=["x", "y"])
    for kind in ("int", "bigint", "float", "decimal(3,1)"):
        df = doubles(spark, 1.0, 0.0).withColumn("v", F.col("v").cast(kind))
        assert indices(stage, df, "back") == ["y", "x"]


def test_inverse_of_keep(spark, way):
    df = strings(spark, "a", "b", "c", None)
    model = LabelIndexer(inputCol="v", outputCol="i", handleInvalid="keep", **way).fit(df)
    indexed = model.transform(df)
    if not way:
        stage = IndexToLabel(inputCol="i", outputCol="back")
        assert indices(stage, indexed, "back") == ["a", "b", "c", "__unknown"]
    back = model.inverse_transform(indexed, {"i": "back"}).orderBy("row").collect()
    assert [r.back for r in back] == ["a", "b", "c", "__unknown"]


def test_inverse_with_many_labels(spark):
    labels = [f"label {i}" for i in range(3_000)]
    df = doubles(spark, 0.0, 2_999.0, 17.5, None)
    stage = IndexToLabel(inputCol="v", outputCol="back", labels=labels)
    assert indices(stage, df, "back") == ["label 0", "label 2999", "label 17", None]


def test_flatten(spark):
    df = spark.sql(
        "select named_struct('x.y', 1, 'in', named_struct('z', 2, 'l', array(1, 2))) as a, 3 as b"
    ).union(spark.sql("select cast(null as struct<`x.y`:int, in:struct<z:int,l:array<int>>>), 4"))
    flat = flatten(df)
    assert flat.columns == ["a.x.y", "a.in.z", "a.in.l", "b"]
    assert [tuple(r) for r in flat.collect()] == [(1, 2, [1, 2], 3), (None, None, None, 4)]
    with pytest.raises(ValueError, match="more than once"):
        flatten(spark.sql("select named_struct('b', 1) as a, 2 as `a.b`"))


def test_counts_of_one_and_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", math.nan), (None, 1.0)], "s string, d double")
    both = {tuple(r) for r in label_counts(df, ["s", "d"]).collect()}
    assert both == {("s", "a", 2), ("d", "1.0", 2)}
    assert [tuple(r) for r in label_counts(df, ["d"]).collect()] == [("d", "1.0", 2)]


def test_labels_given_twice_or_not_at_all(spark):
    model = LabelIndexerModel.from_labels(
        ["a", "b", "a"], inputCol="v", outputCol="i", handleInvalid="keep"
    )
    assert indices(model, strings(spark, "a", "b", "z")) == [2.0, 1.0, 3.0]
    several = LabelIndexerModel.from_arrays_of_labels(
        [["a"], ["1"]], inputCols=["v", "row"], outputCols=["i", "j"], handleInvalid="keep"
    )
    assert indices(several, strings(spark, "z", "a"), "i") == [1.0, 0.0]
    assert indices(several, strings(spark, "z", "a"), "j") == [1.0, 0.0]


@pytest.mark.parametrize("limits", [{}, {"localLabelLimit": 2}, {"localLabelLimit": 0}])
def test_counts_are_written_for_a_large_table(spark, monkeypatch, limits):
    from labelloom.plans import dictionary

    df = strings(spark, *"bbaaccd", None)
    settings = {"inputCols": ["v", "row"], "outputCols": ["i", "j"], **limits}
    cached = LabelIndexer(**settings).fit(df).dictionary_table().collect()
    written = LabelIndexer(**settings).fit(df).dictionary_table().collect()
    assert sorted(written) == sorted(cached)
    assert len(written) == 4 + 8


STRANGE = ["it's", 'say "hi"', "back\\slash", "\\u0041", "${user.name}", "$x", "a\nb", "", " ", "é\U0001f600"]


def test_labels_of_any_characters(spark, way):
    df = strings(spark, *STRANGE)
    model = LabelIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc", **way).fit(df)
    expected = sorted(STRANGE, key=str.encode)
    assert [r.label for r in model.dictionary_table().orderBy("idx").collect()] == expected
    assert indices(model, df) == [float(expected.index(v)) for v in STRANGE]
    back = model.inverse_transform(model.transform(df), {"i": "back"}).orderBy("row").collect()
    assert [r.back for r in back] == STRANGE
    stage = IndexToLabel(inputCol="row", outputCol="back", labels=STRANGE)
    assert indices(stage, df.drop("v"), "back") == STRANGE
    with pytest.raises(Exception, match="Unseen label: it's not"):
        model.transform(strings(spark, "it's not")).collect()
    known = model.copy().setHandleInvalid("skip")
    assert indices(known, strings(spark, "it's", "its", "")) == [
        float(expected.index("it's")),
        0.0,
    ]

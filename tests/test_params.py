"""Settings and schema checks."""

from __future__ import annotations

import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from labelloom import ColumnRenamer, IndexToLabel, LabelIndexer, LabelIndexerModel
from labelloom.functions.names import quote, unquote


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("a", 1, True, "x"), ("b", 2, False, "y")], "s string, k int, flag boolean, `p.q` string"
    )


def model_of(labels=("a", "b"), **settings):
    return LabelIndexerModel.from_labels(labels, **settings)


def test_setters_chain():
    indexer = (
        LabelIndexer()
        .setInputCols(["a"])
        .setOutputCols(["b"])
        .setHandleInvalid("keep")
        .setStringOrderType("alphabetAsc")
        .setLocalLabelLimit(5)
        .setBroadcastLimit(7)
    )
    assert indexer.in_out_columns() == (["a"], ["b"])
    assert indexer.getHandleInvalid() == "keep"
    assert indexer.getStringOrderType() == "alphabetAsc"
    assert (indexer.getLocalLabelLimit(), indexer.getBroadcastLimit()) == (5, 7)


def test_defaults():
    assert LabelIndexer().getHandleInvalid() == "error"
    assert LabelIndexer().getStringOrderType() == "frequencyDesc"


@pytest.mark.parametrize("setting", [{"handleInvalid": "drop"}, {"stringOrderType": "random"}])
def test_values_outside_their_domain(setting):
    with pytest.raises(ValueError, match="is not one of"):
        LabelIndexer(**setting)


@pytest.mark.parametrize(
    "settings, message",
    [
        ({}, "exactly one of"),
        ({"inputCol": "s", "inputCols": ["s"], "outputCol": "i"}, "exactly one of"),
        ({"inputCol": "s"}, "set outputCol"),
        ({"inputCol": "s", "outputCols": ["i"]}, "set outputCol"),
        ({"inputCols": ["s"], "outputCols": ["i"], "outputCol": "i"}, "not outputCol"),
        ({"inputCols": ["s", "k"], "outputCols": ["i"]}, "as many outputs"),
        ({"inputCols": ["s", "k"], "outputCols": ["i", "i"]}, "the same name"),
        ({"inputCols": ["s", "k"], "outputCols": ["i", "I"]}, "the same name"),
        ({"inputCol": "s", "outputCol": "k"}, "already exists"),
        ({"inputCol": "s", "outputCol": "K"}, "already exists"),
        ({"inputCol": "nope", "outputCol": "i"}, "does not exist"),
        ({"inputCol": "flag", "outputCol": "i"}, "labels are strings or numbers"),
    ],
)
def test_fit_rejects(df, settings, message):
    with pytest.raises(ValueError, match=message):
        LabelIndexer(**settings).fit(df)
    with pytest.raises(ValueError, match=message):
        LabelIndexer(**settings).transformSchema(df.schema)


def test_case_sensitive_session(spark, df):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        model = LabelIndexer(inputCol="s", outputCol="K").fit(df)
        assert model.transform(df).columns == [*df.columns, "K"]
        with pytest.raises(ValueError, match="does not exist"):
            LabelIndexer(inputCol="S", outputCol="i").fit(df)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_declared_schema_is_the_real_one(df):
    indexer = LabelIndexer(inputCols=["s", "`p.q`"], outputCols=["i", "j"])
    model = indexer.fit(df)
    real = model.transform(df).schema
    for declared in (indexer.transformSchema(df.schema), model.transformSchema(df.schema)):
        assert declared.names == real.names == [*df.columns, "i", "j"]
        assert [f.dataType for f in declared] == [f.dataType for f in real]
    assert real["i"].dataType == DoubleType()


def test_many_outputs_keep_their_order(df):
    outputs = [f"out{9 - i}" for i in range(8)]
    model = LabelIndexer(inputCols=["s", "k"] * 4, outputCols=outputs).fit(df)
    assert model.transform(df).columns == [*df.columns, *outputs]


def test_metadata(df):
    model = LabelIndexer(inputCol="s", outputCol="i").fit(df)
    assert model.transform(df).schema["i"].metadata == {
        "ml_attr": {"type": "nominal", "name": "i", "vals": ["a", "b"]}
    }
    kept = model.copy({model.handleInvalid: "keep"}).transform(df)
    assert kept.schema["i"].metadata["ml_attr"]["vals"] == ["a", "b", "__unknown"]
    assert model.getHandleInvalid() == "error"
    table = LabelIndexer(inputCol="s", outputCol="i", localLabelLimit=1).fit(df).transform(df)
    assert table.schema["i"].metadata == model.transform(df).schema["i"].metadata
    told = LabelIndexer(inputCol="s", outputCol="i", metadataLabelLimit=1).fit(df).transform(df)
    metadata = told.schema["i"].metadata
    assert metadata["ml_attr"] == {"type": "nominal", "name": "i"}
    assert metadata["labelloom"]["size"] == 2
    assert IndexToLabel(inputCol="i", outputCol="back").transform(told).where("back <> s").count() == 0
    bare = df.select(F.lit(0.0).alias("i"))
    with pytest.raises(ValueError, match="tells of none"):
        IndexToLabel(inputCol="i", outputCol="back").transform(bare)


def test_metadata_is_read_by_spark(df):
    from pyspark.ml.feature import IndexToString

    indexed = LabelIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    back = IndexToString(inputCol="i", outputCol="back").transform(indexed)
    assert back.where("back <> s").count() == 0


def test_label_named_unknown_is_warned_about(df, caplog):
    model = model_of(["a", "b", "__unknown"], inputCol="s", outputCol="i", handleInvalid="keep")
    with caplog.at_level(logging.WARNING):
        got = model.transform(df)
    assert got.schema["i"].metadata["ml_attr"]["vals"] == ["a", "b", "__unknown", "__unknown"]
    assert "__unknown" in caplog.text


@pytest.mark.parametrize("policy", ["error", "keep", "skip"])
def test_missing_columns_are_left_out(df, policy, caplog):
    model = LabelIndexer(
        inputCols=["s", "k"], outputCols=["si", "ki"], handleInvalid=policy
    ).fit(df)
    with caplog.at_level(logging.WARNING):
        assert model.transform(df.drop("k")).columns == ["s", "flag", "p.q", "si"]
    assert "k does not exist" in caplog.text
    assert model.transform(df.drop("s", "k")).columns == ["flag", "p.q"]
    # nothing about the first two runs is remembered
    assert model.transform(df).columns == [*df.columns, "si", "ki"]


def test_model_of_known_labels(df):
    model = LabelIndexerModel.from_arrays_of_labels(
        [["b", "a"], ["2", "1"]], uid="mine", inputCols=["s", "k"], outputCols=["i", "j"]
    )
    assert model.uid == "mine"
    assert model.labelsArray == [["b", "a"], ["2", "1"]]
    assert [(r.i, r.j) for r in model.transform(df).orderBy("s").collect()] == [(1, 1), (0, 0)]
    with pytest.warns(FutureWarning), pytest.raises(ValueError, match="labels_array"):
        _ = model.labels
    one = model_of(inputCol="s", outputCol="i")
    with pytest.warns(FutureWarning):
        assert one.labels == ["a", "b"]
    with pytest.raises(ValueError, match="strings"):
        model_of([1, 2])


def test_number_of_dictionaries_must_fit(df):
    model = model_of(inputCols=["s", "k"], outputCols=["i", "j"])
    with pytest.raises(ValueError, match="1 columns, but 2"):
        model.transform(df)


def test_copies_and_description(df):
    indexer = LabelIndexer(inputCols=["s"], outputCols=["i"])
    other = indexer.copy({indexer.stringOrderType: "alphabetDesc"})
    assert other.getStringOrderType() == "alphabetDesc" and other.uid == indexer.uid
    assert indexer.getStringOrderType() == "frequencyDesc"
    model = indexer.fit(df, {indexer.stringOrderType: "alphabetDesc"})
    assert model.uid == indexer.uid
    assert model.labels_array() == [["b", "a"]]
    assert repr(model) == "LabelIndexerModel(s -> i (2 labels); error)"


def test_inverse_checks(df):
    with pytest.raises(ValueError, match="an index is a number"):
        IndexToLabel(inputCol="s", outputCol="back", labels=["a"]).transform(df)
    with pytest.raises(ValueError, match="already exists"):
        IndexToLabel(inputCol="k", outputCol="s", labels=["a"]).transform(df)
    with pytest.raises(ValueError, match="does not exist"):
        IndexToLabel(inputCol="nope", outputCol="back", labels=["a"]).transformSchema(df.schema)
    stage = IndexToLabel(inputCol="k", outputCol="back").setLabels(["a", "b", "c"])
    assert stage.transformSchema(df.schema)["back"].dataType == StringType()
    with pytest.raises(ValueError, match="not an output column"):
        model_of(inputCol="s", outputCol="i").inverse_transform(df, {"k": "back"})


def test_given_labels_win_over_metadata(df):
    indexed = LabelIndexer(inputCol="s", outputCol="i.x").fit(df).transform(df)
    for name in ("i.x", "`i.x`"):
        given = IndexToLabel(inputCol=name, outputCol="back", labels=["p", "q"])
        assert {r.back for r in given.transform(indexed).collect()} == {"p", "q"}
        empty = IndexToLabel(inputCol=name, outputCol="back", labels=[])
        assert {r.back for r in empty.transform(indexed).collect()} == {"a", "b"}


def test_rename(df):
    stage = ColumnRenamer(inputCol="`p.q`", outputCol="r")
    assert stage.transform(df).columns == ["s", "k", "flag", "r"]
    assert stage.transformSchema(df.schema) == stage.transform(df).schema
    assert ColumnRenamer(inputCol="s", outputCol="S").transform(df).columns[0] == "S"
    with pytest.raises(ValueError, match="already exists"):
        ColumnRenamer(inputCol="s", outputCol="k").transform(df)
    with pytest.raises(ValueError, match="does not exist"):
        ColumnRenamer(inputCol="nope", outputCol="r").transform(df)


def test_rename_keeps_metadata(df):
    indexed = LabelIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    renamed = ColumnRenamer(inputCol="i", outputCol="j").transform(indexed)
    assert renamed.schema["j"].metadata == indexed.schema["i"].metadata


@pytest.mark.parametrize("name", ["a", "a.b", "a`b", "`", "``"])
def test_quoting(name):
    assert unquote(quote(name)) == name


def test_names_with_backticks(spark):
    df = spark.createDataFrame([("a",)], "`x``y.z` string")
    for name in ("x`y.z", "`x``y.z`"):
        model = LabelIndexer(inputCol=name, outputCol="i").fit(df)
        assert model.transform(df).first()["i"] == 0.0


def test_columns_not_indexed_may_share_a_name(spark):
    df = spark.sql("select 'a' as s, 1 as k, 2 as k")
    model = LabelIndexer(inputCol="s", outputCol="i").fit(df)
    assert model.transform(df).columns == ["s", "k", "k", "i"]

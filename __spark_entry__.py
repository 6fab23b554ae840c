"""The registered queries, and for each of them the SQL that gives the same result.

Labels are compared with what DuckDB prints for the same value, so label columns are strings,
integers and small doubles. The tables hold no nulls and no NaN; those are derived in the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import (
    ColumnRenamer,
    IndexToLabel,
    LabelIndexer,
    LabelIndexerModel,
    flatten,
    label_counts,
    label_sets,
    num_features,
    num_features_from_schema,
    transform_stream,
)
from labelloom.session import SHARED_DIR, new_folder

# The corpus operators are an optional part: without their files, or a library that they need, all else
# works as before.
try:
    import corpus_pipeline
    from labelloom.llm import queries as corpus_queries
except ImportError:
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)):
        spark.conf.set(SHARED_DIR, f"{spark.conf.get('spark.sql.warehouse.dir')}/_labelloom")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- counting and ordering labels -------------------------------------------------------


def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_counts(_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_quantity"])


def q_label_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_sets(_table(spark, sf_dir, "events"), ["event_type", "user_id"])


def _learned(df: DataFrame, column: str, order: str, **settings) -> DataFrame:
    indexer = LabelIndexer(inputCol=column, outputCol="i", stringOrderType=order, **settings)
    return indexer.fit(df).dictionary_table()


def q_fit_frequency_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _learned(_table(spark, sf_dir, "lineitem"), "l_quantity", "frequencyDesc")


def q_fit_frequency_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _learned(_table(spark, sf_dir, "part"), "p_brand", "frequencyAsc")


def q_fit_alphabet_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _learned(_table(spark, sf_dir, "part"), "p_size", "alphabetAsc")


def q_fit_alphabet_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _learned(_table(spark, sf_dir, "events"), "event_type", "alphabetDesc")


def q_fit_null_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = (
        F.when(F.col("l_linenumber") == 7, F.lit(float("nan")))
        .when(F.col("l_linenumber") == 6, F.lit(None))
        .otherwise(F.col("l_quantity"))
    )
    return _learned(_table(spark, sf_dir, "lineitem").select(q.alias("q")), "q", "frequencyDesc")


def q_fit_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _learned(
        _table(spark, sf_dir, "lineitem"), "l_orderkey", "frequencyDesc", localLabelLimit=0
    )
    return rows.select("label", "n", "idx")


def q_fit_multi_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexer = LabelIndexer(
        inputCols=["l_partkey", "l_suppkey"],
        outputCols=["p", "s"],
        stringOrderType="alphabetDesc",
        localLabelLimit=0,
    )
    return indexer.fit(_table(spark, sf_dir, "lineitem")).dictionary_table()


# --- labels to indices --------------------------------------------------------------------


def q_transform_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    model = LabelIndexer(inputCol="o_orderpriority", outputCol="priority_idx").fit(orders)
    return model.transform(orders).select("o_orderkey", "priority_idx")


def _partly_known(
    spark: SparkSession, sf_dir: str, policy: str
) -> tuple[LabelIndexerModel, DataFrame]:
    """A model that has not seen '5-LOW', and orders with nulls for '1-URGENT'."""
    orders = _table(spark, sf_dir, "orders")
    model = LabelIndexer(
        inputCol="o_orderpriority", outputCol="priority_idx", handleInvalid=policy
    ).fit(orders.where(F.col("o_orderpriority") != "5-LOW"))
    return model, orders.withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    )


def q_transform_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, orders = _partly_known(spark, sf_dir, "keep")
    return model.transform(orders).select("o_orderkey", "priority_idx")


def q_transform_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, orders = _partly_known(spark, sf_dir, "skip")
    return model.transform(orders).select("o_orderkey", "priority_idx")


def q_transform_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCols=["l_returnflag", "l_linestatus"], outputCols=["flag_idx", "status_idx"]
    ).fit(lineitem)
    return model.transform(lineitem).select(
        "l_orderkey", "l_linenumber", "flag_idx", "status_idx"
    )


def q_transform_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCols=["l_quantity", "l_linenumber", "l_suppkey"],
        outputCols=["quantity_idx", "line_idx", "supplier_idx"],
        stringOrderType="alphabetAsc",
    ).fit(lineitem)
    return model.transform(lineitem).select(
        "l_orderkey", "l_linenumber", "quantity_idx", "line_idx", "supplier_idx"
    )


def q_transform_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCols=["l_returnflag", "l_linestatus"], outputCols=["flag_idx", "status_idx"]
    ).fit(lineitem)
    narrow = lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return model.transform(narrow).drop("l_returnflag")


def q_transform_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys of few lines are learned; the others and nulls get the extra index."""
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCol="l_orderkey",
        outputCol="order_idx",
        handleInvalid="keep",
        localLabelLimit=0,
        broadcastLimit=0,
    ).fit(lineitem.where("l_linenumber > 3"))
    null_some = lineitem.withColumn(
        "l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    )
    return model.transform(null_some).select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "order_idx"
    )


def q_transform_skip_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCol="l_orderkey",
        outputCol="order_idx",
        handleInvalid="skip",
        localLabelLimit=0,
        broadcastLimit=0,
    ).fit(lineitem.where("l_linenumber > 3"))
    return model.transform(lineitem).select("l_orderkey", "l_linenumber", "order_idx")


def q_model_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = LabelIndexerModel.from_labels(
        ["view", "click"], inputCol="event_type", outputCol="type_idx", handleInvalid="keep"
    )
    return model.transform(_table(spark, sf_dir, "events")).select("event_id", "type_idx")


# --- indices to labels --------------------------------------------------------------------


def q_inverse_given_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumn("b", F.col("p_size") / 10.0)
    stage = IndexToLabel(inputCol="b", outputCol="bucket", labels=[f"s{i}" for i in range(6)])
    return stage.transform(part).select("p_partkey", "bucket")


def q_inverse_from_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, orders = _partly_known(spark, sf_dir, "keep")
    stage = IndexToLabel(inputCol="priority_idx", outputCol="back")
    return stage.transform(model.transform(orders)).select("o_orderkey", "back")


def q_inverse_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key")
    model = LabelIndexer(
        inputCol="key", outputCol="order_idx", localLabelLimit=0, broadcastLimit=0
    ).fit(lineitem)
    indexed = model.transform(lineitem).drop("key")
    return model.inverse_transform(indexed, {"order_idx": "back"}).select(
        "back", "l_linenumber", "l_partkey"
    )


# --- columns, stages, files, streams ------------------------------------------------------


def _nested_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.struct(
        F.col("c_nationkey").alias("nation"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("market"),
    )
    return _table(spark, sf_dir, "customer").select("c_custkey", place.alias("place"))


def q_flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_nested_customers(spark, sf_dir), separator="_")


def q_dotted_column_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(_nested_customers(spark, sf_dir))
    model = LabelIndexer(inputCol="`place.nation`", outputCol="nation_idx").fit(flat)
    return model.transform(flat).select("c_custkey", "nation_idx")


def q_rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return ColumnRenamer(inputCol="n_name", outputCol="nation").transform(nation)


def q_num_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The width found in one row, beside every row's vector."""
    embeddings = _table(spark, sf_dir, "embeddings")
    width = num_features(embeddings, "embedding")
    return embeddings.select("vec_id", F.lit(width).cast("int").alias("num_features"))


def q_num_features_from_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The width in the metadata an assembled vector column carries."""
    vectors = _table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("embedding"), F.col("label").cast("double")
    )
    width = num_features(vectors, "embedding")
    with_size = vectors.withMetadata("embedding", {"ml_attr": {"num_attrs": width}})
    both = VectorAssembler(inputCols=["embedding", "label"], outputCol="v").transform(with_size)
    declared = num_features_from_schema(both.schema["v"])
    return both.select("vec_id", F.lit(declared).cast("int").alias("num_features"))


def q_stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    stages = [
        ColumnRenamer(inputCol="event_type", outputCol="kind"),
        LabelIndexer(inputCol="kind", outputCol="kind_idx"),
        IndexToLabel(inputCol="kind_idx", outputCol="kind_back"),
    ]
    return Pipeline(stages=stages).fit(events).transform(events).drop("kind_idx")


def q_stage_chain_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More labels than metadata lists and the driver holds, there and back in one pipeline."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    stages = [
        LabelIndexer(inputCol="l_orderkey", outputCol="order_idx", localLabelLimit=1_000),
        IndexToLabel(inputCol="order_idx", outputCol="back"),
    ]
    return Pipeline(stages=stages).fit(lines).transform(lines).select("back", "l_linenumber")


def q_saved_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfitted stages saved and loaded inside a pipeline."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    path = new_folder(spark, "pipeline")
    stages = [
        LabelIndexer(inputCol="event_type", outputCol="i", stringOrderType="alphabetDesc"),
        ColumnRenamer(inputCol="i", outputCol="type_idx"),
    ]
    Pipeline(stages=stages).write().overwrite().save(path)
    loaded = Pipeline.load(path)
    return loaded.fit(events).transform(events).select("event_id", "type_idx")


def q_copy_with_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings given for one fit, and a copy of the model with another policy."""
    orders = _table(spark, sf_dir, "orders")
    indexer = LabelIndexer(inputCol="o_orderpriority", outputCol="priority_idx")
    known = orders.where(F.col("o_orderpriority") != "5-LOW")
    model = indexer.fit(known, {indexer.stringOrderType: "alphabetDesc"})
    model = model.copy({model.handleInvalid: "keep"})
    return model.transform(orders).select("o_orderkey", "priority_idx")


def q_load_single_column_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model in the older layout: a single row with the labels of a single column."""
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(inputCol="l_returnflag", outputCol="flag_idx").fit(lineitem)
    path = new_folder(spark, "model")
    model.write().save(path)
    labels = F.array_sort(F.collect_list(F.struct("idx", "label")))["label"]
    old = model.dictionary_table().agg(labels.alias("labels"))
    old.write.mode("overwrite").parquet(f"{path}/data")
    loaded = LabelIndexerModel.load(path)
    return loaded.transform(lineitem).select("l_orderkey", "l_linenumber", "flag_idx")


def q_given_labels_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given labels of which one is listed twice (the later counts), saved as more than the driver
    holds; looked up before and after loading, by broadcast and by shuffle."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    settings = {"inputCol": "event_type", "outputCol": "i", "handleInvalid": "keep"}
    model = LabelIndexerModel.from_labels(
        ["view", "click", "view"], localLabelLimit=2, **settings
    )
    path = new_folder(spark, "model")
    model.write().save(path)
    loaded = LabelIndexerModel.load(path)
    shuffled = loaded.copy({loaded.broadcastLimit: 0})
    ways = {"given": model, "loaded": loaded, "shuffled": shuffled}
    parts = [m.transform(events).select(F.lit(k).alias("way"), "event_id", "i") for k, m in ways.items()]
    return parts[0].union(parts[1]).union(parts[2])


def _saved_and_loaded(
    spark: SparkSession, sf_dir: str, **options: str
) -> tuple[LabelIndexerModel, DataFrame]:
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(inputCol="l_returnflag", outputCol="flag_idx").fit(lineitem)
    path = new_folder(spark, "model")
    writer = model.write()
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)
    return LabelIndexerModel.load(path), lineitem


def q_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, lineitem = _saved_and_loaded(spark, sf_dir)
    return model.transform(lineitem).select("l_orderkey", "l_linenumber", "flag_idx")


def q_save_load_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, lineitem = _saved_and_loaded(spark, sf_dir, layout="labelsArray")
    return model.transform(lineitem).select("l_orderkey", "l_linenumber", "flag_idx")


def q_stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    model = LabelIndexerModel.from_labels(
        ["view", "click"], inputCol="event_type", outputCol="type_idx", handleInvalid="keep"
    )
    output = new_folder(spark, "stream")
    query = transform_stream(
        model,
        stream.select("event_id", "event_type"),
        output,
        new_folder(spark, "stream-checkpoint"),
        available_now=True,
    )
    query.awaitTermination()
    return spark.read.parquet(output).select("event_id", "type_idx")


def q_stream_high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream and a dictionary in buckets: as a join of the stream, and batch by batch."""
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCol="l_orderkey",
        outputCol="order_idx",
        handleInvalid="keep",
        localLabelLimit=0,
        broadcastLimit=0,
    ).fit(lineitem.where("l_linenumber > 3"))
    stream = spark.readStream.schema(lineitem.schema).parquet(f"{sf_dir}/lineitem*.parquet")
    parts = []
    for way, by_batch in (("joined", False), ("by batch", True)):
        output = new_folder(spark, "stream")
        transform_stream(
            model,
            stream.select("l_orderkey", "l_linenumber"),
            output,
            new_folder(spark, "stream-checkpoint"),
            available_now=True,
            by_batch=by_batch,
        ).awaitTermination()
        written = spark.read.parquet(output)
        parts.append(written.select(F.lit(way).alias("way"), "l_orderkey", "l_linenumber", "order_idx"))
    return parts[0].union(parts[1])


def q_transform_hot_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded dictionary without counts; one value that it does not have in a third of the rows."""
    lineitem = _table(spark, sf_dir, "lineitem")
    learned = LabelIndexer(inputCol="l_orderkey", outputCol="order_idx", localLabelLimit=0)
    known = learned.fit(lineitem.where("l_linenumber > 3")).dictionary_table()
    path = new_folder(spark, "model")
    settings = {"inputCol": "l_orderkey", "outputCol": "order_idx", "handleInvalid": "keep"}
    LabelIndexerModel.from_labels([], localLabelLimit=0, broadcastLimit=0, **settings).write().save(path)
    rows = known.select(F.lit("0").alias("column"), "label", F.lit(None).cast("long").alias("n"), "idx")
    rows.write.mode("overwrite").parquet(f"{path}/data")
    model = LabelIndexerModel.load(path).in_buckets()
    hot = F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(F.col("l_orderkey"))
    return model.transform(lineitem.withColumn("l_orderkey", hot)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "order_idx"
    )


def q_transform_check_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values are checked in a pass of its own, so the filter after the stage reaches the files."""
    lineitem = _table(spark, sf_dir, "lineitem")
    model = LabelIndexer(
        inputCols=["l_partkey", "l_returnflag"],
        outputCols=["part_idx", "flag_idx"],
        stringOrderType="alphabetAsc",
        checkFirst=True,
    ).fit(lineitem)
    indexed = model.transform(lineitem).where("l_quantity < 10")
    return indexed.select("l_orderkey", "l_linenumber", "part_idx", "flag_idx")


def q_label_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty columns at once: the remainders of two keys by thirty numbers."""
    lineitem = _table(spark, sf_dir, "lineitem")
    columns = [
        (F.col(key) % (k + 2)).cast("string" if k % 2 else "long").alias(f"{key}_{k + 2}")
        for key in ("l_orderkey", "l_partkey")
        for k in range(30)
    ]
    return label_counts(lineitem.select(*columns), [f"{key}_{k + 2}" for key in ("l_orderkey", "l_partkey") for k in range(30)])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: index two columns of ``lineitem`` at once."""
    return q_transform_multi(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    of_corpora = {}
    if corpus_queries:
        of_corpora = corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return of_corpora | {
        "label_counts": q_label_counts,
        "label_sets": q_label_sets,
        "fit_frequency_desc": q_fit_frequency_desc,
        "fit_frequency_asc": q_fit_frequency_asc,
        "fit_alphabet_asc": q_fit_alphabet_asc,
        "fit_alphabet_desc": q_fit_alphabet_desc,
        "fit_null_nan": q_fit_null_nan,
        "fit_high_cardinality": q_fit_high_cardinality,
        "fit_multi_high_cardinality": q_fit_multi_high_cardinality,
        "transform_error": q_transform_error,
        "transform_keep": q_transform_keep,
        "transform_skip": q_transform_skip,
        "transform_multi": q_transform_multi,
        "transform_numeric": q_transform_numeric,
        "transform_missing_column": q_transform_missing_column,
        "transform_high_cardinality": q_transform_high_cardinality,
        "transform_skip_high_cardinality": q_transform_skip_high_cardinality,
        "model_from_labels": q_model_from_labels,
        "inverse_given_labels": q_inverse_given_labels,
        "inverse_from_metadata": q_inverse_from_metadata,
        "inverse_high_cardinality": q_inverse_high_cardinality,
        "flatten_structs": q_flatten_structs,
        "dotted_column_index": q_dotted_column_index,
        "rename_column": q_rename_column,
        "num_features": q_num_features,
        "num_features_from_schema": q_num_features_from_schema,
        "stage_chain": q_stage_chain,
        "stage_chain_high_cardinality": q_stage_chain_high_cardinality,
        "saved_stages": q_saved_stages,
        "copy_with_overrides": q_copy_with_overrides,
        "load_single_column_layout": q_load_single_column_layout,
        "given_labels_save_load": q_given_labels_save_load,
        "save_load": q_save_load,
        "save_load_arrays": q_save_load_arrays,
        "stream_transform": q_stream_transform,
        "stream_high_cardinality": q_stream_high_cardinality,
        "transform_hot_unseen": q_transform_hot_unseen,
        "transform_check_first": q_transform_check_first,
        "label_counts_wide": q_label_counts_wide,
    }


def _dictionary(table: str, column: str, order: str = "n DESC, label", where: str = "TRUE") -> str:
    """SQL for the dictionary ``(label, n, idx)`` of one column."""
    return f"""
        SELECT label, n, CAST(ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS idx
        FROM (SELECT CAST({column} AS VARCHAR) AS label, COUNT(*) AS n
              FROM {table} WHERE {where} GROUP BY 1)"""


def _named_dictionary(table: str, column: str, order: str = "n DESC, label") -> str:
    return f"SELECT '{column}' AS col_name, * FROM ({_dictionary(table, column, order)})"


def oracle_sql() -> dict[str, str]:
    flag = _dictionary("lineitem", "l_returnflag")
    flag_index = f"""
        WITH a AS ({flag})
        SELECT l_orderkey, l_linenumber, a.idx AS flag_idx
        FROM lineitem JOIN a ON l_returnflag = a.label"""
    known = _dictionary("orders", "o_orderpriority", where="o_orderpriority <> '5-LOW'")
    late_orders = _dictionary("lineitem", "l_orderkey", where="l_linenumber > 3")
    given_labels = """
        SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END
                              AS DOUBLE) AS type_idx
        FROM events"""
    of_corpora = {}
    if corpus_queries:
        of_corpora = dict(corpus_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            of_corpora["pipeline"] = corpus_pipeline.ORACLE_SQL
    return of_corpora | {
        "label_counts": """
            SELECT 'l_returnflag' AS col_name, l_returnflag AS label, COUNT(*) AS n
            FROM lineitem GROUP BY l_returnflag
            UNION ALL
            SELECT 'l_quantity', CAST(l_quantity AS VARCHAR), COUNT(*)
            FROM lineitem GROUP BY l_quantity""",
        "label_sets": """
            SELECT DISTINCT 'event_type' AS col_name, event_type AS label FROM events
            UNION ALL
            SELECT DISTINCT 'user_id', CAST(user_id AS VARCHAR) FROM events""",
        "fit_frequency_desc": _named_dictionary("lineitem", "l_quantity"),
        "fit_frequency_asc": _named_dictionary("part", "p_brand", "n, label"),
        "fit_alphabet_asc": _named_dictionary("part", "p_size", "label"),
        "fit_alphabet_desc": _named_dictionary("events", "event_type", "label DESC"),
        "fit_null_nan": "SELECT 'q' AS col_name, * FROM ("
        + _dictionary("lineitem", "l_quantity", where="l_linenumber NOT IN (6, 7)")
        + ")",
        "fit_high_cardinality": _dictionary("lineitem", "l_orderkey"),
        "fit_multi_high_cardinality": _named_dictionary("lineitem", "l_partkey", "label DESC")
        + " UNION ALL "
        + _named_dictionary("lineitem", "l_suppkey", "label DESC"),
        "transform_error": f"""
            WITH d AS ({_dictionary("orders", "o_orderpriority")})
            SELECT o_orderkey, d.idx AS priority_idx
            FROM orders JOIN d ON o_orderpriority = d.label""",
        "transform_keep": f"""
            WITH d AS ({known})
            SELECT o_orderkey,
                   COALESCE(d.idx, (SELECT CAST(COUNT(*) AS DOUBLE) FROM d)) AS priority_idx
            FROM orders LEFT JOIN d ON NULLIF(o_orderpriority, '1-URGENT') = d.label""",
        "transform_skip": f"""
            WITH d AS ({known})
            SELECT o_orderkey, d.idx AS priority_idx
            FROM orders JOIN d ON NULLIF(o_orderpriority, '1-URGENT') = d.label""",
        "transform_multi": f"""
            WITH a AS ({flag}), b AS ({_dictionary("lineitem", "l_linestatus")})
            SELECT l_orderkey, l_linenumber, a.idx AS flag_idx, b.idx AS status_idx
            FROM lineitem JOIN a ON l_returnflag = a.label JOIN b ON l_linestatus = b.label""",
        "transform_numeric": f"""
            WITH a AS ({_dictionary("lineitem", "l_quantity", "label")}),
                 b AS ({_dictionary("lineitem", "l_linenumber", "label")}),
                 c AS ({_dictionary("lineitem", "l_suppkey", "label")})
            SELECT l_orderkey, l_linenumber, a.idx AS quantity_idx, b.idx AS line_idx,
                   c.idx AS supplier_idx
            FROM lineitem
            JOIN a ON CAST(l_quantity AS VARCHAR) = a.label
            JOIN b ON CAST(l_linenumber AS VARCHAR) = b.label
            JOIN c ON CAST(l_suppkey AS VARCHAR) = c.label""",
        "transform_missing_column": flag_index,
        "transform_high_cardinality": f"""
            WITH d AS ({late_orders})
            SELECT l_partkey, l_suppkey, l_linenumber, l_returnflag,
                   COALESCE(d.idx, (SELECT CAST(COUNT(*) AS DOUBLE) FROM d)) AS order_idx
            FROM lineitem LEFT JOIN d
              ON CASE WHEN l_returnflag <> 'R' THEN CAST(l_orderkey AS VARCHAR) END = d.label""",
        "transform_skip_high_cardinality": f"""
            WITH d AS ({late_orders})
            SELECT l_orderkey, l_linenumber, d.idx AS order_idx
            FROM lineitem JOIN d ON CAST(l_orderkey AS VARCHAR) = d.label""",
        "model_from_labels": given_labels,
        "inverse_given_labels": """
            SELECT p_partkey, 's' || CAST(CAST(TRUNC(p_size / 10.0) AS INTEGER) AS VARCHAR) AS bucket
            FROM part""",
        "inverse_from_metadata": """
            SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN '__unknown'
                                    ELSE o_orderpriority END AS back
            FROM orders""",
        "inverse_high_cardinality": """
            SELECT CAST(l_orderkey AS VARCHAR) AS back, l_linenumber, l_partkey FROM lineitem""",
        "flatten_structs": """
            SELECT c_custkey, c_nationkey AS place_nation, c_mktsegment AS place_market_segment
            FROM customer""",
        "dotted_column_index": f"""
            WITH d AS ({_dictionary("customer", "c_nationkey")})
            SELECT c_custkey, d.idx AS nation_idx
            FROM customer JOIN d ON CAST(c_nationkey AS VARCHAR) = d.label""",
        "rename_column": "SELECT n_nationkey, n_name AS nation, n_regionkey FROM nation",
        "num_features": "SELECT vec_id, CAST(LEN(embedding) AS INTEGER) AS num_features FROM embeddings",
        "num_features_from_schema": """
            SELECT vec_id, CAST(LEN(embedding) + 1 AS INTEGER) AS num_features FROM embeddings""",
        "stage_chain": "SELECT event_id, event_type AS kind, event_type AS kind_back FROM events",
        "stage_chain_high_cardinality": """
            SELECT CAST(l_orderkey AS VARCHAR) AS back, l_linenumber FROM lineitem""",
        "saved_stages": f"""
            WITH d AS ({_dictionary("events", "event_type", "label DESC")})
            SELECT event_id, d.idx AS type_idx FROM events JOIN d ON event_type = d.label""",
        "copy_with_overrides": f"""
            WITH d AS ({_dictionary("orders", "o_orderpriority", "label DESC", "o_orderpriority <> '5-LOW'")})
            SELECT o_orderkey,
                   COALESCE(d.idx, (SELECT CAST(COUNT(*) AS DOUBLE) FROM d)) AS priority_idx
            FROM orders LEFT JOIN d ON o_orderpriority = d.label""",
        "load_single_column_layout": flag_index,
        "given_labels_save_load": """
            SELECT way, event_id, CAST(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 1 ELSE 3 END
                                       AS DOUBLE) AS i
            FROM events CROSS JOIN (VALUES ('given'), ('loaded'), ('shuffled')) AS w(way)""",
        "save_load": flag_index,
        "save_load_arrays": flag_index,
        "stream_transform": given_labels,
        "stream_high_cardinality": f"""
            WITH d AS ({late_orders}),
                 r AS (SELECT l_orderkey, l_linenumber,
                              COALESCE(d.idx, (SELECT CAST(COUNT(*) AS DOUBLE) FROM d)) AS order_idx
                       FROM lineitem LEFT JOIN d ON CAST(l_orderkey AS VARCHAR) = d.label)
            SELECT 'joined' AS way, * FROM r
            UNION ALL
            SELECT 'by batch', * FROM r""",
        "transform_hot_unseen": f"""
            WITH d AS ({late_orders}),
                 t AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_orderkey END
                                         AS l_orderkey)
                       FROM lineitem)
            SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   COALESCE(d.idx, (SELECT CAST(COUNT(*) AS DOUBLE) FROM d)) AS order_idx
            FROM t LEFT JOIN d ON CAST(l_orderkey AS VARCHAR) = d.label""",
        "transform_check_first": f"""
            WITH a AS ({_dictionary("lineitem", "l_partkey", "label")}),
                 b AS ({_dictionary("lineitem", "l_returnflag", "label")})
            SELECT l_orderkey, l_linenumber, a.idx AS part_idx, b.idx AS flag_idx
            FROM lineitem
            JOIN a ON CAST(l_partkey AS VARCHAR) = a.label
            JOIN b ON l_returnflag = b.label
            WHERE l_quantity < 10""",
        "label_counts_wide": " UNION ALL ".join(
            f"SELECT '{key}_{k + 2}' AS col_name, CAST({key} % {k + 2} AS VARCHAR) AS label, COUNT(*) AS n "
            "FROM lineitem GROUP BY 2"
            for key in ("l_orderkey", "l_partkey")
            for k in range(30)
        ),
    }

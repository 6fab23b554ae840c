"""Every registered query against its SQL, on whole tables at sf0.01."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(SF_DIR, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def ordered(table: pa.Table) -> pa.Table:
    table = table.select(sorted(table.column_names))
    return table.sort_by([(name, "ascending") for name in table.column_names])


def test_every_query_of_the_library_has_sql():
    without = entry_points.queries().keys() - entry_points.oracle_sql().keys()
    of_corpora = entry_points.corpus_queries.QUERIES if entry_points.corpus_queries else {}
    assert without <= {*of_corpora, "pipeline"}


@pytest.mark.parametrize("name", entry_points.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    got = ordered(entry_points.queries()[name](spark, SF_DIR).toArrow())
    want = ordered(duck.sql(entry_points.oracle_sql()[name]).to_arrow_table())
    assert got.column_names == want.column_names
    assert [str(t) for t in got.schema.types] == [str(t) for t in want.schema.types]
    assert got.num_rows == want.num_rows > 0
    assert got.to_pydict() == want.to_pydict()


@pytest.mark.parametrize("hidden", ["zstandard", "public_tokenizers", "labelloom.llm", "corpus_pipeline"])
def test_the_library_works_without_the_corpus_operators(hidden):
    code = f"""
import sys
sys.modules[{hidden!r}] = None
import __spark_entry__ as e
assert e.queries().keys() == e.oracle_sql().keys() and "transform_multi" in e.queries()
assert not [name for name in e.queries() if name.startswith("op") or name == "pipeline"]
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry_points.__file__))


def test_flagship(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["l_orderkey", "l_linenumber", "flag_idx", "status_idx"]
    assert rows.count() > 0

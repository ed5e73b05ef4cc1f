"""The registered queries as a whole: SQL parity on the smallest tables, plans, sinks."""

import os

import duckdb
import pytest
from conftest import plan, rows

import __spark_entry__ as entry
from brindle.plans import oracle, registry
from brindle.sources import readers, sinks

FOLDER = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
labels conversations""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, database, name):
    frame = entry.queries()[name](spark, FOLDER)
    result = database.sql(entry.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert sorted(result.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    key = lambda r: tuple((v is None, v) for v in r)
    expected = sorted(result.project(picked).fetchall(), key=key)
    assert sorted((tuple(r) for r in frame.select(*columns).collect()), key=key) == expected


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: Sequential passes in shards and sums of weight vectors have no built-in form.
WITH_PYTHON = {"spam_train_mixed", "roc_bootstrap"}


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("stream_")))
def test_plans_have_no_cross_join_and_no_needless_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert name in WITH_PYTHON or ("Python" not in text and "InPandas" not in text)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_pair_text_sink(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b", 0.5, 3)], "w1 string, w2 string, pmi double, n int")
    path = str(tmp_path / "pairs")
    sinks.write_pairs_text(pairs, path, ["w1", "w2"], ["pmi", "n"])
    sinks.write_pairs_text(pairs, path, ["w1", "w2"], ["pmi", "n"])
    assert rows(readers.text_lines(spark, path)) == [("((a, b), (0.5, 3))",)]
    for format in ("parquet", "csv", "json"):
        sinks.write_table(pairs, path, format)
        assert spark.read.schema(pairs.schema).format(format).load(path).first().n == 3

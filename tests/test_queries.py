"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows_of(table, columns):
    return sorted(zip(*[table.column(c).to_pylist() for c in columns]), key=repr)


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    found = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    want = sql.sql(entry_point.oracle_sql()[name]).to_arrow_table()
    assert sorted(want.column_names) == columns
    assert rows_of(found.toArrow(), columns) == rows_of(want, columns)


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_query_gives_rows(spark, name):
    assert entry_point.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    found = entry_point.entry(spark)
    assert found.count() == 2
    assert found.where("loss is null or val_loss is null").count() == 0


def test_model_round_trip_keeps_the_predictions(spark):
    stored = entry_point.queries()["model_round_trip"](spark, SF_DIR).collect()
    unstored = entry_point.queries()["scored_predictions"](spark, SF_DIR).select("start", "pred").collect()
    assert len(stored) > 100 and sorted(map(tuple, stored)) == sorted(map(tuple, unstored))

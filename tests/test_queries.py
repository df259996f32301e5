"""Every core query against its SQL on the smallest tables."""

import importlib

import pytest
from compare import DATA, rows_of, sql_rows

import __spark_entry__ as entry

CORE = {n: (q, r.oracles.get(n)) for m in entry._CORE for r in [importlib.import_module(f"corpusloom.plans.{m}").REGISTRY] for n, q in r.queries.items()}
SMALL = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, name):
    query, sql = CORE[name]
    columns, rows = rows_of(query(spark, str(SMALL)))
    if sql is None:
        assert rows
    else:
        assert (columns, rows) == sql_rows(SMALL, sql)


def test_every_key_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_result_does_not_depend_on_partitions(spark):
    one = rows_of(CORE["backlinks"][0](spark, str(SMALL)))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows_of(CORE["backlinks"][0](spark, str(SMALL))) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "id", "prev_version", "next_version", "change"]

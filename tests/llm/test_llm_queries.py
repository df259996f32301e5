"""Every text query on the smallest tables, on empty ones, and with SQL where there is one."""

import pytest
from compare import DATA, rows_of, sql_rows

from corpusloom.llm.queries import REGISTRY

SMALL = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
FOUND = {
    "p1_found": ["key_a", "key_b", "tbl"], "p2_found": ["key_a", "key_b", "tbl"], "p3_found": ["unit_key"], "p5_found": ["unit_key", "word"], "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query(spark, name):
    columns, rows = rows_of(REGISTRY.queries[name](spark, str(SMALL)))
    assert columns == FOUND.get(name, columns)
    if name in REGISTRY.oracles:
        assert (columns, rows) == sql_rows(SMALL, REGISTRY.oracles[name])


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for table in ("units", "pcg_term", "documents", "split_rule", "container_spec", "mix_target"):
        df = spark.read.parquet(str(SMALL / f"{table}.parquet"))
        df.limit(0).withColumnsRenamed({}).coalesce(1).write.parquet(str(folder / f"{table}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_empty_tables(spark, empty, name):
    assert REGISTRY.queries[name](spark, empty).count() == 0

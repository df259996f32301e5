from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.snapshots import CHANGES, OUT, SnapshotIndex, fed_changes, snapshot_change_values, snapshot_changes

SCHEMA = "source string, id string, source_version string, canonical_hash string, fetched_at timestamp, title string, change string, was int"
DAY = lambda d: datetime(2026, 1, d)


def table(spark, *rows):
    return spark.createDataFrame([(*r, "t", "clash", 1) for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r)[:5] for r in df.select(*OUT).collect())


def test_added_removed_changed_and_spellings(spark):
    rows = table(
        spark,
        ("eCFR ", "a", "1", "sha256:AA", DAY(1)), ("ecfr", "b", "1", "bb", DAY(1)), ("ecfr", "c", "1", None, DAY(1)), ("ecfr", "d", "1", "dd", DAY(1)),
        (" ECFR", "a", "2", "aa ", DAY(2)), ("ecfr", "b", "2", "b2", DAY(2)), ("ecfr", "c", "2", "cc", DAY(2)), ("ecfr", "e", "2", None, DAY(2)),
        ("other", "a", "9", "aa", DAY(2)),
    )
    assert found(snapshot_changes(rows)) == [("ecfr", "b", "1", "2", "changed"), ("ecfr", "d", "1", "2", "removed"), ("ecfr", "e", "1", "2", "added")]


def test_latest_delivery_counts_and_ties_are_fixed(spark):
    rows = [
        ("s", "a", "1", "x", DAY(1)), ("s", "a", "2", "x", DAY(2)), ("s", "a", "2", "late", DAY(9)), ("s", "a", "2", "never", None),
        ("s", "b", "1", "x", DAY(1)), ("s", "b", "2", "x", DAY(2)), ("s", "b", "2", "y", DAY(2)), ("s", "b", "2", "y", DAY(2)),
    ]
    want = [("s", "a", "1", "2", "changed"), ("s", "b", "1", "2", "changed")]
    assert found(snapshot_changes(table(spark, *rows))) == want
    assert found(snapshot_changes(table(spark, *rows[::-1]).repartition(5))) == want


def test_nulls_in_keys_one_version_and_empty(spark):
    rows = table(spark, (None, "a", "1", "x", DAY(1)), ("s", None, "1", "x", DAY(1)), ("s", "a", None, "x", DAY(1)), ("s", "a", "1", "x", DAY(1)))
    assert found(snapshot_changes(rows)) == []
    assert found(snapshot_changes(rows.limit(0))) == []
    assert snapshot_changes(rows.limit(0)).schema.simpleString() == spark.createDataFrame([], CHANGES).schema.simpleString()


def test_sources_with_histories_of_different_length(spark):
    rows = table(spark, ("s", "a", "1", "x", DAY(1)), ("s", "a", "2", "y", DAY(1)), ("s", "a", "3", "z", DAY(1)), ("t", "a", "1", "x", DAY(1)), ("t", "b", "2", "x", DAY(1)))
    assert found(snapshot_changes(rows)) == [
        ("s", "a", "1", "2", "changed"), ("s", "a", "2", "3", "changed"), ("t", "a", "1", "2", "removed"), ("t", "b", "1", "2", "added"),
    ]


def test_hot_key(spark):
    many = spark.range(20_000).select(F.lit("s").alias("source"), F.lit("a").alias("id"), F.lit("1").alias("source_version"), F.lit("x").alias("canonical_hash"), F.lit(DAY(1)).alias("fetched_at"))
    rows = many.unionByName(many.limit(1).withColumns({"source_version": F.lit("2"), "canonical_hash": F.lit("y")}))
    assert found(snapshot_changes(rows)) == [("s", "a", "1", "2", "changed")]


def test_feed_one_by_one_swaps_the_index(spark):
    index = SnapshotIndex(spark, buckets=4)
    assert index.feed(table(spark, ("s", "a", "1", "x", DAY(1)), ("t", "a", "1", "x", DAY(1)))).count() == 0
    assert found(index.feed(table(spark, ("s", "a", "2", "y", DAY(2)), ("s", "b", "2", "y", DAY(2))))) == [("s", "a", "1", "2", "changed"), ("s", "b", "1", "2", "added")]
    assert found(index.feed(table(spark, ("t", "c", "2", "x", DAY(3))))) == [("t", "a", "1", "2", "removed"), ("t", "c", "1", "2", "added")]


def test_probe_needs_no_shuffle(spark):
    index = SnapshotIndex(spark, buckets=4)
    index.feed(table(spark, ("s", "a", "1", "x", DAY(1))))
    new = index.write(table(spark, ("s", "a", "2", "x", DAY(1))).selectExpr("source", "id", "source_version version", "canonical_hash hash"))
    plan = index.probe(new)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_history_needs_one_join_and_no_shuffle_after_the_index(spark):
    from corpusloom.operators.snapshots import buckets_for

    rows = table(spark, *[("s", i, str(v), f"{i}{v // 3}", DAY(v)) for v in range(1, 9) for i in "abc"])
    plan = snapshot_changes(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "Exchange" not in plan
    assert [buckets_for(n, 8) for n in (0, 10, 120_000, 10**7, 10**12)] == [1, 1, 3, 20, 20_000]


def test_fed_in_turn_is_the_same(spark):
    rows = table(spark, *[(s, i, str(v), f"{i}{v // 2}", DAY(v)) for v in range(1, 6) for s in "st" for i in "abcd" if (v + ord(i)) % 3 and (s == "s" or v < 4)])
    assert found(fed_changes(rows)) == found(snapshot_changes(rows)) != []
    assert found(fed_changes(rows.limit(0))) == []


def test_values_of_changed_rows(spark):
    rows = table(spark, ("s", "a", "1", "x", DAY(1)), ("s", "a", "2", "y", DAY(2)), ("s", "b", "2", "y", DAY(2)))
    got = {r.id: (r.old_title, r.new_title, r.old_hash, r.new_hash) for r in snapshot_change_values(rows, "title").collect()}
    assert got == {"a": ("t", "t", "x", "y"), "b": (None, "t", None, "y")}


def test_scratch_folder_must_be_shared(monkeypatch):
    from corpusloom import scratch

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda name, default=None: default)})

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())

import itertools
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import copies, near_duplicates, walk
from corpusloom.llm.near_duplicates import Edits, SetOverlap


def written(spark):
    """Bytes that all stages so far wrote as shuffle files or tables."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() + stages.apply(i).outputBytes() for i in range(stages.size()))


def test_disk_follows_the_input(spark):
    """All that is written on the way, freed or not, is a few times the input: neither roots, nodes nor met pairs are moved."""
    path = Path("/root/testdata/sf0.1/units.parquet")
    if not path.exists():
        pytest.skip("needs the test tables")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    before = written(spark)
    assert copies.unit_copies(spark.read.parquet(str(path))).links.count() > 0
    size = sum(p.stat().st_size for p in ([path] if path.is_file() else path.glob("*.parquet")))
    assert 0 < written(spark) - before < 10 * size


def test_many_blocks_against_all_pairs(spark, monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(walk, "POSTINGS", 150)
    base = [[draw.randrange(-(2**63), 2**63) for _ in range(40)] for _ in range(12)]
    rows = [(k, list({*draw.sample(draw.choice(base), draw.randrange(20, 41)), *range(draw.randrange(4))})) for k in range(90)]
    df = spark.createDataFrame(rows, "item long, tokens array<long>").repartition(5)
    want = {(a, b, len({*x} & {*y})) for (a, x), (b, y) in itertools.combinations(rows, 2) if len({*x} & {*y}) / len({*x} | {*y}) >= 0.5}
    got = [tuple(r) for r in near_duplicates.similar_sets(df, 0.5).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_crowded_counters_lose_no_pair(spark, monkeypatch):
    """All tokens in one bucket: the rank says nothing, the pairs are the same."""
    draw = random.Random(4)
    rows = [(k, [4 * near_duplicates.BUCKETS * t for t in draw.sample(range(40), draw.randrange(1, 15))]) for k in range(80)]
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if len({*x} & {*y}) / len({*x} | {*y}) >= 0.4}
    got = near_duplicates.similar_sets(spark.createDataFrame(rows, "item long, tokens array<long>"), 0.4)
    assert {(r.a, r.b) for r in got.collect()} == want and want


def test_blocks_hold_every_record_once(spark, monkeypatch):
    monkeypatch.setattr(walk, "POSTINGS", 10)
    monkeypatch.setattr(walk, "FILE_ROWS", 7)
    rows = spark.range(50).select(F.col("id").alias("item"), F.expr("transform(sequence(1, cast(id % 13 + 1 as int)), i -> i)").alias("roots"))
    path = walk.planted(rows.repartition(3), "blocks")
    store, _ = walk.opened(path)
    from pyarrow import parquet

    items, seen = walk.blocks(path), []
    for block in items:
        parts = [parquet.read_table(f, filesystem=store).slice(lo, hi - lo) for f, lo, hi in block]
        lengths = [len(r) for p in parts for r in p.column("roots").to_pylist()]
        assert sum(lengths) <= 10 or len(lengths) == 1
        seen += [i for p in parts for i in p.column("item").to_pylist()]
    assert sorted(seen) == list(range(50))


@pytest.mark.parametrize("own", [True, False])
@pytest.mark.parametrize("test", [SetOverlap(0.01), Edits(200)])
def test_lots_and_held_meetings_change_nothing(monkeypatch, own, test):
    """Pairs that meet at enough roots, whatever the lots; bounds that exclude nothing leave the count alone to decide."""
    draw = np.random.default_rng(5)

    def made(first):
        lengths = draw.integers(0, 9, 40)
        roots = np.concatenate([draw.choice(30, n, replace=False) for n in lengths])
        size = np.full(40, 100)
        marks = np.zeros((40, 4), np.uint64)
        return (np.arange(first, first + 40), size, size, np.zeros(40, np.int64), marks, lengths, roots), np.split(roots, np.cumsum(lengths)[:-1])

    (one, x), (two, y) = made(0), made(0 if own else 100)
    enough = int(test.meetings(np.array([200])).max()) if isinstance(test, SetOverlap) else 1
    if own:
        want = {(a, b) for a, b in itertools.combinations(range(40), 2) if len({*x[a]} & {*x[b]}) >= enough}
    else:
        want = {(a, b) for a in range(40) for b in range(40) if len({*x[a]} & {*y[b]}) >= enough}
    for lot, held, node in ((1 << 18, 1 << 22, 16), (3, 5, 2), (1, 1, 1)):
        monkeypatch.setattr(walk, "LOT", lot)
        monkeypatch.setattr(walk, "HELD", held)
        left = walk.forest(*one, test, node)
        a, b = walk.walk(left, left if own else walk.forest(*two, test, node), test)
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(want) and want

"""Related records: all pairs meet inside of tasks, and every record of the table asks."""

import math
import re
from collections import Counter

import pytest
from compare import DATA

import __spark_entry__ as entry
from corpusloom.operators import cosine, related

SMALL = DATA / "sf0.001"


def by_hand(data, k, floor, asks=lambda key: True):
    counts = {key: Counter(re.findall("[a-z][a-z]+", text.lower())) for key, _, text in data if key is not None and text}
    df = Counter(t for _, _, text in data if text for t in set(re.findall("[a-z][a-z]+", text.lower())))
    raw = {key: {t: (1 + math.log(n)) * (math.log((len(data) + 1) / (df[t] + 1)) + 1) for t, n in c.items()} for key, c in counts.items() if c}
    unit = {key: {t: v / math.sqrt(sum(x * x for x in r.values())) for t, v in r.items()} for key, r in raw.items()}
    group = {key: g for key, g, _ in data}
    out = []
    for a in filter(asks, unit):
        near = [(-round(sum(v * unit[b].get(t, 0) for t, v in unit[a].items()), 6), b) for b in unit if b != a]
        for same in (True, False):
            best = sorted(x for x in near if -x[0] >= floor and (group[x[1]] == group[a]) == same)[:k]
            out += [(a, b, same, rank, -s) for rank, (s, b) in enumerate(best, 1)]
    return sorted(out)


def made():
    words = ["altimeter", "beacon", "ceiling", "dispatch", "ember", "flap", "glide", "hold", "inbound", "jet", "keel", "light"]
    rows = [(i, ("x", "y", None)[i % 3], " ".join(w for j, w in enumerate(words) if i * 2654435761 >> j & 1) + (f" only{'abcdefghij'[i % 10]}" if i % 4 else "")) for i in range(120)]
    rows += [(1000 + i, "x" if i % 5 else "y", "beacon beacon glide of a hold") for i in range(40)]
    return [*rows, (2000, "x", None), (2001, "y", "1 2"), (None, "x", "beacon light")]


@pytest.mark.parametrize("block, lot", [(2048, 4096), (7, 5), (50, 17)])
def test_copies_groups_and_lots_against_all_pairs(spark, block, lot):
    data = made()
    df = spark.createDataFrame(data, "k long, g string, text string").repartition(5)
    got = related.related(df, "k", "g", None, len(data), k=3, block=block, rows_at_once=lot).collect()
    assert sorted((*r[:4], round(r[4], 6)) for r in got) == by_hand(data, 3, 0.25)
    some = related.related(df, "k", "g", "k % 7 = 0", len(data), k=3, block=block, rows_at_once=lot).collect()
    assert sorted((*r[:4], round(r[4], 6)) for r in some) == by_hand(data, 3, 0.25, lambda key: key % 7 == 0)


def test_tables_without_pairs(spark):
    df = spark.createDataFrame([(1, "x", "alone here"), (2, "x", None), (3, "x", "other words")], "k long, g string, text string")
    assert related.related(df, "k", "g", None, 3).count() == 0
    assert related.related(df.limit(0), "k", "g", None, 0).count() == 0


def test_pairs_are_not_moved(spark):
    """Moved pairs were 2.3 GB for 31 MB of units."""
    df = spark.createDataFrame(made(), "k long, g string, text string")
    plan = related.related(df, "k", "g", "k % 5 = 0", 160)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def units(spark):
    rows = spark.read.parquet(f"{SMALL}/units.parquet").dropDuplicates(["unit_key"]).collect()
    return [(r.unit_key, r.layer, "\n".join(t for t in [r.heading, *(r.texts or [])] if t is not None)) for r in rows]


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_every_unit_asks_for_related_units(spark):
    want = by_hand(units(spark), 5, 0.25)
    got = entry.queries()["tfidf_related_topk"](spark, str(SMALL)).select("src", "dst", "same_group", "rank", "score").collect()
    assert sorted((*r[:4], round(r[4], 6)) for r in got) == want
    assert {r[0] % 50 for r in got} == set(range(50))


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_index_has_every_unit(spark):
    want = by_hand(units(spark), 5, 0.25)
    got = entry.queries()["related_index"](spark, str(SMALL)).collect()
    assert sorted((r.src, r.dst, r.same_group, r["rank"], round(r.score, 6)) for r in got) == want
    assert {(r.provider_id, r.provider_version) for r in got} == {related.PROVIDER}


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_every_unit_keeps_what_it_does_not_cite(spark):
    queries = entry.queries()
    rows = spark.read.parquet(f"{SMALL}/units.parquet").select("unit_key", "layer", "citation").distinct().collect()
    keys = {(r.layer, r.citation): set() for r in rows}
    for r in rows:
        keys[r.layer, r.citation].add(r.unit_key)
    forms = {"section": ("cfr", "14 CFR § "), "paragraph": ("aim", "AIM ")}
    cited = {(r.unit_key, key) for r in queries["explicit_refs"](spark, str(SMALL)).collect() if r.kind in forms for key in keys.get((forms[r.kind][0], forms[r.kind][1] + r.target), ())}
    want = sorted((a, b, s) for a, b, _, _, s in by_hand(units(spark), 5, 0.25) if (a, b) not in cited)
    got = queries["related_minus_explicit"](spark, str(SMALL)).collect()
    assert sorted((r.src, r.dst, round(r.score, 6)) for r in got) == want


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_every_unit_is_reviewed(spark):
    reviews = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct().collect()
    rejected = {(r.l_orderkey, r.l_partkey) for r in reviews}
    want = sorted((a, b, s) for a, b, _, _, s in by_hand(units(spark), 5, 0.25) if (a, b) not in rejected)
    got = entry.queries()["review_filter"](spark, str(SMALL)).collect()
    assert sorted((r.src, r.dst, round(r.score, 6)) for r in got) == want


def test_packed_numbers_come_back():
    numbers = [0, 1, 127, 128, 16_383, 16_384, 5, 2**31 - 1, 0]
    data, used = cosine.packed(numbers)
    got, until = cosine.unpacked(data)
    assert got.tolist() == numbers and until.tolist() == used.cumsum().tolist() and len(data) == 17
    assert cosine.unpacked(cosine.packed([3, 0, 9])[0])[0].tolist() == [3, 0, 9]

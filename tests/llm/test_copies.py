import itertools
import random
from datetime import datetime

import pytest

from corpusloom.llm import copies, near_duplicates

AT = datetime(2026, 1, 1)
UNIT = "unit_key long, texts array<string>, collected_at timestamp, heading string, item int, text string"
TERM = "term_key long, term string, fetched_at timestamp, a int, b int, text string"


def units(spark, *rows):
    return spark.createDataFrame([(k, t, AT, "h", 1, "x") for k, t in rows], UNIT)


def terms(spark, *rows):
    return spark.createDataFrame([(k, t, AT, 1, 2, "x") for k, t in rows], TERM)


def pairs(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def runs(words, n=3):
    return set(zip(*[words[i:] for i in range(n)]))


def made(seed, n=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[draw.choice(vocabulary) for _ in range(draw.randrange(45, 120))] for _ in range(n // 4)]
    rows = []
    for k in range(n):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 3, 8, 15])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((k, words))
    return rows


@pytest.mark.parametrize("node", [1024, 16, 1])
def test_units_against_all_pairs(spark, monkeypatch, node):
    monkeypatch.setattr(near_duplicates, "NODE", node)
    rows = made(node)
    want = set()
    for (a, x), (b, y) in itertools.combinations(rows, 2):
        s, t = runs(x), runs(y)
        if min(len(x), len(y)) >= 50 and len(s & t) / len(s | t) >= 0.5:
            want.add((a, b))
    df = units(spark, *[(k, [" ".join(w[:20]), None, " ".join(w[20:])]) for k, w in rows], (None, ["x"]), (900, None), (901, []), (902, [""]), (903, [None]))
    got = copies.unit_copies(df.unionByName(df))
    assert pairs(got.pairs()) == want
    assert want
    groups = {r.key: (r.class_id, r.group_id) for r in got.groups().collect()}
    assert all(groups[a][1] == groups[b][1] for a, b in want)
    assert len(groups) == sum(len(w) >= 50 for _, w in rows)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = list(itertools.accumulate(zip(row, row[1:], b), lambda left, d: min(left + 1, d[1] + 1, d[0] + (x != d[2])), initial=i))
    return row[-1]


@pytest.mark.parametrize("node", [1024, 16, 1])
def test_terms_against_all_pairs(spark, monkeypatch, node):
    monkeypatch.setattr(near_duplicates, "NODE", node)
    draw = random.Random(node)
    words = ["runway", "glide", "path", "angle", "fuel", "beacon", "ab"]
    rows = []
    for k in range(80):
        term = " ".join(draw.sample(words, draw.randrange(1, 4)))
        for _ in range(draw.randrange(4)):
            i = draw.randrange(len(term) + 1)
            term = draw.choice([term[:i] + "q" + term[i:], term[:i] + term[i + 1 :], term[:i] + "z" + term[i + 1 :]])
        rows.append((k, term))
    rows += [(200, "RUNWAY GLIDE"), (201, "glide runway"), (202, None), (203, ""), (204, "--------"), (205, "......... "), (206, "rуnway glide")]
    low = {k: t.lower().replace("у", "y") for k, t in rows if t is not None and len(t) >= 8}
    bag = lambda t: sorted(__import__("re").findall("[a-z0-9]+", t))
    want = {(a, b) for a, b in itertools.combinations(sorted(low), 2) if edits(low[a], low[b]) <= 2 or bag(low[a]) == bag(low[b]) != []}
    assert pairs(copies.term_copies(terms(spark, *rows, (None, "runway glide"))).pairs()) == want


def test_equal_texts_are_one_class(spark):
    text = " ".join(f"word{i}" for i in range(60))
    got = copies.unit_copies(units(spark, *[(k, [text]) for k in range(400)]))
    assert got.links.count() == 0
    assert {(r.class_id, r.links) for r in got.groups().collect()} == {(0, 0)}
    assert got.pairs().count() == 400 * 399 // 2


def test_empty_tables(spark):
    for got in (copies.unit_copies(units(spark, (1, ["x"])).limit(0)), copies.term_copies(terms(spark, (1, "x")).limit(0))):
        assert got.pairs().count() == 0 and got.groups().count() == 0
    assert copies.unit_spellings(units(spark, (1, ["x"])).limit(0)).count() == 0
    assert copies.term_spellings(terms(spark, (1, "x")).limit(0)).count() == 0


def test_spellings(spark):
    rows = [
        (1, ["A", "b c"]), (2, ["Ａ", "b c"]), (3, ["A", "b c"]), (4, ["A", "b c"]), (5, ["A b c"]), (6, ["A", None]), (7, ["А", None]), (8, ["A", ""]),
        (9, None), (10, []), (11, ["a", "b c"]), (12, ["A​", None]),
    ]
    assert pairs(copies.unit_spellings(units(spark, *rows, *rows))) == {(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (6, 7), (6, 12), (7, 12)}
    entries = [(1, "BEACON"), (2, "BЕACON"), (3, "BEACON"), (4, "beacon"), (5, None), (6, "BÉACON"), (7, "BÉACON"), (8, "BEACON﻿")]
    assert pairs(copies.term_spellings(terms(spark, *entries))) == {(1, 2), (2, 3), (6, 7), (1, 8), (2, 8), (3, 8)}


def test_small_sets_against_all_pairs(spark):
    draw = random.Random(9)
    rows = [(k, draw.sample(range(30), draw.randrange(9))) for k in range(150)] + [(200, None), (201, [])]
    df = spark.createDataFrame(rows, "item long, tokens array<long>")
    for least in (0.3, 0.5, 0.8):
        want = {(a, b, len(set(x) & set(y))) for (a, x), (b, y) in itertools.combinations(rows[:150], 2) if x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= least}
        assert pairs(near_duplicates.similar_sets(df, least)) == want and want


def test_trees_are_built_and_pruned_at_every_size(spark):
    """On the test tables, with production parameters: pairs of nodes are formed below the roots and most are not followed."""
    from pathlib import Path

    from pyspark.sql import functions as F

    from corpusloom.llm.common import joined_text, latest

    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("needs the test tables")
    rows = latest(spark.read.parquet(f"{folder}/units.parquet"), "unit_key", "collected_at", "texts").select("unit_key", F.lower(joined_text(F.col("texts"))).alias("text"))
    words = rows.select(F.col("unit_key").alias("item"), F.regexp_extract_all("text", F.lit(copies.WORD), F.lit(0)).alias("w")).where("size(w) >= 50")
    sets = words.select("item", F.array_distinct(F.expr("transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))")).alias("tokens"))
    test = near_duplicates.SetOverlap(0.5)
    nodes = near_duplicates.nodes_of(near_duplicates.forest_of(near_duplicates.ranked_records(sets, test), test), test).cache()
    assert nodes.where("size(members) > 1").count() > 100
    met = near_duplicates.met_nodes(nodes, None)
    formed, kept = met.count(), near_duplicates.followed(met, test).count()
    assert formed > 10_000 and 0 < kept < formed / 3


def test_groups_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.item: r.group for r in near_duplicates.groups_of(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}

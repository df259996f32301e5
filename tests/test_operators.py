import pytest
from pyspark.sql import functions as F

from corpusloom.operators import blocks, editions, graph, links, notes, related, terms


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_references(spark):
    text = "See § 91.155(a), §§ 91.215(b)(2) and 91.225(d), 14 CFR 374.3, part 61 of this chapter, § 91.155, § 91.1 and AIM, Para 5-4-3."
    df = spark.createDataFrame([(1, text, "91.1"), (2, None, "x"), (3, "", None)], "k int, text string, own string")
    got = rows(links.references(df, "k", "text", own="own"))
    assert got == [(1, "paragraph", "5-4-3"), (1, "part", "61"), (1, "section", "374.3"), (1, "section", "91.155"), (1, "section", "91.215"), (1, "section", "91.225")]


LISTS = {
    "§§ 91.1, 91.3(b)(2), and 91.5.": {"section": "91.1 91.3 91.5"},
    "under §§ 121.1 through 121.9 or § 135.1": {"section": "121.1 121.9 135.1"},
    "sections 23.5; 23.7 and/or 23.9a": {"section": "23.5 23.7 23.9a"},
    "parts 61 and 91 of this chapter": {"part": "61 91"},
    "14 CFR parts 121, 125, and 135": {"part": "121 125 135"},
    "part 121 or 135 of this chapter": {"part": "121 135"},
    "part 91 and 2 pilots, 14 CFR 91.103 and 91.105": {"part": "91", "section": "91.103 91.105"},
    "AIM, Para 5-4-3 and 5-4-5, AIM 4-1, AIM 5-4-1234": {"paragraph": "5-4-3 5-4-5", "aim_section": "4-1"},
    "nothing 91.5 here, counterparts 5 and 6": {},
}


def test_lists_of_references(spark):
    """Expected by hand."""
    texts = list(LISTS)
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    want = {(k, kind, t) for k, text in enumerate(texts) for kind, ts in LISTS[text].items() for t in ts.split()}
    assert set(rows(links.references(df, "k", "text"))) == want


def test_resolution(spark):
    edges = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "src int, t string")
    targets = spark.createDataFrame([("a", "A")], "t string, title string")
    assert rows(links.resolve(edges, targets, "t")) == [("a", 1, "A")]
    with pytest.raises(Exception, match="no target for b"):
        links.resolve(edges, targets, "t", required=True).collect()
    assert rows(links.dangling(edges, targets, "t")) == [("b", 1), ("b", 2)]
    kept = links.resolve_or_keep(edges, targets, "t", "title", "t").select("src", "shown", "resolved")
    assert rows(kept) == [(1, "A", True), (1, "b", False), (2, "b", False)]
    assert rows(links.backlinks(edges.union(edges), "src", "t")) == [("a", [1], 1), ("b", [1, 2], 2)]
    assert rows(links.without(edges, edges.where("src = 1"), "src", "t")) == [(2, "b")]


def test_terms(spark):
    dictionary = spark.createDataFrame([(1, "Air Traffic Service (ATS) route"), (2, "VOR"), (3, "Party"), (4, "flight plan"), (5, None), (6, "landing gear")], "id int, term string")
    texts = spark.createDataFrame([("a", "Each party filed Flight  Plans along the air traffic service route by vor"), ("b", "A VOR and parties; landing, gear"), ("c", None), ("d", "")], "k string, text string")
    assert rows(terms.matched_terms(texts, "k", dictionary, "id")) == [("a", 1), ("a", 3), ("a", 4), ("b", 2), ("b", 3), ("b", 6)]


def test_scopes(spark):
    uses = spark.createDataFrame([(5,), (200,), (None,)], "at int")
    scopes = spark.createDataFrame([(1, 1, 199), (2, 5, 5), (3, 5, 5), (4, 10, 2), (5, None, 9)], "scope_id int, lo int, hi int")
    found = terms.in_scope(uses, scopes, "at")
    assert rows(found.select("at", "scope_id")) == [(5, 1), (5, 2), (5, 3)]
    assert rows(terms.narrowest(found, "at").select("at", "scope_id")) == [(5, 2)]


def test_related_is_exact(spark):
    words = ["alpha", "beta", "gamma", "delta", "common"]
    data = [(i, "x" if i % 2 else "y", " ".join(w for j, w in enumerate(words) if (i >> j) & 1) + " common") for i in range(1, 31)] + [(31, "x", None), (32, "x", "")]
    df = spark.createDataFrame(data, "k long, g string, text string")
    got = rows(related.related(df, "k", "g", "k % 5 = 0", 32, k=2, floor=0.3))
    w = {}
    for r in related.weights(df, "k", 32).collect():
        w.setdefault(r.k, {})[r.token] = r.w
    group = {k: g for k, g, _ in data}
    want = []
    for a in (k for k in w if k % 5 == 0):
        score = [(round(sum(v * w[b].get(t, 0) for t, v in w[a].items()), 6), b) for b in w if b != a]
        for same in (True, False):
            best = sorted((s for s in score if s[0] >= 0.3 and (group[s[1]] == group[a]) == same), key=lambda s: (-s[0], s[1]))[:2]
            want += [(a, b, same, i, s) for i, (s, b) in enumerate(best, 1)]
    assert got == sorted(want, key=repr)


def test_nearest_vectors_against_all(spark):
    import numpy as np

    draw = np.random.default_rng(3)
    data = [(i, [float(x) for x in draw.integers(-2, 3, 4)]) for i in range(300)] + [(900, None), (901, [0.0] * 4), (902, [1.0, 0.0, 0.0, 0.0]), (903, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "k long, v array<double>").repartition(5)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in data if v and any(v)}
    want = [
        (a, b, r, s) for a in unit if a % 50 == 0
        for r, (s, b) in enumerate(sorted(((round(float(unit[a] @ unit[b]), 6), b) for b in unit if b != a), key=lambda x: (-x[0], x[1]))[:3], 1)
    ]
    got = rows(related.nearest_vectors(df, "k", "v", "id % 50 = 0", k=3, block=2, rows_at_once=20))
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want, key=repr)]
    assert rows(related.nearest_vectors(df.where("k < 2"), "k", "v", "id % 50 = 0", k=3)) == [g for g in rows(related.nearest_vectors(df.where("k < 2"), "k", "v", "id = 0", k=3))]
    assert related.nearest_vectors(df.limit(0), "k", "v", "id % 50 = 0").count() == 0


def test_transitions_and_as_of(spark):
    df = spark.createDataFrame([(1, "e1", "a"), (1, "e2", "a"), (1, "e3", None), (2, "e1", None)], "k int, e string, v string")
    assert rows(editions.transitions(df, "k", "e", "v")) == [(1, "e1", None, "first"), (1, "e2", "e1", "same"), (1, "e3", "e2", "changed"), (2, "e1", None, "first")]
    facts = spark.createDataFrame([(1, "s", 5), (2, "s", 1), (3, "t", 9), (4, "s", None), (5, "s", 7)], "id int, src string, at int")
    known = spark.createDataFrame([("s", 2, "v1"), ("s", 5, "v2"), ("s", 5, "v1")], "src string, since int, v string")
    got = rows(editions.as_of(facts, known, "src", "at", "since", "v").select("id", "v"))
    assert got == [(1, "v2"), (2, None), (3, None), (4, None), (5, "v2")]


def test_gates(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert editions.assert_gates(df, any=F.lit(True)) == {"any": 0}
    with pytest.raises(ValueError, match="positive"):
        editions.assert_gates(df, positive=F.col("x") > 0)
    a, b = spark.createDataFrame([("x",), ("y",)], "n string"), spark.createDataFrame([("y",), ("z",), ("z",)], "n string")
    assert rows(editions.set_difference(a, b, "n")) == [("x", "missing"), ("z", "unknown")]
    assert rows(editions.last_known_good(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, None), (3, "c")], "k int, v string"), "k", "v")) == [(1, "a"), (2, "b"), (3, "c")]


def test_graph(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("d", None)], "c string, p string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "n string")
    assert rows(graph.prerequisite_levels(nodes, edges, "n", "c", "p")) == [("a", 0), ("b", 1), ("c", 2), ("d", 0)]
    assert graph.cyclic_nodes(edges, "c", "p").count() == 0
    loop = edges.unionByName(spark.createDataFrame([("x", "y"), ("y", "x")], "c string, p string"))
    assert rows(graph.cyclic_nodes(loop, "c", "p")) == [("x",), ("y",)]
    with pytest.raises(ValueError, match="cycle"):
        graph.ancestors(loop, "c", "p")
    chain = spark.range(70).select((F.col("id") + 1).alias("c"), F.col("id").alias("p"))
    got = graph.ancestors(chain, "c", "p")
    assert got.count() == 70 * 71 // 2 and got.agg(F.max("depth")).first()[0] == 70


def test_notes(spark):
    df = spark.createDataFrame([("n", "related", "r"), ("n", "source", "s"), ("n", "text", " "), ("n", "odd", "o"), ("m", "text", None)], "n string, s string, b string")
    assert rows(notes.assemble(df, "n", "s", "b")) == [("n", "s\n\nr\n\no")]
    titles = spark.createDataFrame([(1, "Noise"), (2, "noise"), (3, "Fees"), (4, None)], "k int, t string")
    assert rows(notes.alias_list(titles, "k", F.col("t"), F.lit("x"))) == [(1, ["x"]), (2, ["x"]), (3, ["x", "Fees"]), (4, ["x"])]
    elements = spark.createDataFrame([("PA.I.A.K1a",), ("PA.I.A.K2",), ("PA.I.A.K1",), ("PA.I.B.K1",)], "code string")
    mapped = spark.createDataFrame([("PA.I.A.K1", "own"), ("PA.I.A", "task")], "code string, v string")
    assert rows(notes.coverage(elements, mapped, "code", "v")) == [("PA.I.A.K1", "own", "element"), ("PA.I.A.K1a", "own", "parent"), ("PA.I.A.K2", "task", "task"), ("PA.I.B.K1", None, None)]


def test_blocks_and_table_function(spark):
    text = "# T\n\n(a) One.\n\n- x\n- y\n\n| a | b |\n\nend"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, text string")
    got = blocks.blocks(df, "k")
    assert [r.kind for r in got.where("k = 1").orderBy("ordinal").collect()] == ["heading", "paragraph", "list", "table", "text"]
    assert got.where("k = 3").count() == 1 and got.where("k = 2").count() == 0
    assert "\n\n".join(r.text for r in got.where("k = 1").orderBy("ordinal").collect()) == text
    blocks.register_blocks_function(spark)
    df.createOrReplaceTempView("some_texts")
    assert rows(spark.sql("select k, b.ordinal, b.kind from some_texts, lateral text_blocks(text) b")) == rows(got.select("k", "ordinal", "kind"))

"""Queries that once left out a part of the tables, against independent counts or SQL over all of them.

The registered SQL of some of them still has the old cut; the SQL here covers the whole job.
"""

import pytest
from compare import DATA, rows_of, sql_rows

import __spark_entry__ as entry

SMALL = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")


def query(spark, name):
    return entry.queries()[name](spark, str(SMALL))


def test_cycle_reaches_all_descendants(spark):
    parts = {r[0] for r in spark.read.parquet(f"{SMALL}/part.parquet").select("p_partkey").collect()}

    def below(n):
        while n > 3:
            n //= 2
        return n == 3

    got = rows_of(query(spark, "cycle_check"))[1]
    assert got == sorted([(-1,), (-2,), (-3,), *((n,) for n in parts if below(n))], key=repr)
    assert len(got) > 5


def test_terms_of_any_length(spark):
    from corpusloom.operators import terms

    dictionary = spark.createDataFrame([(1, "minimum safe altitude warning system display"), (2, "WINDSHEAR P\u00c9RIPH\u00c9RIE OUTBOUND"), (3, "RIPH")], "id int, term string")
    texts = spark.createDataFrame([("a", "The minimum safe altitude, warning system displays fail"), ("b", "a windshear p\u00e9riph\u00e9rie outbound"), ("c", "minimum safe altitude warning system")], "k string, text string")
    got = terms.matched_terms(texts, "k", dictionary, "id")
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 2)]
    assert terms.matched_terms(texts, "k", dictionary.where("false"), "id").isEmpty()


def test_glossary_finds_every_term_that_stands_in_a_text(spark):
    """Each term against each text by its padded words, without runs."""
    import re

    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+(?:[-'/][^\W_]+)*", t)).lower() + " "
    rows = spark.read.parquet(f"{SMALL}/pcg_term.parquet").select("term_key", "term", "text").dropDuplicates(["term_key"]).collect()
    plain = [(r[0], words(r[1])) for r in rows if r[1] and not re.fullmatch("[A-Z0-9]{1,5}s?", r[1])]
    whole = {(r[0], key) for r in rows if r[2] for t in [words(r[2])] for key, term in plain if term.strip() and term in t}
    got = set(map(tuple, query(spark, "glossary_terms").select("unit_key", "term_key").collect()))
    assert whole <= got
    long = {key for key, term in plain if len(term.split()) > 4}
    assert {key for _, key in got} & long or not long
    gate = set(map(tuple, query(spark, "term_gate").select("unit_key", "term_key").collect()))
    short = {r[0] for r in rows if r[1] and len(r[1]) < 5}
    assert gate == {(u, t) for u, t in got if u != t and t not in short}


ALL_TARGETS = r"""
    , once AS (SELECT DISTINCT ON (unit_key) * FROM units), every AS (
      SELECT 'section' AS kind, section AS target, min(title) AS title FROM cfr_section WHERE section IS NOT NULL GROUP BY section
      UNION ALL SELECT DISTINCT 'part', part, NULL FROM cfr_section WHERE part IS NOT NULL
      UNION ALL SELECT 'paragraph', citation[5:], min(heading) FROM once WHERE layer = 'aim' AND citation LIKE 'AIM %' GROUP BY citation
      UNION ALL SELECT DISTINCT 'aim_section', regexp_extract(citation, '^AIM ([0-9]+-[0-9]+)-', 1), NULL FROM once WHERE layer = 'aim' AND citation LIKE 'AIM %')
"""


def test_links_of_every_kind(spark):
    from corpusloom.plans.link_queries import _REFS

    folder = DATA / "sf0.01"
    found = sql_rows(folder, _REFS + ALL_TARGETS + "SELECT unit_key, kind, target, title FROM refs JOIN every USING (kind, target)")
    lost = sql_rows(folder, _REFS + ALL_TARGETS + "SELECT unit_key, target FROM refs ANTI JOIN every USING (kind, target)")
    assert rows_of(entry.queries()["link_resolve"](spark, str(folder))) == found
    assert rows_of(entry.queries()["dangling_links"](spark, str(folder))) == lost
    assert {"part", "paragraph"} <= {r[0] for r in found[1]}
    assert any("-" in r[0] for r in lost[1])


DELIVERED = """
    WITH d AS (SELECT lower(trim(source)) AS source, id, source_version AS version, fetched_at, regexp_replace(lower(trim(canonical_hash)), '^sha256:', '') AS hash FROM cfr_section),
    k AS (SELECT * FROM d WHERE source IS NOT NULL AND id IS NOT NULL AND version IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY source, id, version ORDER BY fetched_at DESC NULLS LAST, hash DESC NULLS LAST) = 1)
"""


def test_editions_of_every_source(spark):
    moves = DELIVERED + """
        SELECT source, id, version, lag(version) OVER w AS previous_edition, CASE WHEN lag(version) OVER w IS NULL THEN 'first' WHEN lag(hash) OVER w IS NOT DISTINCT FROM hash THEN 'same' ELSE 'changed' END AS change
        FROM k WINDOW w AS (PARTITION BY source, id ORDER BY version)"""
    diff = DELIVERED + """
        , s AS (SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY version DESC) AS n FROM k)
        SELECT coalesce(o.source, n.source) AS source, coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.hash IS DISTINCT FROM n.hash THEN 'changed' ELSE 'unchanged' END AS change
        FROM (SELECT * FROM s WHERE n = 2) o FULL JOIN (SELECT * FROM s WHERE n = 1) n ON o.source = n.source AND o.id = n.id"""
    for name, sql in (("edition_transitions", moves), ("snapshot_diff", diff)):
        columns, rows = rows_of(query(spark, name))
        assert (columns, rows) == sql_rows(SMALL, sql)
        assert len({r[columns.index("source")] for r in rows}) > 1


def test_the_delivery_fetched_last_decides(spark, tmp_path):
    rows = [("a", "1", "v1", "2026-01-01", "f"), ("a", "1", "v1", "2026-01-02", "0"), ("a", "1", "v2", "2026-02-01", "0"), ("b", "1", "v9", "2026-01-01", "c")]
    made = spark.createDataFrame(rows, "source string, id string, source_version string, fetched_at string, canonical_hash string")
    made.selectExpr("source", "id", "source_version", "cast(fetched_at as timestamp) as fetched_at", "canonical_hash").write.parquet(str(tmp_path / "cfr_section.parquet"))
    got = {tuple(r) for r in entry.queries()["edition_transitions"](spark, str(tmp_path)).collect()}
    assert got == {("a", "1", "v1", None, "first"), ("a", "1", "v2", "v1", "same"), ("b", "1", "v9", None, "first")}
    got = {tuple(r) for r in entry.queries()["snapshot_diff"](spark, str(tmp_path)).collect()}
    assert got == {("a", "1", "unchanged"), ("b", "1", "added")}


def test_related_drops_what_is_cited(spark, tmp_path):
    same = "handling of the certified altimeter setting near the displaced threshold"
    texts = {50: f"See § 91.2 and AIM 5-4-3. {same}", 51: same, 52: same, 5000: same, 5001: same, 5002: same}
    cited = {50: ("cfr", "14 CFR § 91.1"), 51: ("cfr", "14 CFR § 91.2"), 52: ("cfr", "14 CFR § 91.3"), 5000: ("aim", "AIM 5-4-3"), 5001: ("aim", "AIM 5-4-4"), 5002: ("cfr", "14 CFR § 91.2-91.9")}
    made = [(k, *cited[k], None, None, [texts[k]]) for k in texts]
    spark.createDataFrame(made, "unit_key long, layer string, citation string, part string, heading string, texts array<string>").write.parquet(str(tmp_path / "units.parquet"))
    suggested = {r[0] for r in entry.queries()["tfidf_related_topk"](spark, str(tmp_path)).where("src = 50").select("dst").collect()}
    kept = {r[0] for r in entry.queries()["related_minus_explicit"](spark, str(tmp_path)).where("src = 50").select("dst").collect()}
    assert suggested == {51, 52, 5000, 5001, 5002}
    assert kept == {52, 5001, 5002}

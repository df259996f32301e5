"""Queries: editions, gates, set operations, aggregates, windows and event streams."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import editions
from corpusloom.operators.notes import in_order
from corpusloom.operators.snapshots import deliveries, plain_source
from corpusloom.plans import Registry
from corpusloom.plans.snapshot_queries import _CHANGES, p4_found
from corpusloom.sources.tables import load
from corpusloom.streaming import windows

REGISTRY = Registry()

_DELIVERED = """
    WITH k AS (SELECT lower(trim(source)) AS source, id, source_version AS version, arg_max(coalesce(regexp_replace(lower(trim(canonical_hash)), '^sha256:', ''), '-'),
        (coalesce(fetched_at, TIMESTAMP '0001-01-01'), coalesce(regexp_replace(lower(trim(canonical_hash)), '^sha256:', ''), ''))) AS hash
      FROM cfr_section WHERE source IS NOT NULL AND id IS NOT NULL AND source_version IS NOT NULL GROUP BY ALL)
"""


def _delivered(spark, folder):
    return deliveries(load(spark, folder, "cfr_section", "source", "id", "source_version", "fetched_at", "canonical_hash"))


@REGISTRY.add("latest_version", "SELECT lower(trim(source)) AS source, max(source_version) AS version FROM cfr_section WHERE source IS NOT NULL GROUP BY 1")
def latest_version(spark, folder):
    rows = load(spark, folder, "cfr_section", "source", "source_version")
    return editions.latest_versions(rows.select(plain_source(F.col("source")).alias("source"), F.col("source_version").alias("version")), "source", "version")


@REGISTRY.add("source_status", """
    SELECT r.source, coalesce(v, 'not yet ingested') AS current_through FROM source_manifest r LEFT JOIN
      (SELECT lower(trim(source)) AS source, arg_max(source_version, (fetched_at, source_version)) AS v FROM cfr_section GROUP BY 1) USING (source)""")  # fmt: skip
def source_status(spark, folder):
    states = load(spark, folder, "cfr_section", "source", "source_version", "fetched_at").withColumn("source", plain_source(F.col("source")))
    return editions.source_status(load(spark, folder, "source_manifest", "source"), states, "source", "source_version", "fetched_at")


@REGISTRY.add("last_known_good", """
    WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0), new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN 'new' END AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice FROM old o FULL JOIN new n ON n.o_orderkey = o.o_orderkey""")  # fmt: skip
def last_known_good(spark, folder):
    rows = load(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    new = rows.where("o_orderkey % 3 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, "new").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return editions.last_known_good(rows.where("o_orderkey % 5 <> 0"), new, "o_orderkey", "o_orderstatus", "o_totalprice")


@REGISTRY.add("edition_transitions", _DELIVERED + """
    SELECT source, id, version, lag(version) OVER w AS previous_edition, CASE WHEN lag(version) OVER w IS NULL THEN 'first' WHEN lag(hash) OVER w = hash THEN 'same' ELSE 'changed' END AS change
    FROM k WINDOW w AS (PARTITION BY source, id ORDER BY version)""")  # fmt: skip
def edition_transitions(spark, folder):
    """The editions of each section in each source; of several deliveries the one fetched last counts."""
    return editions.transitions(_delivered(spark, folder), ["source", "id"], "version", "hash")


@REGISTRY.add("snapshot_diff", _DELIVERED + """
    , v AS (SELECT source, list(DISTINCT version ORDER BY version DESC) AS vs FROM k GROUP BY source),
    s AS (SELECT k.*, list_position(vs, version) AS n FROM k JOIN v USING (source))
    SELECT source, id, CASE WHEN max(n) = 1 THEN 'added' WHEN min(n) = 2 THEN 'removed' WHEN min(hash) <> max(hash) THEN 'changed' ELSE 'unchanged' END AS change FROM s WHERE n <= 2 GROUP BY source, id""")  # fmt: skip
def snapshot_diff(spark, folder):
    """The last two versions of each source; a source with one version only adds."""
    rows = _delivered(spark, folder)
    by_age = Window.partitionBy("source").orderBy(F.desc("version"))
    last = rows.select("source", "version").distinct().withColumn("n", F.row_number().over(by_age)).where("n <= 2")  # two rows a source
    rows = rows.join(last, ["source", "version"])
    old = rows.where("n = 2").select("source", "id", F.struct("hash").alias("old"))
    new = rows.where("n = 1").select("source", "id", F.struct("hash").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("old.hash").eqNullSafe(F.col("new.hash")), "changed").otherwise("unchanged")
    return old.join(new, ["source", "id"], "full_outer").select("source", "id", change.alias("change"))


@REGISTRY.add("change_summary", _CHANGES + "SELECT source, next_version, change, count(*) AS n, grouping(source, next_version, change) AS level FROM met WHERE change IS NOT NULL GROUP BY ROLLUP (source, next_version, change)")
def change_summary(spark, folder):
    """How many sections each edition of each source added, removed and changed, with subtotals."""
    return editions.change_counts(p4_found(spark, folder), "source", "next_version", "change")


@REGISTRY.add("asof_edition", """
    WITH e AS (SELECT user_id, ts, max(event_type) AS event_type FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY ALL), f AS (SELECT event_id, user_id, ts AS seen_at FROM events WHERE event_type = 'view')
    SELECT event_id, f.user_id, seen_at, e.ts, e.event_type AS edition FROM f ASOF LEFT JOIN e ON f.user_id = e.user_id AND f.seen_at >= e.ts""")  # fmt: skip
def asof_edition(spark, folder):
    events = load(spark, folder, "events", "event_id", "user_id", "ts", "event_type")
    facts = events.where("event_type = 'view'").select("event_id", "user_id", F.col("ts").alias("seen_at"))
    last = events.where("event_type in ('signup', 'purchase')").select("user_id", "ts", F.col("event_type").alias("edition"))
    return editions.as_of(facts, last, "user_id", "seen_at", "ts", "edition")


@REGISTRY.add("manifest_set_diff", """
    WITH known AS (SELECT source FROM source_manifest), found AS (SELECT DISTINCT lower(trim(source)) AS source FROM cfr_section WHERE source IS NOT NULL UNION SELECT 'stray')
    SELECT source, 'missing' AS problem FROM known WHERE source NOT IN (SELECT source FROM found) UNION ALL SELECT source, 'unknown' FROM found WHERE source NOT IN (SELECT source FROM known)""")  # fmt: skip
def manifest_set_diff(spark, folder):
    found = load(spark, folder, "cfr_section", "source").where("source is not null").select(plain_source(F.col("source")).alias("source")).unionByName(spark.createDataFrame([("stray",)], "source string"))
    return editions.set_difference(load(spark, folder, "source_manifest", "source"), found, "source")


@REGISTRY.add("manifest_validate", """
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE accepted_version IS NULL) AS never_accepted, count(*) FILTER (WHERE canonical_hash IS NOT NULL AND NOT regexp_matches(canonical_hash, '^sha256:[0-9a-f]{64}$')) AS bad_hash FROM source_manifest""")  # fmt: skip
def manifest_validate(spark, folder):
    rows = load(spark, folder, "source_manifest")
    ok = F.col("canonical_hash").isNull() | F.col("canonical_hash").rlike("^sha256:[0-9a-f]{64}$")
    return rows.agg(F.count(F.lit(1)).alias("rows_in"), editions.gate("never_accepted", F.col("accepted_version").isNotNull()), editions.gate("bad_hash", ok))


@REGISTRY.add("drop_nulls_json", """
    SELECT source, '{' || concat_ws(',', '"accepted_version":"' || accepted_version || '"', '"change":' || change, '"source":"' || source || '"') || '}' AS state FROM source_manifest""")  # fmt: skip
def drop_nulls_json(spark, folder):
    return load(spark, folder, "source_manifest").select("source", F.to_json(F.struct("accepted_version", "change", "source")).alias("state"))


@REGISTRY.add("integrity_gate", "SELECT source, count(*) AS n, count(*) FILTER (WHERE length(text) < 20) AS too_small, count(*) FILTER (WHERE n_chars <> length(text)) AS wrong_length, count(*) >= 50 AS enough FROM documents GROUP BY source")
def integrity_gate(spark, folder):
    rows = load(spark, folder, "documents", "source", "text", "n_chars")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), editions.gate("too_small", F.length("text") >= 20), editions.gate("wrong_length", F.col("n_chars") == F.length("text")), (F.count(F.lit(1)) >= 50).alias("enough"))


@REGISTRY.add("unknown_kinds", "SELECT doc_type, count(*) AS n FROM documents WHERE doc_type IS NULL OR doc_type NOT IN ('regulation', 'glossary', 'aim', 'appendix', 'acs_task', 'concept', 'prep') GROUP BY 1")
def unknown_kinds(spark, folder):
    known = ["regulation", "glossary", "aim", "appendix", "acs_task", "concept", "prep"]
    rows = load(spark, folder, "documents", "doc_type").where(~F.coalesce(F.col("doc_type").isin(known), F.lit(False)))
    return rows.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("lossless_check", "SELECT doc_id, sha256(text) AS hash, len(string_split(text, chr(10) || chr(10))) AS blocks, true AS lossless FROM documents WHERE text IS NOT NULL")
def lossless_check(spark, folder):
    """Whether the blocks of each text, in order, are the text again."""
    from corpusloom.operators.blocks import blocks

    texts = load(spark, folder, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.sha2("text", 256).alias("hash"))
    kept = blocks(load(spark, folder, "documents", "doc_id", "text"), "doc_id").groupBy("doc_id").agg(
        in_order(F.col("text"), F.col("ordinal"), separator="\n\n").alias("again"), F.count(F.lit(1)).cast("int").alias("blocks")
    )
    same = F.coalesce(F.sha2("again", 256) == F.col("hash"), F.lit(False))
    return texts.join(kept, "doc_id", "left").select("doc_id", "hash", "blocks", same.alias("lossless"))


@REGISTRY.add("contents_crosscheck", "SELECT coalesce(o_orderkey, l_orderkey) AS order_key, o_orderkey IS NOT NULL AS listed, l_orderkey IS NOT NULL AS present FROM orders FULL JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL OR l_orderkey IS NULL")
def contents_crosscheck(spark, folder):
    listed = load(spark, folder, "orders", F.col("o_orderkey").alias("order_key")).withColumn("listed", F.lit(True))
    present = load(spark, folder, "lineitem", "l_orderkey").select(F.col("l_orderkey").alias("order_key"), F.lit(True).alias("present")).distinct()
    both = listed.join(present, "order_key", "full_outer").fillna(False, ["listed", "present"])
    return both.where("not (listed and present)")


@REGISTRY.add("union_layers", "SELECT 'cfr' AS layer, id, title FROM cfr_section UNION SELECT 'pcg', id, title FROM pcg_term UNION SELECT layer, unit_id, heading FROM units")
def union_layers(spark, folder):
    cfr = load(spark, folder, "cfr_section", "id", "title").withColumn("layer", F.lit("cfr"))
    pcg = load(spark, folder, "pcg_term", "id", "title").withColumn("layer", F.lit("pcg"))
    units = load(spark, folder, "units", "layer", F.col("unit_id").alias("id"), F.col("heading").alias("title"))
    return cfr.unionByName(pcg).unionByName(units).distinct().select("layer", "id", "title")


@REGISTRY.add("set_intersect", "SELECT unit_id AS id FROM units INTERSECT SELECT id FROM cfr_section")
def set_intersect(spark, folder):
    return load(spark, folder, "units", F.col("unit_id").alias("id")).intersect(load(spark, folder, "cfr_section", "id"))


@REGISTRY.add("set_except", "SELECT unit_id AS id FROM units EXCEPT SELECT id FROM cfr_section")
def set_except(spark, folder):
    return load(spark, folder, "units", F.col("unit_id").alias("id")).subtract(load(spark, folder, "cfr_section", "id"))


@REGISTRY.add("grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag, l_linestatus) AS level FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def grouping_sets(spark, folder):
    load(spark, folder, "lineitem", "l_returnflag", "l_linestatus").createOrReplaceTempView("corpusloom_lineitem")
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS level FROM corpusloom_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@REGISTRY.add("cube_counts", "SELECT c_mktsegment, c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY CUBE (c_mktsegment, c_nationkey)")
def cube_counts(spark, folder):
    return load(spark, folder, "customer", "c_mktsegment", "c_nationkey", "c_acctbal").cube("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@REGISTRY.add("distinct_counts", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def distinct_counts(spark, folder):
    return load(spark, folder, "lineitem", "l_returnflag", "l_partkey", "l_suppkey").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@REGISTRY.add("approx_distinct")
def approx_distinct(spark, folder):
    """Approximate counts within 2 percent: engines differ in the sketch, so there is no SQL to compare with."""
    return load(spark, folder, "lineitem", "l_returnflag", "l_partkey").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))


@REGISTRY.add("running_total", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders")
def running_total(spark, folder):
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return load(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").select("o_orderkey", F.round(F.sum("o_totalprice").over(order), 2).alias("running"))


@REGISTRY.add("range_frame", "SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)")
def range_frame(spark, folder):
    """What each user did within the hour before each event."""
    hour = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-3_600_000_000, 0)
    return load(spark, folder, "events", "event_id", "user_id", "ts", "value").select("event_id", F.count(F.lit(1)).over(hour).alias("n"), F.round(F.sum("value").over(hour), 4).alias("total"))


@REGISTRY.add("window_ranks", "SELECT s_suppkey, rank() OVER w AS rank, dense_rank() OVER w AS dense, ntile(4) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS quartile, round(percent_rank() OVER w, 6) AS pct FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal)")
def window_ranks(spark, folder):
    w, total = Window.partitionBy("s_nationkey").orderBy("s_acctbal"), Window.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey")
    return load(spark, folder, "supplier").select("s_suppkey", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense"), F.ntile(4).over(total).alias("quartile"), F.round(F.percent_rank().over(w), 6).alias("pct"))


@REGISTRY.add("global_topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def global_topk(spark, folder):
    return load(spark, folder, "orders", "o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@REGISTRY.add("tumbling_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark, folder):
    return windows.windowed_counts(load(spark, folder, "events"), "ts", "event_type", "1 hour", value="value").withColumn("total", F.round("total", 4))


@REGISTRY.add("sliding_counts", "SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY ALL")
def sliding_counts(spark, folder):
    return windows.windowed_counts(load(spark, folder, "events"), "ts", "event_type", "2 hours", "1 hour")


@REGISTRY.add("sessionize", """
    WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM events), s AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")  # fmt: skip
def sessionize(spark, folder):
    return windows.sessions(load(spark, folder, "events"), "ts", "user_id", "6 hours")


@REGISTRY.add("events_once", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, ts FROM events) GROUP BY ALL")
def events_once(spark, folder):
    rows = windows.once(load(spark, folder, "events", "user_id", "event_type", "ts"), "ts", "user_id", "event_type", "ts")
    return rows.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("text_blocks", r"""
    SELECT doc_id, len(string_split(text, chr(10) || chr(10))) AS blocks, len(list_filter(string_split(text, chr(10) || chr(10)), lambda x: starts_with(x, '- '))) AS lists,
      len(list_filter(string_split(text, chr(10) || chr(10)), lambda x: starts_with(x, '|'))) AS tables FROM documents""")  # fmt: skip
def text_blocks(spark, folder):
    from corpusloom.operators.blocks import blocks

    rows = blocks(load(spark, folder, "documents", "doc_id", "text"), "doc_id")
    kind = lambda k: F.count_if(F.col("kind") == k)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("blocks"), kind("list").cast("int").alias("lists"), kind("table").cast("int").alias("tables"))

"""Queries of problem 4: changes between consecutive full snapshots of cfr_section."""

from corpusloom.operators import snapshots
from corpusloom.plans import Registry
from corpusloom.sources.tables import load

REGISTRY = Registry()

_CHANGES = """
WITH delivered AS (
  SELECT lower(trim(source)) AS source, id, source_version AS version, fetched_at, title,
         regexp_replace(lower(trim(canonical_hash)), '^sha256:', '') AS hash
  FROM cfr_section WHERE source IS NOT NULL AND id IS NOT NULL AND source_version IS NOT NULL
), kept AS (
  SELECT source, id, version, hash, title FROM delivered
  QUALIFY row_number() OVER (PARTITION BY source, id, version ORDER BY fetched_at DESC NULLS LAST, hash DESC NULLS LAST, title DESC NULLS LAST) = 1
), versions AS (
  SELECT source, version, lead(version) OVER (PARTITION BY source ORDER BY version) AS next_version
  FROM (SELECT DISTINCT source, version FROM kept)
), old AS (
  SELECT kept.*, next_version FROM kept JOIN versions USING (source, version) WHERE next_version IS NOT NULL
), new AS (
  SELECT kept.source, kept.id, kept.hash, kept.title, versions.version AS prev_version, kept.version AS next_version
  FROM kept JOIN versions ON kept.source = versions.source AND kept.version = versions.next_version
), met AS (
  SELECT coalesce(old.source, new.source) AS source, coalesce(old.id, new.id) AS id,
         coalesce(old.version, new.prev_version) AS prev_version, coalesce(old.next_version, new.next_version) AS next_version,
         CASE WHEN old.id IS NULL THEN 'added' WHEN new.id IS NULL THEN 'removed' WHEN old.hash <> new.hash THEN 'changed' END AS change,
         old.hash AS old_hash, new.hash AS new_hash, old.title AS old_title, new.title AS new_title
  FROM old FULL JOIN new ON old.source = new.source AND old.id = new.id AND old.version = new.prev_version
)
"""


@REGISTRY.add("p4_found", _CHANGES + "SELECT source, id, prev_version, next_version, change FROM met WHERE change IS NOT NULL")
def p4_found(spark, folder):
    sections = load(spark, folder, "cfr_section", "source", "id", "source_version", "canonical_hash", "fetched_at")
    return snapshots.snapshot_changes(sections).select("source", "id", "prev_version", "next_version", "change")


@REGISTRY.add("p4_feed", _CHANGES + "SELECT source, id, prev_version, next_version, change FROM met WHERE change IS NOT NULL")
def p4_feed(spark, folder):
    """The same changes from snapshots fed in turn, the index swapped after each."""
    sections = load(spark, folder, "cfr_section", "source", "id", "source_version", "canonical_hash", "fetched_at")
    return snapshots.fed_changes(sections).select("source", "id", "prev_version", "next_version", "change")


@REGISTRY.add("p4_values", _CHANGES + "SELECT source, id, prev_version, next_version, change, old_hash, new_hash, old_title, new_title FROM met WHERE change IS NOT NULL")
def p4_values(spark, folder):
    sections = load(spark, folder, "cfr_section", "source", "id", "source_version", "canonical_hash", "fetched_at", "title")
    return snapshots.snapshot_change_values(sections, "title")


@REGISTRY.add("p4_summary", _CHANGES + "SELECT source, prev_version, next_version, change, count(*) AS sections FROM met WHERE change IS NOT NULL GROUP BY ALL")
def p4_summary(spark, folder):
    from pyspark.sql import functions as F

    return p4_found(spark, folder).groupBy("source", "prev_version", "next_version", "change").agg(F.count(F.lit(1)).alias("sections"))

"""References in texts, their resolution to targets, and the graph of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers of sections, parts and paragraphs, what stands between two of a list, and the forms of a citation in text.
SECTION = r"[0-9]+[a-z]?\.[0-9]+[a-z]?"
PART = r"[0-9]+[a-z]?"
PARAGRAPH = r"[0-9]+(?:-[0-9]+)+"
SUFFIX = r"(?:\([0-9A-Za-z]+\))*"
BETWEEN = r"(?:\s*[,;]\s*(?:(?:and/or|and|or)\s+)?|\s+(?:and/or|and|or|through|to)\s+)"
SECTION_REF = rf"§\s*({SECTION})"
SECTION_LIST = rf"(?:§§|\b[Ss]ections|14 CFR(?:\s+sections?|\s*§+)?)\s*({SECTION}{SUFFIX}(?:{BETWEEN}(?:§\s*)?{SECTION}{SUFFIX})*)"
PART_REF = rf"\b[Pp]art\s+({PART})\b"
PART_LIST = rf"\b[Pp]arts\s+({PART}(?:{BETWEEN}{PART})*)\b"
PARTS_OF_THIS = rf"\b[Pp]art\s+({PART}(?:{BETWEEN}{PART})+)\s+of\s+this\b"
AIM_LIST = rf"\bAIM,?\s+(?:[Pp]ara(?:graphs?|s|\.)?\s+|[Ss]ections?\s+)?({PARAGRAPH}(?:{BETWEEN}{PARAGRAPH})*)"


def listed(text: Column, pattern: str, item: str) -> Column:
    """Every ``item`` in the lists that ``pattern`` captures, in order; null counts as no list."""
    lists = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    items = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(item), F.lit(0))))
    return F.coalesce(items, F.array().cast("array<string>"))


def section_refs(text: Column) -> Column:
    """Sections that a text cites, each once, without paragraph suffixes."""
    return F.array_distinct(F.concat(listed(text, SECTION_REF, SECTION), listed(text, SECTION_LIST, SECTION)))


def part_refs(text: Column) -> Column:
    """Parts that a text cites, each once; after the singular a list counts only if it ends in 'of this'."""
    return F.array_distinct(F.concat(*[listed(text, p, PART) for p in (PART_REF, PART_LIST, PARTS_OF_THIS)]))


def references(units: DataFrame, key: str, text: str, own: str | None = None) -> DataFrame:
    """(key, kind, target) for every citation in ``text``: kinds section, part, paragraph and aim_section, each target once.

    Lists are taken as a whole (``§§ 91.1, 91.3(b), and 91.5``, ``parts 61 and 91``).  ``own`` names the column with the record's
    own citation, to which it does not refer.  Null texts cite nothing.
    """
    aim = F.array_distinct(listed(F.col(text), AIM_LIST, PARAGRAPH))
    kinds = {
        "section": section_refs(F.col(text)), "part": part_refs(F.col(text)),
        "paragraph": F.filter(aim, lambda x: x.rlike("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{1,3}$")),
        "aim_section": F.filter(aim, lambda x: x.rlike("^[0-9]{1,2}-[0-9]{1,2}$")),
    }
    found = F.concat(*[F.transform(v, lambda t: F.struct(F.lit(k).alias("kind"), t.alias("target"))) for k, v in kinds.items()])  # noqa: B023
    rows = units.select(key, *([F.col(own).alias("own")] if own else []), F.explode(found).alias("r")).select("*", "r.kind", "r.target")
    if own:
        rows = rows.where(F.col("own").isNull() | (F.col("own") != F.col("target")))
    return rows.select(key, "kind", "target").distinct()


def resolve(edges: DataFrame, targets: DataFrame, on: str, required: bool = False) -> DataFrame:
    """Edges with the columns of their target; without one they are dropped, or stop the query if ``required``.

    Targets may be large: Spark chooses the join by size.  Targets must be unique in ``on``.
    """
    if not required:
        return edges.join(targets, on)
    mark = targets.withColumn("__met", F.lit(True))
    error = F.raise_error(F.concat(F.lit("no target for "), F.col(on).cast("string"))).cast("boolean")
    return edges.join(mark, on, "left").where(F.coalesce("__met", error)).drop("__met")


def resolve_or_keep(items: DataFrame, targets: DataFrame, on: str, link: str, plain: str) -> DataFrame:
    """Items as links where a target exists, else as plain text: adds columns ``shown`` and ``resolved``."""
    joined = items.join(targets, on, "left")
    return joined.withColumn("resolved", F.col(link).isNotNull()).withColumn("shown", F.coalesce(link, plain))


def dangling(edges: DataFrame, targets: DataFrame, *on: str) -> DataFrame:
    """Edges whose target does not exist."""
    return edges.join(targets.select(*on).distinct(), list(on), "left_anti")


def without(suggested: DataFrame, explicit: DataFrame, *on: str) -> DataFrame:
    """Suggestions that are no explicit link (or no rejected pair) already."""
    return suggested.join(explicit.select(*on).distinct(), list(on), "left_anti")


def reviewed(suggested: DataFrame, verdicts: DataFrame, reject: str) -> DataFrame:
    """Suggestions (src, dst, ...) without those that the table of verdicts (src, dst, verdict) rejects; pairs without a verdict stay."""
    return without(suggested, verdicts.where(F.col("verdict") == reject), "src", "dst")


def backlinks(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(target, sources, n): who links here, in order; each source once.

    A target that a third of all records cite still makes one row: sources are made distinct before they meet.
    """
    return edges.select(source, target).distinct().groupBy(target).agg(F.array_sort(F.collect_list(source)).alias("sources"), F.count(F.lit(1)).alias("n"))

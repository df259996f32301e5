"""Notes put together from ordered blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import markdown


def in_order(text: Column, *order: Column, separator: str = "\n") -> Column:
    """Aggregate: texts of a group joined in the given order, whatever the order of rows; null texts are left out."""
    kept = F.when(text.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("t")))
    return F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["t"]), separator)


def natural(citation: Column) -> list[Column]:
    """Sort keys of a citation: each number by its value, letters after it."""
    part, rest = F.regexp_extract(citation, r"^([0-9]*)", 1), F.regexp_extract(citation, r"^[0-9]*[^0-9]*([0-9]*)", 1)
    return [part.try_cast("bigint"), rest.try_cast("bigint"), citation]


def contents(children: DataFrame, parent: str, text: Column, *order: Column, depth: int = 0) -> DataFrame:
    """(parent, contents): a list of the children of each parent in order."""
    item = F.concat(F.lit("  " * depth + "- "), text)
    return children.groupBy(parent).agg(in_order(item, *order).alias("contents"))


def nested_contents(upper: DataFrame, lower: DataFrame, key: str, parent: str, upper_text: Column, lower_text: Column, upper_order: Column, lower_order: Column) -> DataFrame:
    """(parent, contents): a list of two levels; an upper entry without lower ones stands alone."""
    inner = contents(lower, key, lower_text, lower_order, depth=1).withColumnRenamed("contents", "__inner")
    rows = upper.join(inner, key, "left").withColumn("__text", F.concat_ws("\n", F.concat(F.lit("- "), upper_text), "__inner"))
    return rows.groupBy(parent).agg(in_order(F.col("__text"), upper_order).alias("contents"))


def ordinals(rows: DataFrame, parent: str, *order: Column) -> DataFrame:
    """Place of each row among its siblings, from 1."""
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(parent).orderBy(*order)))


def alias_list(rows: DataFrame, key: str, title: Column, *always: Column) -> DataFrame:
    """(key, aliases): the given aliases, and the title if no other record has it in any case.

    Titles are counted apart and joined back, so that a title shared by a third of all records costs one row per task.
    """
    titled = rows.select("*", F.lower(title).alias("__title"))
    counts = titled.where("__title is not null").groupBy("__title").agg(F.count(F.lit(1)).alias("__n"))
    own = F.when(F.col("__n") == 1, title)
    return titled.join(counts, "__title", "left").select(key, F.array_distinct(F.array_compact(F.array(*always, own))).alias("aliases"))


def assemble(sections: DataFrame, note: str, section: str, body: str) -> DataFrame:
    """(note, text): the sections of each note in their fixed order, empty ones left out, a blank line between them."""
    rank = F.array_position(F.lit(markdown.SECTIONS), F.col(section))
    rows = sections.where(F.length(F.trim(body)) > 0)
    return rows.groupBy(note).agg(in_order(F.col(body), F.when(rank == 0, len(markdown.SECTIONS) + 1).otherwise(rank), F.col(section), separator="\n\n").alias("text"))


def related_section(links: DataFrame, note: str, rank: str, stem: Column, display: Column, heading: str, remark: str) -> DataFrame:
    """(note, text): heading, remark and ranked links; a note without links has no row."""
    item = F.concat(F.lit("- "), markdown.wikilink(stem, display))
    listed = links.groupBy(note).agg(in_order(item, F.col(rank)).alias("__items"))
    return listed.select(note, F.concat(F.lit(f"{heading}\n\n> [!info] {remark}\n\n"), "__items").alias("text"))


def coverage(elements: DataFrame, mapped: DataFrame, code: str, value: str) -> DataFrame:
    """Elements with the coverage listed for them, else for their parent element, else for the whole task.

    Codes look like PA.I.A.K1a; the parent of a sub-element drops its letter, the task is the first three parts.  ``mapped``
    has one row per code (element or task).  ``covered_by`` names the level that gave the value, null without any.
    """
    levels = {"element": F.col(code), "parent": F.regexp_replace(code, "[a-z]$", ""), "task": F.substring_index(F.col(code), ".", 3)}
    rows = elements
    for level, at in levels.items():
        listed = mapped.select(F.col(code).alias(f"__{level}_code"), F.col(value).alias(f"__{level}"))
        rows = rows.withColumn("__at", at).join(listed, F.col("__at") == F.col(f"__{level}_code"), "left").drop("__at")
    named = F.coalesce(*[F.when(F.col(f"__{level}").isNotNull(), level) for level in levels])
    return rows.select(*elements.columns, F.coalesce(*[F.col(f"__{level}") for level in levels]).alias(value), named.alias("covered_by"))

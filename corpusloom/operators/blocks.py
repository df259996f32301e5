"""Texts as ordered blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of blocks and how their first line begins.
KINDS = {"list": r"^- ", "table": r"^\|", "heading": r"^#+ ", "callout": r"^> ", "paragraph": r"^\([0-9A-Za-z]{1,4}\)"}


def blocks(texts: DataFrame, key: str) -> DataFrame:
    """(key, ordinal, kind, label, text) of rows (key, text): parts between blank lines, in order; null texts have none.

    Joined by a blank line in order they are the text again.
    """
    rows = texts.select(key, F.posexplode(F.split("text", "\n\n")).alias("ordinal", "text"))
    kind = F.coalesce(*[F.when(F.col("text").rlike(pattern), name) for name, pattern in KINDS.items()], F.lit("text"))
    label = F.nullif(F.regexp_extract("text", r"^\(([0-9A-Za-z]{1,4})\)", 1), F.lit(""))
    return rows.select(key, F.col("ordinal") + 1, kind.alias("kind"), label.alias("label"), "text").toDF(key, "ordinal", "kind", "label", "text")


def register_blocks_function(spark: SparkSession, name: str = "text_blocks") -> None:
    """The same as a table function for SQL, for use with LATERAL: text_blocks(text) -> (ordinal, kind, text).

    It runs in Python, row by row; ``blocks`` is the way for large tables.
    """
    import re

    from pyspark.sql.functions import udtf

    patterns = [(kind, re.compile(pattern)) for kind, pattern in KINDS.items()]

    @udtf(returnType="ordinal int, kind string, text string")
    class TextBlocks:
        def eval(self, text: str):
            if text is not None:
                for i, part in enumerate(text.split("\n\n"), 1):
                    yield i, next((k for k, p in patterns if p.match(part)), "text"), part

    spark.udtf.register(name, TextBlocks)

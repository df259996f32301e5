"""Splitting texts above a size limit at natural boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a piece may end, the strongest first. {h} is half of the most that is taken at once, {m} the most.
ITEM = r"[ \t]*(?:[-*•|]|\(?[0-9A-Za-z]{1,4}[.)])[ \t]"
ENDS = (
    r".{1,{m}}\z",  # all that is left
    r".{{h},{m}}(?<=\n)(?=\s*\n|(?!" + ITEM + r"))",  # paragraph
    r".{{h},{m}}(?<=\n)",  # list item, table row
    r".{{h},{m}}(?<=[.!?…][\"'”’)\]]{0,2}\s)(?=[\"'“‘(\[§]?\p{Lu}|\(?[a-z0-9]{1,4}[.)]\s)",  # sentence
    r".{1,{m}}(?<=[.!?…\n][\"'”’)\]]{0,2}\s)",  # sentence or line, earlier
    r".{1,{m}}(?<=\s)",  # word
    r".{1,{m}}(?!\p{M})",  # character, but not before a mark
    r".{1,{m}}",
)


GROUP = 256  # pieces whose sizes are added up together


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, n: acc + n)


def boundary_pattern(most: Column) -> Column:
    """Pattern that takes up to ``most`` code points at a time, ending at the strongest boundary there is."""
    half = F.greatest(F.floor(most / 2), F.lit(1)).cast("string")
    pattern = F.lit("(?s:" + "|".join(ENDS) + ")")
    return F.replace(F.replace(pattern, F.lit("{h}"), half), F.lit("{m}"), most.cast("string"))


def split_texts(texts: DataFrame, key: str) -> DataFrame:
    """Numbered pieces of rows (key, text, max_chars, overlap_chars), one row per key.

    Result: (key, piece_no from 1, start_char from 0, overlap_chars, piece).  A piece has at most ``max_chars`` code points; from
    the second on it begins with the last ``overlap_chars`` code points before it, so the pieces without their overlap,
    joined, are the text.  A text within the limit, and one whose limit is null, is one piece; an empty text is one empty
    piece, a null text none.  A limit below 1, or an overlap that is negative or above a third of it, is an error.
    """
    limit, over = F.col("max_chars"), F.coalesce(F.col("overlap_chars"), F.lit(0))
    wrong = (limit < 1) | (over < 0) | (over * 3 > limit)
    checked = F.when(wrong, F.raise_error(F.lit("a limit below 1, or an overlap below 0 or above a third of the limit"))).otherwise(limit)
    whole = limit.isNull() | (F.length("text") <= checked)
    taken = F.regexp_extract_all("text", boundary_pattern(checked - over), F.lit(0))
    rows = texts.where(F.col("text").isNotNull()).select(
        key, "text", F.when(whole, 0).otherwise(over).alias("over"), F.when(whole, F.array("text")).otherwise(taken).alias("cores")
    )
    sizes = F.transform("cores", lambda c: F.length(c))
    # places in two steps, by groups of pieces, so that the time stays near the number of pieces
    group = F.lit(GROUP)
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size("cores") - 1) / GROUP).cast("int")), lambda g: _sum(F.slice("sizes", g * group + 1, group)))
    starts = F.transform("sizes", lambda _, i: _sum(F.slice("groups", F.lit(1), (i / group).cast("int"))) + _sum(F.slice("sizes", (i / group).cast("int") * group + 1, i % group)))

    def piece(core: Column, i: Column) -> Column:
        start, over = F.get("starts", i), F.col("over")
        near = F.array_join(F.slice("cores", F.greatest(i - 7, F.lit(1)), F.least(i, F.lit(8))), "")
        # the last few pieces nearly always hold the overlap; only very short ones need a walk through the text
        before = F.when(F.length(near) >= F.least(over, start), F.right(near, over)).otherwise(F.substring("text", F.greatest(start - over, F.lit(0)) + 1, F.least(over, start)))
        before = F.when((i > 0) & (over > 0), before).otherwise("")
        return F.struct(start.alias("start"), F.length(before).alias("overlap"), F.concat(before, core).alias("piece"))

    rows = rows.where(F.size("cores") > 0).withColumn("sizes", sizes).withColumn("groups", groups).withColumn("starts", starts).select(key, F.posexplode(F.transform("cores", piece)).alias("at", "p"))
    return rows.select(
        key, (F.col("at") + 1).alias("piece_no"), (F.col("p.start") - F.col("p.overlap")).alias("start_char"), F.col("p.overlap").alias("overlap_chars"), F.col("p.piece").alias("piece")
    )

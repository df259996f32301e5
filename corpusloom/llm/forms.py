"""One form for text that prints alike but differs in its characters.

A text is exploded to positioned pieces: a run of plain ASCII characters, which no rule touches, travels as one piece, every
other code point (and the plain character before it, which a combining mark may follow) as a piece of its own.  Pieces are
joined with a broadcast table of decompositions and look-alikes, marks are ordered by combining class within their letter,
letters are recomposed by a second broadcast table, and the text is put together again.  The tables are rules over the fixed
Unicode repertoire (some 17,000 rows), so their size has a bound that does not depend on the data.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.scratch import cut

# Letters of other scripts that cannot be told from a Latin letter.
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ")) | dict(zip("ονϲϳ", "ovcj"))
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХҮԌԚԜӀ", "ABESIJKMHOPCTXYGQWI")) | dict(zip("аеосрухѕіјһԁԛԝӏү", "aeocpyxsijhdqwly"))
ARMENIAN = {"Օ": "O", "օ": "o"}
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ"))
COPTIC = dict(zip("ⲀⲂⲈⲎⲔⲘⲚⲞⲢⲤⲦⲨⲬ", "ABEHKMNOPCTYX")) | dict(zip("ⲟⲣⲥ", "opc"))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
# Hyphens that look like the ASCII one. Longer dashes and the minus sign look different.
HYPHENS = "‐‑⁃﹣－"
LOOK_ALIKE = GREEK | CYRILLIC | ARMENIAN | CHEROKEE | COPTIC | LISU | {"ɡ": "g"} | dict.fromkeys(HYPHENS, "-")

PLAIN = r"\x09-\x0D\x20-\x7E"
PIECES = f"[{PLAIN}]+(?![^{PLAIN}])|(?s:.)"
SPECIAL = f"[^{PLAIN}]"


def _invisible(ch: str) -> bool:
    """What prints nothing: format characters, variation selectors, fillers, controls other than blanks."""
    cp = ord(ch)
    return (
        unicodedata.category(ch) in ("Cf", "Cc")
        or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)
        or 0x180B <= cp <= 0x180F
        or 0xFE00 <= cp <= 0xFE0F
        or 0xE0000 <= cp <= 0xE0FFF
    )


def decomposed(ch: str) -> str:
    """The characters that ``ch`` stands for: nothing, a blank, the plain letters it looks like, or itself in parts."""
    if ch in LOOK_ALIKE:
        return LOOK_ALIKE[ch]
    if "\t" <= ch <= "\r":
        return ch
    if ch in ("\x85", "\u2028", "\u2029"):
        return "\n"
    if _invisible(ch):
        return ""
    if unicodedata.category(ch) == "Zs":
        return " "
    rule = unicodedata.decomposition(ch)
    if not rule:
        return unicodedata.normalize("NFD", ch) if "가" <= ch <= "힣" else ch
    kind, *rest = rule.split() if rule[0] == "<" else ("", *rule.split())
    parts = "".join(chr(int(x, 16)) for x in rest)
    letters = parts.isascii() and parts.isalpha()
    alike = kind in ("", "<wide>", "<narrow>", "<small>", "<noBreak>") or (kind in ("<compat>", "<font>") and letters and ch != "ſ")
    return "".join(map(decomposed, parts)) if alike else ch


@lru_cache(maxsize=1)
def character_rules() -> list[tuple[str, list[tuple[str, int]]]]:
    """(character, the characters it becomes with their combining classes), for each character that changes or combines."""
    rules = []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cn", "Co"):
            continue
        to = decomposed(ch)
        if to != ch or unicodedata.combining(ch):
            rules.append((ch, [(x, unicodedata.combining(x)) for x in to]))
    return rules


@lru_cache(maxsize=1)
def compositions() -> list[tuple[str, str]]:
    """(letter and ordered marks, composed letter) for every letter that Unicode composes."""
    found = {}
    for ch, parts in character_rules():
        sequence = "".join(x for x, _ in parts)
        composed = unicodedata.normalize("NFC", sequence)
        if len(composed) == 1 and all(mark for _, mark in parts[1:]) and len(parts) > 1:
            found[sequence] = composed
    return sorted(found.items())


def form_of(text: str | None) -> str | None:
    """The same form by plain Python, for tests."""
    if text is None:
        return None
    marks = [(x, unicodedata.combining(x)) for ch in text for x in decomposed(ch)]
    clusters: list[list[tuple[int, str]]] = []
    for x, order in marks:
        if order == 0 or not clusters:
            clusters.append([])
        clusters[-1].append((order, x))
    table = dict(compositions())
    ordered = ("".join(x for _, x in sorted(c, key=lambda m: m[0])) for c in clusters)
    return "".join(table.get(c, c) for c in ordered)


_WRITTEN: dict[str, tuple[DataFrame, DataFrame]] = {}


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Both tables, written once per session so that plans hold a file scan instead of their rows."""
    session = f"{spark.sparkContext.applicationId} {id(spark)}"
    if session not in _WRITTEN:
        rules = spark.createDataFrame(character_rules(), "__piece string, __becomes array<struct<ch string, mark int>>")
        composed = spark.createDataFrame(compositions(), "__letter string, __composed string")
        _WRITTEN.clear()
        _WRITTEN[session] = cut(rules.coalesce(1), "characters", keep=True), cut(composed.coalesce(1), "letters", keep=True)
    rules, composed = _WRITTEN[session]
    return F.broadcast(rules), F.broadcast(composed)


def one_form(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """``df`` with ``column`` in its one form; ``keys`` identify a row.

    Null stays null, a text of characters that print nothing becomes empty, an empty text stays empty.  Case, accents and
    ASCII characters (but for controls) are kept.  Marks at the start of a text are ordered among themselves.  A letter with
    marks for which Unicode has no composed letter stays in parts, in one order, and so does a Hangul syllable, whose parts are
    no marks.  Rows of equal keys must be equal.
    Texts of ASCII alone are already in that form and go past the explosion.
    """
    spark = df.sparkSession
    rules, composed = _tables(spark)
    special = F.col(column).rlike(SPECIAL)
    others = df.where(F.col(column).isNull() | ~special)
    pieces = df.where(special).select(
        *keys, F.posexplode(F.regexp_extract_all(column, F.lit(PIECES), F.lit(0))).alias("__at", "__piece")
    )
    itself = F.array(F.struct(F.col("__piece").alias("ch"), F.lit(0).alias("mark")))
    points = pieces.join(rules, "__piece", "left").select(
        *keys, "__at", F.posexplode_outer(F.coalesce("__becomes", itself)).alias("__sub", "__x")
    )
    in_text = Window.partitionBy(*keys).orderBy("__at", "__sub")
    starts = F.when(F.col("__x.mark") == 0, 1).otherwise(0)
    mark = F.when(F.col("__x").isNotNull(), F.struct("__x.mark", "__at", "__sub", "__x.ch"))
    letters = (
        points.withColumn("__no", F.sum(starts).over(in_text))
        .groupBy(*keys, "__no")
        .agg(F.array_sort(F.collect_list(mark)).alias("__marks"))
        .select(*keys, "__no", F.array_join(F.col("__marks.ch"), "").alias("__letter"))
        .join(composed, "__letter", "left")
    )
    whole = letters.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("__no", F.coalesce("__composed", "__letter").alias("text")))).alias("__parts")
    )
    whole = whole.select(*keys, F.array_join(F.col("__parts.text"), "").alias("__form"))
    changed = df.where(special).join(whole, list(keys)).withColumn(column, F.col("__form")).select(*df.columns)
    return others.select(*df.columns).unionByName(changed)

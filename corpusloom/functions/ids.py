"""Stable identifiers as column expressions: a key is derived from the citation, never from headings or file names.

Null in, null out.  Where a value has no valid key, ``strict`` functions raise inside the query; the others give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of an appendix citation.
SFAR = r"^Special Federal Aviation Regulation No\.\s*([0-9]+(?:-[0-9]+)?)"
APPENDIX = r"^Appendix ([A-Z]+) to Part [0-9]+"
APPENDIX_RANGE = r"^Appendixes ([A-Z]+)\s*-\s*([A-Z]+)$"
# Fixed value: paragraph numbers such as 4-1-15.
PARAGRAPH = r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{1,3}$"
# Fixed value: element codes such as PA.I.A.K1 or PA.I.A.K1a.
ELEMENT = r"^([A-Z]{2,3})\.([IVX]+)\.([A-Z])\.([KRS])([0-9]+)([a-z]?)$"
# Roman digits of ones; tens are repeated X.
ONES = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]


def section_id(title: Column, part: Column, section: Column) -> Column:
    """cfr-14-91.155; a number that is local to its part is qualified by the part (cfr-14-241-1-1)."""
    own = part.isNull() | (section == part) | F.startswith(section, F.concat(part, F.lit(".")))
    return F.when(own, F.concat_ws("-", F.lit("cfr"), title, section)).otherwise(F.concat_ws("-", F.lit("cfr"), title, part, section))


def part_id(title: Column, part: Column) -> Column:
    """cfr-14-part-91."""
    return F.concat(F.lit("cfr-"), title.cast("string"), F.lit("-part-"), part)


def appendix_id(title: Column, part: Column, name: Column, heading: Column) -> Column:
    """The key of an appendix: by its name, else by its heading, else a slug of the name."""
    found = []
    for text in (name, heading):
        text = F.coalesce(text, F.lit(""))
        got = lambda pattern, group: F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))  # noqa: B023, E731
        found += [
            F.concat(F.lit("sfar-"), got(SFAR, 1)),
            F.concat(F.lit("appendix-"), got(APPENDIX, 1)),
            F.concat(F.lit("appendixes-"), got(APPENDIX_RANGE, 1), F.lit("-"), got(APPENDIX_RANGE, 2)),
        ]
    slug = F.btrim(F.regexp_replace(name, "[^A-Za-z0-9.]+", "-"), F.lit("-"))
    return F.concat(part_id(title, part), F.lit("-"), F.coalesce(*found, slug))


def valid_or_raise(ok: Column, value: Column, what: str) -> Column:
    """``value`` where ``ok`` holds; null stays null; anything else stops the query."""
    return F.when(ok, value).when(ok.isNull(), F.lit(None)).otherwise(F.raise_error(F.lit(f"not a valid {what}")).cast("string"))


def paragraph_id(number: Column, strict: bool = False) -> Column:
    """aim-4-1-15; null (or an error) for a number of another form."""
    ok, key = number.rlike(PARAGRAPH), F.concat(F.lit("aim-"), number)
    return valid_or_raise(ok, key, "paragraph number") if strict else F.when(ok, key)


def aim_id(kind: str, *numbers: Column) -> Column:
    """aim-chapter-4, aim-4-1 (a section), aim-appendix-3."""
    front = {"chapter": "aim-chapter", "section": "aim", "appendix": "aim-appendix"}[kind]
    return F.concat_ws("-", F.lit(front), *[n.cast("string") for n in numbers])


def letter_id(letter: Column, strict: bool = False) -> Column:
    """pcg-letter-a for a lower-case letter of the glossary."""
    ok, key = letter.rlike("^[a-z]$"), F.concat(F.lit("pcg-letter-"), letter)
    return valid_or_raise(ok, key, "letter") if strict else F.when(ok, key)


def slug(text: Column) -> Column:
    """Lower-case ASCII letters and digits, every other run a hyphen, none at the ends; null where nothing is left."""
    return F.nullif(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-")), F.lit(""))


def term_id(term: Column, strict: bool = False) -> Column:
    """pcg-<slug> of a glossary term."""
    key = F.concat(F.lit("pcg-"), slug(term))
    return valid_or_raise(F.when(term.isNotNull(), slug(term).isNotNull()), key, "term") if strict else key


def acs_id(document: Column, area: Column | None = None, task: Column | None = None) -> Column:
    """acs-pa, acs-PA.I, acs-PA.I.A."""
    if area is None:
        return F.concat(F.lit("acs-"), F.lower(document))
    return F.concat(F.lit("acs-"), F.concat_ws(".", *[document, area] + ([task] if task is not None else [])))


def acs_appendix_id(document: Column, number: Column) -> Column:
    """acs-pa-appendix-1."""
    return F.concat(F.lit("acs-"), F.lower(document), F.lit("-appendix-"), number.cast("string"))


def element_parts(code: Column) -> Column:
    """Struct of an element code (acs, area, task, kind, number, sub); null if it is none."""
    part = lambda i: F.regexp_extract(code, ELEMENT, i)
    fields = [part(1).alias("acs"), part(2).alias("area"), part(3).alias("task"), part(4).alias("kind"), part(5).cast("int").alias("number"), F.nullif(part(6), F.lit("")).alias("sub")]
    return F.when(code.rlike(ELEMENT), F.struct(*fields))


def int_to_roman(number: Column) -> Column:
    """1..39 as a Roman numeral; null beyond."""
    ones = F.element_at(F.array(*[F.lit(x) for x in ONES]), (F.pmod(number, F.lit(10)) + 1).cast("int"))
    return F.when(number.between(1, 39), F.concat(F.repeat(F.lit("X"), F.floor(number / 10).cast("int")), ones))


def roman_to_int(text: Column) -> Column:
    """1..39 of a well-formed Roman numeral, by a table of all of them; null for anything else."""
    all_ = [("X" * (n // 10) + ONES[n % 10], n) for n in range(1, 40)]
    table = F.create_map(*[F.lit(x) for pair in all_ for x in pair])
    return F.try_element_at(table, text)

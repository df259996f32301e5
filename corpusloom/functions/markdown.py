"""Rendering of notes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = "    "
# Kinds of callouts and their labels.
CALLOUTS = {"info": "Info", "note": "Note", "cite": "References", "example": "Example", "quote": "Quote", "study": "Study"}
# Order of the sections of a note.
SECTIONS = ["source", "study", "text", "notes", "references", "terms", "related"]


def indent(text: Column, levels: int = 1) -> Column:
    """Each line that is not empty moved in; empty lines stay empty."""
    return F.regexp_replace(text, "(^|\n)(?=[^\n])", "$1" + STEP * levels)


def list_item(head: Column, depth: Column, children: Column | None = None) -> Column:
    """One item of a list at ``depth`` (from 0), further lines of its head below it; an empty head stops the query.

    ``children`` is an array of finished texts (paragraphs, inner lists): each stands below the head after an empty line, one step
    further in; null and empty ones are left out.
    """
    empty = F.trim(head) == ""
    checked = F.when(empty, F.raise_error(F.lit("a list item needs a head")).cast("string")).otherwise(head)
    lead = F.repeat(F.lit(STEP), depth)
    inner = F.concat(lead, F.lit(STEP))
    moved = lambda text: F.concat(F.when(F.length(text) > 0, inner).otherwise(""), _after_breaks(text, inner))
    item = F.concat(lead, F.lit("- "), _after_breaks(checked, inner))
    if children is None:
        return item
    kept = F.filter(F.coalesce(children, F.array().cast("array<string>")), lambda x: F.length(F.trim(x)) > 0)
    return F.concat(item, F.array_join(F.transform(kept, lambda x: F.concat(F.lit("\n\n"), moved(x))), ""))


def _after_breaks(text: Column, lead: Column) -> Column:
    """``text`` with ``lead`` before each line behind the first that is not empty."""
    lines = F.split(text, "\n")
    return F.array_join(F.transform(lines, lambda x, i: F.when((i > 0) & (F.length(x) > 0), F.concat(lead, x)).otherwise(x)), "\n")


def link_display(text: Column) -> Column:
    """Text that may stand inside a link: no brackets, slashes for bars."""
    return F.translate(text, "|[]", "/")


def wikilink(stem: Column, display: Column, anchor: Column | None = None) -> Column:
    """[[stem|display]] or [[stem#^anchor|display]]."""
    at = F.lit("") if anchor is None else F.when(anchor.isNull(), "").otherwise(F.concat(F.lit("#^"), anchor))
    return F.concat(F.lit("[["), stem, at, F.lit("|"), link_display(display), F.lit("]]"))


def wikilink_stems(text: Column) -> Column:
    """Targets of all links in a text, without anchor and display, in order."""
    return F.regexp_extract_all(text, F.lit(r"\[\[([^\]|#]+)"), F.lit(1))


def escaped(text: Column) -> Column:
    """Brackets and asterisks that are text, not markup."""
    return F.regexp_replace(text, r"([\[*])", r"\\$1")


def hard_breaks(text: Column) -> Column:
    """Line ends that stay line ends."""
    return F.replace(text, F.lit("\n"), F.lit("\\\n"))


def block_anchor(code: Column) -> Column:
    """' ^pa-i-a-k1' for PA.I.A.K1."""
    return F.concat(F.lit(" ^"), F.replace(F.lower(code), F.lit("."), F.lit("-")))


def figure(file: Column, alt: Column) -> Column:
    """![[file|alt]]."""
    return F.concat(F.lit("![["), file, F.lit("|"), link_display(alt), F.lit("]]"))


def callout(kind: Column, title: Column, body: Column) -> Column:
    """A callout: its kind and title, each line of the body quoted; an unknown kind becomes a note."""
    known = F.when(kind.isin(*CALLOUTS), kind).otherwise("note")
    return F.concat(F.lit("> [!"), known, F.lit("] "), title, F.lit("\n> "), F.replace(body, F.lit("\n"), F.lit("\n> ")))


# Fields of a study callout in their order.
STUDY = ["Gist", "Why", "Numbers", "Watch out", "Mnemonic", "ACS", "Stage"]
# Kinds of source notes in their order.
SOURCE_NOTES = [
    "Authority", "Source", "Citations", "Section authority", "Approvals", "Editorial Note", "Effective Date Note", "Amendment notes", "Cross Reference",
]


def study_callout(fields: dict[str, Column]) -> Column:
    """A study callout of the fields that are not null, in their fixed order; null if all are."""
    lines = [F.concat(F.lit(f"**{name}:** "), fields[name]) for name in STUDY if name in fields]
    body = F.concat_ws("\n", *lines)
    return F.when(F.length(body) > 0, callout(F.lit("study"), F.lit(CALLOUTS["study"]), body))


def pipe_row(cells: Column) -> Column:
    """One row of a simple table; bars inside cells are escaped, null cells are empty."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda x: F.replace(F.coalesce(x, F.lit("")), F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))


def html_row(cells: Column) -> Column:
    """One row of an HTML table."""
    clean = lambda x: F.replace(F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<tr><td>"), F.array_join(F.transform(cells, clean), "</td><td>"), F.lit("</td></tr>"))


def table_style(depth: Column, cells: Column) -> Column:
    """'html' inside a list item or with cells of several lines, else 'pipe'."""
    return F.when((depth > 0) | F.exists(cells, lambda x: F.coalesce(F.contains(x, F.lit("\n")), F.lit(False))), "html").otherwise("pipe")


def front_matter(pairs: list[tuple[str, Column, str]]) -> Column:
    """Key, value and kind ('string', 'bare' or 'list') in the given order; null values are left out."""
    quoted = lambda x: F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    lines = []
    for key, value, kind in pairs:
        if kind == "list":
            shown = F.when(F.size(value) > 0, F.concat(F.lit(f"{key}:\n  - "), F.array_join(F.transform(value, quoted), "\n  - ")))
        else:
            shown = F.concat(F.lit(f"{key}: "), quoted(value) if kind == "string" else value.cast("string"))
        lines.append(shown)
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---"))


def folder(prefix: str, number: Column, width: int = 3) -> Column:
    """'Part 091': leading digits of each side of a range padded, never cut."""
    padded = lambda x: F.concat(F.repeat(F.lit("0"), F.greatest(width - F.length(F.regexp_extract(x, "^[0-9]*", 0)), F.lit(0))), x)
    return F.concat(F.lit(prefix + " "), F.array_join(F.transform(F.split(number, "-"), padded), "-"))


def stem(term: Column) -> Column:
    """File name of a term: round brackets for square ones, no path signs."""
    return F.translate(term, "[]/\\:", "()---")

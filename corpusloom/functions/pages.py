"""Fetched pages and addresses as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a content delivery network adds to a page.
INJECTED = (
    r'<script[^>]*>bazadebezolkohpepadr="[^"<]*"</script>',
    r'<script[^>]* src="[^"]*/akam/[^"]*"[^>]*></script>',
    r'<noscript><img[^>]* src="[^"]*/akam/[^"]*"[^>]*></noscript>',
)


def strip_injected(html: Column) -> Column:
    """The page without the injected script pair and pixel; other scripts stay, and a second pass changes nothing."""
    for pattern in INJECTED:
        html = F.regexp_replace(html, pattern, "")
    return html


def cache_busted(url: Column, nonce: Column, parameter: str = "cb") -> Column:
    """The address with a nonce parameter at its end."""
    return F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit(f"{parameter}="), nonce)


def download_nonce() -> Column:
    """16 hex characters, fresh for each row and run: never use it in content."""
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 16)


def same_origin(url: Column, origin: str) -> Column:
    """Whether an absolute address lies on ``origin`` (scheme, host, no other port, no user)."""
    return F.coalesce(url.rlike("^" + origin.replace(".", r"\.") + r"(?:[/?#]|$)"), F.lit(False))


def hrefs(html: Column) -> Column:
    """Targets of all links of a page, in order."""
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))


def images(html: Column) -> Column:
    """Sources of all images of a page, in order."""
    return F.regexp_extract_all(html, F.lit(r'<img[^>]* src="([^"]*)"'), F.lit(1))


def title(html: Column) -> Column:
    """Text of the title element; null if there is none."""
    return F.nullif(F.trim(F.regexp_extract(html, r"<title>([^<]*)</title>", 1)), F.lit(""))


def plain_text(html: Column) -> Column:
    """Visible text: scripts, styles and tags removed, the basic entities decoded, runs of blanks folded."""
    text = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, to in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(to))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def dom(html: Column) -> Column:
    """(text, links, images) of a page as its tree has them: any quoting of attributes, every entity, no scripts and styles.

    A Pandas UDF on Python's own parser, for pages beyond ``plain_text``, ``hrefs`` and ``images``; null for null.
    """
    from html.parser import HTMLParser

    class Page(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.parts, self.links, self.images, self.hidden = [], [], [], 0

        def handle_starttag(self, tag, attrs):
            named = dict(attrs)
            self.hidden += tag in ("script", "style")
            if named.get("href") is not None:
                self.links.append(named["href"])
            if tag == "img" and named.get("src") is not None:
                self.images.append(named["src"])
            self.parts.append(" ")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style") and self.hidden > 0
            self.parts.append(" ")

        def handle_data(self, data):
            if not self.hidden:
                self.parts.append(data)

    @F.pandas_udf("text string, links array<string>, images array<string>")
    def parsed(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for html in pages:
            if html is None:
                rows.append((None, None, None))
                continue
            page = Page()
            page.feed(html)
            page.close()
            rows.append((" ".join("".join(page.parts).split()), page.links, page.images))
        return pd.DataFrame(rows, columns=["text", "links", "images"])

    return parsed(html)


def register_citations(text: Column) -> Column:
    """Array of (volume, page) of the citations of the Federal Register in a note: 58 FR 51968."""
    found = F.regexp_extract_all(text, F.lit(r"\b([0-9]{1,3} FR [0-9]{1,6})\b"), F.lit(1))
    return F.transform(found, lambda x: F.struct(F.split_part(x, F.lit(" "), F.lit(1)).cast("int").alias("volume"), F.split_part(x, F.lit(" "), F.lit(3)).cast("int").alias("page")))


def captions(text: Column) -> Column:
    """Array of (kind, number, caption) of the tables and figures of a note: **TBL 3-1-5** *caption*."""
    found = F.regexp_extract_all(text, F.lit(r"(\*\*(?:TBL|FIG) [0-9A-Z-]+\*\*(?: \*[^*\n]+\*)?)"), F.lit(1))
    part = lambda x, i: F.regexp_extract(x, r"^\*\*(TBL|FIG) ([0-9A-Z-]+)\*\*(?: \*([^*\n]+)\*)?$", i)
    return F.transform(found, lambda x: F.struct(part(x, 1).alias("kind"), part(x, 2).alias("number"), F.nullif(part(x, 3), F.lit("")).alias("caption")))


def edition_change(label: Column) -> Column:
    """Highest change number of a listing label ('Change 1, 2 and 3' is 3, 'Basic' is 0); null if it names none."""
    listed = F.regexp_extract(label, r"(?i)changes?\s+([0-9]+(?:\s*(?:,|and|&)\s*[0-9]+)*)", 1)
    numbers = F.transform(F.regexp_extract_all(listed, F.lit("[0-9]+"), F.lit(0)), lambda x: x.cast("int"))
    return F.when(F.size(numbers) > 0, F.array_max(numbers)).when(label.rlike("(?i)basic"), 0)


def edition_date(label: Column) -> Column:
    """Effective date of a listing label ('effective 7/9/2026'); null if it has none or an impossible one."""
    return F.try_to_date(F.nullif(F.regexp_extract(label, r"(?i)effective\s+([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1), F.lit("")), "M/d/yyyy")


def retry_wait(header: Column, attempt: Column, cap: int = 300) -> Column:
    """Seconds to wait: the Retry-After header if it is a number, else doubling from 1, at most ``cap``."""
    asked = header.try_cast("int")
    return F.least(F.coalesce(F.when(asked >= 0, asked), F.pow(F.lit(2), attempt).cast("int")), F.lit(cap))

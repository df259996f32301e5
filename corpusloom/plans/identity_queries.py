"""Queries: identifiers, hashes and fetched pages."""

from pyspark.sql import functions as F

from corpusloom.functions import canonical, ids, pages
from corpusloom.plans import Registry
from corpusloom.sources.tables import load

REGISTRY = Registry()


@REGISTRY.add("id_section", """
    SELECT DISTINCT id, part, section, CASE WHEN part IS NULL OR section = part OR starts_with(section, part || '.') THEN 'cfr-' || title_number || '-' || section
      ELSE 'cfr-' || title_number || '-' || part || '-' || section END AS computed_id FROM cfr_section""")  # fmt: skip
def id_section(spark, folder):
    rows = load(spark, folder, "cfr_section", "id", "title_number", "part", "section")
    return rows.select("id", "part", "section", ids.section_id(F.col("title_number"), F.col("part"), F.col("section")).alias("computed_id")).distinct()


@REGISTRY.add("id_part", "SELECT DISTINCT part, 'cfr-' || title_number || '-part-' || part AS part_id FROM cfr_section")
def id_part(spark, folder):
    return load(spark, folder, "cfr_section", "title_number", "part").select("part", ids.part_id(F.col("title_number"), F.col("part")).alias("part_id")).distinct()


@REGISTRY.add("id_appendix", r"""
    WITH named AS (SELECT DISTINCT part, unnest(['Appendix A to Part ' || part, 'Special Federal Aviation Regulation No. 50-2', 'Appendixes B - C', 'Figure (1) & notes']) AS name FROM cfr_section)
    SELECT part, name, 'cfr-14-part-' || part || '-' || CASE
      WHEN regexp_matches(name, '^Special Federal Aviation Regulation No\.\s*[0-9]+') THEN 'sfar-' || regexp_extract(name, '^Special Federal Aviation Regulation No\.\s*([0-9]+(?:-[0-9]+)?)', 1)
      WHEN regexp_matches(name, '^Appendix [A-Z]+ to Part [0-9]+') THEN 'appendix-' || regexp_extract(name, '^Appendix ([A-Z]+) to', 1)
      WHEN regexp_matches(name, '^Appendixes [A-Z]+\s*-\s*[A-Z]+$') THEN 'appendixes-' || regexp_extract(name, '^Appendixes ([A-Z]+)\s*-\s*([A-Z]+)$', 1) || '-' || regexp_extract(name, '^Appendixes ([A-Z]+)\s*-\s*([A-Z]+)$', 2)
      ELSE trim(regexp_replace(name, '[^A-Za-z0-9.]+', '-', 'g'), '-') END AS appendix_id FROM named""")  # fmt: skip
def id_appendix(spark, folder):
    parts = load(spark, folder, "cfr_section", "part").distinct()
    names = F.array(F.concat(F.lit("Appendix A to Part "), F.col("part")), F.lit("Special Federal Aviation Regulation No. 50-2"), F.lit("Appendixes B - C"), F.lit("Figure (1) & notes"))
    rows = parts.select("part", F.explode(names).alias("name"))
    return rows.select("part", "name", ids.appendix_id(F.lit(14), F.col("part"), F.col("name"), F.lit(None)).alias("appendix_id"))


@REGISTRY.add("id_paragraph", r"""
    WITH n AS (SELECT l_orderkey, l_linenumber, (l_orderkey % 12) || '-' || l_linenumber || '-' || (l_partkey % 1500) AS number FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(number, '^[0-9]{1,2}-[0-9]{1,2}-[0-9]{1,3}$') THEN 'aim-' || number END AS paragraph_id FROM n""")  # fmt: skip
def id_paragraph(spark, folder):
    rows = load(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    number = F.concat_ws("-", F.col("l_orderkey") % 12, F.col("l_linenumber"), F.col("l_partkey") % 1500)
    return rows.select("l_orderkey", "l_linenumber", ids.paragraph_id(number).alias("paragraph_id"))


@REGISTRY.add("id_aim", r"""
    WITH n AS (SELECT DISTINCT string_split(citation[5:], '-') AS n FROM units WHERE layer = 'aim' AND citation LIKE 'AIM %')
    SELECT DISTINCT 'aim-chapter-' || n[1] AS chapter_id, 'aim-' || n[1] || '-' || n[2] AS section_id, 'aim-appendix-' || n[1] AS appendix_id FROM n""")  # fmt: skip
def id_aim(spark, folder):
    """Identifiers of the chapters and sections that hold the paragraphs (and of the appendix of the same number)."""
    rows = load(spark, folder, "units", "layer", "citation").where("layer = 'aim' and startswith(citation, 'AIM ')")
    n = F.split(F.substring("citation", 5, 100), "-")
    rows = rows.select(F.get(n, F.lit(0)).alias("chapter"), F.get(n, F.lit(1)).alias("section")).distinct()
    return rows.select(
        ids.aim_id("chapter", F.col("chapter")).alias("chapter_id"), ids.aim_id("section", F.col("chapter"), F.col("section")).alias("section_id"), ids.aim_id("appendix", F.col("chapter")).alias("appendix_id")
    ).distinct()


@REGISTRY.add("id_letter", "SELECT DISTINCT letter, CASE WHEN regexp_matches(lower(letter), '^[a-z]$') THEN 'pcg-letter-' || lower(letter) END AS letter_id FROM pcg_term")
def id_letter(spark, folder):
    return load(spark, folder, "pcg_term", "letter").select("letter", ids.letter_id(F.lower("letter")).alias("letter_id")).distinct()


@REGISTRY.add("id_term", "SELECT DISTINCT term_key, 'pcg-' || nullif(trim(regexp_replace(lower(term), '[^a-z0-9]+', '-', 'g'), '-'), '') AS term_id FROM pcg_term")
def id_term(spark, folder):
    return load(spark, folder, "pcg_term", "term_key", "term").select("term_key", ids.term_id(F.col("term")).alias("term_id")).distinct()


_ROMAN = "repeat('X', ({n}) // 10) || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][({n}) % 10 + 1]"


@REGISTRY.add("id_acs", f"""
    SELECT s_suppkey, 'acs-pa' AS publication_id, 'acs-PA.' || {_ROMAN.format(n='s_suppkey % 39 + 1')} AS area_id,
      'acs-PA.' || {_ROMAN.format(n='s_suppkey % 39 + 1')} || '.' || chr(65 + s_nationkey) AS task_id, 'acs-pa-appendix-' || (s_suppkey % 5) AS appendix_id FROM supplier""")  # fmt: skip
def id_acs(spark, folder):
    rows = load(spark, folder, "supplier", "s_suppkey", "s_nationkey")
    area, task = ids.int_to_roman(F.col("s_suppkey") % 39 + 1), F.chr(F.lit(65) + F.col("s_nationkey"))
    pa = F.lit("PA")
    return rows.select("s_suppkey", ids.acs_id(pa).alias("publication_id"), ids.acs_id(pa, area).alias("area_id"), ids.acs_id(pa, area, task).alias("task_id"), ids.acs_appendix_id(pa, F.col("s_suppkey") % 5).alias("appendix_id"))


@REGISTRY.add("parse_element_code", rf"""
    WITH c AS (SELECT p_partkey, 'PA.' || coalesce({_ROMAN.format(n='p_partkey % 45')}, '') || '.' || chr(65 + p_size % 26) || '.' || ['K', 'R', 'S', 'X'][p_partkey % 4 + 1] || p_size || CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE '' END AS code FROM part),
    ok AS (SELECT *, regexp_matches(code, '^[A-Z]{{2,3}}\.[IVX]+\.[A-Z]\.[KRS][0-9]+[a-z]?$') AS ok FROM c)
    SELECT code, p_partkey, CASE WHEN ok THEN split_part(code, '.', 2) END AS area, CASE WHEN ok THEN split_part(code, '.', 3) END AS task, CASE WHEN ok THEN regexp_extract(code, '\.([KRS])[0-9]', 1) END AS kind,
      CASE WHEN ok THEN regexp_extract(code, '[KRS]([0-9]+)[a-z]?$', 1)::INT END AS number, CASE WHEN ok THEN nullif(regexp_extract(code, '([a-z]?)$', 1), '') END AS sub FROM ok""")  # fmt: skip
def parse_element_code(spark, folder):
    rows = load(spark, folder, "part", "p_partkey", "p_size")
    kind = F.element_at(F.array(*map(F.lit, "KRSX")), (F.col("p_partkey") % 4 + 1).cast("int"))
    n = F.col("p_partkey") % 45
    roman = F.concat(F.repeat(F.lit("X"), F.floor(n / 10).cast("int")), F.element_at(F.array(*map(F.lit, ids.ONES)), (n % 10 + 1).cast("int")))
    code = F.concat(F.lit("PA."), roman, F.lit("."), F.chr(F.lit(65) + F.col("p_size") % 26), F.lit("."), kind, F.col("p_size"), F.when(F.col("p_partkey") % 3 == 0, "a").otherwise(""))
    rows = rows.select("p_partkey", code.alias("code")).withColumn("e", ids.element_parts(F.col("code")))
    return rows.select("p_partkey", "code", *[F.col(f"e.{f}").alias(f) for f in ("area", "task", "kind", "number", "sub")])


@REGISTRY.add("roman", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 45 BETWEEN 1 AND 39 THEN {_ROMAN.format(n='o_orderkey % 45')} END AS roman, CASE WHEN o_orderkey % 45 BETWEEN 1 AND 39 THEN (o_orderkey % 45)::INT END AS number FROM orders""")  # fmt: skip
def roman(spark, folder):
    rows = load(spark, folder, "orders", "o_orderkey").withColumn("roman", ids.int_to_roman(F.col("o_orderkey") % 45))
    return rows.select("o_orderkey", "roman", ids.roman_to_int(F.col("roman")).alias("number"))


@REGISTRY.add("canonical_hash", """
    SELECT n_nationkey, 'sha256:' || sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS hash FROM nation""")  # fmt: skip
def canonical_hash(spark, folder):
    rows = load(spark, folder, "nation").withColumn("source", F.lit("anywhere"))
    record = F.struct("source", "n_regionkey", "n_nationkey", "n_name")
    return rows.select("n_nationkey", canonical.canonical_hash(record, rows.select(record.alias("r")).schema["r"].dataType).alias("hash"))


@REGISTRY.add("canonical_nested", """
    SELECT DISTINCT term_key, 'sha256:' || sha256('{"links":' || coalesce('[' || array_to_string(list_transform(see_also, lambda x: '{"item":' || coalesce(to_json(x)::VARCHAR, 'null') || '}'), ',') || ']', 'null')
      || ',"names":{"letter":' || coalesce(to_json(letter)::VARCHAR, 'null') || ',"term":' || coalesce(to_json(term)::VARCHAR, 'null') || '}}') AS hash FROM pcg_term""")  # fmt: skip
def canonical_nested(spark, folder):
    """Glossary entries as nested records: provenance in structs within arrays and in map keys does not count."""
    rows = load(spark, folder, "pcg_term", "term_key", "term", "letter", "see_also", "source").distinct()
    links = F.transform("see_also", lambda x: F.struct(F.col("source").alias("source"), x.alias("item")))
    names = F.create_map(F.lit("term"), F.col("term"), F.lit("source"), F.col("source"), F.lit("letter"), F.col("letter"))
    rows = rows.select("term_key", F.struct(names.alias("names"), links.alias("links")).alias("r"))
    return rows.select("term_key", canonical.canonical_hash(F.col("r"), rows.schema["r"].dataType).alias("hash")).distinct()


@REGISTRY.add("strip_provenance", """
    SELECT DISTINCT id, source_version, '{"id":"' || id || '","title":' || coalesce('"' || title || '"', 'null') || '}' AS content FROM cfr_section""")  # fmt: skip
def strip_provenance(spark, folder):
    rows = load(spark, folder, "cfr_section", "id", "title", "source", "canonical_hash", "source_version")
    record = F.struct("title", "source", "canonical_hash", "id")
    return rows.select("id", "source_version", canonical.canonical_json(record, rows.select(record.alias("r")).schema["r"].dataType).alias("content")).distinct()


@REGISTRY.add("tree_hash", """
    WITH b AS (SELECT source, substr(sha256(doc_id::VARCHAR), 1, 2) AS branch, sha256(text) || ' ' || doc_id AS line FROM documents),
    h AS (SELECT source, branch || ' ' || sha256(string_agg(line, chr(10) ORDER BY line)) AS hash FROM b GROUP BY source, branch)
    SELECT source, 'sha256:' || sha256(string_agg(hash, chr(10) ORDER BY hash)) AS hash FROM h GROUP BY source""")  # fmt: skip
def tree_hash(spark, folder):
    rows = load(spark, folder, "documents", "source", "doc_id", "text")
    return canonical.tree_hashes(rows, "source", F.col("doc_id").cast("string"), F.sha2("text", 256))


@REGISTRY.add("exact_dups", "SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dups(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("hash"))
    return rows.groupBy("hash").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


# A page around each document, with and without what a delivery network adds.
_HEAD = "'<html><head><title>' || replace(split_part(text, chr(10), 1), '<', '') || '</title>'"
_BODY = """'</head><body><script src="./nav.js"></script><a href="/doc/' || doc_id || '?v=' || source_version || '">x</a><a href="#top">&amp;</a><img alt="" src="images/' || source || '.png"></body></html>'"""
_ADDED = """'<script >bazadebezolkohpepadr="' || doc_id || '"</script><script type="text/javascript" src="https://h/akam/13/' || doc_id || '"  defer></script>'"""
_PAGES = f"SELECT doc_id, {_HEAD} || {_ADDED} || {_BODY} AS html, {_HEAD} || {_BODY} AS clean FROM documents"


def _pages(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text", "source", "source_version")
    return rows.select("doc_id", F.expr(f"{_HEAD} || {_ADDED} || {_BODY}".replace("chr(10)", "'\\n'")).alias("html"))


@REGISTRY.add("html_strip_injected", f"SELECT doc_id, sha256(clean) AS clean_hash FROM ({_PAGES})")
def html_strip_injected(spark, folder):
    return _pages(spark, folder).select("doc_id", F.sha2(pages.strip_injected(F.col("html")), 256).alias("clean_hash"))


@REGISTRY.add("html_title", f"SELECT doc_id, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title FROM ({_PAGES})")
def html_title(spark, folder):
    return _pages(spark, folder).select("doc_id", pages.title(F.col("html")).alias("title"))


_TEXT = rf"""
    SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')) AS text FROM ({_PAGES})"""


@REGISTRY.add("html_text", _TEXT)
def html_text(spark, folder):
    return _pages(spark, folder).select("doc_id", pages.plain_text(F.col("html")).alias("text"))


@REGISTRY.add("html_dom", f"SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, 2 AS links, 1 AS images FROM ({_TEXT})")
def html_dom(spark, folder):
    """The same text from the parsed tree, with the number of links and images."""
    rows = _pages(spark, folder).select("doc_id", pages.dom(F.col("html")).alias("d"))
    return rows.select("doc_id", "d.text", F.size("d.links").alias("links"), F.size("d.images").alias("images"))


@REGISTRY.add("page_links", f"""SELECT doc_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM ({_PAGES})""")
def page_links(spark, folder):
    return _pages(spark, folder).select("doc_id", F.explode(pages.hrefs(F.col("html"))).alias("target"))


@REGISTRY.add("figures", f"""SELECT DISTINCT unnest(regexp_extract_all(html, '<img[^>]* src="([^"]*)"', 1)) AS figure FROM ({_PAGES})""")
def figures(spark, folder):
    return _pages(spark, folder).select(F.explode(pages.images(F.col("html"))).alias("figure")).distinct()


_URL = """CASE doc_id % 4 WHEN 0 THEN 'https://www.example.org/d/' || doc_id WHEN 1 THEN 'http://www.example.org/d' WHEN 2 THEN '//www.example.org/' || doc_id ELSE 'https://www.example.org.evil.net/?q=' || doc_id END"""


@REGISTRY.add("url_cache_bust", f"SELECT doc_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'cb=' || substr(sha256(url), 1, 16) AS busted FROM (SELECT doc_id, {_URL} AS url FROM documents)")
def url_cache_bust(spark, folder):
    rows = load(spark, folder, "documents", "doc_id").withColumn("url", F.expr(_URL))
    return rows.select("doc_id", pages.cache_busted(F.col("url"), F.substring(F.sha2("url", 256), 1, 16)).alias("busted"))


@REGISTRY.add("origin_gate", rf"SELECT regexp_matches(url, '^https://www\.example\.org(?:[/?#]|$)') AS same_origin, count(*) AS urls FROM (SELECT {_URL} AS url FROM documents) GROUP BY 1")
def origin_gate(spark, folder):
    rows = load(spark, folder, "documents", "doc_id").select(pages.same_origin(F.expr(_URL), "https://www.example.org").alias("same_origin"))
    return rows.groupBy("same_origin").agg(F.count(F.lit(1)).alias("urls"))


_LABEL = """CASE WHEN change IS NULL OR change = 0 THEN 'Basic (HTML)' WHEN change = 1 THEN 'Basic with Change 1 (HTML)' ELSE 'Basic with Change 1, 2 and ' || change || ' (HTML)' END || ' (effective ' || {m} || '/' || {d} || '/' || {y} || ')'"""


@REGISTRY.add("edition_parse", f"""
    WITH l AS (SELECT term_key, change, effective_date, {_LABEL.format(m='month(effective_date)', d='day(effective_date)', y='year(effective_date)')} AS label FROM pcg_term)
    SELECT DISTINCT label, CASE WHEN label IS NULL THEN NULL WHEN regexp_matches(label, 'Change') THEN greatest(change, CASE WHEN change = 1 THEN 1 ELSE 2 END) ELSE 0 END AS change, CASE WHEN label IS NOT NULL THEN effective_date END AS effective FROM l""")  # fmt: skip
def edition_parse(spark, folder):
    rows = load(spark, folder, "pcg_term", "change", "effective_date")
    label = F.expr(_LABEL.format(m="month(effective_date)", d="day(effective_date)", y="year(effective_date)")).alias("label")
    return rows.select(label).distinct().select("label", pages.edition_change(F.col("label")).alias("change"), pages.edition_date(F.col("label")).alias("effective"))


@REGISTRY.add("retry_wait", "SELECT event_id, least(CASE WHEN event_id % 3 = 0 THEN event_id % 700 ELSE (2 ** (event_id % 12))::INT END, 300)::INT AS seconds FROM events")
def retry_wait(spark, folder):
    header = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 700).cast("string")).otherwise("soon")
    return load(spark, folder, "events", "event_id").select("event_id", pages.retry_wait(header, F.col("event_id") % 12).alias("seconds"))


@REGISTRY.add("download_nonce")
def download_nonce(spark, folder):
    """Fresh for each run, so there is nothing to compare it with."""
    return load(spark, folder, "source_manifest", "source").select("source", pages.download_nonce().alias("nonce"))

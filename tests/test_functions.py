import pytest
from pyspark.sql import functions as F

from corpusloom.functions import canonical, ids, markdown, pages


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_section_ids(spark):
    rows = [(14, "91", "91.155"), (14, "241", "1-1"), (14, None, "91.155"), (14, "91", "91"), (14, "91", "91.27-91.99"), (14, "9", "91.5"), (14, "91", None)]
    got = values(spark, rows, "t int, p string, s string", ids.section_id(F.col("t"), F.col("p"), F.col("s")))
    assert [g[0] for g in got[:6]] == ["cfr-14-91.155", "cfr-14-241-1-1", "cfr-14-91.155", "cfr-14-91", "cfr-14-91.27-91.99", "cfr-14-9-91.5"]


def test_appendix_ids(spark):
    rows = [
        ("Special Federal Aviation Regulation No. 50-2", None, "sfar-50-2"), ("Appendix A to Part 91", None, "appendix-A"), ("Appendixes B - C", None, "appendixes-B-C"),
        ("bad", "Appendix D to Part 91", "appendix-D"), ("(odd) name!", "odd", "odd-name"),
    ]
    got = values(spark, [r[:2] for r in rows], "n string, h string", ids.appendix_id(F.lit(14), F.lit("91"), F.col("n"), F.col("h")))
    assert [g[0] for g in got] == [f"cfr-14-part-91-{r[2]}" for r in rows]


def test_paragraph_letter_and_term_ids(spark):
    assert one(spark, ids.paragraph_id(F.lit("4-1-15"))) == "aim-4-1-15"
    assert one(spark, ids.paragraph_id(F.lit("4-1"))) is None
    assert one(spark, ids.letter_id(F.lit("a"))) == "pcg-letter-a"
    assert one(spark, ids.letter_id(F.lit("A"))) is None
    assert one(spark, ids.term_id(F.lit("ACC [ICAO] – é"))) == "pcg-acc-icao"
    assert one(spark, ids.term_id(F.lit("–"))) is None
    for bad in (ids.paragraph_id(F.lit("4-1"), strict=True), ids.letter_id(F.lit("ab"), strict=True), ids.term_id(F.lit("!"), strict=True)):
        with pytest.raises(Exception, match="not a valid"):
            one(spark, bad)
    assert one(spark, ids.aim_id("appendix", F.lit(3))) == "aim-appendix-3"


def test_roman_numbers(spark):
    got = spark.range(0, 45).select(F.col("id"), ids.int_to_roman(F.col("id")).alias("r")).collect()
    assert {r.id: r.r for r in got if r.id in (0, 1, 4, 9, 14, 39, 40)} == {0: None, 1: "I", 4: "IV", 9: "IX", 14: "XIV", 39: "XXXIX", 40: None}
    back = values(spark, [(x,) for x in ("IV", "IIII", "", "XL", "iv", "XXXIX", None)], "r string", ids.roman_to_int(F.col("r")))
    assert [b[0] for b in back] == [4, None, None, None, None, 39, None]


def test_element_codes(spark):
    got = values(spark, [("PA.I.A.K1a",), ("PAX.XI.B.S12",), ("PA.1.A.K1",), (None,)], "c string", ids.element_parts(F.col("c")))
    assert tuple(got[0][0]) == ("PA", "I", "A", "K", 1, "a")
    assert tuple(got[1][0]) == ("PAX", "XI", "B", "S", 12, None)
    assert got[2][0] is None and got[3][0] is None


def test_canonical_hash_ignores_provenance_and_order(spark):
    rows = spark.sql("select named_struct('b', 1, 'source', 'x', 'a', array(named_struct('canonical_hash', 'h', 'z', cast(null as string), 'c', 'é'))) r")
    other = spark.sql("select named_struct('a', array(named_struct('c', 'é', 'z', cast(null as string))), 'b', 1, 'canonical_hash', 'other') r")
    hashes = {df.select(canonical.canonical_hash(F.col("r"), df.schema["r"].dataType)).first()[0] for df in (rows, other)}
    text = '{"b":1,"source":{},"a":[{"canonical_hash":"h","z":null,"c":"é"}]}'
    hashes.add(spark.createDataFrame([(text,)], "t string").select(canonical.canonical_hash_json(F.col("t"))).first()[0])
    assert len(hashes) == 1 and hashes.pop().startswith("sha256:")
    assert spark.createDataFrame([("{no",), (None,)], "t string").select(canonical.canonical_hash_json(F.col("t")).alias("h")).where("h is not null").count() == 0


def test_canonical_json_of_every_shape(spark):
    """Against Python's own form: control characters, numbers with a fraction, maps, arrays of maps, nulls."""
    import json

    def bare(x):
        if isinstance(x, dict):
            return {k: bare(v) for k, v in x.items() if k not in ("source", "canonical_hash")}
        return [bare(v) for v in x] if isinstance(x, list) else x

    text = "".join(map(chr, range(1, 33))) + "\x7f\u2028é\U0001d518 \"q\" \\u000B \\\\u000B \\\x0b/"
    kinds = "s string, source string, m map<string,string>, a array<map<string,struct<z:string,canonical_hash:string>>>, mm map<string,map<string,int>>"
    one = {"s": text, "source": "x", "m": {"b": "\x1f", "a": None, "source": "gone"}, "a": [{"k": {"z": "1", "canonical_hash": "h"}, "source": None}, None, {}], "mm": {"y": {"source": 1, "b": 2}, "x": None}}
    two = dict.fromkeys(one) | {"a": []}
    df = spark.createDataFrame([(one,), (two,)], f"r struct<{', '.join(':'.join(x.split(' ', 1)) for x in kinds.split(', '))}>")
    got = [r[0] for r in df.select(canonical.canonical_json(F.col("r"), df.schema["r"].dataType)).collect()]
    assert got == [json.dumps(bare(x), sort_keys=True, ensure_ascii=False, separators=(",", ":")) for x in (one, two)]
    numbers = [1e20, 1e-5, 0.1, 1.0, 12345678.5, -0.0, 1e16, 5e-324, None]
    df = spark.createDataFrame([({"d": x, "s": "\x0b"},) for x in numbers], "r struct<d:double,s:string>")
    got = [r[0] for r in df.coalesce(1).select(canonical.canonical_json(F.col("r"), df.schema["r"].dataType)).collect()]
    assert got == [json.dumps({"d": x, "s": "\x0b"}, separators=(",", ":")) for x in numbers]


def test_tree_hash_does_not_depend_on_order(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "p string, c string")
    rows = rows.withColumn("g", F.lit(1))
    tree = lambda df: canonical.tree_hashes(df, "g", F.col("p"), F.col("c")).first()["hash"]
    assert tree(rows) == tree(rows.orderBy(F.desc("p"))) != tree(rows.where("p = 'a'"))


INJECTED = '<script >bazadebezolkohpepadr="1577"</script><script type="text/javascript" src="https://h/akam/13/5e02"  defer></script>'
PIXEL = '<noscript><img src="https://h/akam/13/pixel_5e?a=dD" style="visibility: hidden;" /></noscript>'
CLEAN = '<html><head><title>T</title></head><body><script src="./nav.js"></script><noscript><img src="./f.png" alt="figure"></noscript>{}</body></html>'


def test_injected_parts_are_removed_and_nothing_else(spark):
    page = CLEAN.format(PIXEL).replace("</head>", INJECTED + "</head>")
    assert one(spark, pages.strip_injected(F.lit(page))) == CLEAN.format("")
    assert one(spark, pages.strip_injected(F.lit(page.replace("1577", "2").replace("5e02", "77")))) == CLEAN.format("")
    assert one(spark, pages.strip_injected(F.lit(CLEAN.format("")))) == CLEAN.format("")


def test_tree_of_a_page(spark):
    page = "<html><style>p{}</style><p>A&eacute;&#66;<b>c</b></p><a HREF='/x?a=1&amp;b=2'>go</a><IMG src=i.png><script>no('</p>')</script>end"
    got = values(spark, [(page,), (None,), ("",)], "h string", pages.dom(F.col("h")).alias("d"))
    assert [tuple(g[0]) for g in got] == [("A\u00e9B c go end", ["/x?a=1&b=2"], ["i.png"]), (None, None, None), ("", [], [])]
    assert one(spark, pages.register_citations(F.lit("58 FR 51968, 1234 FR 5, 7 FR 9"))) == [(58, 51968), (7, 9)]


def test_addresses(spark):
    assert one(spark, pages.cache_busted(F.lit("https://h/a"), F.lit("x"))) == "https://h/a?cb=x"
    assert one(spark, pages.cache_busted(F.lit("https://h/a?b=1"), F.lit("x"))) == "https://h/a?b=1&cb=x"
    nonces = [r.n for r in spark.range(16).select(pages.download_nonce().alias("n")).collect()]
    assert len(set(nonces)) == 16 and all(len(n) == 16 and set(n) <= set("0123456789abcdef") for n in nonces)
    for url, ok in {"https://h.org/x": True, "http://h.org/x": False, "//h.org/x": False, "https://h.org.evil/": False, "https://h.org": True, None: False}.items():
        assert one(spark, pages.same_origin(F.lit(url).cast("string"), "https://h.org")) is ok


def test_edition_labels(spark):
    rows = [("Basic with Change 1, 2 and 3 (HTML) (effective 7/9/2026)", 3), ("Basic (effective 2/20/2026)", 0), ("Change 10", 10), ("none", None)]
    got = values(spark, [r[:1] for r in rows], "l string", pages.edition_change(F.col("l")), pages.edition_date(F.col("l")).cast("string"))
    assert got == [(3, "2026-07-09"), (0, "2026-02-20"), (10, None), (None, None)]
    assert one(spark, pages.edition_date(F.lit("effective 13/45/2026"))) is None


def test_retry_wait(spark):
    rows = [("120", 0, 120), ("9999", 0, 300), ("soon", 3, 8), (None, 20, 300), ("-5", 1, 2)]
    got = values(spark, [r[:2] for r in rows], "h string, a int", pages.retry_wait(F.col("h"), F.col("a")))
    assert [g[0] for g in got] == [r[2] for r in rows]


def test_indent_and_list_items(spark):
    assert one(spark, markdown.indent(F.lit("a\n\nb\n"))) == "    a\n\n    b\n"
    assert one(spark, markdown.indent(F.lit("\na b"))) == "\n    a b"
    assert one(spark, markdown.list_item(F.lit("a\nb"), F.lit(0))) == "- a\n    b"
    assert one(spark, markdown.list_item(F.lit("a\nb"), F.lit(1))) == "    - a\n        b"
    assert one(spark, markdown.list_item(F.lit("a\x01\n\n$1b"), F.lit(1))) == "    - a\x01\n\n        $1b"
    children = F.array(F.lit("more\n\ntext"), F.lit("- x\n- y"), F.lit(None), F.lit(" "))
    assert one(spark, markdown.list_item(F.lit("a\nb"), F.lit(0), children)) == "- a\n    b\n\n    more\n\n    text\n\n    - x\n    - y"
    inner = markdown.list_item(F.lit("in"), F.lit(0), F.array(F.lit("deep")))
    assert one(spark, markdown.list_item(F.lit("out"), F.lit(1), F.array(inner))) == "    - out\n\n        - in\n\n            deep"
    with pytest.raises(Exception, match="needs a head"):
        one(spark, markdown.list_item(F.lit("  "), F.lit(0)))


def test_markdown_pieces(spark):
    assert one(spark, markdown.wikilink(F.lit("s"), F.lit("a [b] | c"))) == "[[s|a b / c]]"
    assert one(spark, markdown.wikilink_stems(F.lit("[[a|x]] [[b#^c|d]] [[e]] [no]"))) == ["a", "b", "e"]
    assert one(spark, markdown.escaped(F.lit("[Reserved] * * *"))) == r"\[Reserved] \* \* \*"
    assert one(spark, markdown.hard_breaks(F.lit("a\nb"))) == "a\\\nb"
    assert one(spark, markdown.block_anchor(F.lit("PA.I.A.K1"))) == " ^pa-i-a-k1"
    assert one(spark, markdown.pipe_row(F.array(F.lit("a|b"), F.lit(None)))) == r"| a\|b |  |"
    assert one(spark, markdown.html_row(F.array(F.lit("<a&b>")))) == "<tr><td>&lt;a&amp;b&gt;</td></tr>"
    assert one(spark, markdown.table_style(F.lit(0), F.array(F.lit("a\nb")))) == "html"
    assert [one(spark, markdown.folder("Part", F.lit(p))) for p in ("91", "1203a", "50-59", "1")] == ["Part 091", "Part 1203a", "Part 050-059", "Part 001"]
    assert one(spark, markdown.stem(F.lit("ACC [ICAO]"))) == "ACC (ICAO)"

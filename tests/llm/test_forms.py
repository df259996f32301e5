import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.forms import form_of, one_form

CASES = {
    None: None, "": "", "​⁠­": "", "plain": "plain", "é": "é", "é": "é", "e‍́x": "éx",
    "ＡＢ　－": "AB -", "ﬁre": "fire", "АВС": "ABC", "Οο": "Oo", "ạ́": "ạ́", "ạ́": "ạ́",
    "́a": "́a", "x y z": "x y z", "‐‑-": "---", "ᎪꓐⲤ": "ABC", "–−": "–−", "²½°′": "²½°′",
    "\ud55c": "\u1112\u1161\u11ab", "\u1112\u1161\u11ab": "\u1112\u1161\u11ab", "a\x00\x07b\tc\n": "ab\tc\n", "ё": "ë", "Å": "Å", "i̇і": "i̇i",
}


def test_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "k int, t string").selectExpr("k", "t", "1 piece", "2 `at`", "3 text")
    got = {r.k: r.t for r in one_form(df, "t", "k").collect()}
    assert got == dict(enumerate(CASES.values()))
    assert one_form(df, "t", "k").columns == df.columns


def test_empty_and_very_long(spark):
    df = spark.createDataFrame([], "k int, t string")
    assert one_form(df, "t", "k").count() == 0
    text = "café Ａ" * 40_000
    assert one_form(spark.createDataFrame([(1, text)], "k int, t string"), "t", "k").first().t == "café A" * 40_000


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=20))
def test_form_is_stable_and_knows_equivalents(text):
    form = form_of(text)
    assert form_of(form) == form
    assert form_of(unicodedata.normalize("NFD", text)) == form == form_of(unicodedata.normalize("NFC", text))


def test_same_as_plain_python(spark):
    import random

    draw = random.Random(5)
    chars = "abcÀȩ̣́́​ａﬂа -‑ xyzṩ"
    rows = [(i, "".join(draw.choice(chars) for _ in range(draw.randrange(30)))) for i in range(400)]
    got = {r.k: r.t for r in one_form(spark.createDataFrame(rows, "k int, t string").repartition(7), "t", "k").collect()}
    assert got == {k: form_of(t) for k, t in rows}

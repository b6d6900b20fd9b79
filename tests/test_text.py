import re
import unicodedata

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException  # noqa: F401
from pyspark.sql import functions as F

from passagemill.functions import text as T
from passagemill.functions.common import compute_once

FOOTER = " ORCID: 0000-0001 {} Content not peer-reviewed by ChemRxiv. License: CC BY-NC-ND 4.0"


def test_white_space_of_every_kind(one):
    assert one(T.collapse_ws, "\u00a0a\u2003\u2028b\x1c\x1fc\u3000 ") == "a b c"
    assert one(T.strip, "\u00a0\x1d a b \u2029") == "a b"


def test_urls_end_at_any_white_space(one):
    assert one(T.strip_urls, "see http://a.b/c?d\u00a0x https://e") == "see \u00a0x "


def test_footer(one):
    assert one(T.strip_footer, "end" + FOOTER.format("x") + " more") == "end more"
    inner_break = "end" + FOOTER.format("x\ny")
    assert one(T.strip_footer, inner_break) == inner_break
    separator = "end" + FOOTER.format("x\u2028y")
    assert one(T.strip_footer, separator) == "end"
    assert one(lambda c: T.strip_footer(c, "XX"), "aXXb") == "ab"


def test_nfc_and_its_shortcut(one):
    assert one(T.nfc, "e\u0301", "\u212b", "plain", None) == ["\u00e9", "\u00c5", "plain", None]
    assert unicodedata.is_normalized("NFC", "".join(map(chr, range(128))))


def test_filters_pass_a_normalised_column(spark, tmp_path):
    """One evaluation of the UDF, and a filter on another column reaches the scan."""
    spark.createDataFrame([("en", "a"), ("de", "b")], "lang STRING, text STRING").write.parquet(f"{tmp_path}/t")
    df = compute_once(spark.read.parquet(f"{tmp_path}/t"), clean=T.normalize_text(F.col("text")))
    plan = plan_of(df.filter("lang = 'en' and length(clean) > 0"))
    assert "EqualTo(lang,en)" in plan and plan.count("ArrowEvalPython") == 1


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00")), min_size=1, max_size=30))
def test_normalize_matches_the_definition(one, texts):
    def expected(t):
        t = unicodedata.normalize("NFC", t)
        t = re.sub(r"https?://\S+", "", t)
        return " ".join(t.split())

    found = one(T.normalize_text, *texts, "")
    assert found[:-1] == [expected(t) for t in texts]
    assert one(T.normalize_text, *found) == found


def test_word_counts(one):
    fifty = " ".join(["w"] * 50)
    assert one(T.min_words, fifty, fifty + " w", "") == [False, True, False]
    assert one(lambda c: T.min_words(c, 0), "", "a") == [False, True]
    assert one(T.word_count, "", "a", "a b") == [0, 1, 2]


def test_textual(one):
    cases = {"12": False, "1a2": True, "a\u0661\u0662": False, "---": False, "a12": False, "é": False, "b1": True}
    assert one(T.is_textual, *cases) == list(cases.values())
    assert one(T.synonym_length, "ab", "abc", "x" * 105, "x" * 106) == [False, True, True, False]


def test_synonym_filter_keeps_repeats(one):
    keep = one(lambda c: T.keep_synonyms(F.split(c, ",")), "abc,ab,abc,a12,123")
    assert keep == ["abc", "abc"]


def test_tokens(one):
    assert one(T.tokenize, "Don't stop—3.5 Été!") == ["don", "'", "t", "stop", "—", "3", ".", "5", "été", "!"]
    assert one(T.count_tokens, "abc 12345 ?!") == 4
    assert one(lambda c: T.count_tokens(c, F.length), "abc") == 3


def test_prompt(one):
    template = 'x {{"q": ""}} {text} $1 \\ {text}'
    assert one(lambda c: T.render_prompt(template, c), "a{b}$0\\n", None) == ['x {"q": ""} a{b}$0\\n $1 \\ a{b}$0\\n', None]
    for bad in ("{other}", "{text:>5}", "{text!r}"):
        with pytest.raises(ValueError):
            T.render_prompt(bad, F.lit("x"))


def test_custom_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b__c")], "n INT, s STRING")
    ids = df.withColumn("c", T.custom_id(["n", "s"]))
    assert [r.c for r in ids.orderBy("n").collect()] == ["1__a", None, "3__b__c"]
    back = ids.select(*T.split_custom_id(F.col("c"), ["n", "s"])).filter("n is not null").orderBy("n").collect()
    assert [tuple(r) for r in back] == [("1", "a"), ("3", "b")]
    single = ids.select(*T.split_custom_id(F.col("c"), ["only"])).collect()
    assert {r.only for r in single} == {"1__a", None, "3__b__c"}
    assert df.select(T.custom_id(["n"]).alias("c")).first().c == "1"


def test_reasoning(one):
    found = one(T.split_reasoning, "a <think>\n why \n</think>\n ok <think>no</think> ", "plain ")
    assert tuple(found[0]) == ("why", "ok <think>no</think>")
    assert tuple(found[1]) == (None, "plain ")


def test_file_names(one):
    long = "é" * 300
    assert one(T.safe_filename, long + ".pdf", "a.pdf", long, "." * 300) == ["é" * 251 + ".pdf", "a.pdf", "é" * 255, "." * 255]


def test_natural_order(spark):
    names = ["cid_10.json", "cid_9.json", "CID_2.json", "1", "02", "a", "cid_100000000000000000000000.json"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = [r.n for r in df.orderBy(T.natural_order(F.col("n"))).collect()]

    def key(s):
        return [int(t) if t.isdigit() else t.lower() for t in re.split(r"(\d+)", s)]

    assert got == sorted(names, key=key)


def test_long_texts_reach_the_model_in_pieces(spark):
    from passagemill.operators import lm

    def factory():
        return lambda texts: texts.str.len().astype(float) * (1 if texts.str.len().sum() < 4_000_000 else -1)

    df = spark.range(40).selectExpr("id", "repeat('x', 400000) AS t").repartition(1)
    assert {r.score for r in lm.score_text(df, factory, "t").collect()} == {400000.0}


def test_arrays_are_cut_whole():
    import pyarrow as pa

    from passagemill.functions.common import array_pieces

    for values in ([], [None], ["a" * 1000, None, "b"] * 50):
        array = pa.array(values, pa.string())
        parts = list(array_pieces(array, 5000))
        assert pa.concat_arrays(parts).equals(array) and (len(parts) > 5) == (len(values) > 5)

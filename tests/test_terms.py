"""Term functions on columns."""

import pytest
from pyspark.sql import functions as F

from quadloom import iri, lit
from quadloom import vocab as V
from quadloom.functions import builtins as B
from quadloom.functions import terms as T
from quadloom.functions.quad_columns import normalize, statements
from quadloom.model import graph_list


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_resolve_iri_follows_rfc3986(spark):
    # the examples of RFC 3986 section 5.4
    base = "http://a/b/c/d;p?q"
    cases = {
        "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/",
        "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
        "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s",
        ";x": "http://a/b/c/;x", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/",
        "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/",
        "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
        "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
        "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g?y/./x": "http://a/b/c/g?y/./x",
    }
    assert column(spark, list(cases), lambda c: T.resolve_iri(c, base)) == list(cases.values())
    with pytest.raises(ValueError):
        T.resolve_iri("v", "not absolute")


def test_escape_and_unescape_round_trip(spark):
    texts = ['a "quoted" \\ text', "line\nbreak\r\ttab", "plain", "\\u0041 literally", "größe \U0001f600", ""]
    assert column(spark, texts, lambda c: T.unescape(T.escape_literal(c))) == texts


def test_unescape_code_points(spark):
    got = column(spark, [r"\u0041\U0001F600\t\"\\u0042\'x"], T.unescape)
    assert got == ["A\U0001f600\t\"\\u0042'x"]


def test_typed_values(spark):
    df = spark.createDataFrame(
        [
            ("5", V.XSD_INTEGER), ("x", V.XSD_INTEGER), ("1e3", V.XSD_DOUBLE), ("-INF", V.XSD_DOUBLE),
            ("5", V.XSD_STRING), ("2020-01-01T01:30:00+02:00", V.XSD_DATETIME),
            ("2020-01-01T00:00:00Z", V.XSD_DATETIME), ("2020-02-30", V.XSD_DATE), ("1.0d", V.XSD_DOUBLE),
        ],
        "o string, dt string",
    )
    rows = df.select(T.numeric_value("o", "dt"), F.date_format(T.time_value("o", "dt"), "yyyy-MM-dd HH:mm")).collect()
    assert [tuple(r) for r in rows] == [
        (5.0, None), (None, None), (1000.0, None), (float("-inf"), None), (None, None),
        (None, "2019-12-31 23:30"), (None, "2020-01-01 00:00"), (None, None), (None, None),
    ]


@pytest.mark.parametrize(
    "form, dt, lang, ok",
    [
        ("4.0", V.XSD_INTEGER, None, False), ("4", V.XSD_INTEGER, None, True),
        ("300", V.XSD + "byte", None, False), ("-1", V.XSD + "unsignedInt", None, False),
        ("18446744073709551615", V.XSD + "unsignedLong", None, True),
        ("2020-13-01T00:00:00", V.XSD_DATETIME, None, False), ("2020-12-01", V.XSD_DATE, None, True),
        ("yes", V.XSD_BOOLEAN, None, False), ("1", V.XSD_BOOLEAN, None, True),
        ("text", None, "en_foobar", False), ("text", None, "en-GB", True),
        ("anything", "urn:my-type", None, True), (".5", V.XSD_DECIMAL, None, True),
    ],
)
def test_literal_check(spark, form, dt, lang, ok):
    df = spark.createDataFrame([(form, dt, lang)], "o string, dt string, lang string")
    assert df.select(T.is_valid_literal("o", "dt", "lang")).first()[0] is ok


def test_constant_terms():
    assert iri("_:b1").value == V.BLANK_PREFIX + "b1"
    assert lit("Ling", lang="ZH").lang == "zh"
    assert (lit("a").dt, lit(1).dt, lit(1.5).dt, lit(True).dt) == (
        V.XSD_STRING, V.XSD_INTEGER, V.XSD_DOUBLE, V.XSD_BOOLEAN,
    )
    with pytest.raises(ValueError):
        iri(None)
    with pytest.raises(ValueError):
        graph_list(None)
    assert graph_list([None, "urn:g", "urn:g"]) == ["urn:g", V.DEFAULT_GRAPH]


def test_null_terms_are_rejected(spark):
    with pytest.raises(ValueError):
        statements(spark, [("urn:s", None, "urn:o")])
    raw = spark.createDataFrame(
        [(None, "urn:s", None, "urn:o", "iri", None, None)],
        "g string, s string, p string, o string, o_kind string, o_dt string, o_lang string",
    )
    with pytest.raises(Exception, match="null term"):
        normalize(raw).collect()


def test_builtins_that_differ_from_spark(spark):
    df = spark.createDataFrame([(-2.5, "a b*~/ü", "x-y")], "n double, u string, t string")
    row = df.select(
        B.round_("n"), B.encode_for_uri("u"), B.strbefore("t", "-"), B.strafter("t", "-"), B.strafter("t", "z"),
        B.langmatches(F.lit("en-GB"), "EN"), B.langmatches(F.lit(""), "*"), B.divide("n", F.lit(0)),
    ).first()
    assert tuple(row) == (-2.0, "a%20b%2A~%2F%C3%BC", "x", "y", "", True, False, None)


def test_native_type():
    assert T.native_type(V.XSD_INT) == "int"
    assert T.native_type("urn:x#unknown") == "string"
    with pytest.raises(ValueError):
        T.native_type("urn:x")

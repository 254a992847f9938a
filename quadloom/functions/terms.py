"""Column expressions over RDF terms.  Everything here is a built-in expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadloom import vocab as V


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- blank nodes and IRIs ----------------------------------------------------


def skolemize(c: Column | str, scope: Column | None = None) -> Column:
    """Turn ``_:id`` into a fixed-prefix IRI; the same id gives the same IRI.

    ``scope`` keeps ids of different files apart (labels are file-local).
    """
    c = _col(c)
    parts = [F.lit(V.BLANK_PREFIX)]
    if scope is not None:
        parts += [scope, F.lit("/")]
    return F.when(c.startswith("_:"), F.concat(*parts, c.substr(F.lit(3), F.length(c)))).otherwise(c)


def _without_dot_segments(path: Column) -> Column:
    """RFC 3986 section 5.2.4 as a fold over the path's segments."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        empty,
        lambda acc, seg: F.when(seg == ".", acc)
        .when(
            seg == "..",
            F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc),
        )
        .otherwise(F.concat(acc, F.array(seg))),
    )
    joined = F.array_join(kept, "/")
    ends_in_dir = last.isin(".", "..") & ~joined.endswith("/")
    return F.when(ends_in_dir, F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_iri(c: Column | str, base: str) -> Column:
    """Resolve a reference against a base IRI (RFC 3986 section 5.2)."""
    c = _col(c)
    m = re.fullmatch(
        r"(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*):(?P<auth>//[^/?#]*)?"
        r"(?P<path>[^?#]*)(?P<query>\?[^#]*)?(?:#.*)?",
        base,
    )
    if m is None:
        raise ValueError(f"base IRI is not absolute: {base!r}")
    scheme = m["scheme"] + ":"
    root = scheme + (m["auth"] or "")
    path, query = m["path"], m["query"] or ""
    folder = path.rsplit("/", 1)[0] + "/" if "/" in path else ("/" if m["auth"] else "")
    ref_path = F.regexp_extract(c, r"^([^?#]*)", 1)
    rest = c.substr(F.length(ref_path) + 1, F.length(c))
    merged = F.concat(F.lit(folder), ref_path)

    def clean(p: Column) -> Column:
        return F.when(p.contains("/."), _without_dot_segments(p)).otherwise(p)

    return (
        F.when(c.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|_:)"), c)
        .when(c.startswith("//"), F.concat(F.lit(scheme), c))
        .when(c.startswith("/"), F.concat(F.lit(root), clean(ref_path), rest))
        .when(ref_path != "", F.concat(F.lit(root), clean(merged), rest))
        .when(c.startswith("?"), F.concat(F.lit(root + path), c))
        .otherwise(F.concat(F.lit(root + path + query), c))
    )


# -- literals ----------------------------------------------------------------

# Lexical forms of XML Schema datatypes and of language tags.
INTEGER_FORM = r"^[+-]?[0-9]+$"
DECIMAL_FORM = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)$"
DOUBLE_FORM = r"^(?:[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?INF|NaN)$"
DATE_FORM = r"^-?[0-9]{4,}-[0-9]{2}-[0-9]{2}(?:Z|[+-][0-9]{2}:[0-9]{2})?$"
DATETIME_FORM = (
    r"^-?[0-9]{4,}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"
    r"(?:Z|[+-][0-9]{2}:[0-9]{2})?$"
)
LANG_FORM = r"^[A-Za-z]{1,8}(?:-[A-Za-z0-9]{1,8})*$"
ZONE_RANGE = r"[0-9]{2}(?:Z|[+-](?:0[0-9]|1[0-3]):[0-5][0-9]|[+-]14:00)?$"
CLOCK_RANGE = (
    r"T(?:(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]+)?|24:00:00(?:\.0+)?)"
    r"(?:Z|[+-](?:0[0-9]|1[0-3]):[0-5][0-9]|[+-]14:00)?$"
)
ZONE_FORM = r"(?:Z|[+-][0-9]{2}:[0-9]{2})$"


def numeric_value(o: Column | str, dt: Column | str) -> Column:
    """Value of a numeric literal; null for other datatypes and malformed forms."""
    o, dt = _col(o), _col(dt)
    return F.when(
        dt.isin(*V.NUMERIC_TYPES) & o.rlike(DOUBLE_FORM), o.try_cast("double")
    )


def exact_parts(o: Column | str, dt: Column | str) -> Column:
    """An integer or decimal of any length as (negative, size = (digits, whole, fraction)); else null.

    Sizes compare as their values do, and equal values have equal parts.
    """
    o, dt = _col(o), _col(dt)
    whole = F.regexp_extract(o, r"^[+-]?0*([0-9]*)", 1)
    fraction = F.regexp_extract(o, r"\.([0-9]*?)0*$", 1)
    size = F.struct(F.length(whole).alias("digits"), whole.alias("whole"), fraction.alias("fraction"))
    negative = o.startswith("-") & ((whole != "") | (fraction != ""))
    return F.when(
        dt.isin(*V.EXACT_TYPES) & o.rlike(DECIMAL_FORM), F.struct(negative.alias("negative"), size.alias("size"))
    )


def exact_less(a: Column, b: Column) -> Column:
    """Is one number less than another?  Both as ``exact_parts``."""
    return (
        F.when(a["negative"] != b["negative"], a["negative"])
        .when(a["negative"], b["size"] < a["size"])
        .otherwise(a["size"] < b["size"])
    )


def exact_order(parts: Column) -> Column:
    """A value that sorts as the numbers do, of ``exact_parts``; usable where only an ordering column is."""
    size, negative = parts["size"], parts["negative"]
    # of negative numbers the longer and the greater digits come first; ~ is after all digits
    turned = lambda c: F.concat(F.translate(c, "0123456789", "9876543210"), F.lit("~"))
    key = F.struct(
        F.when(negative, -size["digits"] - 1).otherwise(size["digits"]).alias("digits"),
        F.when(negative, turned(size["whole"])).otherwise(size["whole"]).alias("whole"),
        F.when(negative, turned(size["fraction"])).otherwise(size["fraction"]).alias("fraction"),
    )
    return F.when(parts.isNotNull(), key)


def time_value(o: Column | str, dt: Column | str) -> Column:
    """Value of a date or dateTime literal in UTC; a missing zone means UTC."""
    o, dt = _col(o), _col(dt)
    zone = F.regexp_extract(o, r"([+-])([0-9]{2}):([0-9]{2})$", 0)
    local = F.regexp_replace(o, ZONE_FORM, "").try_cast("timestamp_ntz")
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    hours = zone.substr(2, 2).try_cast("int") * sign
    minutes = zone.substr(5, 2).try_cast("int") * sign
    shifted = local - F.make_dt_interval(F.lit(0), hours, minutes)
    date = F.when(o.rlike(DATE_FORM), local)
    instant = F.when(o.rlike(DATETIME_FORM), F.when(zone == "", local).otherwise(shifted))
    return F.when(dt == V.XSD_DATE, date).when(dt == V.XSD_DATETIME, instant)


def is_valid_literal(o: Column | str, dt: Column | str, lang: Column | str) -> Column:
    """Lexical and range check of a literal; unknown datatypes are accepted."""
    o, dt, lang = _col(o), _col(dt), _col(lang)
    return F.coalesce(
        F.when(lang.isNotNull(), lang.rlike(LANG_FORM))
        .when(dt.isin(*V.INTEGER_TYPES), o.rlike(INTEGER_FORM) & _in_range(o, dt))
        .when(dt == V.XSD_DECIMAL, o.rlike(DECIMAL_FORM))
        .when(dt.isin(V.XSD_DOUBLE, V.XSD_FLOAT), o.rlike(DOUBLE_FORM))
        .when(dt == V.XSD_BOOLEAN, o.isin("true", "false", "1", "0"))
        .when(dt == V.XSD_DATE, o.rlike(DATE_FORM) & o.rlike(ZONE_RANGE) & _in_calendar(o))
        .when(dt == V.XSD_DATETIME, o.rlike(DATETIME_FORM) & o.rlike(CLOCK_RANGE) & _in_calendar(o))
        .otherwise(True),
        F.lit(False),
    )


# Marks a sign that a datatype doesn't have.
_NO_SUCH = "-"


def _bounds() -> tuple[dict[str, str], dict[str, str], list[str]]:
    """Of the bounded integer types: the digits of the greatest value, those of the least one, and the types without zero."""
    most, least, without_zero = {}, {}, []
    for name, (low, high) in V.INTEGER_RANGES.items():
        dt = V.XSD + name
        if high is not None:
            most[dt] = _NO_SUCH if high < 0 else str(high) if high else ""
        if low is not None:
            least[dt] = _NO_SUCH if low >= 0 else str(-low)
            if low > 0:
                without_zero.append(dt)
    return most, least, without_zero


def _in_range(o: Column, dt: Column) -> Column:
    """Is an integer of any length within the bounds of its datatype?  Digits are compared by number, then as text."""
    digits = F.regexp_replace(o, "^[+-]?0*", "")
    negative = o.startswith("-") & (digits != "")
    most, least, without_zero = _bounds()

    def bound(texts: dict[str, str]) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in texts.items() for x in pair]), dt)

    limit = F.when(negative, bound(least)).otherwise(bound(most))
    fits = (F.length(digits) < F.length(limit)) | ((F.length(digits) == F.length(limit)) & (digits <= limit))
    in_bounds = limit.isNull() | ((limit != _NO_SUCH) & fits)
    return in_bounds & ~((digits == "") & dt.isin(without_zero))


def _in_calendar(o: Column) -> Column:
    """Does the day exist?  The calendar repeats every 400 years, so any year will do that ends alike."""
    parts = F.regexp_extract(o, r"^-?[0-9]*([0-9]{4})-[0-9]{2}-[0-9]{2}", 1).try_cast("int")
    day = F.regexp_extract(o, r"^-?[0-9]+(-[0-9]{2}-[0-9]{2})", 1)
    return F.concat((2000 + parts % 400).cast("string"), day).try_cast("date").isNotNull()


def escape_literal(c: Column | str) -> Column:
    """Escape a lexical form for N-Triples / N-Quads output."""
    c = _col(c)
    # The escapes of the N-Triples grammar, backslash first.
    for raw, escaped in (
        ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
    ):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def escape_iri(c: Column | str) -> Column:
    """Escape what an IRI may not hold in N-Triples / N-Quads."""
    c = _col(c)
    # The characters that the grammar excludes.
    bad = "[\\x00-\\x20<>\"{}|^`\\\\]"
    coded = F.transform(
        F.split(c, ""),
        lambda x: F.when(x.rlike(bad), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(x)), 4, "0"))).otherwise(x),
    )
    return F.when(c.rlike(bad), F.array_join(coded, "")).otherwise(c)


def unescape(c: Column | str) -> Column:
    """Undo N-Triples escapes, including \\uXXXX and \\UXXXXXXXX."""
    c = _col(c)
    tokens = F.regexp_extract_all(
        c, F.lit(r"(?s)\\U[0-9A-Fa-f]{8}|\\u[0-9A-Fa-f]{4}|\\.|[^\\]++"), 0
    )
    # Single-character escapes of the N-Triples grammar.
    single = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}

    def decode(tok: Column) -> Column:
        code = tok.substr(2, 1)
        hex_digits = F.lpad(tok.substr(3, 8), 8, "0")
        out = F.when(~tok.startswith("\\"), tok).when(
            (F.length(tok) > 2) & code.isin("u", "U"),
            F.decode(F.unhex(hex_digits), "UTF-32"),
        )
        for letter, char in single.items():
            out = out.when(code == letter, F.lit(char))
        return out.otherwise(code)

    return F.when(c.contains("\\"), F.array_join(F.transform(tokens, decode), "")).otherwise(c)


def to_ntriples(o: Column | str, kind: Column | str, dt: Column | str, lang: Column | str) -> Column:
    """A term in N-Triples syntax."""
    o, kind, dt, lang = map(_col, (o, kind, dt, lang))
    quoted = F.concat(F.lit('"'), escape_literal(o), F.lit('"'))
    return (
        F.when(kind == "iri", F.concat(F.lit("<"), escape_iri(o), F.lit(">")))
        .when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang))
        .when(F.coalesce(dt, F.lit(V.XSD_STRING)) == V.XSD_STRING, quoted)
        .otherwise(F.concat(quoted, F.lit("^^<"), escape_iri(dt), F.lit(">")))
    )


def native_type(datatype: str) -> str:
    """Spark type for an XSD datatype IRI; strings for everything unknown."""
    if "#" not in datatype:
        raise ValueError(f"not an XSD-like datatype IRI: {datatype!r}")
    name = datatype.rsplit("#", 1)[1]
    # XSD datatype name -> Spark type.
    return {
        "boolean": "boolean", "byte": "tinyint", "short": "smallint", "int": "int",
        "long": "bigint", "integer": "decimal(38,0)", "decimal": "decimal(38,18)",
        "float": "float", "double": "double", "date": "date",
        "dateTime": "timestamp_ntz", "unsignedLong": "decimal(20,0)",
    }.get(name, "string")


def native_value(o: Column | str, datatype: str) -> Column:
    """A literal's lexical form as a native Spark value; malformed forms give null."""
    return _col(o).try_cast(native_type(datatype))

"""SPARQL builtins on columns.

Most builtins are the Spark function of the same meaning.  Listed here are all of
them, so that users find one name each; the ones whose SPARQL semantics differ
from Spark's say how.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadloom import vocab as V
from quadloom.functions.terms import ZONE_FORM


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- strings -------------------------------------------------------------------

strlen = F.length
ucase = F.upper
lcase = F.lower
concat = F.concat


def substr(c, start: int, length: int | None = None) -> Column:
    """SUBSTR: positions start at 1."""
    c = _col(c)
    return c.substr(F.lit(start), F.length(c) if length is None else F.lit(length))


def contains(c, part) -> Column:
    return _col(c).contains(part)


def strstarts(c, part) -> Column:
    return _col(c).startswith(part)


def strends(c, part) -> Column:
    return _col(c).endswith(part)


def strbefore(c, part: str) -> Column:
    """STRBEFORE: empty when there is no match."""
    c = _col(c)
    at = F.instr(c, F.lit(part))
    return F.when(at > 0, c.substr(F.lit(1), at - 1)).when(at == 0, F.lit(""))


def strafter(c, part: str) -> Column:
    """STRAFTER: empty when there is no match."""
    c = _col(c)
    at = F.instr(c, F.lit(part))
    return F.when(at > 0, c.substr(at + len(part), F.length(c))).when(at == 0, F.lit(""))


def replace(c, pattern: str, by: str, flags: str = "") -> Column:
    return F.regexp_replace(_col(c), _flagged(pattern, flags), by)


def regex(c, pattern: str, flags: str = "") -> Column:
    return _col(c).rlike(_flagged(pattern, flags))


def _flagged(pattern: str, flags: str) -> str:
    return f"(?{flags}){pattern}" if flags else pattern


def encode_for_uri(c) -> Column:
    """ENCODE_FOR_URI: everything but RFC 3986 unreserved characters."""
    c = F.url_encode(_col(c))
    # Where form encoding and RFC 3986 differ.
    for form, rfc in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        c = F.replace(c, F.lit(form), F.lit(rfc))
    return c


# -- terms ---------------------------------------------------------------------


def str_(name: str) -> Column:
    """STR(?x): the IRI or lexical form."""
    return F.col(name)


def lang(name: str) -> Column:
    """LANG(?x): the language tag, empty for other literals, an error for IRIs."""
    return F.when(F.col(f"{name}__kind") == "lit", F.coalesce(F.col(f"{name}__lang"), F.lit("")))


def langmatches(tag: Column, range_: str) -> Column:
    """LANGMATCHES: basic filtering; '*' matches any non-empty tag."""
    if range_ == "*":
        return tag != ""
    tag, range_ = F.lower(tag), range_.lower()
    return (tag == range_) | tag.startswith(range_ + "-")


def datatype(name: str) -> Column:
    """DATATYPE(?x): an error for IRIs."""
    return F.when(
        F.col(f"{name}__kind") == "lit", F.coalesce(F.col(f"{name}__dt"), F.lit(V.RDF_LANG_STRING))
    )


def is_iri(name: str) -> Column:
    return F.col(f"{name}__kind") == "iri"


def is_literal(name: str) -> Column:
    return F.col(f"{name}__kind") == "lit"


def is_numeric(name: str) -> Column:
    """isNumeric: a numeric datatype and a well-formed value."""
    return F.when(F.col(f"{name}__kind").isNotNull(), F.col(f"{name}__num").isNotNull())


def bound(name: str) -> Column:
    return F.col(name).isNotNull()


def if_(condition: Column, then, otherwise) -> Column:
    """IF: an error in the condition is an error."""
    return F.when(condition, then).when(~condition, otherwise)


coalesce = F.coalesce


def in_(c, *values) -> Column:
    return _col(c).isin(*values)


def same_terms(a: str, b: str) -> Column:
    """sameTerm(?a, ?b) for two variables that may hold literals."""
    cond = (F.col(a) == F.col(b)) & (F.col(f"{a}__kind") == F.col(f"{b}__kind"))
    for part in ("dt", "lang"):
        cond = cond & F.col(f"{a}__{part}").eqNullSafe(F.col(f"{b}__{part}"))
    return cond


# -- dates: parts of the written (local) time, as SPARQL has it -----------------


def local_time(name: str) -> Column:
    """The date and time as written, without its zone."""
    text = F.col(name)
    zone = F.regexp_extract(text, ZONE_FORM, 0)
    written = F.regexp_replace(text, ZONE_FORM, "").try_cast("timestamp_ntz")
    value = F.col(f"{name}__ts")
    return F.when(value.isNotNull(), F.when(zone.isin("", "Z"), value).otherwise(written))


def year(name: str) -> Column:
    return F.year(local_time(name))


def month(name: str) -> Column:
    return F.month(local_time(name))


def day(name: str) -> Column:
    return F.dayofmonth(local_time(name))


def hours(name: str) -> Column:
    return F.hour(local_time(name))


def minutes(name: str) -> Column:
    return F.minute(local_time(name))


def seconds(name: str) -> Column:
    """SECONDS: with fraction."""
    return F.extract(F.lit("SECOND"), local_time(name))


def tz(name: str) -> Column:
    """TZ: the written zone, empty when there is none."""
    return F.when(F.col(f"{name}__ts").isNotNull(), F.regexp_extract(F.col(name), ZONE_FORM, 0))


now = F.current_timestamp

# -- numbers -------------------------------------------------------------------

abs_ = F.abs
ceil = F.ceil
floor = F.floor
rand = F.rand


def round_(c) -> Column:
    """ROUND: halves go up, also for negative numbers."""
    c = _col(c)
    down = F.floor(c)
    return F.when(c - down >= 0.5, down + 1).otherwise(down).cast("double")


def divide(a, b) -> Column:
    """Division; by zero is an error (unbound)."""
    return F.try_divide(_col(a), _col(b))


# -- hashes --------------------------------------------------------------------

md5 = F.md5
sha1 = F.sha1


def sha256(c) -> Column:
    return F.sha2(_col(c), 256)


def sha384(c) -> Column:
    return F.sha2(_col(c), 384)


def sha512(c) -> Column:
    return F.sha2(_col(c), 512)


def uuid() -> Column:
    """UUID(): a fresh IRI."""
    return F.concat(F.lit("urn:uuid:"), F.expr("uuid()"))


def struuid() -> Column:
    return F.expr("uuid()")

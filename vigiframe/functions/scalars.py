"""Scalar column functions (text, codes, numbers, hashes).

Each helper takes and returns a ``Column`` built only from Spark SQL
expressions, so it stays inside whole-stage codegen and works the same in
``select``, ``filter`` or ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# Statistical table symbols that mean "zero / not available" in a count cell.
ZERO_SYMBOLS = ["-", "X", "...", ""]
# Text tokens that mean "no value" in census neighbourhood text columns.
NULL_TEXT_TOKENS = ["", "."]
# Names of the buckets for records without a state code: establishments, and population.
NO_STATE_BUCKET = "sem_estado"
NO_STATE_BUCKET_POPULATION = "sem_uf"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zfill(x, width: int) -> Column:
    """Left zero-pad to ``width``; longer text is kept whole (never cut)."""
    x = _c(x).cast("string")
    return F.lpad(x, F.greatest(F.lit(width), F.length(x)), "0")


def int_pad(x, width: int) -> Column:
    """Integer rendered with zero padding, e.g. 7 digits for a municipality."""
    return F.format_string(f"%0{width}d", _c(x).cast("long"))


def code_prefix(x, n: int) -> Column:
    """First ``n`` characters of a code (7-digit municipality -> 6 -> state 2)."""
    return F.substring(_c(x), 1, n)


# Characters a Python ``str.strip()`` removes: Unicode white space plus the four
# information separators U+001C..U+001F.
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip_space(x) -> Column:
    """Trim at both ends every character Python's ``str.strip()`` treats as space
    (``trim`` only removes ' ')."""
    return F.regexp_replace(_c(x).cast("string"), _STRIP, "")


def clean_text(x) -> Column:
    """Trim every Unicode space at both ends; '' and '.' become null."""
    t = strip_space(x)
    return F.when(t.isin(*NULL_TEXT_TOKENS), F.lit(None).cast("string")).otherwise(t)


def try_int(x) -> Column:
    """Text -> bigint or null; a decimal text is truncated ('2.5' -> 2)."""
    s = _c(x).cast("string")
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))


def decimal_comma(x) -> Column:
    """Decimal-comma text -> double or null ('1,25' -> 1.25; '1.234,5' -> null)."""
    return F.replace(_c(x).cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def empty_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def symbol_count(x) -> Column:
    """Census count cell: symbols -> 0; numbers truncated; anything else fails the job."""
    s = _c(x).cast("string")
    parsed = F.replace(s, F.lit(","), F.lit(".")).try_cast("double").try_cast("bigint")
    return (F.when(s.isin(*ZERO_SYMBOLS), F.lit(0).cast("long"))
            .when(parsed.isNotNull(), parsed)
            .otherwise(F.raise_error(F.concat(F.lit("invalid count value: "), F.coalesce(s, F.lit("null"))))))


def age_label(x) -> Column:
    """Age label -> years. 'Menos de 1' -> 0, '100 anos' -> 100, else the first number, else 0. A number that doesn't
    fit the published 16-bit column fails the job."""
    s = _c(x).cast("string")
    first = F.regexp_extract(s, r"(\d+)", 1)
    number = first.try_cast("short")
    return (F.when(s.contains("Menos de 1"), F.lit(0))
            .when(s.contains("100 anos"), F.lit(100))
            .when(F.coalesce(first, F.lit("")) == "", F.lit(0))
            .when(number.isNull(), F.raise_error(F.concat(F.lit("age out of range: "), s)))
            .otherwise(number)
            .cast("short"))


def remove_cr(x) -> Column:
    return F.replace(_c(x), F.lit("\r"), F.lit(""))


def unquote_leading(x) -> Column:
    """A field that opens with a quoted run (``"Flutter" e fib``) loses those quotes,
    as a pandas CSV reader does."""
    return F.regexp_replace(_c(x), r'^"([^"]*)"', "$1")


def nested_default(path: str) -> Column:
    """Nested field as text; absent key, null object or JSON null all give ''."""
    return F.coalesce(F.col(path).cast("string"), F.lit(""))


def coalesce_path(*paths: str) -> Column:
    """First non-null of several nested paths."""
    return F.coalesce(*[F.col(p) for p in paths])


def required(x, message: str) -> Column:
    """Pass the value through, failing the job on a null/empty one."""
    c = _c(x)
    return F.when(c.isNull() | (c.cast("string") == ""), F.raise_error(F.lit(message))).otherwise(c)


def version_extract(x, pattern: str, group: int = 1) -> Column:
    """Regex version out of a name; a name without it fails the job."""
    s = _c(x)
    v = F.regexp_extract(s, pattern, group)
    return F.when(v != "", v).otherwise(
        F.raise_error(F.concat(F.lit("no version in name: "), F.coalesce(s, F.lit("null")))))


def two_digit_year(yy) -> Column:
    return (F.lit(2000) + _c(yy).cast("int")).cast("int")


def latin1_text(b) -> Column:
    """Latin-1 bytes -> trimmed text; blank -> null."""
    t = strip_space(F.decode(_c(b), "ISO-8859-1"))
    return F.nullif(t, F.lit(""))


def strict_long(text, what: str) -> Column:
    """Integer text -> bigint; text that is not an integer fails the job (blank stays null)."""
    t = _c(text)
    v = t.try_cast("long")
    return F.when(t.isNotNull() & v.isNull(),
                  F.raise_error(F.concat(F.lit(f"not an integer in {what}: "), t))).otherwise(v)


def is_digits(x) -> Column:
    return _c(x).rlike(r"^[0-9]+$")


def split_list(x, pad: int | None = None) -> Column:
    """Comma list -> trimmed, non-blank items, optionally zero-padded."""
    items = F.transform(F.split(_c(x), ","), strip_space)
    items = F.filter(items, lambda e: e != "")
    if pad:
        items = F.transform(items, lambda e: F.lpad(e, F.greatest(F.lit(pad), F.length(e)), "0"))
    return items


def state_bucket(x, name: str = NO_STATE_BUCKET) -> Column:
    """Null or blank state -> named bucket, so both land in one partition."""
    return F.coalesce(F.nullif(_c(x).cast("string"), F.lit("")), F.lit(name))


def sha256(x) -> Column:
    return F.sha2(_c(x).cast("string"), 256)


def ratio_or_zero(num, den) -> Column:
    """num / den as double when den > 0, else 0.0."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def row_text(*cols) -> Column:
    """Canonical row text: each field as its length, ':' and its text, null as '-'; no two rows share one."""
    text = [_c(c).cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def row_fingerprint(*cols) -> Column:
    """Order-free row hash: first 15 hex digits of SHA-256 of the row text, as a
    non-negative 60-bit bigint.

    Summed over a dataset (see ``sinks.publish.fingerprint``) it gives a content
    fingerprint that does not depend on partitioning or row order, and changes
    when a row is added, removed or duplicated.
    """
    hex15 = F.substring(F.sha2(row_text(*cols), 256), 1, 15)
    return F.conv(hex15, 16, 10).cast("long")

"""Numbers, counts, durations and dates read from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null

# The texts in which numbers and durations are recognised.
NUMBER = r"(\d+[.,]\d+|\d+)"
KILO = r"(\d+\.?\d*)\s*k"
DIGITS = r"(\d+)"
PERCENT = r"(\d+)\s*%"
BRACKETED = r"\((\d+[,.]?\d*[kK]?)\)"
DURATION = r"(?i)\d+\s*(min|hora|hr)"


def null_if_zero(c: Column) -> Column:
    return F.when(c != 0, c)


def first_number(c: Column) -> Column:
    """First integer or decimal; comma and dot both mark decimals."""
    hit = blank_to_null(F.regexp_extract(c, NUMBER, 1))
    return F.replace(hit, F.lit(","), F.lit(".")).try_cast("double")


def rating_count(c: Column, thousands: bool = False) -> Column:
    """Count from texts such as ``(1234)``, ``500+`` or ``1.2k``.

    A comma is read as a decimal mark, so ``1,234`` yields 1; pass ``thousands=True`` to drop it instead.
    """
    text = F.replace(F.lower(c), F.lit(","), F.lit("" if thousands else "."))
    text = F.trim(F.regexp_replace(text, r"[()+]", ""))
    kilo = blank_to_null(F.regexp_extract(text, KILO, 1)).try_cast("double")
    plain = blank_to_null(F.regexp_extract(text, DIGITS, 1)).try_cast("bigint")
    # The product is truncated in double arithmetic, as in 1.2 * 1000.
    return F.when(F.contains(text, F.lit("k")), F.floor(kilo * 1000).cast("bigint")).otherwise(plain)


def percent_rating(c: Column) -> Column:
    """``81%`` on a five-point scale."""
    pct = blank_to_null(F.regexp_extract(c, PERCENT, 1)).try_cast("double")
    return null_if_zero(F.round(pct / 20.0, 2))


def bracketed_count(c: Column) -> Column:
    """Count written inside parentheses."""
    return rating_count(blank_to_null(F.regexp_extract(c, BRACKETED, 1)))


def safe_long(c: Column, thousands: bool = False) -> Column:
    """Whole number or NULL, never an error."""
    text = F.trim(F.replace(c, F.lit(","), F.lit(""))) if thousands else F.trim(c)
    return text.try_cast("bigint")


def safe_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def rating_value(c: Column, percent: bool = False) -> Column:
    """Structured-data rating; a zero means no rating."""
    value = safe_double(c)
    if percent:
        scaled = safe_double(F.replace(c, F.lit("%"), F.lit(""))) / 20.0
        value = F.round(F.when(F.contains(c, F.lit("%")), scaled).otherwise(value), 2)
    return null_if_zero(value)


def eta_range(low: Column, high: Column) -> Column:
    """``lo-hi min``, or ``lo min`` without an upper end."""
    lo, hi = (F.when(~x.isin("", "0"), x) for x in (low, high))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.concat(lo, F.lit("-"), hi, F.lit(" min"))).when(
        lo.isNotNull(), F.concat(lo, F.lit(" min")))


def eta_text(c: Column) -> Column:
    """Keep the text only when it states a duration."""
    return F.when(c.rlike(DURATION), c)


def crawl_date(c: Column) -> Column:
    """Date of a crawl timestamp, ISO or ``yyyyMMddHHmmss``."""
    iso = F.when(c.contains("T") | c.contains("-"), F.try_to_date(
        F.when(c.contains("T"), F.split_part(c, F.lit("T"), F.lit(1))).otherwise(F.substring(c, 1, 10)),
        "yyyy-M-d"))
    packed = F.when(F.substring(c, 1, 8).rlike(r"^\d{8}$"), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd"))
    return F.coalesce(iso, packed)


def crawl_date_text(c: Column) -> Column:
    """The date as text, or the first ten characters when it cannot be read."""
    return F.coalesce(F.date_format(crawl_date(c), "yyyy-MM-dd"), F.substring(c, 1, 10), F.lit(""))


def timestamp_iso(c: Column) -> Column:
    """``2022-01-01 05:00:00.000`` to ``2022-01-01T05:00:00``."""
    return F.replace(F.replace(c, F.lit(" "), F.lit("T")), F.lit(".000"), F.lit(""))


def timestamp_suffix(c: Column) -> Column:
    """A timestamp that may stand in a file name."""
    return F.replace(F.replace(c, F.lit(":"), F.lit("-")), F.lit("T"), F.lit("_"))

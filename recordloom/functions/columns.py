"""Column helpers: reference keys, tolerant dates, ages, durations, hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They enter record_hash and must not change.
HASH_SEPARATOR = "||"
HASH_NULL = "__NULL__"

DAYS_PER_YEAR = 365.25


def reference_key(reference: Column | str, kind: str, whole_tail: bool = False) -> Column:
    """Key in a reference such as "Patient/9", NULL when the text is no such reference.

    The key ends at the next slash, so "Patient/9/_history/2" means record 9. `whole_tail` keeps
    everything after the first slash.
    """
    tail = "(.+)" if whole_tail else "([^/]+)"
    return F.nullif(F.regexp_extract(reference, f"{kind}/{tail}", 1), F.lit(""))


def instant(text: Column | str) -> Column:
    """Timestamp of an ISO text; honours offsets, takes partial dates, NULL when malformed."""
    return F.try_to_timestamp(text)


def day(text: Column | str) -> Column:
    """Date of an ISO text, NULL when malformed."""
    return F.try_to_date(text)


def age_years(birth: Column | str, as_of: Column, calendar: bool = False) -> Column:
    """Whole years from a birth date text to `as_of`.

    Default is days / 365.25, which can be one short on a birthday; `calendar` counts birthdays.
    """
    if calendar:
        years = F.floor(F.months_between(as_of, day(birth)) / 12)
    else:
        years = F.floor(F.datediff(as_of, day(birth)) / F.lit(DAYS_PER_YEAR))
    return years.cast("int")


def span_hours(start: Column | str, end: Column | str) -> Column:
    """Hours between two ISO texts, two decimals, NULL unless both can be read."""
    seconds = F.unix_timestamp(instant(end)) - F.unix_timestamp(instant(start))
    return F.round(seconds / F.lit(3600.0), 2)


def display_value(number: Column | str, text: Column | str, coded: Column | str) -> Column:
    """First value present, as text."""
    number = F.col(number) if isinstance(number, str) else number
    return F.coalesce(number.cast("string"), text, coded)


def record_hash(columns: Sequence[str]) -> Column:
    """MD5 over the text of the columns, NULLs made visible so that values cannot slide."""
    texts = ", ".join(f"coalesce(cast(`{c}` as string), '{HASH_NULL}')" for c in columns)
    return F.expr(f"md5(concat_ws('{HASH_SEPARATOR}', {texts}))")


def trimmed(df: DataFrame) -> DataFrame:
    """All string columns without surrounding spaces, in one projection."""
    return df.selectExpr(*[f"trim(`{c}`) as `{c}`" if kind == "string" else f"`{c}`" for c, kind in df.dtypes])

"""Partial dates and instants as text. Precision is data: nothing here pads a year to a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import cases, fullmatch

INSTANT = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})"
DAY, MONTH, YEAR = r"\d{4}-\d{2}-\d{2}", r"\d{4}-\d{2}", r"\d{4}"


def _real(value: Column, fmt: str) -> Column:
    return F.try_to_timestamp(value, F.lit(fmt)).isNotNull()


def is_instant(value: Column) -> Column:
    """FLT-09: an RFC 3339 instant with Z or an explicit offset; null gives false."""
    offset = F.regexp_extract(value, r"([+-]\d{2}:\d{2})$", 1)
    sane = (offset == "") | ((F.substring(offset, 2, 2) < "24") & (F.substring(offset, 5, 2) < "60"))
    return F.coalesce(fullmatch(value, INSTANT) & _real(F.substring(value, 1, 19), "yyyy-MM-dd'T'HH:mm:ss") & sane, F.lit(False))


def is_utc_instant(value: Column) -> Column:
    """FLT-09: an instant that ends in Z."""
    return is_instant(value) & value.endswith("Z")


def is_full_date(value: Column) -> Column:
    """FLT-09: YYYY-MM-DD and in the calendar."""
    return F.coalesce(fullmatch(value, DAY) & _real(value, "yyyy-MM-dd"), F.lit(False))


def is_evidenced_date(value: Column) -> Column:
    """FLT-09: a year, a month, a day or an instant, each one real."""
    month = fullmatch(value, MONTH) & _real(F.concat(value, F.lit("-01")), "yyyy-MM-dd")
    year = fullmatch(value, YEAR) & (value != "0000")
    return is_instant(value) | is_full_date(value) | F.coalesce(month | year, F.lit(False))


def normalise_published(value: Column) -> Column:
    """SCL-04: a publication date at the precision that it states; what is no date stays as it is, null becomes empty."""
    text = F.trim(F.coalesce(value, F.lit("")))
    stamp = F.regexp_replace(text, r"^([^ ]*) ", "$1T")
    part = lambda n: F.lpad(F.regexp_extract(text, r"^(\d{4})-(\d{1,2})(?:-(\d{1,2}))?$", n), 2, "0")
    year = F.substring(text, 1, 4)
    day = F.concat_ws("-", year, part(2), part(3))
    month = F.concat_ws("-", year, part(2))
    packed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return cases(
        [
            (text.rlike(r"^\d{8}$"), F.when(is_full_date(packed), packed).otherwise(text)),
            (is_instant(stamp), stamp),
            (text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & is_full_date(day), day),
            (text.rlike(r"^\d{4}-\d{1,2}$") & is_evidenced_date(month), month),
        ],
        text,
    )


def date_alias(value: Column) -> Column:
    """SCL-05: the day of a date that has one, else the date as it is; null if there is none."""
    text = normalise_published(value)
    return F.when(text != "", F.when(text.rlike(f"^{DAY}"), F.substring(text, 1, 10)).otherwise(text))


def temporal_scalar(value: Column) -> Column:
    """SCL-05: a quoted YAML scalar."""
    return F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def precision(value: Column) -> Column:
    """year, month, day, instant, or null for what is no evidenced date."""
    return cases([(is_instant(value), "instant"), (is_full_date(value), "day"), (is_evidenced_date(value) & (F.length(value) == 7), "month"), (is_evidenced_date(value), "year")])


def date_lower(value: Column) -> Column:
    """The first day that an evidenced date can mean."""
    padded = cases([(F.length(value) == 4, F.concat(value, F.lit("-01-01"))), (F.length(value) == 7, F.concat(value, F.lit("-01")))], F.substring(value, 1, 10))
    return F.when(is_evidenced_date(value), F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")).cast("date"))


def dates_in_slug(url: Column, until: Column) -> Column:
    """SCL-06, SRT-05: the latest real date that a URL's slug spells, from 1990 to `until` (yyyy-MM-dd), or null.

    Eight digits, with or without separators, are year, month, day; six digits are day, month and year of the century
    that keeps the date at or before `until`, read as mmddyy.
    """
    found = F.regexp_extract_all(url, F.lit(r"(?<!\d)((?:19|20)\d{2}[-/_.]?\d{2}[-/_.]?\d{2})(?!\d)"), F.lit(1))
    eight = F.transform(found, lambda x: F.regexp_replace(x, r"(\d{4})\D?(\d{2})\D?(\d{2})", "$1-$2-$3"))
    six = F.regexp_extract_all(url, F.lit(r"(?<!\d)(\d{6})(?!\d)"), F.lit(1))
    turned = lambda x, c: F.concat(F.lit(c), F.substring(x, 5, 2), F.lit("-"), F.substring(x, 1, 2), F.lit("-"), F.substring(x, 3, 2))
    both = F.flatten(F.array(eight, F.transform(six, lambda x: F.when(turned(x, "20") <= until, turned(x, "20")).otherwise(turned(x, "19")))))
    return F.array_max(F.filter(both, lambda d: _real(d, "yyyy-MM-dd") & (d >= "1990-01-01") & (d <= until)))

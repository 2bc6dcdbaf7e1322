"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once a row even if body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def nonempty(value: Column) -> Column:
    """The trimmed text, or null if nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def group(value: Column, pattern: str, n: int = 1) -> Column:
    """Group n of the first match, or null without a match."""
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, n))


def fullmatch(value: Column, pattern: str) -> Column:
    return value.rlike(f"^(?:{pattern})\\z")


def cases(pairs: list[tuple[Column, Column | str]], otherwise: Column | None = None) -> Column:
    """The value of the first condition that holds: ordered rules as one CASE (SRT-06)."""
    out = F
    for condition, value in pairs:
        out = out.when(condition, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(otherwise if otherwise is not None else F.lit(None))


def collapse(value: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(value, r"\s+", " "))

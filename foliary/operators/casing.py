"""Replacements that depend on what was matched: casing of terms, classification marks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def build_caser(terms: list[str]):
    """SCL-30, SRT-03, UDF-02: a function of a column that writes each whole-word term in the given case, the longest first.

    Only case changes. The terms are a small list that goes with the plan; without terms texts stay as they are.
    """
    rules = {t.strip().lower(): t.strip() for t in terms if t.strip()}
    if not rules:
        return lambda column: column
    pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(rules, key=len, reverse=True))) + r")\b", re.I)

    def cased(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else pattern.sub(lambda m: rules.get(m[0].lower(), m[0]), t))

    return lambda column: F.pandas_udf(cased, "string")(column)


#: Markings of documents; full ones in brackets, short ones at the start of a line.
LEVEL = "TOP SECRET|SECRET|CONFIDENTIAL|UNCLASSIFIED"
CAVEAT = r"(?://|/)[A-Z0-9][A-Z0-9 ,/]*"
_STRUCK = re.compile(rf"~~\(?((?:{LEVEL}|TS|S|C|U)(?:{CAVEAT})?)\)?~~")
_FULL = re.compile(rf"\(((?:{LEVEL})(?:{CAVEAT})?|(?:TS|S|C|U){CAVEAT})\)")
_BARE = re.compile(r"(?m)^([ \t]*(?:#+[ \t]+)?)\((TS|S|C|U)\)[ \t]*")


def reconcile(banner: str | None, body: str) -> tuple[str | None, str]:
    """The document's banner (the stated one, else the first mark with caveats, else the first) and the body with its other marks as annotations."""
    if body is None:
        return banner, None
    marks = [m[1] for p in (_STRUCK, _FULL) for m in p.finditer(body)]
    banner = banner or next((m for m in marks if "//" in m), marks[0] if marks else None)

    def note(value: str) -> str:
        quoted = '"' + value.replace('"', '\\"') + '"' if set(value) & set(":,") else value
        return "" if value == banner else "{{classification: " + quoted + "}}"

    for p in (_STRUCK, _FULL):
        body = p.sub(lambda m: note(m[1]), body)
    body = _BARE.sub(lambda m: f"{m[1]}{note(m[2])} ", body)
    return banner, re.sub(r"[ \t]+\n", "\n", re.sub(r"[ \t]{2,}", " ", body))


def _reconciled(banner: pd.Series, body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([reconcile(a or None, b) for a, b in zip(banner, body)], columns=["banner", "body"])


def reconcile_classification(banner: Column, body: Column) -> Column:
    """SCL-19: STRUCT<banner, body>."""
    return F.pandas_udf(_reconciled, "banner string, body string")(banner, body)

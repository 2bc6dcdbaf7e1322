"""Record text from typed columns: only the sink needs it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.temporal import temporal_scalar
from ..functions.text import yaml_quote


def plain(name: str, value: Column, indent: int = 0) -> Column:
    """`name: value`, or null without a value."""
    return F.concat(F.lit(" " * indent + f"{name}: "), value.cast("string"))


def quoted(name: str, value: Column, indent: int = 0) -> Column:
    return F.concat(F.lit(" " * indent + f"{name}: "), yaml_quote(value))


def dated(name: str, value: Column, indent: int = 0) -> Column:
    return F.concat(F.lit(" " * indent + f"{name}: "), temporal_scalar(F.nullif(value, F.lit(""))))


def listed(name: str, values: Column, indent: int = 0) -> Column:
    """A block list, or null without elements."""
    pad = " " * indent
    return F.when(F.size(values) > 0, F.concat(F.lit(f"{pad}{name}:\n"), F.array_join(F.transform(values, lambda v: F.concat(F.lit(f"{pad}  - "), yaml_quote(v))), "\n")))


def block(name: str, *lines: Column) -> Column:
    """A mapping of the lines that are there, or null if none is."""
    kept = F.array_compact(F.array(*lines))
    return F.when(F.size(kept) > 0, F.concat(F.lit(f"{name}:\n"), F.array_join(kept, "\n")))


def record_text(lines: list[Column], body: Column) -> Column:
    """LIF-06: a record: the frontmatter lines that are not null, in order, and the body."""
    return F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*lines)), "\n"), F.lit("\n---\n\n"), body)


def body_fields(record: Column) -> Column:
    """SCL-49: STRUCT<pages, duration> that a record's text states."""
    return F.struct(
        F.nullif(F.regexp_extract(record, r"(?m)^pages: (\d+)", 1), F.lit("")).try_cast("int").alias("pages"),
        F.nullif(F.regexp_extract(record, r"(?m)^duration: ([0-9.]+)", 1), F.lit("")).try_cast("double").alias("duration"),
    )


def tool(name: str, version: str, role: str, model: str | None = None, provider: str = "local") -> Column:
    """SCL-50: a producer's stamp; versions are literals that the driver knows."""
    lines = [f"    - name: {name}", f'      version: "{version}"', *([f"      model: {model}"] if model else []), f"      role: {role}", f"      provider: {provider}"]
    return F.lit("\n".join(lines))

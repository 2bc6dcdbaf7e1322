"""Validation of records: every rule is a CASE whose message goes into an array of errors or warnings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import temporal as T
from ..functions.core import let
from ..functions.rights import DOCUMENT_TYPES, SOURCE_TYPES, STATUSES

REQUIRED = ("schema", "title", "source_type")
#: Fields that extraction owns, and what a date must look like.
EXTRACTION_OWNED = ("date_extracted", "processing", "quality", "review_carryover")
PUBLISHED = "expected YYYY, YYYY-MM, YYYY-MM-DD, or an RFC 3339 timestamp with Z or an explicit offset"
OFFSET = "expected an RFC 3339 timestamp with Z or an explicit offset"
UTC = "expected an RFC 3339 UTC timestamp ending in Z"
TAGS = ("b", "br", "div", "em", "i", "p", "span", "strong", "sub", "sup")


def strip_code_fences(content: Column) -> Column:
    """A record without the code fence that a model may put around it."""
    t = F.trim(content, F.lit(" \t\r\n"))
    bare = F.trim(F.regexp_replace(F.regexp_replace(t, r"\A```[^\n]*\n", ""), r"```\s*\z", ""), F.lit(" \t\r\n"))
    return F.when(t.startswith("```"), bare).otherwise(content)


def quote_colons(frontmatter: Column) -> Column:
    """Top-level values that hold a colon without quotes get them."""
    line = r"(?m)^([a-z_]+): (?!\"|')(.*:.*)$"
    hits = F.regexp_extract_all(frontmatter, F.lit(line.replace("(?m)^", "(?m)^(", 1)[:-1] + "$)"), F.lit(1))
    fixed = lambda h: F.concat(F.regexp_extract(h, r"^([a-z_]+: )", 1), F.lit('"'), F.replace(F.regexp_replace(h, r"^[a-z_]+: ", ""), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return let(hits, lambda hs: F.when(F.size(hs) == 0, frontmatter).otherwise(F.array_join(F.zip_with(F.split(frontmatter, line, -1), F.concat(F.transform(hs, fixed), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")))


def structure_errors(content: Column) -> Column:
    """Errors of the outer shape: a code fence, no frontmatter, no end of it."""
    bare = F.trim(strip_code_fences(content), F.lit(" \t\r\n"))
    opened = bare.startswith("---")
    closed = F.size(F.split(bare, "---", 3)) >= 3
    return F.array_compact(
        F.array(
            F.when(F.trim(content, F.lit(" \t\r\n")).startswith("```"), F.lit("Content wrapped in code fence - should be stripped")),
            F.when(~opened, F.lit("No YAML frontmatter found (must start with ---)")),
            F.when(opened & ~closed, F.lit("Incomplete YAML frontmatter (missing closing ---)")),
        )
    )


def field_errors(fields: Column, schema: str, required: tuple[str, ...] = ()) -> Column:
    """SCL-18, SET-06: errors of frontmatter as a MAP<STRING,STRING> of dotted paths, in the order of the rules."""
    get = lambda k: F.try_element_at(fields, F.lit(k))
    has = lambda k: F.array_contains(F.map_keys(fields), k)
    date = lambda k, ok, say: F.when(has(k) & ~ok(get(k)), F.lit(f"Invalid {k}: {say}"))
    leaks = F.transform(
        F.array_sort(F.map_keys(F.map_filter(fields, lambda _, v: v.rlike(r"\{\{.*?\}\}")))),
        lambda k: F.concat(F.lit("Body-annotation syntax ({{...}}) in frontmatter value: "), k, F.lit(" - {{...}} is body-only; a described person is [bracketed], a withheld one is [redacted]")),
    )
    missing = F.transform(F.array_except(F.array(*[F.lit(k) for k in (*REQUIRED, *required)]), F.map_keys(fields)), lambda k: F.concat(F.lit("Missing required frontmatter field: "), k))
    indexed = lambda pattern, ok, say: F.transform(
        F.array_sort(F.map_keys(F.map_filter(fields, lambda k, v: k.rlike(pattern) & ~ok(v)))), lambda k: F.concat(F.lit("Invalid "), k, F.lit(f": {say}"))
    )
    rules = [
        *[date(k, T.is_evidenced_date, PUBLISHED) for k in ("date_published", "posted_date")],
        date("date_accessed", T.is_instant, OFFSET),
        date("date_extracted", T.is_utc_instant, UTC),
        *[date(f"provenance.{k}", T.is_evidenced_date, PUBLISHED) for k in ("published_date", "posted_date")],
        date("provenance.acquired_date", T.is_instant, OFFSET),
        date("release.release_date", T.is_full_date, "expected YYYY-MM-DD"),
        *[date(f"copyright.{k}", T.is_full_date, "expected YYYY-MM-DD") for k in ("granted_at", "expires")],
        *[date(f"{k}.at", T.is_utc_instant, UTC) for k in ("review_carryover", "refresh_refused")],
    ]
    wrong = F.when(F.coalesce(get("schema") != "", F.lit(False)) & (get("schema") != schema), F.concat(F.lit("Wrong schema version: "), get("schema"), F.lit(f" (expected {schema})")))
    kind = F.when(has("document_type") & ~F.coalesce(get("document_type").isin(*DOCUMENT_TYPES), F.lit(False)), F.lit("Invalid document_type: expected one of " + ", ".join(DOCUMENT_TYPES)))
    return F.concat(
        leaks,
        missing,
        F.array_compact(F.array(*rules)),
        indexed(r"^snapshots\[\d+\]\.captured_at$", T.is_utc_instant, UTC),
        indexed(r"^processing\.source\.audio\[\d+\]\.fetched_at$", T.is_instant, OFFSET),
        F.array_compact(F.array(wrong, kind)),
    )


def body_errors(body: Column) -> Column:
    """Dates of message annotations that are no quoted instants."""
    notes = F.regexp_extract_all(body, F.lit(r"<!--\s*message:\s*(\{.*?\})\s*-->"), F.lit(1))
    dated = F.filter(notes, lambda n: n.rlike(r"\bdate:"))
    bad = F.filter(dated, lambda n: ~T.is_instant(F.regexp_extract(n, r"\bdate:\s*\"([^\"]*)\"", 1)))
    return F.transform(bad, lambda _: F.lit("Invalid annotations.message.date: expected a quoted " + OFFSET.removeprefix("expected an ")))


def warnings(body: Column) -> Column:
    """An empty body, or HTML tags where markdown belongs."""
    b = F.trim(body, F.lit(" \t\r\n"))
    tags = F.array_sort(F.array_distinct(F.regexp_extract_all(b, F.lit(f"<({'|'.join(sorted(TAGS, key=len, reverse=True))})[>\\s/]"), F.lit(1))))
    listed = F.array_join(F.transform(tags, lambda t: F.concat(F.lit("<"), t, F.lit(">"))), ", ")
    return F.array_compact(
        F.array(
            F.when(b == "", F.lit("No content after frontmatter (empty body)")),
            F.when(F.size(tags) > 0, F.concat(F.lit("HTML tags found (should use markdown instead): "), listed)),
        )
    )


def introduced(new_errors: Column, old_errors: Column) -> Column:
    """SET-03: errors that the new text has and the old one had not."""
    return F.array_except(new_errors, old_errors)


def dropped_fields(old: Column, new: Column) -> Column:
    """SET-04: keys of the old map that the new one lacks, sorted."""
    return F.array_sort(F.array_except(F.map_keys(old), F.map_keys(new)))


def protected_equal(old: Column, new: Column) -> Column:
    """SET-05: all fields but those that extraction owns are the same."""
    own = lambda k: F.split_part(k, F.lit("."), F.lit(1)).isin(*EXTRACTION_OWNED)
    kept = lambda m: F.array_sort(F.map_entries(F.map_filter(m, lambda k, _: ~own(k))))
    return kept(old) == kept(new)


def metadata_errors(meta: Column) -> Column:
    """LIF-05: why supplied metadata is refused; `meta` is a MAP<STRING,STRING> of the supplied fields."""
    allowed = ("title", "source_type", "source_url", "source_id", "publisher", "date_published", "description", "copyright.status")
    get = lambda k: F.try_element_at(meta, F.lit(k))
    unknown = F.array_sort(F.array_except(F.map_keys(meta), F.array(*[F.lit(k) for k in allowed])))
    return F.array_compact(
        F.array(
            F.when(F.size(meta) == 0, F.lit("record metadata must be a non-empty mapping")),
            F.when(F.size(unknown) > 0, F.concat(F.lit("record metadata contains unsupported fields: "), F.array_join(unknown, ", "))),
            *[F.when(F.trim(get(k)) == "", F.lit(f"record metadata {k} must be a non-empty string")) for k in ("title", "source_url", "source_id", "publisher", "description")],
            F.when(~get("source_type").isin(*SOURCE_TYPES), F.lit("record metadata source_type is unsupported")),
            F.when(~get("source_url").rlike("^(https?|file):"), F.lit("record metadata source_url must be an absolute URL")),
            F.when(get("date_published").isNotNull() & ~T.is_evidenced_date(get("date_published")), F.lit("record metadata date_published is not an evidenced date")),
            F.when(~get("copyright.status").isin(*STATUSES), F.lit("record metadata copyright.status is unsupported")),
        )
    )


def minimum_content(content: Column, pages: Column) -> Column:
    """FLT-10: STRUCT<ok, reason>: a record begins with frontmatter and has 500 characters, or 200 a page."""
    t = F.trim(strip_code_fences(content), F.lit(" \t\r\n"))
    least = F.greatest(F.lit(500), pages * 200)
    why = F.when(~t.startswith("---"), F.lit("no frontmatter (doesn't start with ---)")).when(F.length(t) < least, F.concat(F.lit("content too short (expected at least "), least.cast("string"), F.lit(" chars)")))
    return F.struct(why.isNull().alias("ok"), F.coalesce(why, F.lit("")).alias("reason"))

"""Transitions of records: stamps, refresh decisions, supersession, merges and publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import cases
from .validate import EXTRACTION_OWNED  # noqa: F401

#: The current extraction generation of each kind of source (fixed values), and the most that a body may lose to regions.
GENERATIONS = {"pdf": 1, "image": 1, "web": 7, "ebook": 6, "audio": 2, "video": 2}
MAX_SHARE_LOSS = 0.15
IDENTITY = ("source_type", "source_url", "source_id")


def current_generation(source_type: Column) -> Column:
    """The generation of a kind of source; null for a kind that there is not."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in GENERATIONS.items() for x in kv]), source_type)


def is_stale(source_type: Column, declared: Column) -> Column:
    """FLT-17: the declared generation is not the current one; an unknown one is stale, never zero."""
    return ~declared.eqNullSafe(current_generation(source_type))


def with_reviews(records: DataFrame, reviews: DataFrame) -> DataFrame:
    """FLT-17: `reviewed`: a review of the record's hash exists."""
    marks = reviews.select(F.col("record_hash").alias("_r")).distinct().withColumn("_m", F.lit(True))
    return records.join(marks, records["record_hash"] == marks["_r"], "left").withColumn("reviewed", F.coalesce("_m", F.lit(False))).drop("_r", "_m")


def identity_holds(content_hash: Column, path: Column) -> Column:
    """FLT-17: the declared hash is well formed and names the file."""
    stem = F.split_part(F.regexp_extract(path, r"([^/]+)$", 1), F.lit("."), F.lit(1))
    return F.coalesce(content_hash.rlike("^sha256:[0-9a-f]{64}$") & (F.substring(content_hash, F.lit(8), F.lit(64)) == stem), F.lit(False))


def stamp_generation(previous: Column, expected: Column, source_type: Column) -> Column:
    """LIF-04: STRUCT<version, changed, error>: compare and set; the error names what was found instead."""
    target = current_generation(source_type)
    say = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    error = F.when(target.isNull(), F.concat(F.lit("unsupported source_type: "), source_type)).when(~previous.eqNullSafe(expected), F.concat(F.lit("record pipeline_version is "), say(previous), F.lit(", expected "), say(expected)))
    return F.struct(F.when(error.isNull(), target).otherwise(previous).alias("version"), (error.isNull() & ~previous.eqNullSafe(target)).alias("changed"), error.alias("error"))


def merge_versions(declared: DataFrame, stored: DataFrame) -> DataFrame:
    """SRC-26: the higher version of each known type; a stored one never falls, an unknown type is left out."""
    a, b = declared.select("source_type", F.col("version").alias("a")), stored.select("source_type", F.col("version").alias("b"))
    out = a.join(b, "source_type", "full_outer").filter(F.col("source_type").isin(*GENERATIONS))
    return out.select("source_type", F.greatest(F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))).alias("version"))


def refresh_outcome(unchanged: Column, generation_current: Column, share_before: Column, share_after: Column, lost: Column, allowed: Column, dropped_pairs: Column, reviewed: Column, introduced: Column, identity: Column, sample: Column | None = None) -> Column:
    """LIF-01: STRUCT<written, reason> of a refresh, from its measures, refusals first and in order; `sample` shows words that were lost."""
    percent = lambda c: F.concat(F.round(c * 100).cast("int").cast("string"), F.lit("%"))
    who = F.when(reviewed, F.lit("a reviewed record keeps every word")).otherwise(F.concat(F.lit("bound "), allowed.cast("string")))
    refusal = cases(
        [
            (~identity, F.lit("refused: declared content_hash is absent, malformed, or differs from the record path")),
            (share_before - share_after > MAX_SHARE_LOSS, F.concat(F.lit("refused: carrying the reviewer's irrelevant regions would leave "), percent(share_after), F.lit(" of the body materialising, against "), percent(share_before), F.lit(" before - a region has been placed over text it did not cover"))),
            ((dropped_pairs > 0) & reviewed, F.concat(F.lit("refused: "), dropped_pairs.cast("string"), F.lit(" of the reviewer's marker pair(s) have no home in the fresh extraction"))),
            (lost > allowed, F.concat(F.lit("refused: "), lost.cast("string"), F.lit(" word(s) of the stored body are absent from the fresh extraction ("), who, F.lit("): "), F.lit("") if sample is None else F.coalesce(sample, F.lit("")))),
            (~unchanged & (F.size(introduced) > 0), F.concat(F.lit("refused: the refreshed record does not validate: "), F.array_join(introduced, "; "))),
        ]
    )
    done = cases([(unchanged & generation_current, F.lit("unchanged")), (unchanged, F.lit("body unchanged, stamps brought up to date"))], F.lit("refreshed in place"))
    return F.struct((refusal.isNull() & (done != "unchanged")).alias("written"), F.coalesce(refusal, done).alias("reason"))


def restamp(records: DataFrame, now: Column, version: str, tool_version: str | None = None) -> DataFrame:
    """LIF-02: fresh stamps in `fm`: extraction time, versions; an earlier refusal goes."""
    fm = F.col("fm").withField("date_extracted", now).withField("refresh_refused", F.lit(None).cast(records.schema["fm"].dataType["refresh_refused"].dataType))
    processing = F.col("fm.processing").withField("version", F.lit(version)).withField("pipeline_version", current_generation(F.col("fm.source_type")))
    if tool_version is not None:
        processing = processing.withField("tools", F.transform("fm.processing.tools", lambda t: t.withField("version", F.lit(tool_version))))
    return records.withColumn("fm", fm.withField("processing", processing))


def supersede(live: DataFrame, incoming: DataFrame, alias: str = "alias") -> DataFrame:
    """LIF-03: forced replacement by alias: old rows close with `superseded_by`, new ones open with `supersedes`; the rest stays.

    Both sides have alias, record_hash, superseded_by, supersedes. `generation` is live or retired.
    """
    new = incoming.select(alias, F.col("record_hash").alias("_new"))
    old = live.select(alias, F.col("record_hash").alias("_old"))
    kept = live.join(new, alias, "left")
    replaced = F.col("_new").isNotNull() & (F.col("_new") != F.col("record_hash"))
    closed = kept.withColumn("superseded_by", F.when(replaced, F.coalesce("superseded_by", "_new")).otherwise(F.col("superseded_by"))).withColumn("generation", F.when(replaced, "retired").otherwise("live"))
    closed = closed.filter(F.col("_new").isNull() | replaced).drop("_new")
    opened = incoming.join(old, alias, "left").withColumn("supersedes", F.when(F.col("_old") != F.col("record_hash"), F.coalesce("supersedes", "_old")).otherwise(F.col("supersedes"))).withColumn("generation", F.lit("live")).drop("_old")
    return closed.unionByName(opened)


def merge_metadata(records: DataFrame, supplied: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """LIF-05, JOI-11: supplied values over stored ones, field by field; `conflict` names identity fields that disagree, and then nothing changes."""
    new = supplied.select(F.col(key).alias("_k"), *[F.col(f).alias(f"_n_{f}") for f in fields])
    rows = records.join(new, records[key] == new["_k"], "left").drop("_k")
    clash = F.array_compact(F.array(*[F.when((F.col(f) != "") & (F.col(f"_n_{f}") != "") & (F.col(f) != F.col(f"_n_{f}")), F.lit(f)) for f in IDENTITY if f in fields] or [F.lit(None).cast("string")]))
    rows = rows.withColumn("conflict", clash)
    for f in fields:
        rows = rows.withColumn(f, F.when(F.size("conflict") > 0, F.col(f)).otherwise(F.coalesce(f"_n_{f}", f)))
    return rows.drop(*[f"_n_{f}" for f in fields])


def canary_errors(parent: Column, candidate: Column, content_hash: Column, reviewed: Column, same_body: Column, protected_same: Column, errors: Column) -> Column:
    """LIF-07: the first reason to refuse a candidate, or null. parent and candidate are STRUCT<content_hash, schema, source_type, pipeline_version, carryover_from>."""
    want = F.concat(F.lit("sha256:"), content_hash)
    return cases(
        [
            (~parent["content_hash"].eqNullSafe(want) | ~candidate["content_hash"].eqNullSafe(want), "content identity does not match the record path"),
            (~candidate["schema"].eqNullSafe(parent["schema"]), "record schema changed"),
            (~candidate["source_type"].eqNullSafe(parent["source_type"]), "source type changed"),
            (~protected_same, "identity, provenance, rights, or curated metadata changed"),
            (is_stale(candidate["source_type"], candidate["pipeline_version"]), "candidate does not declare the current extraction generation"),
            (F.size(errors) > 0, F.concat(F.lit("candidate does not validate: "), F.array_join(errors, "; "))),
            (reviewed & candidate["source_type"].isin("audio", "video") & ~same_body, "reviewed audio/video body changed"),
            (reviewed & ~same_body & ~candidate["carryover_from"].eqNullSafe(content_hash), "changed reviewed body has no valid review_carryover"),
        ]
    )


def publishable(changes: DataFrame, base: DataFrame, now: DataFrame) -> DataFrame:
    """LIF-08: changed paths, with `ok` if what is stored now is still what the change was based on. All have path, digest."""
    b, n = base.select("path", F.col("digest").alias("_b")), now.select("path", F.col("digest").alias("_n"))
    return changes.join(b, "path", "left").join(n, "path", "left").select("path", "digest", F.col("_b").eqNullSafe(F.col("_n")).alias("ok"))


def append_by_sha(existing: Column, entry: Column) -> Column:
    """AGG-19: the entry at the end, unless one with its sha256 is there."""
    return F.when(F.exists(existing, lambda e: e["sha256"] == entry["sha256"]), existing).otherwise(F.array_append(existing, entry))


def snapshot_hash(snapshots: Column, role: str) -> Column:
    """SCL-48: the hash of the first snapshot of a role."""
    return F.get(F.filter(snapshots, lambda s: s["role"] == role), F.lit(0))["hash"]


def replace_snapshot(snapshots: Column, entry: Column) -> Column:
    """SCL-48: the entry in the place of its role's, or at the end."""
    there = F.exists(snapshots, lambda s: s["role"] == entry["role"])
    return F.when(there, F.transform(snapshots, lambda s: F.when(s["role"] == entry["role"], entry).otherwise(s))).otherwise(F.array_append(F.coalesce(snapshots, F.array().cast("array<struct<role:string,hash:string>>")), entry))


def accepts_capture(coverage: Column, css_before: Column, css_after: Column) -> Column:
    """A fresh capture replaces the stored one if it holds 80 % of the text's words and, where one is stored, half as much CSS again."""
    return (coverage >= 0.8) & F.coalesce(css_after >= css_before * F.lit(1.5), F.lit(True))

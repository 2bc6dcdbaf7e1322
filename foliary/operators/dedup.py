"""Intake deduplication by identity, by URL alias and by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fields of a record that hold its URLs, at the top level or under `provenance`.
URL_FIELDS = ("source_url", "fetched_url", "also_published_at")


def bare_hash(value: Column) -> Column:
    """A hash without its label; empty becomes null, which matches nothing."""
    return F.nullif(F.regexp_replace(F.trim(value), "^sha256:", ""), F.lit(""))


def live(records: DataFrame) -> DataFrame:
    """SRC-01: records that nothing supersedes."""
    return records.filter(F.coalesce(F.trim("superseded_by"), F.lit("")) == "")


def first_by_path(records: DataFrame, key: str) -> DataFrame:
    """SRT-01: for each key the first live record in path order, as (key, path). Empty keys match nothing."""
    return live(records).filter(F.trim(key) != "").groupBy(key).agg(F.min("path").alias("path"))


def known(incoming: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """JOI-01: incoming rows whose key a live record has already, with that record's path as `existing`."""
    return incoming.join(first_by_path(records, key).withColumnRenamed("path", "existing"), key)


def unknown(incoming: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """JOI-01: incoming rows that no live record matches; rows without a key are all admitted."""
    return incoming.join(live(records).select(key).filter(F.trim(key) != ""), key, "left_anti")


def aliases(urls: list[Column]) -> Column:
    """SET-01: the distinct trimmed URLs of scalar and list fields together."""
    # a bare F.trim would take the place in the list as the characters to trim
    return F.array_distinct(F.filter(F.transform(F.flatten(F.array(*urls)), lambda u: F.trim(u)), lambda u: u != ""))


def alias_bridge(records: DataFrame, urls: Column) -> DataFrame:
    """JOI-02: (url, path), a row for each alias of each live record and the first path on ties."""
    return live(records).select("path", F.explode(urls).alias("url")).groupBy("url").agg(F.min("path").alias("path"))


def known_by_url(incoming: DataFrame, bridge: DataFrame, url: str = "url") -> DataFrame:
    """JOI-02: incoming rows that any alias of a live record equals, with its path as `existing`."""
    return incoming.join(bridge.select(F.col("url").alias(url), F.col("path").alias("existing")), url)


def resolve_one(queries: DataFrame, records: DataFrame) -> DataFrame:
    """JOI-03, SET-02: for each query the union of records that match its hash, id or URL, and whether it is exactly one.

    queries: query, asset_hash, source_id, source_url. records: path, content_hash, source_hash, source_id, urls ARRAY.
    Gives query, n (distinct paths, 0 without any) and path (null unless n is 1).
    """
    rows = live(records) if "superseded_by" in records.columns else records
    hashes = rows.select("path", F.explode(F.array_distinct(F.array(bare_hash(F.col("content_hash")), bare_hash(F.col("source_hash"))))).alias("k")).filter("k is not null")
    ids = rows.select("path", F.col("source_id").alias("k")).filter("k <> ''")
    urls = rows.select("path", F.explode("urls").alias("k"))
    hit = lambda key, side: queries.select("query", key.alias("k")).filter(F.trim("k") != "").join(side, "k").select("query", "path")
    found = hit(bare_hash(F.col("asset_hash")), hashes).union(hit(F.col("source_id"), ids)).union(hit(F.col("source_url"), urls)).distinct()
    counted = found.groupBy("query").agg(F.count("*").alias("n"), F.min("path").alias("path"))
    out = queries.select("query").join(counted, "query", "left")
    return out.select("query", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.when(F.col("n") == 1, F.col("path")).alias("path"))


def same_content(records: DataFrame, key: str, text: str) -> DataFrame:
    """SCL-01, SRT-01: each row's content hash, the first key of its hash and the number of rows that share it."""
    hashed = records.select(key, F.sha2(F.col(text).cast("binary"), 256).alias("content_hash"))
    groups = hashed.groupBy("content_hash").agg(F.min(key).alias("first_key"), F.count("*").alias("n"))
    return hashed.join(groups, "content_hash").select(key, "content_hash", "first_key", "n")

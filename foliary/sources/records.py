"""Record stores: Markdown with YAML frontmatter, one file a record."""

from __future__ import annotations

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class _Plain(yaml.SafeLoader):
    """YAML whose scalars stay text, so a bare year or date keeps its precision."""


_Plain.yaml_implicit_resolvers = {}


def flatten(value, path: str = "") -> dict[str, str]:
    """Dotted paths of a nested value: a.b for mappings, a[0] for lists; empty values are empty text."""
    if isinstance(value, dict):
        return {k: v for key, sub in value.items() for k, v in flatten(sub, f"{path}.{key}" if path else str(key)).items()}
    if isinstance(value, list):
        return {k: v for i, sub in enumerate(value) for k, v in flatten(sub, f"{path}[{i}]").items()}
    return {path: "" if value is None else str(value)} if path else {}


def _fields(text: pd.Series) -> pd.Series:
    def one(t):
        try:
            value = yaml.load(t, _Plain) if t is not None else None
        except yaml.YAMLError:
            return None
        return flatten(value) if isinstance(value, dict) else None

    return text.map(one)


def yaml_fields(text: Column) -> Column:
    """SCL-16: frontmatter as a map of dotted paths; null if it is no YAML mapping."""
    return F.pandas_udf(_fields, "map<string,string>")(text)


def split(text: Column) -> Column:
    """SCL-16: STRUCT<frontmatter, body> by the first closing fence on its own line; nulls without a frontmatter."""
    body = r"(?s)\A---\n(.*?)\n---\n(.*)\z"
    ok = text.rlike(body)
    return F.struct(F.when(ok, F.regexp_extract(text, body, 1)).alias("frontmatter"), F.when(ok, F.regexp_extract(text, body, 2)).alias("body"))


def split_anywhere(text: Column) -> Column:
    """SCL-16, the loose form: cut at the first two `---` wherever they stand; nulls if there are fewer."""
    parts = F.split(text, "---", 3)
    ok = F.size(parts) >= 3
    return F.struct(F.when(ok, F.get(parts, F.lit(1))).alias("frontmatter"), F.when(ok, F.get(parts, F.lit(2))).alias("body"))


def replace_block(frontmatter: Column, key: str, block: Column | None) -> Column:
    """SCL-17: a top-level key and its indented lines replaced by `block`, put at the end if it is not there; None drops it."""
    pattern = rf"(?m)^{key}:.*(?:\n[ \t].*)*\n?"
    bare = F.regexp_replace(frontmatter, pattern, "")
    if block is None:
        return F.regexp_replace(bare, r"\n\z", "")
    at = F.regexp_instr(frontmatter, F.lit(pattern))
    head = F.substring(frontmatter, F.lit(1), at - 1)
    tail = F.substring(bare, at, F.length(bare))
    put = F.regexp_replace(F.concat(head, block, F.lit("\n"), tail), r"\n\z", "")
    return F.when(at > 0, put).otherwise(F.concat(F.regexp_replace(frontmatter, r"\n+\z", ""), F.lit("\n"), block))


def parse_store(raw: DataFrame) -> DataFrame:
    """SRC-02, SCL-16: record files (path, value) as path, record_hash, variant, fm (map of paths), body, stub (no content hash) and the fields that joins need.

    Files without readable frontmatter are left out. Live records are those without superseded_by: see operators.dedup.
    """
    name = F.regexp_extract(F.col("path"), r"([^/]+)\.md$", 1)
    rows = raw.select("path", split(F.col("value")).alias("s"))
    rows = rows.select("path", F.split_part(name, F.lit("."), F.lit(1)).alias("record_hash"), F.nullif(F.regexp_replace(name, r"^[^.]*\.?", ""), F.lit("")).alias("variant"), yaml_fields(F.col("s.frontmatter")).alias("fm"), F.col("s.body").alias("body"))
    rows = rows.filter("fm is not null")
    get = lambda k: F.nullif(F.try_element_at("fm", F.lit(k)), F.lit(""))
    return rows.select("*", get("superseded_by").alias("superseded_by"), get("content_hash").isNull().alias("stub"), *[F.coalesce(get(k), get(f"provenance.{k}")).alias(k) for k in ("source_url", "source_id", "source_hash")], get("source_type").alias("source_type"))


def read_store(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """SRC-01, SRC-02: every record file of a folder; see parse_store."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=recursive)
    return parse_store(raw.select(F.col("_metadata.file_path").alias("path"), "value"))


def generations(live: DataFrame, retired: DataFrame | None) -> DataFrame:
    """SRC-03: the live and the retired store together, with `root`."""
    out = live.withColumn("root", F.lit("store"))
    return out if retired is None else out.unionByName(retired.withColumn("root", F.lit("store/v1")))


def read_generations(spark: SparkSession, store: str, recursive: bool = False) -> DataFrame:
    """SRC-03: both stores from their folders; the retired one may be missing."""
    live = read_store(spark, store, recursive)
    try:
        return generations(live, read_store(spark, f"{store}/v1", recursive))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return generations(live, None)
        raise


def urls_of(fm: Column) -> Column:
    """SET-01: the URLs of a record's fields at both levels, distinct."""
    ours = r"^(provenance\.)?(source_url|fetched_url|also_published_at)(\[\d+\])?$"
    return F.array_distinct(F.filter(F.transform(F.map_values(F.map_filter(fm, lambda k, _: k.rlike(ours))), F.trim), lambda u: u != ""))


def web_heads(records: DataFrame) -> DataFrame:
    """SRC-04: live web records, by the parsed fields; no window over the file."""
    return records.filter("source_type = 'web' and superseded_by is null")

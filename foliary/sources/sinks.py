"""Writers. Transport to other stores is planned here, never done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_records(records: DataFrame, existing: DataFrame, path: str, force: bool = False) -> DataFrame:
    """SRC-23: append records (record_hash, alias, source_type, …) by source type; gives what was refused.

    A row whose alias another hash holds already is refused unless force; rows that repeat a stored hash are left out.
    """
    held = existing.select("alias", F.col("record_hash").alias("_held")).dropDuplicates(["alias"])
    rows = records.join(held, "alias", "left")
    clash = F.col("_held").isNotNull() & (F.col("_held") != F.col("record_hash"))
    refused = rows.filter(clash & ~F.lit(force)).drop("_held")
    good = rows.filter(~clash | F.lit(force)).drop("_held").join(existing.select("record_hash").distinct(), "record_hash", "left_anti")
    good.write.mode("append").partitionBy("source_type").parquet(path)
    return refused


def sidecars(records: DataFrame, challenges: DataFrame) -> DataFrame:
    """SRC-24: (record_hash, json): verification sidecars of gated records. challenges: record_hash, id, before, after, answer."""
    lists = challenges.groupBy("record_hash").agg(F.array_sort(F.collect_list(F.struct("id", "before", "after", "answer"))).alias("challenges"))
    rows = records.join(lists, "record_hash", "left")
    body = F.struct(F.lit("cloze-v1").alias("algorithm"), F.lit(30).alias("challenge_count"), F.lit(4).alias("context_words"), F.col("record_hash").alias("sha256"), "size_bytes", "challenges")
    return rows.select("record_hash", F.to_json(body).alias("json"))


def receipts(rows: DataFrame) -> DataFrame:
    """SRC-25: (run_uuid, json, error): receipts with keys in order; the error names the first rule that a row breaks."""
    rules = [
        (F.col("run_uuid").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), "run_uuid must be a canonical lowercase UUID"),
        (F.col("outcome").isin("committed", "no-op"), "outcome must be committed or no-op"),
        (F.col("record_path").rlike(r"^(?!/)(?!.*(^|/)\.{0,2}(/|$)).+$"), "record_path must be a normalised relative POSIX path"),
        (F.col("content_hash").rlike("^sha256:[0-9a-f]{64}$"), "record has no canonical content_hash"),
        (F.col("commit_sha").rlike("^[0-9a-f]{40}([0-9a-f]{24})?$"), "commit_sha must be a full lowercase Git object ID"),
    ]
    error = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(say)) for ok, say in rules], F.lit(None).cast("string"))
    fields = ("commit_sha", "completed_at", "content_hash", "outcome", "record_path", "run_uuid", "schema")
    return rows.withColumn("schema", F.coalesce(F.col("schema"), F.lit("ingest-result/1"))).select("run_uuid", F.to_json(F.struct(*fields)).alias("json"), error.alias("error"))


def write_receipts(rows: DataFrame, path: str) -> None:
    """SRC-25: append receipts; a run that has one already stops the write."""
    spark = rows.sparkSession
    made = receipts(rows)
    try:
        old = spark.read.parquet(path).select(F.col("run_uuid").alias("_r"))
        made = made.join(old, F.col("run_uuid") == F.col("_r"), "left").withColumn("error", F.coalesce("error", F.when(F.col("_r").isNotNull(), F.lit("result already exists")))).drop("_r")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    checked = made.withColumn("json", F.when(F.col("error").isNull(), F.col("json")).otherwise(F.raise_error(F.col("error"))))
    checked.select("run_uuid", "json").write.mode("append").parquet(path)


def push_plan(records: DataFrame, originals: DataFrame, stored: DataFrame) -> DataFrame:
    """SRC-27: (record_hash, zone, key, action): what a backup would push; exists, would-push or no-original.

    records: record_hash, status, original; originals: stem, ext; stored: zone, key.
    """
    from ..functions.rights import storage_zone

    files = originals.groupBy(F.col("stem").alias("original")).agg(F.min("ext").alias("ext"))
    rows = records.join(files, "original", "left").withColumn("zone", storage_zone(F.col("status"))).withColumn("key", F.concat(F.lit("sources/"), "record_hash", F.lit("."), "ext"))
    rows = rows.join(stored.select("zone", "key", F.lit(True).alias("_s")).distinct(), ["zone", "key"], "left")
    action = F.when(F.col("ext").isNull(), "no-original").when(F.col("_s"), "exists").otherwise("would-push")
    return rows.select("record_hash", "zone", "key", action.alias("action"))


def write_report(report: DataFrame, path: str) -> None:
    """SRC-07, SRC-28: JSON lines by Spark's own commit, so readers see all of a report or none."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)

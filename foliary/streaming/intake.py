"""Admission of manifests that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import url_source_id
from ..sources.schemas import MANIFEST


def manifest_stream(spark: SparkSession, path: str) -> DataFrame:
    """New manifests of a folder, one JSON object a line."""
    return spark.readStream.schema(MANIFEST).json(path)


def admit(manifests: DataFrame, known: DataFrame, late: str = "7 days") -> DataFrame:
    """Manifests without an error whose id no stored record (source_id) has, each id once within `late` of its first arrival."""
    rows = manifests.filter("error is null").withColumn("source_id", F.coalesce("source_id", url_source_id(F.col("source")))).withColumn("at", F.try_to_timestamp("fetched_at"))
    new = rows.join(known.select("source_id").distinct(), "source_id", "left_anti")
    return new.withWatermark("at", late).dropDuplicatesWithinWatermark(["source_id"])


def arrivals(manifests: DataFrame, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Arrivals by window and kind of asset."""
    rows = manifests.withColumn("at", F.try_to_timestamp("fetched_at")).withWatermark("at", late)
    return rows.groupBy(F.window("at", window), "detected_type").agg(F.count("*").alias("n"))

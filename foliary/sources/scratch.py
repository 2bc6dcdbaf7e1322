"""A folder for tables that a job writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir. A local master (tests) may do without: it gets a new one.

    Elsewhere a folder of one machine would hold each executor's part alone, so a missing setting is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliary-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/foliary-{tag}-{uuid.uuid4().hex}"

"""Manifests, transcripts, logs and lookups as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: acquisition manifests."""
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)


def parse_manifests(raw: DataFrame) -> DataFrame:
    """SRC-05: manifests that lie in a column, `json`; other columns stay."""
    return raw.withColumn("m", F.from_json("json", schemas.MANIFEST)).select(*[c for c in raw.columns if c != "json"], "m.*")


def parse_transcripts(raw: DataFrame) -> DataFrame:
    """SRC-06: transcript archives that lie in a column, `json`, beside their `stem`."""
    return raw.select("stem", F.from_json("json", schemas.TRANSCRIPT).alias("t")).select("stem", "t.*")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06: transcript archives, with `stem` of the file name."""
    raw = spark.read.schema(schemas.TRANSCRIPT).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]*)", 1).alias("stem"), "*")


def segments(transcripts: DataFrame) -> DataFrame:
    """SRC-06, SRC-17: (stem, ord, text, start, end, words); words without both times are dropped."""
    rows = transcripts.select("stem", F.posexplode("whisperx.aligned.segments").alias("ord", "s"))
    timed = F.filter("s.words", lambda w: w["start"].isNotNull() & w["end"].isNotNull())
    words = F.transform(timed, lambda w: F.struct(F.trim(w["word"]).alias("text"), w["start"].alias("start"), w["end"].alias("end")))
    return rows.select("stem", "ord", F.trim("s.text").alias("text"), "s.start", "s.end", F.coalesce(words, F.expr("cast(array() as array<struct<text:string,start:double,end:double>>)")).alias("words"))


def tracks(transcripts: DataFrame, exclusive: bool = False) -> DataFrame:
    """SRC-06, SRC-18: (stem, ord, start, end, speaker) of the regular or the exclusive tracks."""
    rows = transcripts.select("stem", F.posexplode("pyannote.exclusive_tracks" if exclusive else "pyannote.tracks").alias("ord", "t"))
    return rows.select("stem", "ord", "t.start", "t.end", "t.speaker")


def truth(transcripts: DataFrame) -> DataFrame:
    """(stem, t, real): reviewed speakers by word time."""
    return transcripts.select("stem", F.explode("reviewed_words").alias("t", "real"))


def reviewed_words(lines: DataFrame, key: str) -> DataFrame:
    """(key, t, real) from a reviewed body's lines: the speaker mark above each timed word; irrelevant speech has none."""
    from ..operators.turns import forward_fill

    mark = F.nullif(F.regexp_extract("text", r"^\s*<!--\s*speaker:\s*(.*?)\s*-->\s*$", 1), F.lit(""))
    rows = forward_fill(lines, [key], ["line_no"], mark, "real").filter("real is not null and real <> '[irrelevant]'")
    return rows.select(key, "real", F.explode(F.regexp_extract_all("text", F.lit(r"\{\{t:([0-9.]+)\}\}\S+"), F.lit(1))).alias("t")).select(key, "t", "real")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """JOI-10: (stem, ext, size) of every archived file, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.regexp_extract(name, r"^([^.]*)", 1).alias("stem"), F.regexp_extract(name, r"\.([^.]*)$", 1).alias("ext"), F.col("length").alias("size"))


def paths_said(lines: DataFrame) -> DataFrame:
    """SRC-29: log lines (log, value) as (log, n, path, error): the distinct paths that each log says were written; path is null unless there is one, error says so."""
    said = F.when(F.col("value").startswith("Written: "), F.trim(F.substring("value", F.lit(10), F.length("value"))))
    rows = lines.groupBy("log").agg(F.array_sort(F.collect_set(said)).alias("p"))
    n = F.size("p")
    return rows.select("log", n.alias("n"), F.when(n == 1, F.get("p", F.lit(0))).alias("path"), F.when(n > 1, F.concat(F.lit("handler reported "), n.cast("string"), F.lit(" different record paths"))).alias("error"))


def written_paths(spark: SparkSession, path: str) -> DataFrame:
    """SRC-29: the same from a folder of handler logs."""
    return paths_said(spark.read.text(path).select(F.col("_metadata.file_path").alias("log"), "value"))


def read_terms(path: str) -> list[str]:
    """SRC-22: the terms of a casing file, without its candidates; a small file that the driver reads."""
    import yaml

    with open(path, encoding="utf-8") as f:
        groups = (yaml.safe_load(f) or {}).get("terms", {})
    lists = groups.values() if isinstance(groups, dict) else [groups]
    return [str(t) for v in lists if isinstance(v, list) for t in v]


def wordlist(lines: DataFrame) -> DataFrame:
    """SRC-22: lines (value) as (word), lower case, each once."""
    return lines.select(F.lower(F.trim("value")).alias("word")).filter("word <> ''").distinct()


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """SRC-22: the same from a file."""
    return wordlist(spark.read.text(path))

"""Runs, turns and rosters: ordered operators over words and sentences of a recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MIN_WORDS, MIN_SECONDS = 4, 0.8


def islands(df: DataFrame, keys: list[str], order: list[str], label: str, out: str = "run") -> DataFrame:
    """Number the runs of equal labels of each key, from 1 in order."""
    w = W.partitionBy(*keys).orderBy(*order)
    new = F.when(F.lag(label).over(w).eqNullSafe(F.col(label)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(out, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def fold_short_runs(words: DataFrame, keys: list[str], order: list[str], label: str, start: Column, end: Column, min_words: int = MIN_WORDS, min_seconds: float = MIN_SECONDS) -> DataFrame:
    """WIN-01: each word's label after runs that are too short have gone to the run before, and its run after merging equal neighbours.

    A run is too short by its own words and seconds, before anything folds into it; the first run of a key stays. Adds
    `folded` (the label) and `run`.
    """
    runs = islands(words, keys, order, label, "_run0")
    size = W.partitionBy(*keys, "_run0")
    runs = runs.withColumn("_words", F.count("*").over(size)).withColumn("_secs", F.max(end).over(size) - F.min(start).over(size))
    keep = (F.col("_run0") == 1) | ((F.col("_words") >= min_words) & (F.col("_secs") >= min_seconds))
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    folded = runs.withColumn("folded", F.last(F.when(keep, F.col(label)), ignorenulls=True).over(w))
    return islands(folded, keys, order, "folded").drop("_run0", "_words", "_secs")


def split_segments(words: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """WIN-02: one segment per run: its words joined, from the first start to the last end. words: keys, order, run, folded, text, start, end."""
    rows = words.groupBy(*keys, "run", "folded").agg(F.min("start").alias("start"), F.max_by("end", F.struct(*order)).alias("end"), F.array_sort(F.collect_list(F.struct(*order, "text"))).alias("_w"))
    return rows.select(*keys, "run", F.col("folded").alias("speaker"), "start", "end", F.array_join(F.transform("_w", lambda x: x["text"]), " ").alias("text"))


def build_turns(sentences: DataFrame, keys: list[str], order: list[str], speaker: str, text: str, time: str) -> DataFrame:
    """WIN-03: consecutive sentences of one speaker as a turn; blank ones are skipped. Gives keys, turn, speaker, start, n, text."""
    said = sentences.filter(F.trim(text) != "")
    rows = islands(said, keys, order, speaker, "turn")
    made = rows.groupBy(*keys, "turn", speaker).agg(F.min_by(time, F.struct(*order)).alias("start"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))).alias("_s"))
    return made.select(*keys, "turn", F.col(speaker).alias("speaker"), "start", "n", F.array_join(F.transform("_s", lambda x: x["_t"]), " ").alias("text"))


def roster(turns: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-09, WIN-13: speakers in order of first appearance, with that time and the label `[speaker k]`."""
    first = turns.groupBy(*keys, "speaker").agg(F.min("turn").alias("first_turn"), F.min_by("start", "turn").alias("first_time"))
    k = F.row_number().over(W.partitionBy(*keys).orderBy("first_turn"))
    return first.select(*keys, "speaker", "first_turn", "first_time", F.concat(F.lit("[speaker "), k.cast("string"), F.lit("]")).alias("label"))


def forward_fill(lines: DataFrame, keys: list[str], order: list[str], marker: Column, out: str) -> DataFrame:
    """WIN-12: the last marker at or before each line; null before the first."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn(out, F.last(marker, ignorenulls=True).over(w))


def segment_stats(segments: DataFrame, key: str) -> DataFrame:
    """AGG-10: segments, words and voiced seconds."""
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return segments.groupBy(key).agg(F.count("*").alias("segments"), F.sum(words).cast("long").alias("words"), F.sum(F.col("end") - F.col("start")).alias("voiced"))


def render(turns: DataFrame, keys: list[str], lines: Column) -> DataFrame:
    """SCL-41: a transcript body: a speaker comment and the lines of each turn, turns set apart by an empty line."""
    block = F.concat(F.lit("<!-- speaker: "), F.col("speaker"), F.lit(" -->\n"), F.array_join(lines, "\n"))
    made = turns.select(*keys, "turn", block.alias("_b")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("turn", "_b"))).alias("_t"))
    return made.select(*keys, F.concat(F.array_join(F.transform("_t", lambda t: t["_b"]), "\n\n"), F.lit("\n")).alias("body"))


def word_line(words: Column) -> Column:
    """SCL-41: words with their start times, as {{t:S.SS}}word; `words` is an array of (text, start)."""
    return F.array_join(F.transform(words, lambda w: F.concat(F.lit("{{t:"), F.format_string("%.2f", w["start"]), F.lit("}}"), w["text"])), " ")


def sentence_starts(sentences: Column, words: Column, segment_start: Column) -> Column:
    """WIN-15: the time of each sentence of a segment: the start of its first word at or after a moving cursor, else the segment's.

    A match moves the cursor on by the sentence's words. `words` is an array of (text, start).
    """
    bare = lambda t: F.trim(F.lower(t), F.lit(".,!?;:'\""))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<double>)").alias("out"))

    def step(a: Column, s: Column) -> Column:
        parts = F.split(F.trim(s), r"\s+")
        places = F.filter(F.transform(words, lambda w, i: F.when((i >= a["at"]) & (bare(w["text"]) == bare(F.element_at(parts, 1))), i)), lambda i: i.isNotNull())
        hit = F.array_min(places)
        found = F.struct((hit + F.size(parts)).alias("at"), F.array_append(a["out"], F.get(words, hit)["start"].cast("double")).alias("out"))
        missed = F.struct(a["at"].alias("at"), F.array_append(a["out"], segment_start.cast("double")).alias("out"))
        return F.when(hit.isNotNull(), found).otherwise(missed)

    return F.aggregate(sentences, start, step)["out"]

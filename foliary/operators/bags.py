"""Bags of words: what a new version of a text lost, and how two texts overlap."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LINK, MARKER, squash

#: Fixed values of the comparison.
JAM_CHARS, REVIEWED_BOUND, FEWEST, MOST, SHARE = 5, 0, 5, 30, 0.1


def plain_words(text: Column) -> Column:
    """AGG-02: a body's words in lower case: a leading heading goes, annotations leave their alt and caption, links their text."""
    has = lambda c, *signs: functools.reduce(lambda a, b: a | b, [F.contains(c, F.lit(s)) for s in signs])
    t = F.regexp_replace(text, r"\A\s*#[^\n]*\n", "")
    notes = F.regexp_replace(t, r"(?m)^(?:<!--|-->|[a-z_]+:|  file: .*)\s*$", "")
    notes = F.regexp_replace(F.regexp_replace(notes, r"(?m)^  (?:alt|caption): ", ""), r"(?s)<!--.*?-->", "")
    notes = F.when(has(text, ":", "<!--", "-->"), notes).otherwise(t)  # most texts have nothing to take out
    bare = F.when(has(text, "{{", "]("), F.regexp_replace(F.regexp_replace(notes, MARKER, ""), LINK, "$1")).otherwise(notes)
    return F.filter(F.split(F.lower(bare), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_bag(docs: DataFrame, key: str, text: str) -> DataFrame:
    """AGG-02: (key, word, n)."""
    return docs.select(key, F.explode(plain_words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))


def words_gone(pairs: DataFrame, key: str, old: str, new: str, carried: str | None = None) -> DataFrame:
    """AGG-03: (key, word, n): words of the old text that the new one, with what is carried, holds nowhere; n as in the old text.

    A word counts as present if the new letters hold it inside another (five letters or more), if it is a word with a note
    number fused to it whose word is there, or if it is a Roman numeral.
    """
    bag = word_bag(pairs, key, old)
    held = [F.explode(plain_words(F.col(new)))] + ([F.explode(plain_words(F.col(carried)))] if carried else [])
    there = pairs.select(key, held[0].alias("word"))
    for h in held[1:]:
        there = there.union(pairs.select(key, h.alias("word")))
    there = there.distinct()
    lost = bag.join(there, [key, "word"], "left_anti").filter(~F.col("word").rlike("^[ivxlcdm]{1,8}$"))
    stems = lost.withColumn("stem", F.regexp_extract("word", r"^([a-z]{3,})\d{1,3}$", 1))
    lost = stems.join(there.withColumnRenamed("word", "stem"), [key, "stem"], "left_anti").drop("stem")
    letters = pairs.select(key, squash(F.regexp_replace(F.col(new), r"(?s)<!--.*?-->", "")).alias("_letters"))
    jammed = (F.length("word") >= JAM_CHARS) & F.contains(F.col("_letters"), F.col("word"))
    return lost.join(letters, key).filter(~F.coalesce(jammed, F.lit(False))).select(key, "word", "n")


def loss_allowed(total: Column, reviewed: Column) -> Column:
    """How many words a new version may lose: none of a reviewed text, else a tenth within 5 and 30."""
    tenth = F.floor(total * SHARE).cast("long")
    return F.when(reviewed, F.lit(REVIEWED_BOUND)).otherwise(F.least(F.lit(MOST), F.greatest(F.lit(FEWEST), tenth)))


def overlap(pairs: DataFrame, key: str, reference: str, candidate: str) -> DataFrame:
    """AGG-04: words of both, and precision and recall in per cent of the words that they share as multisets."""
    ref, cand = word_bag(pairs, key, reference), word_bag(pairs, key, candidate).withColumnRenamed("n", "m")
    both = ref.join(cand, [key, "word"], "full_outer").select(key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m"))
    sums = both.groupBy(key).agg(F.sum("n").alias("reference_words"), F.sum("m").alias("candidate_words"), F.sum(F.least("n", "m")).alias("shared"))
    pct = lambda of: F.round(F.col("shared") / F.greatest(F.col(of), F.lit(1)) * 100, 2)
    return sums.select(key, "reference_words", "candidate_words", "shared", pct("candidate_words").alias("precision_pct"), pct("reference_words").alias("recall_pct"))

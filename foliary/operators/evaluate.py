"""Scores of predicted labels against reviewed truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def time_key(start: Column) -> Column:
    """JOI-07: the text that joins a predicted word to a reviewed one; never a float."""
    return F.format_string("%.2f", start.cast("double"))


def match_truth(predicted: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """JOI-07: predicted rows (with `start`) and the reviewed `real` speaker of the same time."""
    return predicted.withColumn("_t", time_key(F.col("start"))).join(truth.select(*keys, F.col("t").alias("_t"), "real"), [*keys, "_t"]).drop("_t")


def label_mapping(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-05: each candidate label's most frequent real name; on ties the one that came first. pairs: keys, ord, label, real."""
    n = pairs.groupBy(*keys, "label", "real").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    best = n.groupBy(*keys, "label").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "real")).alias("x"))
    return best.select(*keys, "label", F.col("x.real").alias("mapped"))


def attribution_errors(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-06: word and turn errors in per cent after mapping labels. pairs: keys, ord, turn, label, real.

    A turn is wrong if its label's name is not the most frequent real name among its matched words, first one on ties.
    """
    mapped = pairs.join(label_mapping(pairs, keys), [*keys, "label"])
    words = mapped.groupBy(*keys).agg(F.count("*").alias("matched_words"), F.count_if(F.col("mapped") != F.col("real")).alias("wrong_words"), F.count_distinct("label").alias("labels"))
    per_turn = mapped.groupBy(*keys, "turn", "mapped", "real").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    top = per_turn.groupBy(*keys, "turn", "mapped").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "real")).alias("x"))
    turns = top.groupBy(*keys).agg(F.count("*").alias("turns"), F.count_if(F.col("mapped") != F.col("x.real")).alias("wrong_turns"))
    pct = lambda a, b: F.round(100 * F.col(a) / F.col(b), 2)
    return words.join(turns, keys).select(*keys, "matched_words", "wrong_words", pct("wrong_words", "matched_words").alias("word_error_pct"), "turns", "wrong_turns", pct("wrong_turns", "turns").alias("turn_error_pct"), "labels")


def decide(scores: DataFrame, strategy: str, challenger: str, incumbent: str) -> DataFrame:
    """AGG-07: sums over records by strategy, and adopt: the challenger has fewer wrong words and not more wrong turns."""
    sums = scores.groupBy(strategy).agg(*[F.sum(c).alias(c) for c in ("matched_words", "wrong_words", "turns", "wrong_turns")])
    flat = sums.groupBy().agg(*[F.sum(F.when(F.col(strategy) == s, F.col(c))).alias(f"{n}_{c}") for s, n in ((challenger, "new"), (incumbent, "old")) for c in ("wrong_words", "wrong_turns", "matched_words", "turns")])
    return flat.withColumn("adopt", (F.col("new_wrong_words") < F.col("old_wrong_words")) & (F.col("new_wrong_turns") <= F.col("old_wrong_turns")))


def micro_average(scores: DataFrame, record: str) -> DataFrame:
    """AGG-07: scores per record and a TOTAL row, in one pass."""
    sums = scores.rollup(record).agg(F.sum("matched_words").alias("matched_words"), F.sum("wrong_words").alias("wrong_words"))
    return sums.select(F.coalesce(F.col(record).cast("string"), F.lit("TOTAL")).alias("record"), "matched_words", "wrong_words", F.round(100 * F.col("wrong_words") / F.col("matched_words"), 2).alias("word_error_pct"))


def word_edit_distance(reference: Column, candidate: Column) -> Column:
    """SCL-23: Levenshtein distance of two word arrays, by a character for each distinct word of both.

    The characters are those beyond the basic plane, a surrogate pair each, so exact for 1,048,576 distinct words; no two
    pages hold more, since the distance of such would take the square of them in steps.
    """
    words = F.array_distinct(F.concat(reference, candidate))
    pair = lambda n: F.concat(F.hex(F.shiftright(n, 10) + 0xD800), F.hex(n.bitwiseAND(F.lit(0x3FF).cast("long")) + 0xDC00))
    coded = lambda a, vocab: F.decode(F.unhex(F.array_join(F.transform(a, lambda w: pair(F.array_position(vocab, w) - 1)), "")), "UTF-16BE")
    return F.element_at(F.transform(F.array(words), lambda v: F.levenshtein(coded(reference, v), coded(candidate, v))), 1)


def match_pages(reviewed: DataFrame, candidate: DataFrame, keys: list[str]) -> DataFrame:
    """JOI-13: pages of both sides; `side` is both, missing (only reviewed) or extra (only candidate)."""
    left = reviewed.select(*keys, F.col("text").alias("reference"), F.lit(True).alias("_l"))
    right = candidate.select(*keys, F.col("text").alias("candidate"), F.lit(True).alias("_r"))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "missing").otherwise("extra")
    return left.join(right, keys, "full_outer").select(*keys, "reference", "candidate", side.alias("side"))


def pair_one_to_one(old: DataFrame, new: DataFrame, doc: str, key: str, order: str) -> DataFrame:
    """JOI-09: the n-th stored row of a key meets the n-th fresh one; rows without a key meet by order; the rest stay alone.

    Gives doc, key, old_ord, new_ord with null on the side that has no partner.
    """
    nth = F.row_number().over(W.partitionBy(doc, key).orderBy(order))
    a = old.select(doc, F.coalesce(key, F.lit("")).alias(key), order).select(doc, key, nth.alias("_n"), F.col(order).alias("old_ord"))
    b = new.select(doc, F.coalesce(key, F.lit("")).alias(key), order).select(doc, key, nth.alias("_n"), F.col(order).alias("new_ord"))
    return a.join(b, [doc, key, "_n"], "full_outer").select(doc, key, "old_ord", "new_ord")

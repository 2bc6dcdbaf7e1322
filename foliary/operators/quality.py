"""Measures of text damage and structure, and OCR substitutions of proper nouns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip_annotations

#: Pairs of glyphs that scanners confuse, and the types that can carry chapters and page anchors.
CONFUSABLE = (
    ("c", "e"), ("c", "o"), ("e", "o"), ("e", "a"), ("a", "o"), ("i", "l"), ("i", "t"), ("i", "j"), ("l", "t"), ("l", "1"), ("i", "1"), ("t", "f"),
    ("m", "n"), ("n", "r"), ("h", "b"), ("h", "n"), ("n", "u"), ("o", "0"), ("u", "v"), ("v", "y"), ("s", "5"), ("g", "q"),
)
WITH_CHAPTERS, WITH_PAGES = ("ebook",), ("ebook", "pdf")
NOUN = r"(?<![\p{L}\p{N}_])([A-Z][a-zA-Z]{4,})(?![\p{L}\p{N}_])"


def measures(body: Column, source_type: Column) -> dict[str, Column]:
    """AGG-01: counts by name. A count that the type cannot carry is null; one that it can is a number, zero included."""
    count = lambda p: F.regexp_count(body, F.lit(p)).cast("long")
    damaged = strip_annotations(body)
    return {
        "replacement_chars": (F.length(damaged) - F.length(F.replace(damaged, F.lit("�"), F.lit("")))).cast("long"),
        "chapter_markers": F.when(source_type.isin(*WITH_CHAPTERS), count(r"<!--\s*chapter:")),
        "chapter_titles": F.when(source_type.isin(*WITH_CHAPTERS), count(r"<!--\s*chapter_title:")),
        "page_anchors": F.when(source_type.isin(*WITH_PAGES), count("printed_page:")),
    }


def proper_nouns(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, noun, n): proper nouns of five letters or more, counted per key."""
    found = F.regexp_extract_all(strip_annotations(F.col(text)), F.lit(NOUN), F.lit(1))
    nouns = docs.select(key, F.explode(found).alias("noun"))
    return nouns.groupBy(key, "noun").agg(F.count("*").alias("n"))


def is_ocr_variant(rare: Column, common: Column) -> Column:
    """JOI-08: equal length, one or two differing characters, each pair one that scanners confuse."""
    pairs = [p for a, b in CONFUSABLE for p in (a + b, b + a)]
    both = F.zip_with(F.split(rare, ""), F.split(common, ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    apart = F.filter(both, lambda p: p["a"] != p["b"])
    return (F.length(rare) == F.length(common)) & F.size(apart).between(1, 2) & F.forall(apart, lambda p: F.lower(F.concat(p["a"], p["b"])).isin(*pairs))


def _glyph_classes() -> dict[str, str]:
    """The least glyph that chains of confusable pairs lead to from each glyph."""
    to = {g: g for pair in CONFUSABLE for g in pair}
    for _ in to:
        for a, b in CONFUSABLE:
            to[a] = to[b] = min(to[a], to[b])
    return to


def _skeleton(noun: Column) -> Column:
    """The noun in lower case with each glyph as its class: the same for a noun and any OCR variant of it, so a join on it loses no pair."""
    classes = _glyph_classes()
    return F.translate(F.lower(noun), "".join(classes), "".join(classes.values()))


def substitutions(nouns: DataFrame, key: str, wordlist: DataFrame | None = None) -> DataFrame:
    """JOI-08: (key, noun, other): rare nouns (twice at most) that a more frequent one (twice at least) is an OCR variant of.

    One row for each rare noun, with the variant that comes first by name. Nouns of `wordlist` (word, lower case) are no
    candidates. The pairs meet on their skeletons, one row a noun.
    """
    rare = nouns.filter("n <= 2")
    if wordlist is not None:
        rare = rare.join(wordlist.select(F.col("word").alias("_w")), F.lower("noun") == F.col("_w"), "left_anti")
    left = rare.select(key, "noun", "n", _skeleton(F.col("noun")).alias("skeleton"))
    right = nouns.filter("n >= 2").select(key, F.col("noun").alias("other"), F.col("n").alias("m"), _skeleton(F.col("noun")).alias("skeleton"))
    hits = left.join(right, [key, "skeleton"]).filter((F.col("m") > F.col("n")) & is_ocr_variant(F.col("noun"), F.col("other")))
    return hits.groupBy(key, "noun").agg(F.min("other").alias("other"))


def substitution_score(nouns: DataFrame, flagged: DataFrame, key: str, examples: int = 6) -> DataFrame:
    """AGG-01, SRT-04: substitutions per 1000 proper nouns, and the first distinct examples by name."""
    totals = nouns.groupBy(key).agg(F.sum("n").alias("nouns"))
    found = flagged.groupBy(key).agg(F.count("*").alias("flagged"))
    # the first of each of many parts of a key, then of those: no task sorts all pairs of a key
    pairs = flagged.select(key, F.concat_ws("->", "noun", "other").alias("pair")).distinct()
    parts = W.partitionBy(key, F.pmod(F.xxhash64("pair"), F.lit(1024))).orderBy("pair")
    few = pairs.withColumn("rn", F.row_number().over(parts)).filter(F.col("rn") <= examples)
    shown = few.groupBy(key).agg(F.slice(F.array_sort(F.collect_list("pair")), 1, examples).alias("examples"))
    out = totals.join(found, key, "left").join(shown, key, "left")
    n = F.coalesce("flagged", F.lit(0)).cast("long")
    return out.select(key, F.col("nouns").cast("long").alias("nouns"), n.alias("flagged"), F.round(n / F.col("nouns") * 1000, 2).alias("substitution_score"), F.coalesce("examples", F.expr("cast(array() as array<string>)")).alias("examples"))

"""Interval joins on a timeline: points in intervals, overlaps and gaps.

Intervals are cut into time buckets, so both sides meet in an equi-join on (key, class, bucket) whose work follows the
overlaps, not the product of a key's rows. A class is a width of buckets: an interval belongs to the first whose buckets
it fills with REACH at most, so that none, however wrong its end, makes more rows than that; what lies beyond all classes
has one bucket. It stands under its own class, and looks for others under the wider ones. The least width is a parameter;
a pair that shares several buckets is kept in the first. Rows with an end that is null, infinite or no number are no
intervals, and such points are no points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets that an interval fills at most, how much wider the next class is, and the number of classes but for the last.
REACH, WIDER, CLASSES = 64, 4096, 2


def _finite(*cols: str) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & (F.abs(F.col(c)) < F.lit(float("inf")))  # no number is greater than any
    return ok


def _bucket(x: Column, width: float, cls: int) -> Column:
    return F.floor(x / F.lit(width * WIDER**cls)).cast("long") if cls < CLASSES else F.lit(0).cast("long")


def spread(df: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """A row for each bucket that [start, end] touches in its own class (_home) and the wider ones: _c the class, _b the bucket, _b0 the first one."""
    lo, hi = F.col(start), F.greatest(F.col(start), F.col(end))
    own = F.lit(CLASSES)
    for c in range(CLASSES - 1, -1, -1):
        own = F.when(hi - lo <= width * WIDER**c * (REACH - 1), F.lit(c)).otherwise(own)
    at = F.array(*[F.struct(F.lit(c).alias("c"), _bucket(lo, width, c).alias("lo"), _bucket(hi, width, c).alias("hi")) for c in range(CLASSES + 1)])
    out = df.filter(_finite(start, end)).withColumn("_own", own).withColumn("_x", F.explode(F.filter(at, lambda x: x["c"] >= F.col("_own"))))
    out = out.withColumn("_b", F.explode(F.sequence("_x.lo", "_x.hi")))
    return out.withColumn("_c", F.col("_x.c")).withColumn("_b0", F.col("_x.lo")).withColumn("_home", F.col("_c") == F.col("_own")).drop("_own", "_x")


def dotted(df: DataFrame, t: str, width: float) -> DataFrame:
    """A row for each class: _c the class and _b the bucket of a point."""
    at = F.array(*[F.struct(F.lit(c).alias("c"), _bucket(F.col(t), width, c).alias("b")) for c in range(CLASSES + 1)])
    return df.withColumn("_x", F.explode(at)).select("*", F.col("_x.c").alias("_c"), F.col("_x.b").alias("_b")).drop("_x")


def point_in_interval(points: DataFrame, tracks: DataFrame, key: str, width: float = 60.0) -> DataFrame:
    """JOI-04: the speaker of each point: of the first track by `ord` that holds `t` (ends included), else of the nearest.

    points: key, point, t. tracks: key, ord, start, end, speaker. Gives key, point, speaker and inside; keys without tracks
    give nothing. Nearest tracks come from two ordered passes over the timeline, so no point meets all tracks of its key.
    Ties go to the lower ord.
    """
    points, tracks = points.select(key, "point", "t").filter(_finite("t")), tracks.filter(_finite("start", "end"))
    near = dotted(points, "t", width).join(spread(tracks, "start", "end", width).filter("_home"), [key, "_c", "_b"])
    held = near.filter(F.col("t").between(F.col("start"), F.col("end"))).groupBy(key, "point").agg(F.min_by("speaker", "ord").alias("speaker"))
    out = points.select(key, "point", "t").join(held, [key, "point"], "left")
    away = out.filter("speaker is null").select(key, "point", "t")
    end = tracks.groupBy(key, "end").agg(F.min(F.struct("ord", "speaker")).alias("s"))
    start = tracks.groupBy(key, "start").agg(F.min(F.struct("ord", "speaker")).alias("s"))
    null = F.lit(None).cast(away.schema["point"].dataType)
    line = away.select(key, F.col("t").alias("at"), "point", F.lit(None).cast("struct<at:double,ord:bigint,speaker:string>").alias("e"), F.lit(None).cast("struct<at:double,ord:bigint,speaker:string>").alias("b"), F.lit(1).alias("kind"))
    mark = lambda s: F.struct(F.col("at").cast("double").alias("at"), s["ord"].cast("long").alias("ord"), s["speaker"].alias("speaker"))
    empty = F.lit(None).cast("struct<at:double,ord:bigint,speaker:string>")
    ends = end.select(key, F.col("end").alias("at"), null.alias("point"), "s").select(key, "at", "point", mark(F.col("s")).alias("e"), empty.alias("b"), F.lit(0).alias("kind"))
    starts = start.select(key, F.col("start").alias("at"), null.alias("point"), "s").select(key, "at", "point", empty.alias("e"), mark(F.col("s")).alias("b"), F.lit(2).alias("kind"))
    all_ = line.unionByName(ends).unionByName(starts)
    order = W.partitionBy(key).orderBy("at", "kind")
    seen = all_.withColumn("e", F.last("e", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn("b", F.first("b", ignorenulls=True).over(order.rowsBetween(0, W.unboundedFollowing)))
    gap = lambda c, d: F.when(F.col(c).isNotNull(), F.struct(d.alias("gap"), F.col(c)["ord"].alias("ord"), F.col(c)["speaker"].alias("speaker")))
    picked = seen.filter("kind = 1").select(key, "point", F.array_min(F.array_compact(F.array(gap("e", F.col("at") - F.col("e.at")), gap("b", F.col("b.at") - F.col("at"))))).alias("n"))
    close = picked.filter("n is not null").select(key, "point", F.col("n.speaker").alias("nearest"))
    both = out.join(close, [key, "point"], "left")
    return both.select(key, "point", F.coalesce("speaker", "nearest").alias("speaker"), F.col("speaker").isNotNull().alias("inside")).filter("speaker is not null")


def overlap_majority(spans: DataFrame, tracks: DataFrame, key: str, width: float = 60.0) -> DataFrame:
    """JOI-05: the speaker with most overlap with each span; on ties the one of the lowest track; spans without overlap are left to JOI-04.

    spans: key, span, start, end. tracks: key, ord, start, end, speaker. Gives key, span, speaker, overlap.
    """
    left = spread(spans.select(key, "span", "start", "end"), "start", "end", width).withColumnRenamed("_b0", "_s0")
    right = spread(tracks, "start", "end", width).select(key, "_c", "_b", F.col("_home").alias("_there"), F.col("_b0").alias("_t0"), "ord", "speaker", F.col("start").alias("ts"), F.col("end").alias("te"))
    pairs = left.join(right, [key, "_c", "_b"]).filter((F.col("_home") | F.col("_there")) & (F.col("_b") == F.greatest("_s0", "_t0")) & (F.col("start") < F.col("te")) & (F.col("ts") < F.col("end")))
    sums = pairs.groupBy(key, "span", "speaker").agg(F.sum(F.least("end", "te") - F.greatest("start", "ts")).alias("overlap"), F.min("ord").alias("ord"))
    best = sums.groupBy(key, "span").agg(F.max(F.struct("overlap", (-F.col("ord")).alias("o"), "speaker")).alias("x"))
    return best.select(key, "span", "x.speaker", "x.overlap")


def unheard_gaps(segments: DataFrame, tracks: DataFrame, key: str, min_gap: float = 3.0, min_speech: float = 1.5, width: float = 60.0) -> DataFrame:
    """JOI-06: (key, gaps, seconds): pauses of `min_gap` between segments in which tracks hold `min_speech` of speech.

    segments: key, ord, start, end. Keys whose segments leave no such pause have a row of zeros.
    """
    w = W.partitionBy(key).orderBy("ord")
    gaps = segments.select(key, "ord", F.col("end").alias("lo"), F.lead("start").over(w).alias("hi")).filter(F.col("hi") - F.col("lo") >= min_gap)
    left = spread(gaps, "lo", "hi", width).withColumnRenamed("_b0", "_s0")
    right = spread(tracks, "start", "end", width).select(key, "_c", "_b", F.col("_home").alias("_there"), F.col("_b0").alias("_t0"), F.col("start").alias("ts"), F.col("end").alias("te"))
    pairs = left.join(right, [key, "_c", "_b"]).filter((F.col("_home") | F.col("_there")) & (F.col("_b") == F.greatest("_s0", "_t0")))
    speech = pairs.groupBy(key, "ord").agg(F.sum(F.greatest(F.lit(0.0), F.least("te", "hi") - F.greatest("ts", "lo"))).alias("speech")).filter(F.col("speech") >= min_speech)
    found = speech.groupBy(key).agg(F.count("*").alias("gaps"), F.sum("speech").alias("seconds"))
    return segments.select(key).distinct().join(found, key, "left").select(key, F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), F.coalesce("seconds", F.lit(0.0)).alias("seconds"))

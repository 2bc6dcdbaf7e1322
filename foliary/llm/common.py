"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word is a run of characters that are neither a space nor an ASCII control blank.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir. A local master (tests) may do without: it gets a new one.

    Elsewhere a folder of one machine would hold each executor's part alone, so a missing setting is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliary-"))
    return sc.getCheckpointDir().rstrip("/")


#: Tables written while `passing` is open, a list for each level of it.
_passing: list[list[DataFrame]] = []


def materialize(df: DataFrame, tag: str, passes: bool = True) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    Inside `passing` the table goes with it, unless `passes` is false.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/foliary-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._foliary_path = path
    if _passing and passes:
        _passing[-1].append(out)
    return out


def forget(df: DataFrame) -> None:
    """Delete the table that materialize wrote for `df`, if it is still there; nothing that is still to be computed may need it."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._foliary_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing() -> Iterator[None]:
    """Delete at its end the tables that operators wrote inside; what comes of them must have been written by then."""
    _passing.append([])
    try:
        yield
    finally:
        for df in _passing.pop():
            forget(df)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row; a plain reference inside a lambda would be evaluated per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def placed(df: DataFrame) -> DataFrame:
    """`df` with _file and _at, which give the order that its rows were written in: part of the table and place in the part."""
    try:
        name = F.col("_metadata.file_name")
        part = F.concat(F.lpad(F.regexp_extract(name, r"part-(\d+)", 1), 12, "0"), name)
        return df.select("*", part.alias("_file"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:  # no table: the order of the rows as they are
        row = F.monotonically_increasing_id()
        return df.select("*", F.format_string("%012d", F.shiftright(row, 33)).alias("_file"), row.alias("_at"))


def spread(*cols: Column) -> Column:
    """A number from 0 below 2^60 that looks random, from the values of `cols` as text (nulls left out): 15 hex digits of their MD5."""
    digest = F.md5(F.concat_ws("\x1f", *[c.cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ranked(df: DataFrame, group: str, order: list[Column], rows_per_cell: int = 4096, cell: Column | None = None) -> DataFrame:
    """Add `group_rank` (0-based, dense inside each value of `group`) without sorting a whole group in one task.

    The first of `order` is a `spread` number; a group of n rows is dealt by its ranges over ceil(n / rows_per_cell) cells,
    or by `cell`, whose values sort like `order`. Ranks inside a cell come from a window over that cell and start at the
    sum of the sizes of the cells before it, so they are those of the whole group. Null groups are a group of their own.
    Whole rows move once, by group and cell. The caller bounds the number of groups, whose sizes are broadcast.
    """
    named = lambda c: F.concat(F.when(c.isNull(), "null").otherwise("="), F.coalesce(c.cast("string"), F.lit("")))
    dealt = df.withColumn("_g", named(F.col(group)))
    if cell is None:
        sizes = df.groupBy(named(F.col(group)).alias("_h")).agg(F.expr(f"({1 << 60} + ceil(count(*) / {rows_per_cell}) - 1) div ceil(count(*) / {rows_per_cell})").alias("_w"))
        dealt = dealt.join(F.broadcast(sizes), F.col("_g") == F.col("_h")).drop("_h")
        dealt = dealt.withColumn("_at", order[0]).withColumn("_cell", F.expr("_at div _w")).drop("_w")
        order = [F.col("_at"), *order[1:]]
    else:
        dealt = dealt.withColumn("_cell", cell)
    cells = dealt.groupBy("_g", "_cell").agg(F.count("*").alias("_n"))
    before = W.partitionBy("_g").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select("_g", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out = dealt.withColumn("_rn", F.row_number().over(W.partitionBy("_g", "_cell").orderBy(*order)) - 1).join(starts, ["_g", "_cell"])
    return out.withColumn("group_rank", F.col("_start") + F.col("_rn")).drop("_g", "_cell", "_rn", "_start", *(["_at"] if cell is None else []))


def sample_hash(salt: str, *cols: Column) -> Column:
    """A number from 0 below 2^63 by which a bounded sample takes the smallest."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), *cols), 1)


def sample_limit(k: int, n: int) -> int:
    """Below this lie about 2k + 64 of n hashes, so the k smallest too but for odds beyond 10^-12: no share that could round to none."""
    return min(2**63 - 1, (2 * k + 64) * 2**63 // max(n, 1))


#: Bits of one row of a sieve (those of Spark's bitmap functions), and the most bits of a whole one: 16 MB.
SIEVE_ROW, SIEVE_BITS = 32_768, 27


def sieve(hashes: DataFrame, n: int) -> DataFrame:
    """Bits of the hashes (one long column, `hash`, n of them): rows (_sieve, _bits), 2^SIEVE_BITS bits at most, so a broadcast bears it.

    About 16 bits a hash; beyond 2^SIEVE_BITS / 16 hashes more and more others pass, which costs time and no row.
    """
    bits = min(SIEVE_BITS, max(15, (16 * max(n, 1) - 1).bit_length()))
    at = hashes.select(_slot(F.col("hash"), bits).alias("x"))
    made = at.groupBy(F.expr("bitmap_bucket_number(x + 1)").alias("_sieve")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(x + 1))").alias("_bits"))
    made._foliary_bits = bits
    return made


def _slot(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits)


def sifted(df: DataFrame, h: Column, made: DataFrame) -> DataFrame:
    """`df` with the boolean _passes: true wherever the sieve has the hash `h`, and false for nearly all others."""
    x = _slot(h, made._foliary_bits)
    out = df.withColumn("_x", x).withColumn("_b", F.expr(f"_x div {SIEVE_ROW} + 1"))
    out = out.join(F.broadcast(made), F.col("_b") == F.col("_sieve"), "left")  # 4 KB a row, 2^12 rows at most
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_x % {SIEVE_ROW} div 8 + 1 as int), 1)), 16, 10) as int)")
    hit = F.expr("1").cast("int").bitwiseAND(F.expr("shiftright(_byte, cast(_x % 8 as int))")) == 1
    out = out.withColumn("_byte", byte).withColumn("_passes", F.coalesce(hit, F.lit(False)))
    return out.drop("_x", "_b", "_sieve", "_bits", "_byte")

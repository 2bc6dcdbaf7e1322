"""Exact deduplication with an extendible-hash index in files of the shared folder.

Every row is logged once as (doc_id, row, key, SHA-256); the key is 60 bits of the hash. Texts whose key no other row has
are alone: a narrow aggregate of the log by key finds the keys that several rows have, and a bitmap of them keeps the
others' texts from any shuffle. What remains is indexed. The directory is a table of key prefixes: a bucket whose texts
exceed `bucket_bytes` is split on one more bit, and the directory doubles when that bucket was already as deep as the
directory. Owner tasks each take buckets, which are ranges of keys, in key order: they chain the entries of one key after
another and compare their bytes. The chains alone say which texts are equal, how often each stands and which row stays.
Each task sends one text a group, so a text that a third of all rows repeat reaches its owner once a task.

An owner holds the chain of one key at a time (different texts share 60 bits practically never), so a bucket needs no room
in memory however large it is; what the directory bounds is the work of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sieve, sifted

#: Fewest bits of the prefixes that buckets are made of; the driver holds their weights, and more only as the bytes need.
PREFIX_BITS = 12
#: Rows that a text has to have, of all rows and at all, before its group is joined by broadcast and not by shuffle.
HOT_SHARE, HOT_ROWS = 1000, 100


def directory(weights: dict[int, int], bucket_bytes: int, prefix_bits: int = PREFIX_BITS) -> tuple[int, list[int]]:
    """(global depth, bucket of each directory slot) after splitting overfull buckets; weights: bytes by key prefix.

    A bucket is (prefix, local depth); its number is the place of its first key prefix. A prefix that alone exceeds the
    bound stays one bucket of full depth: its owner has more to do, not more to hold.
    """
    total = [0]
    for k in range(1 << prefix_bits):
        total.append(total[-1] + weights.get(k, 0))
    depth, buckets, work = 0, [], [(0, 0)]
    while work:
        prefix, local = work.pop()
        lo, hi = prefix << (prefix_bits - local), (prefix + 1) << (prefix_bits - local)
        if total[hi] - total[lo] > bucket_bytes and local < prefix_bits:
            depth = max(depth, local + 1)  # the directory doubles
            work += [(2 * prefix + 1, local + 1), (2 * prefix, local + 1)]
        else:
            buckets.append((lo, hi))
    slots = []
    for number, (lo, hi) in enumerate(sorted(buckets)):
        slots += [number] * ((hi - lo) >> (prefix_bits - depth))
    return depth, slots


def _entries(batches: Iterator[pa.RecordBatch], flush_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, doc_id, n) as (key, sha, text, doc_id, n), those with equal bytes summed up as far as `flush_bytes` hold them."""
    chains: dict[int, list[list]] = {}
    held = 0

    def flushed() -> pa.RecordBatch:
        rows = [(k, *e) for k, chain in chains.items() for e in chain]
        return _batch([(k, hashlib.sha256(t).hexdigest(), t, d, n) for k, t, d, n in rows])

    for batch in batches:
        for key, text, doc_id, n in zip(*(c.to_pylist() for c in batch.columns)):
            if _chained(chains.setdefault(key, []), text, doc_id, n):
                held += len(text) + 200
            if held > flush_bytes:
                yield flushed()
                chains.clear()
                held = 0
    if chains:
        yield flushed()


def _chained(chain: list[list], text: bytes, doc_id: int | None, n: int) -> bool:
    """Add an entry to the chain of its key: to the text with the same bytes, or as a new one (then true). The largest doc_id stays; a null one is less than any other."""
    for e in chain:
        if e[0] == text:
            e[1] = max((x for x in (e[1], doc_id) if x is not None), default=None)
            e[2] += n
            return False
    chain.append([text, doc_id, n])
    return True


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "sha": pa.string(), "text": pa.large_binary(), "doc_id": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, kinds.values())], list(kinds))


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (key, sha, keep_id, n) for each text of the owner's buckets that repeats; entries come in order of their keys."""
    last, chain, out = None, [], []

    def sent() -> Iterator[pa.RecordBatch]:
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "sha", "keep_id", "n"])

    def closed() -> None:
        out.extend((last, hashlib.sha256(t).hexdigest(), d, n) for t, d, n in chain if n > 1)

    for batch in batches:
        for i in range(batch.num_rows):  # one entry at a time: texts of other keys stay where they are
            key, text, doc_id, n = (c[i].as_py() for c in batch.columns)
            if key != last:
                closed()
                last, chain = key, []
            _chained(chain, text, doc_id, n)
        if len(out) > 10_000:
            yield from sent()
            out.clear()
    closed()
    yield from sent()


def _keyed(sha: str, key_bits: int) -> Column:
    """The first bits of the hash: the index key. Fewer bits make collisions, which the chains sort out."""
    return F.shiftright(F.conv(F.substring(sha, 1, 15), 16, 10).cast("long"), 60 - key_bits)


def index(docs: DataFrame, key_bits: int = 60, bucket_bytes: int = 4 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(log, several, repeats): (doc_id, row, key, sha) of every row; the keys that several rows have; and (key, sha, keep_id, n) of every text that repeats."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.sha2(text, 256).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes"))
    log = materialize(raw.withColumn("key", _keyed("sha", key_bits)), "dedup-log")
    several = log.groupBy("key").agg(F.count("*").alias("n"), F.max("n_bytes").alias("n_bytes")).filter("n > 1").select("key", "n_bytes")
    several = materialize(several, "dedup-keys")
    n_keys, n_bytes = several.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    bucket_bytes = max(bucket_bytes, n_bytes >> 16)  # 2^16 buckets or so at most
    bits = min(key_bits, max(PREFIX_BITS, (n_bytes // bucket_bytes).bit_length() + 3))
    slot = lambda depth: F.shiftright("key", key_bits - depth).cast("int")
    weights = {r[0]: r[1] for r in several.groupBy(slot(bits)).agg(F.sum("n_bytes")).collect()}  # 2^20 rows at most
    depth, slots = directory(weights, bucket_bytes, bits)
    book = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(",".join(map(str, slots))), ",")).alias("_slot", "_bucket"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", _keyed(F.sha2("text", 256), key_bits))
    rows = sifted(rows, _spot(key_bits), sieve(several.select(_spot(key_bits).alias("hash")), n_keys)).filter("_passes")
    rows = rows.select("key", "text", "doc_id", F.lit(1).cast("long").alias("n"))
    schema = "key long, sha string, text binary, doc_id long, n long"
    sent = rows.mapInArrow(partial(_entries, flush_bytes=32 << 20), schema)  # one text a task and group, before any shuffle
    sent = sent.join(F.broadcast(book), slot(depth) == F.col("_slot"))  # 2^20 rows at most
    owned = sent.repartition("_bucket").sortWithinPartitions("key", "sha").select("key", "text", "doc_id", "n").mapInArrow(_owned, "key long, sha string, keep_id long, n long")
    return log, several, materialize(owned, "dedup-index")


def _spot(key_bits: int) -> Column:
    """The key as a hash for the sieve: its bits first."""
    return F.shiftleft("key", 64 - key_bits)


def _hot(log: DataFrame, repeats: DataFrame) -> DataFrame:
    """The texts that more than one row in HOT_SHARE repeats: HOT_SHARE rows at most."""
    return repeats.filter((F.col("n") > HOT_ROWS) & (F.col("n") * HOT_SHARE > log.count()))


def _fates(log: DataFrame, repeats: DataFrame) -> DataFrame:
    """The log with keep_id and n of its text, null if it stands alone. A text that many rows repeat is found by broadcast, and its rows stay where they are."""
    hot = _hot(log, repeats).select(F.col("sha").alias("_hot"), F.col("keep_id").alias("_keep"), F.col("n").alias("_n"))
    out = log.join(F.broadcast(hot), F.col("sha") == F.col("_hot"), "left")  # HOT_SHARE rows at most
    own = F.when(F.col("_hot").isNull(), F.col("key")).otherwise(-1 - F.pmod(F.col("row"), F.lit(1 << 20)))  # no key is negative
    rest = repeats.select(F.col("key").alias("_k"), F.col("sha").alias("_s"), "keep_id", "n")
    out = out.withColumn("_own", own).join(rest, (F.col("_own") == F.col("_k")) & (F.col("sha") == F.col("_s")), "left")
    return out.select("doc_id", "row", "sha", F.coalesce("_keep", "keep_id").alias("keep_id"), F.coalesce("_n", "n").alias("n"))


def exact_groups(docs: DataFrame, key_bits: int = 60, bucket_bytes: int = 4 << 20) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, text_sha256) for each row of `docs`.

    Texts are equal if their bytes are, however long; a null text counts as empty. Of a group the row with the largest
    doc_id stays, one row even if rows with that doc_id repeat; null ids stay only in groups without other ids. An empty
    table gives an empty result. Other columns, whatever their names, are ignored.
    """
    log, _, repeats = index(docs, key_bits, bucket_bytes)
    fates = materialize(_fates(log, repeats), "dedup-fates")
    alone, head = F.col("n").isNull(), F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # one row of each group stays: the last of those with its doc_id
    last = fates.filter(~alone & head).groupBy("sha").agg(F.max("row").alias("_row"), F.count("*").alias("_many")).filter("_many > 1")
    last = materialize(last.select(F.col("sha").alias("_sha"), "_row"), "dedup-ties")
    tied = fates.filter(~alone & head).join(last, F.col("sha") == F.col("_sha"), "left")
    rest = fates.filter(alone | ~head).withColumn("_row", F.lit(None).cast("long"))
    out = rest.unionByName(tied.drop("_sha"))
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (head & F.coalesce(F.col("row") == F.col("_row"), F.lit(True)))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, all columns as they are: of each text the row with the largest doc_id.

    Rows that agree in text (null is empty) and doc_id are told apart by nothing that a reader could name: one of them
    stays. Rows whose text stands alone, by the bitmap of keys, are passed on without a shuffle, a join or a look at a chain.
    """
    log, several, repeats = index(docs)
    name = lambda df: df.select(F.col("sha").alias("_of"), F.col("keep_id").alias("_keep"))
    copy = (F.col("_sha") == F.col("_of")) & ~F.col("_id").eqNullSafe(F.col("_keep"))
    made = sieve(several.select(_spot(60).alias("hash")), several.count())
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("_sha"))
    rows = sifted(rows.withColumn("key", _keyed("_sha", 60)), _spot(60), made)
    some = rows.filter("_passes").select("_row", "_id", "_sha")
    some = some.join(F.broadcast(name(_hot(log, repeats))), copy, "left_anti")  # HOT_SHARE rows at most; their copies go before the shuffle
    kept = some.join(name(repeats), copy, "left_anti").dropDuplicates(["_sha", "_id"])
    out = rows.filter("not _passes").select("_row").unionByName(kept.select("_row"))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

"""Packing documents into padded batches by optimal length buckets.

The histogram of all lengths goes to the driver: a row for each length that occurs, of which a corpus of W words has
sqrt(2 W) at most (6 million for 2e13 words). Dynamic programming over it chooses the bucket boundaries that need the
least padding; leftmost best predecessors only rise along the lengths, so each bucket costs n log n. Batches of at most
`budget` padded words form inside each bucket. Lengths are words, not tokens of any model: counting those takes some 370
CPU seconds a GB by op4, which is the reader's to spend (`pack` takes any length).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, placed, ranked, spread


def words(text: Column) -> Column:
    """Length in words; a null text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))), F.lit(0)).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """min(buckets, lengths) of the ascending `lengths`, the last included, that minimise sum(count * (boundary - length)); of equal choices the one with the least last but one, and so on."""
    n = len(lengths)
    if not n:
        return []
    wide = int(counts.sum()) * int(lengths[-1]) >= 2**62
    size, total = lengths.astype(object if wide else np.int64), np.concatenate([[0], np.cumsum(counts.astype(np.int64))]).astype(object if wide else np.int64)
    best, back = np.concatenate([[0], total[1:] * size]), []  # least cost, up to a constant, of the first j lengths in k buckets
    for k in range(2, min(buckets, n) + 1):
        now, came = best.copy(), np.zeros(n + 1, np.int64)
        # middles of all ranges at once; the predecessors of a range lie between those of its ends
        lo, hi, first, last = (np.array([x]) for x in (k, n, k - 1, n - 1))
        while len(lo):
            mid = (lo + hi) // 2
            many = np.minimum(last, mid - 1) - first + 1
            start = np.cumsum(many) - many
            i = np.arange(many.sum()) - np.repeat(start - first, many)
            j = np.repeat(mid, many)
            cost = best[i] + (total[j] - total[i]) * size[j - 1]
            least = np.minimum.reduceat(cost, start)
            hit = np.flatnonzero(cost == np.repeat(least, many))
            pick = i[hit[np.searchsorted(hit, start)]]
            now[mid], came[mid] = least, pick
            lo, hi, first, last = (np.concatenate(x) for x in ((lo, mid + 1), (mid - 1, hi), (first, pick), (pick, last)))
            some = lo <= hi
            lo, hi, first, last = lo[some], hi[some], first[some], last[some]
        best = now
        back.append(came)
    j, out = n, [int(lengths[-1])]
    for came in reversed(back):
        j = int(came[j])
        out.append(int(lengths[j - 1]))
    return out[::-1]


def pack(df: DataFrame, length: Column, order: list[str], buckets: int = 16, budget: int = 65_536, cell: str | None = None) -> DataFrame:
    """`df` with n_words, bucket_len, batch_id and batch_pos (columns of these names are replaced), a row for each of its rows.

    A row is padded to bucket_len, the least boundary that holds its n_words; a batch holds max(1, budget // bucket_len)
    rows of one bucket (the last may hold fewer), so only a row longer than the budget has a batch above it, to itself.
    batch_id is `bucket_len:number`. Length 0 or null is padded like 1. Rows are
    batched by `spread` of `order`, or in its own order if `cell`, a column that sorts like it, deals them into tasks. Rows
    that agree in `order`, as repeated rows do, are batched in any order; null ids are ids; an empty table gives an empty
    result. Columns of other names are carried as they are.
    """
    lengths = df.select(F.struct(*df.columns).alias("_row"), F.coalesce(length, F.lit(0)).cast("long").alias("_n"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(cell or order[0]).alias("_in"))
    lengths = materialize(lengths, "lengths")  # every pass below needs them; texts are counted once
    hist = lengths.groupBy(F.greatest("_n", F.lit(1)).alias("top")).count().orderBy("top").collect()  # a row per length
    edges = boundaries(np.array([r[0] for r in hist]), np.array([r[1] for r in hist]), buckets)
    cuts = F.array(*[F.lit(e).cast("long") for e in edges or [1]])
    top = lengths.withColumn("_len", F.element_at(F.filter(cuts, lambda e: e >= F.greatest(F.col("_n"), F.lit(1))), 1))
    at = [F.col(f"_o{i}") for i in range(len(order))]
    out = ranked(top, "_len", at if cell else [spread(*at), *at], cell=F.col("_in") if cell else None)
    rows = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("_len")).cast("long"))
    out = out.withColumn("_rows", rows)
    kept = [c for c in df.columns if c not in ("n_words", "bucket_len", "batch_id", "batch_pos")]
    return out.select(
        *[F.col("_row")[c].alias(c) for c in kept],
        F.col("_n").alias("n_words"),
        F.col("_len").alias("bucket_len"),
        F.concat_ws(":", "_len", F.expr("group_rank div _rows")).alias("batch_id"),
        F.expr("cast(group_rank % _rows as int)").alias("batch_pos"),
    )


def in_batches(docs: DataFrame, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """Each document's place in the batches, by words, in the order that the documents were written in: doc_id, n_words, bucket_len, batch_id, batch_pos.

    Null and empty texts have length 0, repeated rows repeat, null ids stay null; an empty table gives an empty result.
    """
    rows = placed(docs.select("doc_id", "text")).select("doc_id", "_file", "_at", words(F.col("text")).alias("n"))
    return pack(rows, F.col("n"), ["_at"], buckets, budget, "_file").select("doc_id", "n_words", "bucket_len", "batch_id", "batch_pos")

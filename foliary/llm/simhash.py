"""Near-duplicate detection on 64-bit SimHash fingerprints with a Gray-order hierarchical index.

Fingerprints are distinct first, so copies never meet in the index. Two fingerprints at `radius` or fewer differing bits
agree on at least two of radius + 2 equal blocks, so each is routed once per pair of blocks under the bits of that pair:
that shared masked pattern is the top node of an index tree. A group above `max_group` is routed again under further
shared bits until it is small; the deepest masks leave so few free bits that no group can stay large. Inside a task the
groups lie in Gray order, eight neighbours become a node that holds the bits on which they agree, eight such nodes the
next, and a search adds up differing bits from the top node down, dropping a whole node once they exceed the radius.
Only a spanning tree of each group's links leaves the task; components are then joined by star rounds.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sieve, sifted
from .components import connected_components

FAN = 8
_BLOCK = 1 << 16
#: Rows that a fingerprint has to have, of all rows and at all, before it is joined by broadcast and not by shuffle.
HOT_SHARE, HOT_ROWS = 1000, 100


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """SimHash of the XXH64 (seed 42) hashes of all word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    hashes, ones = map(partial(xxhash.xxh64_intdigest, seed=42), shingles), np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        h = np.fromiter(itertools.islice(hashes, _BLOCK), np.uint64, min(_BLOCK, n - i))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long. A null text counts as empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(x.as_py()) for x in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(each, "doc_id long, fp long")


def _masks(radius: int, levels: int) -> list[list[int]]:
    """Masks of the routes at each level: pairs of blocks, then each with one of radius + 1 parts of the free bits."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [sum(1 << k for k in range(a, b)) for a, b in itertools.pairwise(cuts)]
    out = [[a | b for a, b in itertools.combinations(blocks, 2)]]
    for _ in range(levels):
        deeper = []
        for m in out[-1]:
            free = [k for k in range(64) if not m >> k & 1]
            deeper += [m | sum(1 << k for k in free[i :: radius + 1]) for i in range(radius + 1)]
        out.append(deeper)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(fp: Column) -> Column:
    """Place of fp in the Gray sequence, as a long whose signed order is that of the rank."""
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class GrayForest:
    """Trees over the codes of groups that lie one after another, each group in Gray order."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        full = np.full(len(codes), ~np.uint64(0))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(codes, full, np.arange(len(codes)))]  # pattern, own mask, first child
        pattern, mask = codes, full
        while len(group) > len(np.unique(group)):
            start = np.r_[True, group[1:] != group[:-1]]
            place = np.arange(len(group)) - np.maximum.accumulate(np.where(start, np.arange(len(group)), 0))
            first = np.flatnonzero(place % FAN == 0)
            parent = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(group)]))
            unlike = np.bitwise_or.reduceat((pattern ^ pattern[first][parent]) | ~mask, first)
            up_mask = ~unlike
            p, _, f = self.levels[-1]
            self.levels[-1] = (p, mask & unlike[parent], f)  # what the parent holds is counted there
            pattern, mask, group = pattern[first] & up_mask, up_mask, group[first]
            self.levels.append((pattern, mask, np.r_[first, len(parent)]))
        self.roots = group

    def search(self, query: np.ndarray, tree: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) places at `radius` or fewer differing bits; tree: the root's place for each query."""
        for a in range(0, len(query), 1 << 14):
            q, node = np.arange(a, min(a + (1 << 14), len(query))), tree[a : a + (1 << 14)]
            acc = np.zeros(len(q), np.uint8)
            for depth in range(len(self.levels) - 1, -1, -1):
                pattern, mask, first = self.levels[depth]
                acc = acc + np.bitwise_count((query[q] ^ pattern[node]) & mask[node])
                near = acc <= radius
                q, node, acc = q[near], node[near], acc[near]
                if depth:
                    n = first[node + 1] - first[node]
                    child = np.repeat(first[node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                    q, node, acc = np.repeat(q, n), child, np.repeat(acc, n)
            yield q, node


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return int(i)


def spanning_links(codes: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same codes as all pairs of a group at `radius` or fewer bits do, one fewer than codes at most."""
    alone = np.r_[True, group[1:] != group[:-1]] & np.r_[group[1:] != group[:-1], True]
    codes, group = codes[~alone], group[~alone]
    if not len(codes):
        return codes, codes
    forest = GrayForest(codes, group)
    tree = np.searchsorted(forest.roots, group)
    parent = np.arange(len(codes))
    for q, hit in forest.search(codes, tree, radius):
        for i, j in zip(q[q < hit].tolist(), hit[q < hit].tolist()):
            if (x := _find(parent, i)) != (y := _find(parent, j)):
                parent[max(x, y)] = min(x, y)
    root = np.array([_find(parent, i) for i in range(len(codes))])
    moved = root != np.arange(len(codes))
    return codes[moved], codes[root[moved]]


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """batches: (route, key, fp) sorted by route, key and Gray rank. Holds `chunk` rows and a group at most."""
    held: list[np.ndarray] = []

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])]
        u, v = spanning_links(np.ascontiguousarray(rows[:, 2]).view(np.uint64), np.cumsum(new), radius)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for b in batches:
        if b.num_rows:
            held.append(np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]))
        if sum(map(len, held)) >= chunk:
            rows = np.concatenate(held)
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield linked(rows[:cut])
            held = [rows[cut:]]
    if held and len(rows := np.concatenate(held)):
        yield linked(rows)


def links(codes: DataFrame, radius: int = 2, max_group: int = 20_000, levels: int = 3) -> DataFrame:
    """(u, v) links that connect exactly the distinct `fp` of `codes` that chains of `radius`-bit steps connect."""
    masks = _masks(radius, levels)
    mask_at = lambda level: F.element_at(F.array(*[F.lit(_signed(m)) for m in masks[level]]), F.col("route") + 1)
    routed = codes.select("fp", F.explode(F.array(*[F.lit(i) for i in range(len(masks[0]))])).alias("route"))
    routed = routed.withColumn("key", F.col("fp").bitwiseAND(mask_at(0))).withColumn("level", F.lit(0))
    ready = None
    for level in range(levels + 1):
        if level < levels:
            hot = materialize(routed.groupBy("route", "key").count().filter(F.col("count") > max_group).select("route", "key"), "hot")
            some = not hot.isEmpty()
        part = routed.join(hot, ["route", "key"], "left_anti") if level < levels and some else routed
        ready = part if ready is None else ready.unionByName(part)
        if level == levels or not some:
            break
        deeper = routed.join(hot, ["route", "key"], "left_semi").select("fp", F.explode(F.array(*[F.col("route") * (radius + 1) + i for i in range(radius + 1)])).alias("route"))
        routed = deeper.withColumn("key", F.col("fp").bitwiseAND(mask_at(level + 1))).withColumn("level", F.lit(level + 1))
    ready = ready.select((F.col("route") + F.col("level") * 1_000_000).alias("route"), "key", "fp")
    dealt = ready.repartition("route", "key").sortWithinPartitions("route", "key", gray_rank(F.col("fp")))
    return dealt.mapInArrow(partial(_link_batches, radius=radius, chunk=200_000), "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 2, max_group: int = 20_000) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for each row of `docs`.

    component_id is the least doc_id that chains of fingerprints within `radius` bits reach, the row's own included.
    Null and empty texts have fingerprint zero and are linked like any other; rows with a null doc_id are linked too but
    name a component only if it has no other id (then null). Whole texts are read, however long; repeated rows give
    repeated rows; an empty table gives an empty result. Other columns, whatever their names, are ignored.
    """
    fps = materialize(fingerprints(docs), "fingerprints")
    codes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "codes")
    roots = connected_components(links(codes, radius, max_group))
    named = codes.join(roots, codes["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = materialize(named.join(names, "root").select("fp", "component_id", "n"), "components")
    hot = by_fp.filter((F.col("n") > HOT_ROWS) & (F.col("n") * HOT_SHARE > fps.count())).drop("n")
    many = fps.join(F.broadcast(hot), "fp")  # HOT_SHARE rows at most; their documents stay where they are
    rest = fps.join(F.broadcast(hot), "fp", "left_anti").join(by_fp.drop("n"), "fp", "left")
    return many.unionByName(rest).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, radius: int = 2) -> DataFrame:
    """The rows of `docs` whose doc_id names their near-duplicate component; all columns stay as they are, whatever their names.

    Rows that share a doc_id share one fate and stay if any of them is its component's first; rows without a doc_id stay.
    Rows that the sieve of the ids to drop does not let through are passed on without a shuffle.
    """
    found = near_duplicates(docs, radius)
    fate = found.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    gone = materialize(fate.filter("not first").select(F.col("doc_id").alias("_gone")), "gone")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    rows = sifted(rows, F.xxhash64("_id"), sieve(gone.select(F.xxhash64("_gone").alias("hash")), gone.count()))
    some = rows.filter("_passes").join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return rows.filter("not _passes").select("_row").unionByName(some.select("_row")).select(*[F.col("_row")[c].alias(c) for c in docs.columns])

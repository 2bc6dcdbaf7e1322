"""Mixing sources to target weights by Pfair scheduling of their blocks.

Weights are exact: whole units in the very ratio of the given numbers, whatever their sum. Block j (from 1) of a source
with u of `total` units is released at slot floor((j - 1) * total / u) and due at ceil(j * total / u); the earliest
deadline among released blocks goes first, which keeps every source within one block of its share at every slot, however
many sources and blocks there are. When a source runs out, the plan goes on with the weights of the others: at most one
phase per source, all found from the sources' counts alone.

The plan is as long as there are blocks, so blocks grow with the table: a block has BLOCK_ROWS rows, or as many more as
keep the plan at `max_blocks` blocks and one more per source at most, 32 bytes each. Up to BLOCK_ROWS * max_blocks rows (4
million) nothing grows; at 5e10 rows a block has 190,000, still a 262,144th of the mix.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, spread

BLOCK_ROWS, MAX_BLOCKS, MAX_SOURCES = 16, 1 << 18, 1 << 16
#: Blocks of a source in one row of the plan; slots later than this are given as this.
CHUNK, LAST = 256, 2**63 - 1
ADDED = ("mix_phase", "mix_block", "mix_release", "mix_due", "mix_slot", "mix_pos")


def exact_units(weights: dict) -> dict:
    """Whole units in exactly the ratio of the weights, by name, the null one last."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("each source needs a positive weight")
    names = sorted(weights, key=lambda x: (x is None, x or ""))
    shares = {k: Fraction(weights[k] if isinstance(weights[k], int) else float(weights[k])) for k in names}
    scale = lcm(*(x.denominator for x in shares.values()))
    units = {k: int(x * scale) for k, x in shares.items()}
    common = gcd(*units.values())
    return {k: u // common for k, u in units.items()}


def schedule(units: dict) -> Iterator[tuple]:
    """(source, release, deadline) of each slot without end, earliest deadline first among released blocks; ties by name order."""
    total, names = sum(units.values()), list(units)
    later = [(0, -(-total // units[k]), i, 1) for i, k in enumerate(names)]  # release, deadline, source, block
    heapq.heapify(later)
    ready: list[tuple[int, int, int, int]] = []
    slot = 0
    while True:
        while later and later[0][0] <= slot:
            release, due, i, j = heapq.heappop(later)
            heapq.heappush(ready, (due, i, j, release))
        due, i, j, release = heapq.heappop(ready)
        assert due > slot
        yield names[i], release, due
        u = units[names[i]]
        heapq.heappush(later, (j * total // u, -(-(j + 1) * total // u), i, j + 1))
        slot += 1


def plan(blocks: dict, weights: dict) -> dict:
    """Phase, release, deadline and slot of every block of each source: four arrays a source, by block; the work grows with the blocks."""
    left = {k: n for k, n in blocks.items() if n > 0}
    out = {k: tuple(array("q") for _ in range(4)) for k in left}
    phase = start = 0
    while left:
        for n, (k, release, due) in enumerate(schedule(exact_units({k: weights[k] for k in left}))):
            for column, x in zip(out[k], (phase, start + release, min(start + due, LAST), start + n)):
                column.append(x)
            left[k] -= 1
            if not left[k]:
                del left[k]
                break
        phase, start = phase + 1, start + n + 1
    return out


def temperature(counts: dict, alpha: float = 0.5) -> dict:
    """Weights that damp large sources: counts to the power alpha, in whole thousandths."""
    return {k: max(1, round(n**alpha * 1000)) for k, n in counts.items()}


def _as_table(df: DataFrame, source: str, spots: dict) -> DataFrame:
    """The plan as rows (_source, _chunk, _phases, _releases, _dues, _slots), from literals: no Python worker has part in it."""
    kind = df.schema[source].dataType.simpleString()
    line = lambda x: ";".join(",".join(map(str, x[c : c + CHUNK])) for c in range(0, len(x), CHUNK))
    names = ("_phases", "_releases", "_dues", "_slots")
    rows = [F.struct(F.lit(k).cast(kind).alias("k"), *[F.lit(line(x)).alias(n) for n, x in zip(names, columns)]) for k, columns in spots.items()]
    none = F.expr(f"cast(array() as array<struct<k:{kind},{','.join(f'{n}:string' for n in names)}>>)")
    table = df.sparkSession.range(1).select(F.explode(F.array(*rows) if rows else none).alias("s")).select("s.*")
    chunks = F.arrays_zip(*[F.split(n, ";").alias(n) for n in names])
    table = table.select(F.col("k").alias("_source"), F.posexplode(chunks).alias("_chunk", "_x"))
    return table.select("_source", "_chunk", *[F.split(F.col("_x")[n], ",").cast("array<long>").alias(n) for n in names])


def mix(df: DataFrame, source: str, order: list[str], weights: dict | None = None, block_rows: int | None = None, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """`df` with the columns of ADDED (which replace such columns of its own): mix_phase, mix_block (of the source), mix_release, mix_due and mix_slot (of the block), mix_pos (in the block).

    Every row is placed once. Rows of a source are numbered by `spread` and value of `order`, blocks of `block_rows` rows
    (by default as the module says) are cut from that numbering. Weights default to the square roots of the sources' row
    counts; each source that has rows needs one, others are ignored. A null source is a source, and null ids are ids.
    Releases and deadlines are slots of the whole schedule. Rows that agree in all of `order`, as repeated rows do, are
    numbered in any order. Texts, of whatever length, are carried and not read; an empty table gives an empty result. The
    counts by source and the plan are what the driver holds; above MAX_SOURCES sources it raises, since the plan has a
    block of each at least.
    """
    counted = df.groupBy(source).count().limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix groups of them")
    counts = {r[0]: r[1] for r in counted}
    rows_each = block_rows or max(BLOCK_ROWS, -(-sum(counts.values()) // max_blocks))
    weights = temperature(counts) if weights is None else weights
    blocks = {k: -(-n // rows_each) for k, n in counts.items()}
    table = _as_table(df, source, plan(blocks, weights))
    at = [F.col(f"_o{i}") for i in range(len(order))]
    out = ranked(df.select(F.struct(*df.columns).alias("_row"), F.col(source).alias("_src"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]), "_src", [spread(*at), *at])
    out = out.withColumn("_block", F.expr(f"group_rank div {rows_each}")).withColumn("_pos", F.pmod(F.col("group_rank"), F.lit(rows_each)).cast("int"))
    same = F.col("_src").eqNullSafe(F.col("_source")) & (F.expr(f"_block div {CHUNK}") == F.col("_chunk"))
    out = out.join(F.broadcast(table), same, "left")  # 32 bytes a block, max_blocks and one per source at most
    of_block = lambda name: F.element_at(name, (F.col("_block") % CHUNK + 1).cast("int"))
    out = out.select(
        *[F.col("_row")[c].alias(c) for c in df.columns if c not in ADDED],
        of_block("_phases").cast("int").alias("mix_phase"),
        F.col("_block").alias("mix_block"),
        of_block("_releases").alias("mix_release"),
        of_block("_dues").alias("mix_due"),
        of_block("_slots").alias("mix_slot"),
        F.col("_pos").alias("mix_pos"),
    )
    out._foliary_slots = sum(blocks.values())
    return out


def interleave(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """The rows of `docs`, columns as they are, sorted in the order of the mix: what `mix` says of odd rows holds here.

    Slots number the whole mix, so a row's part of the output follows from its slot; no sampling pass looks for bounds.
    """
    placed = mix(docs.select("source", "doc_id", F.struct(*docs.columns).alias("row")), "source", ["doc_id"], weights)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionById(parts, F.expr(f"cast(mix_slot div {placed._foliary_slots // parts + 1} as int)")).sortWithinPartitions("mix_slot", "mix_pos")
    return placed.select(*[F.col("row")[c].alias(c) for c in docs.columns])

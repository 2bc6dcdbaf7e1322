"""Consistent sharding with a permutation-filled lookup table.

Shards take turns claiming slots of a table of prime size, each in its own order of preference (an offset and a step
drawn from its name), so every shard owns equally many slots to within one and few slots move when a shard joins or
leaves. A row's slot is a hash of its key; the broadcast table, whose size is the parameter `slots`, gives its shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """Shard number of each slot. `slots` is a prime, best a hundred times the number of shards or more."""
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime that is no less than the number of shards")
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must have distinct names, one at least")
    start = [_number(f"{s}/offset") % slots for s in shards]
    step = [_number(f"{s}/skip") % (slots - 1) + 1 for s in shards]
    table, turn, free = [-1] * slots, [0] * len(shards), slots
    while free:
        for k in range(len(shards)):
            while table[at := (start[k] + turn[k] * step[k]) % slots] >= 0:
                turn[k] += 1
            table[at] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int) -> Column:
    """Hash slot of a key; a null key hashes like the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign_shards(df: DataFrame, key: str, shards: list[str], slots: int = 4099) -> DataFrame:
    """(key, slot, shard) for each row, in one pass without a shuffle; a key named slot or shard gives way to the result of that name.

    Null keys share a shard, as the empty text does; long keys are hashed whole; rows that repeat or tie in the key go
    together, and repeat; an empty table gives an empty result. Other columns, whatever their names, are not looked at.
    """
    owners = ",".join(map(str, lookup_table(shards, slots)))
    table = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_slot", "_k"))
    names = F.array(*[F.lit(s) for s in shards])
    table = table.select("_slot", F.element_at(names, F.col("_k").cast("int") + 1).alias("_shard"))
    placed = df.select(F.col(key).alias("_key"), slot_of(F.col(key), slots).alias("_at"))
    out = placed.join(F.broadcast(table), F.col("_at") == F.col("_slot"))  # `slots` rows
    return out.select(*[F.col("_key").alias(key)] * (key not in ("slot", "shard")), F.col("_at").alias("slot"), F.col("_shard").alias("shard"))

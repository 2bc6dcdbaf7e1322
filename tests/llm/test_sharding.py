from collections import Counter

import pytest

from foliary.llm.sharding import assign_shards, lookup_table

NAMES = [f"shard-{i:02d}" for i in range(16)]


def test_table_is_even_and_moves_little():
    table = lookup_table(NAMES, 4099)
    n = Counter(table)
    assert max(n.values()) - min(n.values()) <= 1 and len(n) == 16
    less = lookup_table(NAMES[:5] + NAMES[6:], 4099)
    stay = [k if k < 5 else k - 1 for k in table]
    moved = sum(a != b for a, b, was in zip(stay, less, table) if was != 5)
    assert moved < 0.05 * 4099
    with pytest.raises(ValueError):
        lookup_table(NAMES, 4096)


def test_rows_follow_their_slot(odd, none, small):
    got = assign_shards(small, "doc_id", NAMES).collect()
    table = lookup_table(NAMES, 4099)
    assert len(got) == small.count() and all(r["shard"] == NAMES[table[r["slot"]]] for r in got)
    assert assign_shards(odd, "doc_id", NAMES).count() == odd.count()
    assert len({r["shard"] for r in assign_shards(odd.filter("doc_id is null"), "doc_id", NAMES).collect()}) == 1
    assert assign_shards(none, "doc_id", NAMES).count() == 0


def test_keys_whose_names_clash(odd):
    for name in ("slot", "shard", "_slot", "_shard", "_k"):
        rows = assign_shards(odd.withColumnRenamed("source", name), name, NAMES).collect()
        assert len(rows) == odd.count() and all(r["shard"] in NAMES for r in rows)

from collections import defaultdict
from fractions import Fraction
from math import ceil, floor, sqrt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliary.llm import mixing as M


def naive(blocks, weights):
    """(source, block, release, due, phase) slot by slot: every released block is looked at, in fractions, with no heap and no units."""
    left, done, slots, phase = dict(blocks), defaultdict(int), [], 0
    names = sorted(blocks)
    while any(left.values()):
        live = [k for k in names if left[k]]
        total, start, mine = sum(Fraction(weights[k]) for k in live), len(slots), defaultdict(int)
        while all(left[k] for k in live):
            t, best = len(slots) - start, None
            for k in live:
                share = Fraction(weights[k]) / total
                release, due = floor(mine[k] / share), ceil((mine[k] + 1) / share)
                if release <= t and (best is None or due < best[1]):
                    best = (k, due, release)
            k, due, release = best
            slots.append((k, done[k], start + release, start + due, phase))
            mine[k] += 1
            done[k] += 1
            left[k] -= 1
        phase += 1
    return slots


@given(st.lists(st.tuples(st.integers(1, 30), st.floats(1e-3, 1e3)), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_plan_is_the_naive_one(sources):
    blocks = {f"s{i}": n for i, (n, _) in enumerate(sources)}
    weights = {f"s{i}": w for i, (_, w) in enumerate(sources)}
    plan, want = M.plan(blocks, weights), naive(blocks, weights)
    got = {slot: (k, j, release, due, phase) for k, spots in plan.items() for j, (phase, release, due, slot) in enumerate(zip(*spots))}
    assert [got[t] for t in range(len(want))] == want


def test_mix_matches_the_simulation(small):
    rows = M.mix(small.select("doc_id", "source"), "source", ["doc_id"], None, 4).collect()
    counts = {r["source"]: r["count"] for r in small.groupBy("source").count().collect()}
    want = naive({k: -(-n // 4) for k, n in counts.items()}, {k: round(sqrt(n) * 1000) for k, n in counts.items()})
    for r in rows:
        assert want[r["mix_slot"]] == (r["source"], r["mix_block"], r["mix_release"], r["mix_due"], r["mix_phase"])
    assert len({(r["mix_slot"], r["mix_pos"]) for r in rows}) == small.count() == len({r["doc_id"] for r in rows})


def test_uneven_sources_with_irrational_weights():
    weights = {f"s{i:03d}": sqrt(i * i * i + 2) * 3.141592653589793 for i in range(100)}
    sizes = {k: max(1, int(w * 3)) for k, w in weights.items()}
    plan = M.plan(sizes, weights)
    order = dict(sorted((s, k) for k, spots in plan.items() for s in spots[3]))
    assert list(order) == list(range(sum(sizes.values())))
    worst, slots = deviation(list(order.values()), weights)
    assert worst < 1 and slots > 1000


def test_the_plan_is_bounded(spark):
    docs = spark.range(10_000).selectExpr("id as doc_id", "cast(if(id % 3 = 0, 7, id % 50) as string) as source")
    rows = M.mix(docs, "source", ["doc_id"], max_blocks=100).select("source", "mix_block", "mix_slot", "mix_pos").collect()
    assert len({r["mix_slot"] for r in rows}) <= 150 and len(rows) == 10_000 and max(r["mix_pos"] for r in rows) == 99
    with pytest.raises(ValueError):
        M.mix(spark.range(M.MAX_SOURCES + 1).selectExpr("id as doc_id", "id as source"), "source", ["doc_id"])


def test_odd_rows(odd, none):
    got = M.mix(odd, "source", ["doc_id"]).collect()
    assert len(got) == odd.count() and all(r["mix_slot"] is not None for r in got)
    out = M.interleave(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert M.interleave(none).count() == 0
    clash = odd.withColumnRenamed("_cell", "_g").withColumnRenamed("row", "mix_slot").withColumnRenamed("fp", "_source")
    assert M.interleave(clash).columns == clash.columns and M.mix(clash, "source", ["doc_id"]).count() == odd.count()


def test_rows_are_written_in_the_order_of_the_mix(small, tmp_path, spark):
    M.interleave(small).write.parquet(str(tmp_path / "x"))
    slots = {r["doc_id"]: (r["mix_slot"], r["mix_pos"]) for r in M.mix(small, "source", ["doc_id"]).collect()}
    back = spark.read.parquet(str(tmp_path / "x")).select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    assert [slots[r["doc_id"]] for r in back] == sorted(slots.values())


def deviation(slots, weights):
    """The most that a source lies off its true share before the first source runs out, in blocks."""
    total, sizes, done, worst = sum(weights.values()), defaultdict(int), defaultdict(int), 0.0
    for k in slots:
        sizes[k] += 1
    for t, k in enumerate(slots, 1):
        done[k] += 1
        worst = max(worst, max(abs(done[s] - t * w / total) for s, w in weights.items()))
        if done[k] == sizes[k]:
            return worst, t


def test_true_weights_hold_with_many_sources(spark):
    weights = {"big": 1 / 3} | {f"s{i:03d}": 2 / 3 / 300 for i in range(300)}
    sizes = {"big": 500} | {f"s{i:03d}": 6 for i in range(300)}
    docs = spark.createDataFrame([(k, i) for k, n in sizes.items() for i in range(n)], "source string, doc_id long")
    rows = M.mix(docs, "source", ["doc_id"], weights, 1).select("source", "mix_slot", "mix_release", "mix_due").collect()
    assert sorted(r["mix_slot"] for r in rows) == list(range(2300)) and all(r["mix_release"] <= r["mix_slot"] < r["mix_due"] for r in rows)
    worst, slots = deviation([r["source"] for r in sorted(rows, key=lambda r: r["mix_slot"])], weights)
    assert worst < 1 and slots > 1000


def test_no_drift_over_many_blocks():
    weights = {"a": 0.3335, "b": 0.3335, "c": 0.333}
    plan = M.plan(dict.fromkeys(weights, 20_000), weights)
    order = dict(sorted((s, k) for k, spots in plan.items() for s in spots[3]))
    assert list(order) == list(range(60_000))
    worst, slots = deviation(list(order.values()), weights)
    assert worst < 1 and slots > 59_000

from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliary.llm import packing as P


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_boundaries_are_optimal(hist, buckets):
    tops = sorted(hist)
    cost = lambda edges: sum(c * (min(e for e in edges if e >= t) - t) for t, c in hist.items())
    got = P.boundaries(np.array(tops), np.array([hist[t] for t in tops]), buckets)
    best = min(cost([*x, tops[-1]]) for k in range(min(buckets, len(tops))) for x in combinations(tops[:-1], k))
    assert len(got) <= buckets and got[-1] == tops[-1] and cost(got) == best


def test_boundaries_of_many_lengths():
    rng = np.random.default_rng(3)
    tops = np.unique(rng.integers(1, 5000, 300))
    counts = rng.integers(1, 50, len(tops))
    n, big = len(tops), 10**15
    total = np.r_[0, np.cumsum(counts)]
    best = np.full(n + 1, big)
    best[0] = 0
    for _ in range(7):  # every predecessor of every length
        best = np.array([0 if not j else min(best[i] + (total[j] - total[i]) * tops[j - 1] for i in range(j)) for j in range(n + 1)])
    got = P.boundaries(tops, counts, 7)
    pads = sum(int(c) * (min(e for e in got if e >= t)) for t, c in zip(tops.tolist(), counts))
    assert pads == best[n] and len(got) == 7 and P.boundaries(tops, counts * 10**12, 7) == got
    assert P.boundaries(tops, counts * 10**14, 7) == got  # numbers beyond 64 bits


def check(rows, budget, n):
    assert len(rows) == n
    batches = {}
    for r in rows:
        assert r["n_words"] <= r["bucket_len"]
        batches.setdefault(r["batch_id"], []).append(r)
    by_bucket = {}
    for b in batches.values():
        assert sorted(r["batch_pos"] for r in b) == list(range(len(b)))
        assert len({r["bucket_len"] for r in b}) == 1 and (len(b) == 1 or len(b) * b[0]["bucket_len"] <= budget)
        by_bucket.setdefault(b[0]["bucket_len"], []).append(len(b))
    for length, sizes in by_bucket.items():
        assert sum(s < max(1, budget // length) for s in sizes) <= 1  # one short batch a bucket


def test_batches_fill_the_budget(small):
    rows = P.pack(small.select("doc_id", P.words(F.col("text")).alias("n")), F.col("n"), ["doc_id"], 8, 4096).collect()
    check(rows, 4096, small.count())
    made = P.in_batches(small, 8, 4096).collect()
    check(made, 4096, small.count())
    assert sorted(r["doc_id"] for r in made) == sorted(r["doc_id"] for r in rows)


def test_odd_rows(odd, none):
    check(P.pack(odd, P.words(F.col("text")), ["doc_id"], 4, 100).collect(), 100, odd.count())
    assert P.pack(none, P.words(F.col("text")), ["doc_id"]).count() == 0 and P.in_batches(none).count() == 0
    check(P.in_batches(odd, 4, 100).collect(), 100, odd.count())

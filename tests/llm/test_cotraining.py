import numpy as np
import pytest
from pyspark.sql import functions as F

from foliary.llm import cotraining as C


def array_pool(views, truth_hidden):
    """The pool of arrays: the same cuts, the first rows beyond them."""

    def pool(fits, want, rate, least):
        odds = [C.odds_of(x, f) for x, f in zip(views, fits)]
        edge = C.cuts(np.array([np.bincount(C.bins(o), minlength=C.ODDS_BINS) for o in odds]), rate, least)
        out = {}
        for (view, y), (cut, n) in edge.items():
            at = np.flatnonzero(C.beyond(odds[view], cut, y))
            assert len(at) == n
            out[view, y] = tuple(x[at[: want[y]]] for x in views)
        return out

    return pool


def test_a_view_that_is_sure_but_wrong_teaches_nothing():
    odds = np.linspace(-10, 10, 401)
    assert all(abs(edge - 2) <= 0.11 for edge in C.sure(odds, (odds > 2).astype(int)).values())  # one in a hundred may be wrong
    none = C.sure(odds, np.arange(401) % 2)
    assert none[0] < -C.ODDS and none[1] > C.ODDS and not C.beyond(odds, none[1], 1).any() and not C.beyond(odds, none[0], 0).any()


def test_exchange_lifts_views_that_have_few_labels():
    rng = np.random.default_rng(0)
    n = 6000
    y = (rng.random(n) < 0.7).astype(int)
    views = [np.column_stack([y[:, None] * 1.5 + rng.standard_normal((n, 2)), rng.standard_normal((n, 60))]).astype(np.float32) for _ in range(2)]
    few = rng.random(n) < 0.04
    fold = rng.choice([C.LEARN, C.CALIBRATE, C.DECIDE], few.sum())
    train = lambda rounds: C.co_train([v[few] for v in views], y[few], fold, array_pool([v[~few] for v in views], y), rounds)
    ahead = lambda rounds: np.mean((train(rounds).score(*views)[2] >= 0.5) == y)
    assert ahead(6) > ahead(0) and train(3).exchanged[0] > 0
    assert C.co_train([v[few] for v in views], np.zeros(few.sum(), int), fold, None) is None


def test_the_pool_of_a_table_is_every_unlabelled_row(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = C.views_of(small).cache()
    t, m = C._arrays(*zip(*[(r["t"], r["m"]) for r in rows.collect()]))
    rng = np.random.default_rng(1)
    fits = [(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), np.r_[rng.standard_normal(x.shape[1]) * 0.2, 0]) for x in (t, m)]
    got = C.table_pool(rows, labels.select(F.col("doc_id").alias("_id")))(fits, {1: 40, 0: 20}, 0.7, [{1: 0.5, 0: -0.5}] * 2)
    known = {r["doc_id"] for r in labels.collect()}
    table = sorted((r["h"], r["doc_id"], r["t"], r["m"]) for r in rows.collect())
    views = C._arrays([r[2] for r in table], [r[3] for r in table])
    odds = [C.odds_of(x, f) for x, f in zip(views, fits)]
    edge = C.cuts(np.array([np.bincount(C.bins(o), minlength=C.ODDS_BINS) for o in odds]), 0.7, [{1: 0.5, 0: -0.5}] * 2)
    for (view, y), (cut, n) in edge.items():
        assert n <= 1.2 * C.SHARE * (0.7 if y else 0.3) * len(table) + 60
        at = [i for i in np.flatnonzero(C.beyond(odds[view], cut, y)) if table[i][1] not in known][: 40 if y else 20]
        assert all(np.array_equal(a, b) for a, b in zip(got[view, y], (views[0][at], views[1][at])))


@pytest.mark.parametrize("sf,lost,wrong", [("sf0.01", 0.05, 0.15), ("sf0.1", 0.02, 0.08)])
def test_held_out_documents(spark, sf, lost, wrong):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    test = F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(3)) == 0
    model = C.train(docs, labels.filter(~test))
    got = C.score(docs, model).join(labels.filter(test), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert len(bad) > 5 and (~good.kept).mean() < lost and bad.kept.mean() < wrong
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_odd_rows(spark, small, odd, none):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").union(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, None)], "doc_id long, quality int, toxic int"))
    model = C.train(small, labels)
    rows = C.score(odd, model).collect()
    assert len(rows) == odd.count() and all(r["score"] is not None for r in rows)
    none_model = C.classify(odd, labels.limit(0)).collect()
    assert all(r["score"] is None and r["kept"] for r in none_model)
    assert C.classify(none, labels).count() == 0 and C.score(none, model).count() == 0


def test_views_take_the_whole_text():
    text = b"plain words here " * 90_000
    assert not np.allclose(C.text_view(text), C.text_view(text + b"##### " * 200_000))

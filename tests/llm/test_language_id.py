import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliary.llm import language_id as L


@pytest.fixture(scope="module")
def model(small):
    return L.train(small, per_lang=80, steps=250)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    net = L.ByteGru(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, weight, label = rng.integers(0, 256, (5, 4)).astype(np.uint8), rng.random((5, 4)), rng.integers(0, 3, 4)
    _, grad = net.gradient(data, weight, label)
    for k, p in net.p.items():
        flat = p.reshape(-1)
        for i in rng.integers(0, flat.size, 4) if k[-1] != "x" else int(data[1, 2]) * 3 * L.HIDDEN + np.array([0, 9, 20]):
            was = flat[i]
            flat[i] = was + 1e-3
            up = net.gradient(data, weight, label)[0]
            flat[i] = was - 1e-3
            down = net.gradient(data, weight, label)[0]
            flat[i] = was
            assert abs((up - down) / 2e-3 - grad[k].reshape(-1)[i]) < 2e-4


def test_windows_are_the_whole_texts():
    texts = [b"", b"abc", bytes(range(256)) * 700, b"x" * 64]
    back = {}
    for owner, data in L.windows(texts):
        for i, row in zip(owner.tolist(), data):
            back[i] = back.get(i, b"") + row.tobytes()
    assert [back.get(i, b"")[: len(t)] for i, t in enumerate(texts)] == texts
    assert all(not back.get(i, b"")[len(t) :].strip(b"\0") for i, t in enumerate(texts))


def test_held_out_accuracy(small, model):
    docs = small.toPandas().set_index("doc_id")
    got = L.predict(small, model).toPandas().set_index("doc_id")
    assert all(got.held_out[d] == (zlib.crc32(str(d).encode()) % 4 == 2) for d in docs.index)
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang[held.index]).mean() > 0.93 and got.score.between(0, 1).all()


def test_order_of_rows_changes_nothing(small, model):
    some = small.limit(40)
    a = {r["doc_id"]: r for r in L.predict(some, model).collect()}
    b = {r["doc_id"]: r for r in L.predict(some.repartition(7), model).collect()}
    assert a.keys() == b.keys() and all(a[d]["lang_pred"] == b[d]["lang_pred"] and abs(a[d]["score"] - b[d]["score"]) < 1e-4 for d in a)


def test_odd_rows(spark, odd, none, model):
    got = {(r["doc_id"], r["lang_pred"]) for r in L.predict(odd, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (None, "und")} <= got and (1, "und") not in got
    assert L.predict(odd, model).count() == odd.count()
    assert L.identify(none).count() == 0
    alone = odd.filter("doc_id is null")
    assert {(r["lang_pred"], r["score"]) for r in L.identify(alone).collect()} == {("und", 0.0)}  # nothing to learn from


def test_sample_is_the_smallest_hashes_whatever_the_size(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "if(id % 4 = 0, 'b', 'a') as lang", "concat('text ', id) as text").withColumn("h", L.sample_hash("language", F.col("doc_id")))
    want = {k: sorted((r["h"], r["doc_id"]) for r in rows.filter(F.col("lang") == k).collect())[:50] for k in "ab"}
    got = L._sample(rows, {"a": 15_000, "b": 5_000}, 50).collect()
    assert {(r["lang"], r["doc_id"]) for r in got} == {(k, d) for k, x in want.items() for _, d in x}
    # at 10^10 rows of a language the limit still lets 2k + 64 hashes through
    for n in (10**9, 10**10, 10**15):
        assert abs(L.sample_limit(256, n) * n / 2**63 - 576) < 1
    hot = rows.union(rows.filter("doc_id = 8").crossJoin(spark.range(3000)).drop("id"))
    assert L._sample(hot, {"a": 15_000, "b": 5_000}, 50).count() == 100


def test_training_reaches_all_of_a_text(spark):
    # what tells the languages apart stands only at the end of long texts
    rows = [(i, "same words here " * 400 + ("zzq xxq " if i % 2 else "oui eau ") * 400, "x" if i % 2 else "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(docs, steps=150).collect()
    assert all(r["lang_pred"] == ("x" if r["doc_id"] % 2 else "y") for r in got)

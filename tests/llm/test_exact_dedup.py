import hashlib

import pyarrow as pa
import pytest

from foliary.llm import exact_dedup as X


@pytest.mark.parametrize("bits,size", [(60, 16 << 20), (3, 2000), (16, 1)])
def test_against_plain_grouping(small, bits, size):
    docs = small.toPandas()
    got = X.exact_groups(small, bits, size).toPandas().set_index("doc_id")
    keep = docs.groupby("text").doc_id.transform("max")
    n = docs.groupby("text").doc_id.transform("count")
    for d, t, k, c in zip(docs.doc_id, docs.text, keep, n):
        assert tuple(got.loc[d, ["keep_id", "group_size", "kept", "text_sha256"]]) == (k, c, k == d, hashlib.sha256(t.encode()).hexdigest())


def test_directory_splits_overfull_buckets_and_doubles():
    depth, slots = X.directory({0: 50, 1: 60, 9: 10}, 100, 4)
    assert depth == 4 and len(slots) == 16 and slots[0] != slots[1] and slots[8:] == [slots[8]] * 8
    assert X.directory({}, 100, 4) == (0, [0])
    assert X.directory({3: 500}, 100, 4)[0] == 4  # one prefix alone stays one bucket


def test_odd_rows(odd, none):
    got = X.exact_groups(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["text_sha256"], []).append(r)
    for rows in by.values():
        assert sum(r["kept"] for r in rows) == 1 and {r["group_size"] for r in rows} == {len(rows)}
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert {r["keep_id"] for r in empty} == {4} and len(empty) == 3
    kept = X.drop_copies(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 4, 5, 6, 7]
    same = odd.sparkSession.createDataFrame([(1, None), (1, ""), (1, ""), (2, "x"), (2, "x")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in X.drop_copies(same).collect()) == [1, 2] and sorted(r["kept"] for r in X.exact_groups(same).collect()) == [False] * 3 + [True] * 2
    assert X.exact_groups(none).count() == 0 and X.drop_copies(none).count() == 0


def test_a_text_that_most_rows_repeat(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_ROWS", 50)
    monkeypatch.setattr(X, "HOT_SHARE", 10)
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, concat('pair ', id div 6), concat('alone ', id))) as text")
    got = {r["doc_id"]: r for r in X.exact_groups(docs, 20, 100).collect()}
    want = docs.toPandas()
    n, keep = (want.groupby("text").doc_id.transform(f) for f in ("count", "max"))
    assert all((got[d]["group_size"], got[d]["keep_id"], got[d]["kept"]) == (c, k, d == k) for d, c, k in zip(want.doc_id, n, keep))


def test_texts_that_stand_alone_are_not_shuffled(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', if(id < 10, 1, id)) as text")
    _, several, repeats = X.index(docs)
    assert several.count() == 1 and [(r["keep_id"], r["n"]) for r in repeats.collect()] == [(9, 10)]


def test_chains_compare_bytes():
    rows = [(5, b"a", 1, 1), (5, b"b", 2, 1), (5, b"a", 3, 1), (7, b"c", 4, 1), (7, b"c", None, 1)]
    part = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "text", "doc_id", "n"])
    sent = [tuple(r.values()) for b in X._entries(iter([part]), 1 << 20) for r in b.to_pylist()]
    assert {(k, t, d, n) for k, _, t, d, n in sent} == {(5, b"a", 3, 2), (5, b"b", 2, 1), (7, b"c", 4, 2)}
    assert [(r["key"], r["keep_id"], r["n"]) for b in X._owned(iter([part])) for r in b.to_pylist()] == [(5, 3, 2), (7, 4, 2)]

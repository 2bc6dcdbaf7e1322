import duckdb

import corpus_pipeline as P
from foliary.llm import exact_dedup, quality_rules, simhash


def test_stages_follow_from_each_other(spark, small, tmp_path):
    docs, sf = small, "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    want = [
        lambda d: ids(quality_rules.verdicts(d, labels).filter("kept")),
        lambda d: ids(exact_dedup.exact_groups(d).filter("kept")),
        lambda d: ids(simhash.near_duplicates(d).filter("doc_id = component_id")),
        ids,
    ]
    for (name, stage), expected in zip(P.STAGES, want):
        out = stage(spark, docs, sf)
        assert out.columns == small.columns
        out.write.parquet(path := str(tmp_path / name))
        after = spark.read.parquet(path)
        assert ids(after) == expected(docs)
        docs = after
    packs = P.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted(r["doc_id"] for r in packs) == ids(docs)
    # batches follow the order of the mix
    order = {r["doc_id"]: i for i, r in enumerate(docs.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect())}
    for bucket in {r["bucket_len"] for r in packs}:
        rows = sorted((r for r in packs if r["bucket_len"] == bucket), key=lambda r: (int(r["batch_id"].split(":")[1]), r["batch_pos"]))
        assert [order[r["doc_id"]] for r in rows] == sorted(order[r["doc_id"]] for r in rows)


def test_run_gives_what_its_sql_gives(spark):
    sf = "/root/testdata/sf0.001"
    out = P.run(spark, sf)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({P.ORACLE_SQL})").fetchall()
    assert len(P.STAGES) == 5 and sorted(map(tuple, out.collect())) == sorted(want) and len(want) > 50


def test_stages_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and out.count() <= docs.count()
        P.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()

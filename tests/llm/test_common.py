import pytest
from pyspark.sql import functions as F

from foliary.llm import common as C


class _Context:
    master = "spark://somewhere:7077"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(ValueError):
        C.shared_dir(_Session())
    assert C.shared_dir(spark)


def test_ranks_are_those_of_the_whole_group(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("doc_id"))
    got = C.ranked(df, "g", [C.spread(F.col("doc_id")), F.col("doc_id")], rows_per_cell=100).withColumn("h", C.spread(F.col("doc_id"))).collect()
    for g in range(3):
        rows = sorted((r for r in got if r["g"] == g), key=lambda r: (r["h"], r["doc_id"]))
        assert [r["group_rank"] for r in rows] == list(range(len(rows)))


@pytest.mark.parametrize("n", [0, 1, 700, 60_000])
def test_sieve_passes_all_of_its_own_and_few_others(spark, n):
    keys = spark.range(n).select(F.xxhash64("id").alias("hash"))
    out = C.sifted(spark.range(100_000), F.xxhash64("id"), C.sieve(keys, n)).groupBy(F.col("id") < n, "_passes").count().collect()
    count = {(r[0], r[1]): r[2] for r in out}
    assert count.get((True, False), 0) == 0 and count.get((False, True), 0) < 0.1 * (100_000 - n)


def test_tables_go_with_their_stage(spark):
    with C.passing():
        gone = C.materialize(spark.range(5), "x")
        kept = C.materialize(gone.filter("id > 1"), "y", passes=False)
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone._foliary_path).count()
    assert C.materialize(spark.range(5), "z").count() == 5

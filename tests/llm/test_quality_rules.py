import math
import random
import re

from pyspark.sql import functions as F

from foliary.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_measures(spark, small, odd, none):
    rng = random.Random(2)
    extra = [(10_000 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))), None) for i in range(300)]
    extra += [(20_000, "x y z\n\nx y z\n x y z\nx y z", None), (20_001, "a b c d e f a b c d e", None), (20_002, "a b c \x1f d", None)]
    docs = small.select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id long, text string, lang string")).union(odd.filter("doc_id is not null").select("doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id") + 30_000))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in Q.measures(docs, ["doc_id"]).collect():
        assert tuple(r[c] for c in names) == plain(texts[r["doc_id"]]), r["doc_id"]
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert Q.verdicts(odd, labels).count() == odd.count()
    assert Q.verdicts(none, labels).count() == 0 and Q.verdicts(odd, labels.limit(0)).count() == odd.count()
    kept = Q.keep_good(odd, labels)
    assert kept.columns == odd.columns and all(plain(r["text"])[0] >= 10 for r in kept.collect())


def tail(n, p, k):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_exact_binomial_bound(spark):
    rows = spark.range(0, 1200, 57).select("id", Q.most_allowed(F.col("id"), 0.02, F.lit(0.01)).alias("k")).collect()
    for r in rows:
        n = r["id"]
        want = max((k for k in range(n + 1) if k <= n * 0.02 and tail(n, 0.02, k) <= 0.01), default=-1)
        assert r["k"] == want


def test_cutoffs_are_safe_and_reject_what_is_bad(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(40)]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + "###" if bad else w for w in words), "en"))
        if i % 2:
            labels.append((i, int(not bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    out = {r["doc_id"]: r["kept"] for r in Q.verdicts(docs, labels, risk=0.02).collect()}
    assert all(out[i] == (i % 5 != 0) for i in range(1500))
    few = Q.verdicts(docs, labels.filter("doc_id < 100"), risk=0.005)  # too few to prove anything
    assert few.filter("not kept").count() == 0


def test_the_guarantee_is_for_all_rules_together(spark):
    # three rules each lose one good document in a hundred and fifty, all of them together one in fifty
    rows, labels = [], []
    for i in range(3000):
        words = ["word"[: 2 + (i * 7 + j) % 3] + chr(97 + (i + j * j) % 26) + chr(97 + (i // 26 + j) % 26) for j in range(60)]
        good = i % 4 != 0
        if not good or i % 150 == 1:
            words = [w + "#" for w in words]
        elif i % 150 == 2:
            words = [w.upper() for w in words]
        elif i % 150 == 3:
            words = [w * 9 for w in words]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = Q.measures(Q._asked(docs, "lang"), ["doc_id", "_id", "_st"]).cache()
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    lost = {r["doc_id"] for r in measured.filter("_score > 0.9 and not base_failed").collect()}
    assert 2500 * 0.015 < sum(i in lost for i in range(3000) if i % 4) < 2500 * 0.03
    assert Q.cutoffs(measured, marks, "_st", 0.01, 0.1).count() == 0  # each rule alone would be within it
    assert Q.cutoffs(measured, marks, "_st", 0.05, 0.1).count() == 1


def test_an_id_counts_once(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" + ("#" if i < 20 else "") for j in range(30)), "en") for i in range(80)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i >= 20)) for i in range(80)], "doc_id long, quality int")
    many = labels
    for _ in range(4):
        many = many.union(labels)
    for table in (labels, many):  # sixty good documents prove no risk of two in a hundred, however often they are labelled
        assert Q.verdicts(docs, table).filter("not kept").count() == 0
    assert Q.verdicts(docs, labels, risk=0.05).filter("not kept").count() == 20
    assert Q.keep_good(docs, labels, risk=0.05).count() == 60


def test_cutoffs_act_on_the_test_table(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = Q.verdicts(small, labels)
    gone = out.filter("not kept and not base_failed")
    assert gone.count() > 10
    lost = gone.join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r["quality"]: r["count"] for r in lost}.get(1, 0) == 0
    assert sorted(r["doc_id"] for r in Q.keep_good(small, labels).select("doc_id").collect()) == sorted(r["doc_id"] for r in out.filter("kept").collect())

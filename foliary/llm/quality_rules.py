"""Quality rules whose cutoffs carry a risk guarantee from labelled holdouts.

Each rule is a ratio that is high on bad text, with a base cutoff. A factor scales the cutoffs of all rules together, so
what a factor rejects is what any rule rejects: the documents whose score, the largest ratio over base cutoff, exceeds it.
Factors are a fixed grid, loosest first. In a stratum with n good labelled documents that pass the base rules, of which k
score above a factor, it is safe if P(Binomial(n, risk) <= k) <= level: the exact lower tail says that a true rate of
false rejection above `risk` is refuted. Factors are tried in order until one fails, which needs no correction; over the
strata the level is divided by their number. So with probability 1 - alpha all rules together reject no more than `risk` of
the good documents of any stratum. Labels are read whole, an id counts once; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, materialize, sieve, sifted

#: Characters that count as symbols, and the rules by the names of their ratios with their base cutoffs.
SYMBOLS = "#*$%&|<>"
RULES = {"symbols": 0.1, "dup_lines": 0.3, "repeats": 0.15, "long_words": 0.05, "upper": 0.25}
#: Factors of the cutoffs, loosest first: a score above the factor rejects. Steps of a sixth of an octave, from 8 to 1/4.
FACTORS = tuple(round(2 ** (3 - i / 6), 4) for i in range(31))


def _alike(rows: Column, key: str) -> Column:
    """Those of an array of structs, sorted by `key`, whose key a neighbour shares."""
    size = F.size(rows)
    same = lambda j, k: (k >= 1) & (k <= size) & (F.get(rows, k - 1)[key] == F.get(rows, j - 1)[key])
    js = F.filter(F.sequence(F.lit(1), size), lambda j: same(j, j - 1) | same(j, j + 1))
    return F.transform(js, lambda j: F.element_at(rows, j))


def _sum_windows(words: Column, width: int) -> Column:
    """Words inside windows of `width` words that the text has twice or more."""
    n = F.size(words)
    places = F.sequence(F.lit(1), n - F.lit(width - 1))

    def exact(hashes: Column) -> Column:
        # only for texts with equal hashes: the places whose hash repeats, of these the ones whose windows do, in order
        hashed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
        near = F.transform(let(hashed, lambda x: _alike(x, "h")), lambda x: F.struct(F.array_join(F.slice(words, x["i"], F.lit(width)), " ").alias("w"), x["i"].alias("i")))
        twice = F.array_sort(F.transform(let(F.sort_array(near), lambda x: F.when(F.size(x) > 0, _alike(x, "w")).otherwise(x)), lambda x: x["i"]))

        def covered(p: Column) -> Column:
            step = F.zip_with(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(width)))
            return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(step, F.lit(width), lambda x, y: x + y))

        return let(twice, covered)

    # each word is hashed once, each window by the hashes of its words
    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(places, lambda i: F.xxhash64(*[F.get(h, (i + (k - 1)).cast("int")) for k in range(width)])))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact(h)).otherwise(F.lit(0)))
    return F.when(n < F.lit(width + 1), F.lit(0)).otherwise(found).cast("long")


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, the base measures and the score of every whole text; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    stats = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _sum_windows(w, 5).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.length(x) > 25)).cast("long").alias("n_long"),
        ),
    )
    plain = F.translate("_text", SYMBOLS, "")
    upper = F.length(F.regexp_replace("_text", r"[^\p{Lu}]", "")).cast("long")
    out = docs.select(*keep, text.alias("_text")).select(
        *keep,
        stats.alias("_s"),
        (F.length("_text") - F.length(plain)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("all"))).alias("_l"),
        upper.alias("_upper"),
        F.monotonically_increasing_id().alias("_row"),  # no filter on the measures moves below here, where it would measure again
    )
    n = F.greatest(F.col("_s.n_words"), F.lit(1))
    ratio = {"symbols": F.col("n_symbols") / F.greatest(F.col("_s.word_chars"), F.lit(1)), "dup_lines": F.col("_l.dup") / F.greatest(F.col("_l.all"), F.lit(1)), "repeats": F.col("_s.n_repeat_words") / n, "long_words": F.col("_s.n_long") / n, "upper": F.col("_upper") / F.greatest(F.col("_s.word_chars"), F.lit(1))}
    score = F.greatest(*[ratio[r] / F.lit(c) for r, c in RULES.items()]).alias("_score")
    out = out.select(*keep, "_row", F.col("_s.n_words").alias("n_words"), F.col("_s.word_chars").alias("word_chars"), "n_symbols", F.col("_l.dup").alias("n_dup_lines"), F.col("_s.n_repeat_words").alias("n_repeat_words"), score)
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def most_allowed(n: Column, risk: float, level: Column) -> Column:
    """The largest k with P(Binomial(n, risk) <= k) <= level, or -1. Log-space sums over k up to the mean."""
    log_odds = F.log(F.lit(risk / (1 - risk)))
    start = F.struct((n * F.log(F.lit(1 - risk))).alias("term"), (n * F.log(F.lit(1 - risk))).alias("sum"), F.lit(-1).cast("long").alias("k"), F.lit(False).alias("over"))

    def step(s: Column, k: Column) -> Column:
        term = F.when(k == 0, s["term"]).otherwise(s["term"] + F.log((n - k + 1) / F.greatest(k, F.lit(1))) + log_odds)
        total = F.when(k == 0, term).otherwise(F.greatest(s["sum"], term) + F.log1p(F.exp(-F.abs(s["sum"] - term))))
        over = s["over"] | (total > F.log(level))
        return F.struct(term.alias("term"), total.alias("sum"), F.when(over, s["k"]).otherwise(k).alias("k"), over.alias("over"))

    steps = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(risk)).cast("long"))
    return F.aggregate(steps, start, step)["k"]


def known(labels: DataFrame) -> DataFrame:
    """(_labelled, _good) once for each id with a label of 0 or 1; of labels that disagree the worse one counts."""
    return labels.filter("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_labelled")).agg((F.min("quality") == 1).alias("_good"))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float, alpha: float) -> DataFrame:
    """(_stratum, factor): of the safe factors of a stratum the one that parts bad from good best, if any does.

    `measured` has `_id`, the stratum, base_failed and _score. Rows that share an id count once, with the largest score.
    Among safe factors the choice is free: bad documents caught less ten times the good ones lost, the loosest on ties; a
    stratum that gains nothing keeps to the base rules.
    """
    marks = known(labels)
    holdout = measured.filter("_row >= 0 and not base_failed").join(marks, measured["_id"] == marks["_labelled"])
    holdout = holdout.groupBy("_labelled", "_good").agg(F.max(F.struct(F.col("_score").alias("score"), F.col(stratum).alias("stratum"))).alias("x"))
    grid = F.array(*[F.lit(float(c)) for c in FACTORS])
    first = F.size(F.filter(grid, lambda c: c >= F.col("x.score"))).alias("first")  # the first factor that the score exceeds
    cells = holdout.select(F.col("x.stratum").alias("_stratum"), "_good", first).groupBy("_stratum", "_good", "first").agg(F.count("*").alias("n"))
    rows = materialize(cells.groupBy("_stratum").agg(F.collect_list(F.struct("_good", "first", "n")).alias("_cells")), "strata")  # two cells a factor at most
    total = lambda good, j: F.aggregate(F.filter("_cells", lambda c: (c["_good"] == good) & (c["first"] <= j)), F.lit(0).cast("long"), lambda a, c: a + c["n"])
    rows = rows.withColumn("_most", most_allowed(total(True, F.lit(len(FACTORS))), risk, F.lit(alpha / max(rows.count(), 1))))

    def judged(c: Column, j: Column) -> Column:
        lost = total(True, j)
        return F.struct((total(False, j) - 10 * lost).alias("gain"), c.alias("factor"), (lost <= F.col("_most")).alias("safe"))

    # good documents above a factor only grow along the grid, so the safe factors are those before the first unsafe one
    best = F.array_max(F.filter(F.transform(grid, judged), lambda g: g["safe"] & (g["gain"] > 0)))
    return rows.select("_stratum", best["factor"].alias("factor")).filter("factor is not null")


def _judged(measured: DataFrame, table: DataFrame) -> DataFrame:
    """`measured` with kept. A stratum has a factor only if it has ln(level) / ln(1 - risk) labels, so the table is far smaller than theirs."""
    out = measured.join(F.broadcast(table), measured["_st"].eqNullSafe(table["_stratum"]), "left")
    return out.filter("_row >= 0").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("_score") > F.col("factor"), F.lit(False)))


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, alpha: float = 0.1) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for each row.

    kept is false if the base rules fail or the score exceeds its stratum's factor. A null stratum is a stratum; one
    without a factor is judged by the base rules alone. Whole texts are measured, however long, each once; repeated rows
    repeat; an empty table gives an empty result. Other columns, whatever their names, are ignored.
    """
    measured = materialize(measures(_asked(docs, stratum), ["doc_id", "_id", "_st"]), "quality")
    out = _judged(measured, cutoffs(measured, labels, "_st", risk, alpha))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _asked(docs: DataFrame, stratum: str, *more: Column) -> DataFrame:
    return docs.select(*more, "doc_id", F.col("doc_id").cast("long").alias("_id"), F.col(stratum).alias("_st"), "text")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, alpha: float = 0.1) -> DataFrame:
    """The rows of `docs` that `verdicts` keeps, all columns as they are, whatever their names; odd rows fare as there.

    Texts with labels (and the few others that the sieve of labelled ids lets through) are measured for the factors, then
    all texts once as they pass.
    """
    marks = known(labels).select(F.xxhash64("_labelled").alias("hash"))
    some = sifted(_asked(docs, stratum), F.xxhash64("_id"), sieve(marks, marks.count())).filter("_passes")
    table = materialize(cutoffs(measures(some, ["_id", "_st"]), labels, "_st", risk, alpha), "cutoffs")
    measured = measures(_asked(docs, stratum, F.struct(*docs.columns).alias("row")), ["row", "_st"])
    return _judged(measured, table).filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])

"""Secret scan: fixed patterns, then a battery of randomness tests over long tokens with false-discovery control.

A candidate comes from a maximal run of 20 or more characters of the hex, base32, base64 and URL-safe alphabets. Where 20
letters and digits stand in a row, the parts between marks are candidates, each of 20 or more; elsewhere the parts between
`=`. The narrowest alphabet that holds a candidate is its inferred encoding. Three tests ask whether it looks like random
draws from that alphabet: chi-squared uniformity of its symbols, the number of runs above and below the middle of the
alphabet, and the correlation of neighbouring symbols, each a standard normal deviate z. Their log-likelihood under
randomness, -z^2 / 2 each, is added to the log-likelihood ratio of uniform draws against text: a chain over vowels,
consonants, digits and marks with the letters' frequencies and their case. That evidence, less the logarithm of the number
of alphabets, is -ln p of the text hypothesis: a ratio that no text model exceeds 1/p with a probability above p (Markov's
inequality), and terms that are never positive only lower it. The step-up procedure of Benjamini and Hochberg, run
separately for each octave of length, decides which candidates are secrets. It needs only the number of p-values in each
of a fixed number of bins, so its threshold is global, exact at bin edges and never above the level.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, materialize

#: Fixed patterns by kind, with the least length of the match or of its second group.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Alphabets by encoding, narrowest first, each in the order that the runs and correlation tests use.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "url64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Fixed values of the text model. Letters of English in percent; kinds of symbols; from row to column, how often a kind
#: follows a kind; how often a letter after a letter changes its case (after others either case is as likely).
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
VOWELS, MARKS = "aeiou", "+/-_"
FOLLOWS = {"v": {"v": 0.15, "c": 0.75, "d": 0.05, "m": 0.05}, "c": {"v": 0.50, "c": 0.42, "d": 0.04, "m": 0.04}, "d": {"v": 0.05, "c": 0.15, "d": 0.60, "m": 0.20}, "m": {"v": 0.25, "c": 0.60, "d": 0.10, "m": 0.05}}
CASE = 0.06
#: Bins of -ln p, four to a unit.
BINS = 400


def symbol_costs() -> dict[str, float]:
    """-ln of each symbol's share within its kind."""
    low = {chr(97 + i): x for i, x in enumerate(LETTERS)}
    share = {True: sum(x for c, x in low.items() if c in VOWELS), False: sum(x for c, x in low.items() if c not in VOWELS)}
    out = {c: -log(x / share[c in VOWELS]) for c, x in low.items()}
    return out | {c.upper(): x for c, x in out.items()} | dict.fromkeys("0123456789", log(10)) | dict.fromkeys(MARKS, log(len(MARKS)))


#: Kinds with their case: a candidate's symbols and, at the same places, their kinds.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + MARKS
KIND_OF = "".join(k for c in SYMBOLS for k in (("v" if c.lower() in VOWELS else "c") if c.islower() else ("V" if c.lower() in VOWELS else "C") if c.isupper() else "d" if c.isdigit() else "m"))


def step_costs() -> dict[str, float]:
    """-ln of how likely a kind with its case follows another; of the first kind, keyed alone, a fourth."""
    case = lambda a, b: 1.0 if b in "dm" else 0.5 if a in "dm" else CASE if a.islower() != b.islower() else 1 - CASE
    kinds = "vVcCdm"
    out = {a + b: -log(FOLLOWS[a.lower()][b.lower()] * case(a, b)) for a in kinds for b in kinds}
    return out | {b: -log(0.25 * case("m", b)) for b in kinds}


def starts(lengths: Column, chunk: int = 128) -> Column:
    """The sum of the lengths before each place. Chunks are appended, so long arrays are not copied place by place."""
    none = lambda kind: F.expr(f"cast(array() as {kind})")

    def inside(at: Column, part: Column) -> Column:
        first = F.struct(at.alias("at"), none("array<int>").alias("out"))
        return F.aggregate(part, first, lambda a, n: F.struct((a["at"] + n).cast("int").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))

    def outer(acc: Column, c: Column) -> Column:
        part = inside(acc["at"], F.slice(lengths, c * chunk + 1, F.lit(chunk)))
        return let(part, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))

    chunks = F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(lengths) - 1) / chunk).cast("int"))
    zero = F.struct(F.lit(0).alias("at"), none("array<array<int>>").alias("out"))
    return F.when(F.size(lengths) == 0, none("array<int>")).otherwise(F.flatten(F.aggregate(chunks, zero, outer)["out"]))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, found), in code points."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})") if not pattern.startswith("(?i)") else F.lit(f"(?i)({pattern[4:]})"), F.lit(1))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def placed(lengths: Column, hits: Column) -> Column:
        before = F.slice(lengths, F.lit(1), F.size(hits))
        ends = starts(F.zip_with(before, hits, lambda a, b: a + F.length(b)))
        at = F.zip_with(F.zip_with(ends, before, lambda a, b: a + b), hits, lambda a, b: F.struct(a.alias("start"), (a + F.length(b)).alias("end"), b.alias("found")))
        return at

    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")
    return let(found, lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(between, lambda lengths: placed(lengths, hits))))


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["end"].alias("end")))


def _table(costs: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in costs.items() for x in kv])


def battery(token: Column) -> Column:
    """(chi, runs, serial, text, evidence) of a token: the three tests' deviates, -ln of its likelihood as text, and -ln p; null if no alphabet holds it."""
    fits = F.array_compact(F.array(*[F.when(F.translate(token, a, "") == "", F.lit(a)) for a in ALPHABETS.values()]))

    letters = lambda t: F.filter(F.split(t, ""), lambda c: c != "")  # noqa: E731  (a place in a string is found from its start, one in an array at once)

    def as_text(t: Column) -> Column:
        unit, step = _table(symbol_costs()), _table(step_costs())
        steps = lambda k: F.zip_with(F.concat(F.array(F.lit("")), F.slice(k, F.lit(1), F.size(k) - 1)), k, lambda a, b: F.element_at(step, F.concat(a, b)))
        costs = F.zip_with(letters(t), let(letters(F.translate(t, SYMBOLS, KIND_OF)), steps), lambda c, s: F.element_at(unit, c) + s)
        return F.aggregate(costs, F.lit(0.0), lambda a, x: a + x)

    def tested(t: Column, alphabet: Column) -> Column:
        n = F.length(t).cast("double")
        m = F.length(alphabet).cast("double")
        values = F.transform(letters(t), lambda c: F.instr(alphabet, c) - 1)

        def stats(v: Column) -> Column:
            # sum of squares of symbol counts = pairs of equal symbols, from the run lengths of the sorted values
            s = F.sort_array(v)
            squares = F.aggregate(
                s,
                F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("sq")),
                lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"], a["c"] + 1).otherwise(F.lit(1).cast("long")).alias("c"), (a["sq"] + F.when(x == a["last"], 2 * a["c"] + 1).otherwise(F.lit(1).cast("long"))).alias("sq")),
            )["sq"]
            chi = squares * m / n - n
            df = m - 1
            z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
            high = F.aggregate(v, F.lit(0), lambda a, x: a + F.when(x * 2 >= m, 1).otherwise(0)).cast("double")
            low = n - high
            pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
            runs = 1 + F.aggregate(pairs, F.lit(0), lambda a, p: a + F.when((p["a"] * 2 >= m) != (p["b"] * 2 >= m), 1).otherwise(0))
            mean = 2 * high * low / n + 1
            var = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
            z_runs = F.when(var > 0, (runs - mean) / F.sqrt(var)).otherwise(F.lit(99.0))
            mid, spread = (m - 1) / 2, (m * m - 1) / 12
            z_serial = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - mid) * (p["b"] - mid)) / (spread * F.sqrt(n - 1))
            return F.struct(z_chi.alias("chi"), z_runs.alias("runs"), z_serial.alias("serial"), as_text(t).alias("text"))

        evidence = lambda z: z["text"] - n * F.log(m) - log(len(ALPHABETS)) - (z["chi"] * z["chi"] + z["runs"] * z["runs"] + z["serial"] * z["serial"]) / 2
        return let(let(values, stats), lambda z: F.struct(z["chi"].alias("chi"), z["runs"].alias("runs"), z["serial"].alias("serial"), z["text"].alias("text"), evidence(z).alias("evidence")))

    return let(fits, lambda a: F.when(F.size(a) > 0, tested(token, F.element_at(a, 1))))


def _candidates(spans: Column) -> Column:
    """Tokens of 20 or more characters of candidate runs, tested: between marks where 20 letters and digits stand in a row, else between `=`."""

    def parts(s: Column) -> Column:
        cut = F.when(s["found"].rlike("[A-Za-z0-9]{20}"), F.split(s["found"], "[^A-Za-z0-9]", -1)).otherwise(F.split(s["found"], "=", -1))
        at = lambda p: F.zip_with(starts(F.transform(p, lambda x: F.length(x) + 1)), p, lambda a, x: F.struct((s["start"] + a).alias("start"), x.alias("found")))
        return F.filter(let(cut, at), lambda x: F.length(x["found"]) >= 20)

    tested = F.transform(F.flatten(F.transform(spans, parts)), lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["found"])).alias("end"), F.greatest(battery(s["found"])["evidence"], F.lit(0.0)).alias("e")))
    octave = lambda s: F.floor(F.log2((s["end"] - s["start"]).cast("double"))).cast("int")
    return F.transform(tested, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), octave(s).alias("octave"), F.least(F.floor(F.coalesce(s["e"], F.lit(0.0)) * 4).cast("int"), F.lit(BINS)).alias("bin")))


def found(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, the three base span arrays and the tested candidates of every whole text."""
    text = F.col("_text")
    eight = lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 8
    base = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    return base.select(
        *keep,
        _kind(F.filter(matches(text, ASSIGN), eight), "assign").alias("_assign"),
        _kind(F.filter(matches(text, ACCESS), lambda s: F.length(s["found"]) >= 16), "access").alias("_access"),
        _kind(matches(text, HEX), "hex").alias("_hex"),
        _candidates(matches(text, CANDIDATE)).alias("_candidates"),
    )


def thresholds(found_: DataFrame, level: float) -> DataFrame:
    """(octave, least): the least bin of -ln p whose candidates are discoveries, per octave of length."""
    binned = found_.select(F.explode("_candidates").alias("c")).groupBy("c.octave", "c.bin").count()
    w = W.partitionBy("octave")  # BINS + 1 rows at most
    at_least = F.sum("count").over(w.orderBy(F.desc("bin")))
    steps = binned.select("octave", "bin", at_least.alias("k"), F.sum("count").over(w).alias("m"))
    ok = F.col("bin") / 4 >= F.log(F.col("m") / (F.col("k") * level))  # p <= level * k / m at the bin's lower edge
    return steps.filter(ok).groupBy("octave").agg(F.min("bin").alias("least"))


def scan(docs: DataFrame, level: float = 0.001) -> DataFrame:
    """One row for each of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    spans lists kind:start:end by start, then kind as in KINDS, then end; `random` spans are the battery's discoveries that
    overlap no base span. A null text counts as empty, texts are read whole, however long; repeated rows repeat; without
    candidates, as in an empty table, there is no threshold and no discovery. The threshold is taken over all rows. Other
    columns, whatever their names, are ignored.
    """
    rows = materialize(found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]), "secrets")
    picked = {r["octave"]: r["least"] for r in thresholds(rows, level).collect()}  # a row per octave of length
    limit = lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in (picked or {-1: BINS + 1}).items() for x in kv]), c["octave"]), F.lit(BINS + 1))
    base = F.concat("_assign", "_access", "_hex")
    more = F.filter("_candidates", lambda c: (c["bin"] > 0) & (c["bin"] >= limit(c)))
    more = F.filter(more, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    line = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1), s["start"], s["end"])), ",")
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.concat(base, _kind(more, "random"))).alias("spans"),
    )

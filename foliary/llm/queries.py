"""Queries over the shared tables for the corpus operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets
from .common import documents
from .cotraining import classify
from .exact_dedup import exact_groups
from .language_id import identify
from .mixing import mix
from .packing import pack, words
from .quality_rules import FACTORS, RULES, verdicts
from .secrets import scan
from .sharding import assign_shards
from .simhash import near_duplicates
from .token_counts import count_tokens

#: Names of the shards that documents are placed on, and the slots of their lookup table.
SHARDS, SLOTS = [f"shard-{i:02d}" for i in range(32)], 4099


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document by its id."""
    return assign_shards(documents(spark, sf_dir), "doc_id", SHARDS, SLOTS)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(documents(spark, sf_dir), tokenizer_path())


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded length and batch of every document, by its words."""
    lengths = documents(spark, sf_dir).select("doc_id", words(F.col("text")).alias("n"))
    return pack(lengths, F.col("n"), ["doc_id"]).drop("n")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    return verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document and the row that stays."""
    return exact_groups(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of sources by the square roots of their sizes."""
    return mix(documents(spark, sf_dir).select("doc_id", "source"), "source", ["doc_id"])


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return scan(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document by text, by metadata and by both."""
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _simhash_sql(seed: int = 42, radius: int = 2) -> str:
    """XXH64 of each distinct shingle by arithmetic modulo 2^64; bits by 64 sums; all pairs of fingerprints, and what they reach."""
    m = f"{1 << 64}::UHUGEINT"
    p1, p2, p3, p4, p5 = (f"{x}::UHUGEINT" for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    bound = lambda value, name, body: f"list_transform([{value}], lambda {name}: {body})[1]"
    turned = lambda value, r: bound(value, "q", f"(q * {1 << r}::UHUGEINT % {m} + q // {1 << (64 - r)}::UHUGEINT)")
    either = lambda a, b: f"xor(({a})::UBIGINT, ({b})::UBIGINT)::UHUGEINT"
    mixed = lambda acc, lane: f"({turned(f'({acc} + {lane} * {p2} % {m}) % {m}', 31)} * {p1} % {m})"
    number = lambda at, width: "('0x' || " + " || ".join(f"substr(x, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(width))) + ")::UBIGINT::UHUGEINT"
    starts = [f"({seed} + {p1} + {p2}) % {m}", f"({seed} + {p2}) % {m}", f"{seed}::UHUGEINT", f"({seed} + {m} - {p1}) % {m}"]
    lanes = ", ".join(f"list_reduce([{v}] || list_transform(range(0, n // 32), lambda j: lanes[4 * j + {i + 1}]), lambda acc, y: {mixed('acc', 'y')}) AS v{i}" for i, v in enumerate(starts))
    joined = f"list_reduce([({' + '.join(turned(f'v{i}', r) for i, r in enumerate((1, 7, 12, 18)))}) % {m}, {', '.join(mixed('0::UHUGEINT', f'v{i}') for i in range(4))}], lambda acc, y: ({either('acc', 'y')} * {p1} + {p4}) % {m})"
    bits = " + ".join(f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(64))
    return f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM w WHERE len(w) > 0),
        b AS (SELECT s, strlen(s) AS n, hex(s) AS x FROM (SELECT DISTINCT s FROM g)),
        l AS (SELECT *, list_transform(range(0, n // 8), lambda k: {number("8 * k", 8)}) AS lanes FROM b),
        v AS (SELECT *, {lanes} FROM l),
        j AS (SELECT s, n, x, lanes, ((CASE WHEN n >= 32 THEN {joined} ELSE {seed} + {p5} END) + n::UHUGEINT) % {m} AS h FROM v),
        t8 AS (SELECT s, n, x, list_reduce([h] || lanes[4 * (n // 32) + 1:], lambda acc, y: ({turned(either('acc', mixed('0::UHUGEINT', 'y')), 27)} * {p1} + {p4}) % {m}) AS h FROM j),
        t4 AS (SELECT s, n, x, CASE WHEN n % 8 >= 4 THEN ({turned(either('h', f"{number('8 * (n // 8)', 4)} * {p1} % {m}"), 23)} * {p2} + {p3}) % {m} ELSE h END AS h FROM t8),
        t1 AS (SELECT s, list_reduce([h] || list_transform(range(4 * (n // 4), n), lambda k: {number('k', 1)}), lambda acc, y: {turned(either('acc', f'y * {p5} % {m}'), 11)} * {p1} % {m}) AS h FROM t4),
        f1 AS (SELECT s, {either('h', f'h // {1 << 33}::UHUGEINT')} * {p2} % {m} AS h FROM t1),
        f2 AS (SELECT s, {either('h', f'h // {1 << 29}::UHUGEINT')} * {p3} % {m} AS h FROM f1),
        f3 AS (SELECT s, {either('h', f'h // {1 << 32}::UHUGEINT')}::UBIGINT AS h FROM f2),
        fp AS (SELECT doc_id, ({bits})::UBIGINT AS fp FROM g JOIN f3 USING (s) GROUP BY doc_id),
        d AS MATERIALIZED (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM documents LEFT JOIN fp USING (doc_id)),
        c AS MATERIALIZED (SELECT fp, min(doc_id) AS least FROM d GROUP BY fp),
        e AS MATERIALIZED (SELECT a.fp AS a, b.fp AS b FROM c a JOIN c b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {radius}),
        r AS (SELECT fp AS a, fp AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
        k AS (SELECT r.a AS fp, min(c.least) AS component_id FROM r JOIN c ON c.fp = r.b GROUP BY 1)
        SELECT doc_id, lpad(lower(hex(fp)), 16, '0') AS fingerprint, component_id FROM d JOIN k USING (fp)"""


def _sharding_sql() -> str:
    """Shards claim slots in turn: a row of the recursion for each claim."""
    names = ", ".join(f"'{s}'" for s in SHARDS)
    number = lambda text: f"('0x' || substr(md5({text}), 1, 15))::BIGINT"
    spot = f"(starts[c] + j * steps[c]) % {SLOTS} + 1"
    return f"""
        WITH RECURSIVE s AS (SELECT [{names}] AS names),
        p AS (SELECT names, list_transform(names, lambda x: {number("x || '/offset'")} % {SLOTS}) AS starts, list_transform(names, lambda x: {number("x || '/skip'")} % ({SLOTS} - 1) + 1) AS steps FROM s),
        claim AS (
            SELECT 0 AS t, list_transform(range({SLOTS}), lambda x: (0 - 1)) AS owners, list_transform(range({len(SHARDS)}), lambda x: 0::BIGINT) AS turns FROM p
            UNION ALL
            SELECT t + 1, list_slice(owners, 1, place - 1) || [c - 1] || list_slice(owners, place + 1, len(owners)), list_slice(turns, 1, c - 1) || [j + 1] || list_slice(turns, c + 1, len(turns))
            FROM (SELECT *, {spot} AS place FROM (
                SELECT t, owners, turns, starts, steps, t % {len(SHARDS)} + 1 AS c,
                       list_filter(range(turns[t % {len(SHARDS)} + 1], {SLOTS}), lambda j: owners[(starts[t % {len(SHARDS)} + 1] + j * steps[t % {len(SHARDS)} + 1]) % {SLOTS} + 1] < 0)[1] AS j
                FROM claim, p WHERE t < {SLOTS}))),
        book AS (SELECT owners FROM claim WHERE t = {SLOTS}),
        d AS (SELECT doc_id, CAST({number("coalesce(CAST(doc_id AS VARCHAR), '')")} % {SLOTS} AS INT) AS slot FROM documents)
        SELECT doc_id, slot, names[owners[slot + 1] + 1] AS shard FROM d, book, s"""


#: The number by which `common.spread` places an id, for SQL.
SPREAD = "('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT"


def _packing_sql(buckets: int = 16, budget: int = 65_536, order: str = f"{SPREAD}, doc_id") -> str:
    """All predecessors of all lengths, bucket by bucket; a cost and the place that it comes from in one number."""
    return f"""
        WITH RECURSIVE d AS (SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_words FROM documents),
        h AS (SELECT greatest(n_words, 1) AS len, count(*) AS c FROM d GROUP BY 1),
        a AS (SELECT list(len ORDER BY len) AS size, list(total ORDER BY len) AS total, count(*) AS n FROM (SELECT len, CAST(sum(c) OVER (ORDER BY len) AS BIGINT) AS total FROM h)),
        dp AS (
            SELECT 1 AS k, list_transform(range(1, n + 1), lambda j: (total[j] * size[j])::HUGEINT) AS cost, [[0::HUGEINT]] AS back FROM a
            UNION ALL
            SELECT k + 1, list_transform(code, lambda x: x // 1000000), back || [list_transform(code, lambda x: x % 1000000)] FROM (
                SELECT k, back, list_transform(range(1, n + 1), lambda j: list_min(list_transform(range(k, j), lambda i: (cost[i] + (total[j] - total[i]) * size[j]) * 1000000 + i))) AS code FROM dp, a WHERE k < least({buckets}, n))),
        path AS (
            SELECT k, n AS j, back FROM dp, a WHERE k = least({buckets}, n)
            UNION ALL
            SELECT k - 1, CAST(back[k][j] AS BIGINT), back FROM path WHERE k > 1),
        e AS (SELECT list(size[j]) AS edges FROM path, a),
        p AS (SELECT d.*, CAST(list_min(list_filter(edges, lambda x: x >= n_words)) AS BIGINT) AS bucket_len FROM d, e),
        r AS (SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY {order}) - 1 AS r, greatest(1, {budget} // bucket_len) AS rows FROM p)
        SELECT doc_id, n_words, bucket_len, bucket_len || ':' || (r // rows) AS batch_id, CAST(r % rows AS INT) AS batch_pos FROM r"""


def _mixing_sql(rows_each: int = 16) -> str:
    """A row of the recursion for each slot: of the released blocks of the sources that have any left, the one due first."""
    return f"""
        WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
        s AS (SELECT list(source ORDER BY source NULLS LAST) AS names, list(greatest(1, round(sqrt(n) * 1000))::HUGEINT ORDER BY source NULLS LAST) AS w,
                     list((n + {rows_each - 1}) // {rows_each} ORDER BY source NULLS LAST) AS blocks, count(*) AS k FROM n),
        step AS (
            SELECT 0 AS slot, 0 AS start, 0 AS phase, list_transform(range(k), lambda i: 0::BIGINT) AS done, list_transform(range(k), lambda i: 0::BIGINT) AS mine, 0::BIGINT AS c, 0::HUGEINT AS release, 0::HUGEINT AS due, 0 AS was, 0::BIGINT AS block FROM s
            UNION ALL
            SELECT slot + 1, CASE WHEN last THEN slot + 1 ELSE start END, phase + last::INT, list_slice(done, 1, c - 1) || [done[c] + 1] || list_slice(done, c + 1, k),
                   CASE WHEN last THEN list_transform(range(k), lambda i: 0::BIGINT) ELSE list_slice(mine, 1, c - 1) || [mine[c] + 1] || list_slice(mine, c + 1, k) END, c, start + mine[c] * total // w[c], start + ((mine[c] + 1) * total + w[c] - 1) // w[c], phase, done[c]
            FROM (SELECT *, done[c] + 1 = blocks[c] AS last FROM (
                SELECT *, (list_min(list_transform(list_filter(live, lambda i: mine[i] * total // w[i] <= slot - start), lambda i: ((mine[i] + 1) * total + w[i] - 1) // w[i] * 100000 + i)) % 100000)::BIGINT AS c FROM (
                    SELECT *, list_sum(list_transform(live, lambda i: w[i]))::HUGEINT AS total FROM (
                        SELECT step.slot, step.start, step.phase, step.done, step.mine, s.*, list_filter(range(1, k + 1), lambda i: done[i] < blocks[i]) AS live FROM step, s) WHERE len(live) > 0)))),
        d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {SPREAD}, doc_id) - 1 AS r FROM documents)
        SELECT doc_id, source, CAST(was AS INT) AS mix_phase, block AS mix_block, CAST(release AS BIGINT) AS mix_release, CAST(due AS BIGINT) AS mix_due, CAST(slot - 1 AS BIGINT) AS mix_slot, CAST(r % {rows_each} AS INT) AS mix_pos
        FROM d, s JOIN step ON step.c > 0 WHERE d.source IS NOT DISTINCT FROM s.names[step.c] AND step.block = r // {rows_each}"""


def _quality_sql(risk: float = 0.02, alpha: float = 0.1) -> str:
    """Measures by windows as rows; the binomial tail by log-gamma; the same choice among safe factors."""
    ratio = {"symbols": "n_symbols / greatest(word_chars, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)", "long_words": "n_long / greatest(n_words, 1)", "upper": "n_upper / greatest(word_chars, 1)"}
    score = ", ".join(f"{ratio[r]} / {c}::DOUBLE" for r, c in RULES.items())
    grid = ", ".join(f"({c}::DOUBLE)" for c in FACTORS)
    return f"""
        WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
        v AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 3, 1))) AS i, words FROM w),
        g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS n FROM v),
        r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY 1),
        m AS (SELECT w.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda x: length(x) > 25)) AS n_long, length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_upper
              FROM w LEFT JOIN r USING (doc_id)),
        t AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest({score}) AS score FROM m),
        y AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY 1),
        x AS (SELECT lang, score, quality FROM t JOIN y USING (doc_id) WHERE NOT base_failed),
        k AS (SELECT lang, c, CAST(count_if(quality = 1 AND score > c) AS BIGINT) AS good, CAST(count_if(quality = 0 AND score > c) AS BIGINT) AS bad, CAST(count_if(quality = 1) AS BIGINT) AS n FROM x, (VALUES {grid}) AS q(c) GROUP BY ALL),
        l AS (SELECT *, {alpha} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM x)) AS level FROM k),
        s AS (SELECT *, list_sum(list_transform(range(0, good + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln({1 - risk})))) AS tail FROM l WHERE n > 0 AND good <= floor(n * {risk})),
        pick AS (SELECT lang, c AS factor FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY bad - 10 * good DESC, c DESC) AS rn FROM s WHERE tail <= level AND bad - 10 * good > 0) WHERE rn = 1)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR coalesce(score > factor, false)) AS kept FROM t LEFT JOIN pick ON pick.lang IS NOT DISTINCT FROM t.lang"""


def _secrets_sql(level: float = 0.001) -> str:
    """Matches placed by the lengths of what lies between them; the battery over lists of symbol numbers."""
    quoted = lambda p: p.replace("'", "''")
    patterns = {"assign": secrets.ASSIGN, "access": secrets.ACCESS, "hex": secrets.HEX, "run": secrets.CANDIDATE}
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS kind, hits[i] AS hit, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a "
        f"FROM (SELECT doc_id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{quoted(p)}') AS hits, regexp_split_to_array(t, '{quoted(p)}') AS pieces FROM d))"
        for k, p in patterns.items()
    )
    alphabet = " ".join(f"WHEN regexp_full_match(tok, '[{a.replace('-', chr(92) + '-')}]+') THEN '{a}'" for a in secrets.ALPHABETS.values())
    ranks = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(secrets.KINDS))
    kinds, unit, step = "vVcCdm", secrets.symbol_costs(), secrets.step_costs()
    listed = lambda xs: "[" + ", ".join(f"{x!r}::DOUBLE" for x in xs) + "]"
    units, firsts, steps = listed(unit[c] for c in secrets.SYMBOLS), listed(step[k] for k in kinds), listed(step[a + b] for a in kinds for b in kinds)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
        b AS (SELECT doc_id, kind, CAST(a AS BIGINT) AS a, CAST(a + length(hit) AS BIGINT) AS e FROM f
              WHERE kind = 'hex' OR (kind = 'access' AND length(hit) >= 16) OR (kind = 'assign' AND length(regexp_extract(hit, '{quoted(secrets.ASSIGN)}', 2)) >= 8)),
        c AS (SELECT doc_id, CAST(a + coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x) + 1)), 0) AS BIGINT) AS a, parts[i] AS tok FROM (
                  SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT *, CASE WHEN regexp_matches(hit, '[A-Za-z0-9]{{20}}') THEN regexp_split_to_array(hit, '[^A-Za-z0-9]') ELSE string_split(hit, '=') END AS parts FROM f WHERE kind = 'run'))),
        g AS (SELECT *, length(tok) AS n, CASE {alphabet} END AS letters FROM c WHERE length(tok) >= 20),
        v AS (SELECT *, length(letters) AS m, list_transform(range(1, n + 1), lambda i: instr(letters, substr(tok, i, 1)) - 1) AS v, list_transform(range(1, n + 1), lambda i: instr('{secrets.SYMBOLS}', substr(tok, i, 1))) AS places FROM g),
        o AS (SELECT *, list_transform(places, lambda x: instr('{kinds}', substr('{secrets.KIND_OF}', x, 1))) AS kinds FROM v),
        s AS (SELECT *, list_sum(list_transform(map_values(list_histogram(v)), lambda x: x * x))::DOUBLE * m / n - n AS chi, m - 1.0::DOUBLE AS df, len(list_filter(v, lambda x: x * 2 >= m))::DOUBLE AS high,
                     1 + len(list_filter(range(1, n), lambda i: (v[i] * 2 >= m) <> (v[i + 1] * 2 >= m))) AS runs, list_sum(list_transform(range(1, n), lambda i: (v[i] - (m - 1) / 2) * (v[i + 1] - (m - 1) / 2))) / ((m * m - 1) / 12 * sqrt(n - 1)) AS z3,
                     list_sum(list_transform(range(1, n + 1), lambda i: {units}[places[i]] + CASE WHEN i = 1 THEN {firsts}[kinds[1]] ELSE {steps}[(kinds[greatest(i - 1, 1)] - 1) * 6 + kinds[i]] END)) AS words FROM o),
        z AS (SELECT *, (pow(greatest(chi, 0) / df, 1.0 / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)) AS z1, high * (n - high) * 2 AS hl FROM s),
        e AS (SELECT *, CASE WHEN hl * (hl - n) > 0 THEN (runs - hl / n - 1) / sqrt(greatest(hl * (hl - n), 1e-9) / (n * n * (n - 1))) ELSE 99 END AS z2 FROM z),
        q AS (SELECT *, greatest(coalesce(words - n * ln(m) - ln({len(secrets.ALPHABETS)}) - (z1 * z1 + z2 * z2 + z3 * z3) / 2, 0), 0) AS nlp FROM e),
        k AS (SELECT doc_id, a, a + n AS e, CAST(floor(log2(n)) AS INT) AS octave, least(CAST(floor(nlp * 4) AS INT), {secrets.BINS}) AS bin FROM q),
        h AS (SELECT octave, bin, count(*) AS n FROM k GROUP BY ALL),
        w AS (SELECT octave, min(bin) AS least FROM (SELECT octave, bin, sum(n) OVER (PARTITION BY octave ORDER BY bin DESC) AS above, sum(n) OVER (PARTITION BY octave) AS m FROM h) WHERE bin / 4 >= ln(m / (above * {level})) GROUP BY 1),
        r AS (SELECT doc_id, 'random' AS kind, a, e FROM k JOIN w USING (octave) WHERE bin > 0 AND bin >= least AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = k.doc_id AND b.a < k.e AND k.a < b.e)),
        x AS (SELECT *, CASE kind {ranks} END AS o FROM (SELECT * FROM b UNION ALL SELECT * FROM r)),
        y AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                     string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, o, e) FILTER (kind <> 'random') AS base, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, o, e) AS spans FROM x GROUP BY 1)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN y USING (doc_id)"""


_EXACT_SQL = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def pipeline_sql() -> str:
    """The SQL of the five stages, each over what the one before it keeps."""
    over = lambda sql, name: sql.replace("documents", name)
    return f"""
        WITH kept_1 AS MATERIALIZED (SELECT d.* FROM documents d JOIN ({_quality_sql()}) q USING (doc_id) WHERE kept),
        kept_2 AS MATERIALIZED (SELECT d.* FROM kept_1 d JOIN ({over(_EXACT_SQL, "kept_1")}) q USING (doc_id) WHERE kept),
        kept_3 AS MATERIALIZED (SELECT d.* FROM kept_2 d JOIN ({over(_simhash_sql(), "kept_2")}) q USING (doc_id) WHERE doc_id = component_id),
        kept_4 AS MATERIALIZED (SELECT d.*, row_number() OVER (ORDER BY mix_slot, mix_pos) AS place FROM kept_3 d JOIN ({over(_mixing_sql(), "kept_3")}) q USING (doc_id))
        {over(_packing_sql(order="place"), "kept_4").replace("WITH RECURSIVE", "SELECT * FROM (WITH RECURSIVE", 1)})"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_sharding, op3_language_id, op4_token_counts, op5_packing, op6_quality_rules, op7_exact_dedup, op8_mixing, op9_secrets, op10_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_simhash": _simhash_sql(),
        "op2_sharding": _sharding_sql(),
        "op6_quality_rules": _quality_sql(),
        "op9_secrets": _secrets_sql(),
        "op5_packing": _packing_sql(),
        "op8_mixing": _mixing_sql(),
        "op7_exact_dedup": _EXACT_SQL,
    }

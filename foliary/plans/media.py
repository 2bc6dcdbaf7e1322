"""Queries on transcripts, pages and URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rights, text, urls
from ..operators import audit, evaluate, intervals, pages, turns
from .registry import query, table

RUNS = """
    WITH e AS (SELECT user_id, event_id, event_type, value, ts, epoch_us(ts) / 1000000.0 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM events),
    f AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND no > 1 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY no)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY no) AS run FROM f)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("t"))
    return e


@query(RUNS + " SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS n, round(max(t) - min(t), 3) AS seconds FROM r GROUP BY ALL")
def turn_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01, WIN-02: runs of equal event types of every user."""
    runs = turns.islands(_events(spark, sf_dir), ["user_id"], ["t", "event_id"], "event_type")
    return runs.groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"), F.round(F.max("t") - F.min("t"), 3).alias("seconds"))


@query(RUNS + """,
    s AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS words FROM r),
    k AS (SELECT *, last_value(CASE WHEN run = 1 OR words >= 2 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY no) AS folded FROM s),
    g AS (SELECT *, CASE WHEN lag(folded) OVER (PARTITION BY user_id ORDER BY no) IS NOT DISTINCT FROM folded AND no > 1 THEN 0 ELSE 1 END AS n2 FROM k),
    h AS (SELECT *, sum(n2) OVER (PARTITION BY user_id ORDER BY no) AS run2 FROM g)
    SELECT user_id, CAST(run2 AS BIGINT) AS run, folded AS speaker, count(*) AS n FROM h GROUP BY ALL""")
def short_run_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01: single events fold into the run before them, then equal neighbours merge."""
    words = turns.fold_short_runs(_events(spark, sf_dir), ["user_id"], ["t", "event_id"], "event_type", F.col("t"), F.col("t"), 2, 0.0)
    return words.groupBy("user_id", "run", F.col("folded").alias("speaker")).agg(F.count("*").alias("n"))


SAID = """
    WITH c AS (SELECT conv_id, turn AS no, 'S' || CAST((turn // 2) % 3 AS VARCHAR) AS speaker, text FROM conversations WHERE trim(text) <> ''),
    f AS (SELECT *, CASE WHEN lag(speaker) OVER w IS NOT DISTINCT FROM speaker AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY no)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY no) AS turn FROM f),
    t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, speaker, CAST(min(no) AS DOUBLE) AS start, count(*) AS n, string_agg(text, ' ' ORDER BY no) AS text FROM r GROUP BY ALL)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("no"), F.concat(F.lit("S"), (F.floor(F.col("turn") / 2) % 3).cast("string")).alias("speaker"), "text", F.col("turn").cast("double").alias("time"))
    return turns.build_turns(said, ["conv_id"], ["no"], "speaker", "text", "time")


@query(SAID + " SELECT conv_id, turn, speaker, start, n, sha256(text) AS digest FROM t")
def turn_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-03: conversation lines as turns of three speakers."""
    return _turns(spark, sf_dir).select("conv_id", "turn", "speaker", "start", "n", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query(SAID + ", s AS (SELECT conv_id, speaker, min(turn) AS first_turn, arg_min(start, turn) AS first_time FROM t GROUP BY ALL) SELECT *, '[speaker ' || CAST(row_number() OVER (PARTITION BY conv_id ORDER BY first_turn) AS VARCHAR) || ']' AS label FROM s")
def speaker_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-09, WIN-13: speakers by first appearance."""
    return turns.roster(_turns(spark, sf_dir), ["conv_id"])


@query(SAID + """, b AS (SELECT conv_id, turn, '<!-- speaker: ' || speaker || ' -->' || chr(10) || printf('%02d:%02d:%02d.%d', CAST(start // 3600 AS INT), CAST(start % 3600 // 60 AS INT), CAST(start % 60 AS INT), 0) || ' ' || text AS block FROM t)
    SELECT conv_id, sha256(string_agg(block, chr(10) || chr(10) ORDER BY turn) || chr(10)) AS digest FROM b GROUP BY conv_id""")
def transcript_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-39, SCL-41: conversations as transcript bodies."""
    line = F.array(F.concat(text.timecode(F.col("start"), tenths=True), F.lit(" "), F.col("text")))
    return turns.render(_turns(spark, sf_dir), ["conv_id"], line).select("conv_id", F.sha2(F.col("body").cast("binary"), 256).alias("digest"))


@query(RUNS + " SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY no) AS marker FROM r")
def forward_fill_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-12: each event's last signup."""
    rows = turns.forward_fill(_events(spark, sf_dir), ["user_id"], ["t", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "marker")
    return rows.select("user_id", "event_id", "marker")


TRACKS = RUNS + """,
    p AS (SELECT user_id, event_id AS point, t FROM r WHERE event_type = 'click' OR event_type = 'view'),
    k AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY no) AS ord, t - 1800 AS s, t + 3600 AS e, 'T' || CAST(event_id % 5 AS VARCHAR) AS speaker FROM r WHERE event_type = 'purchase')"""


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    e = _events(spark, sf_dir).filter("event_type = 'purchase'")
    ord_ = F.row_number().over(W.partitionBy("user_id").orderBy("t", "event_id"))
    return e.select("user_id", ord_.alias("ord"), (F.col("t") - 1800).alias("start"), (F.col("t") + 3600).alias("end"), F.concat(F.lit("T"), (F.col("event_id") % 5).cast("string")).alias("speaker"))


@query(TRACKS + """,
    g AS (SELECT p.user_id, p.point, k.speaker, p.t BETWEEN k.s AND k.e AS inside, CASE WHEN p.t BETWEEN k.s AND k.e THEN 0 WHEN k.s > p.t THEN k.s - p.t ELSE p.t - k.e END AS gap, k.ord FROM p JOIN k USING (user_id)),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id, point ORDER BY inside DESC, CASE WHEN inside THEN 0 ELSE gap END, ord) AS rn FROM g)
    SELECT user_id, point, speaker, inside FROM n WHERE rn = 1""")
def point_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-04: clicks and views in the time around purchases, or nearest to it."""
    points = _events(spark, sf_dir).filter("event_type in ('click', 'view')").select("user_id", F.col("event_id").alias("point"), "t")
    return intervals.point_in_interval(points, _tracks(spark, sf_dir), "user_id", 3600.0)


@query(TRACKS + """,
    sp AS (SELECT user_id, event_id AS span, t AS s, t + value * 60 AS e FROM r WHERE event_type <> 'purchase'),
    o AS (SELECT sp.user_id, sp.span, k.speaker, sum(least(sp.e, k.e) - greatest(sp.s, k.s)) AS ov, min(k.ord) AS ord FROM sp JOIN k ON sp.user_id = k.user_id AND sp.s < k.e AND k.s < sp.e GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id, span ORDER BY ov DESC, ord) AS rn FROM o)
    SELECT user_id, span, speaker, round(ov, 3) AS overlap FROM n WHERE rn = 1""")
def overlap_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-05: events as spans as long as their value in minutes against the tracks around purchases."""
    spans = _events(spark, sf_dir).filter("event_type <> 'purchase'").select("user_id", F.col("event_id").alias("span"), F.col("t").alias("start"), (F.col("t") + F.col("value") * 60).alias("end"))
    return intervals.overlap_majority(spans, _tracks(spark, sf_dir), "user_id", 3600.0).withColumn("overlap", F.round("overlap", 3))


@query(RUNS + """,
    s AS (SELECT user_id, t AS e, lead(t) OVER (PARTITION BY user_id ORDER BY no) AS n, no FROM r WHERE event_type = 'purchase'),
    k AS (SELECT user_id, t AS a, t + 600 AS b FROM r WHERE event_type = 'view'),
    g AS (SELECT s.user_id, s.no, sum(greatest(0, least(k.b, s.n) - greatest(k.a, s.e))) AS speech FROM s JOIN k USING (user_id) WHERE s.n - s.e >= 7200 AND k.a <= s.n AND k.b >= s.e GROUP BY ALL HAVING sum(greatest(0, least(k.b, s.n) - greatest(k.a, s.e))) >= 900)
    SELECT u.user_id, count(g.speech) AS gaps, round(coalesce(sum(g.speech), 0), 3) AS seconds FROM (SELECT DISTINCT user_id FROM s) u LEFT JOIN g USING (user_id) GROUP BY u.user_id""")
def unheard_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-06: pauses of two hours between purchases that hold fifteen minutes of views."""
    e = _events(spark, sf_dir)
    segments = e.filter("event_type = 'purchase'").select("user_id", F.struct("t", "event_id").alias("ord"), F.col("t").alias("start"), F.col("t").alias("end"))
    tracks = e.filter("event_type = 'view'").select("user_id", F.col("t").alias("start"), (F.col("t") + 600).alias("end"))
    return intervals.unheard_gaps(segments, tracks, "user_id", 7200.0, 900.0, 3600.0).withColumn("seconds", F.round("seconds", 3))


PAIRED = RUNS + """,
    q AS (SELECT user_id, no AS ord, run AS turn, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY no), 'none') AS label, event_type AS real FROM r),
    c AS (SELECT user_id, label, real, count(*) AS n, min(ord) AS f FROM q GROUP BY ALL),
    m AS (SELECT user_id, label, real AS mapped FROM (SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY n DESC, f) AS rn FROM c) WHERE rn = 1),
    j AS (SELECT q.*, m.mapped FROM q JOIN m USING (user_id, label)),
    w AS (SELECT user_id, count(*) AS matched_words, count_if(mapped <> real) AS wrong_words, count(DISTINCT label) AS labels FROM j GROUP BY ALL),
    tt AS (SELECT user_id, turn, mapped, real, count(*) AS n, min(ord) AS f FROM j GROUP BY ALL),
    t1 AS (SELECT *, row_number() OVER (PARTITION BY user_id, turn, mapped ORDER BY n DESC, f) AS rn FROM tt),
    t2 AS (SELECT user_id, count(*) AS turns, count_if(mapped <> real) AS wrong_turns FROM t1 WHERE rn = 1 GROUP BY ALL)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    runs = turns.islands(_events(spark, sf_dir), ["user_id"], ["t", "event_id"], "event_type", "turn")
    w = W.partitionBy("user_id").orderBy("t", "event_id")
    return runs.select("user_id", F.row_number().over(w).alias("ord"), "turn", F.coalesce(F.lag("event_type").over(w), F.lit("none")).alias("label"), F.col("event_type").alias("real"))


@query(PAIRED + " SELECT user_id, matched_words, CAST(wrong_words AS BIGINT) AS wrong_words, round(100 * wrong_words / matched_words, 2) AS word_error_pct, turns, CAST(wrong_turns AS BIGINT) AS wrong_turns, round(100 * wrong_turns / turns, 2) AS turn_error_pct, labels FROM w JOIN t2 USING (user_id)")
def attribution_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-07, AGG-05, AGG-06: the event before as a prediction of the event."""
    return evaluate.attribution_errors(_pairs(spark, sf_dir), ["user_id"])


@query(PAIRED + """,
    a AS (SELECT user_id % 2 AS s, sum(matched_words) AS mw, sum(wrong_words) AS ww, sum(turns) AS tn, sum(wrong_turns) AS wt FROM w JOIN t2 USING (user_id) GROUP BY 1)
    SELECT CAST(n.ww AS BIGINT) AS new_wrong_words, CAST(n.wt AS BIGINT) AS new_wrong_turns, CAST(n.mw AS BIGINT) AS new_matched_words, CAST(n.tn AS BIGINT) AS new_turns, CAST(o.ww AS BIGINT) AS old_wrong_words, CAST(o.wt AS BIGINT) AS old_wrong_turns, CAST(o.mw AS BIGINT) AS old_matched_words, CAST(o.tn AS BIGINT) AS old_turns, n.ww < o.ww AND n.wt <= o.wt AS adopt
    FROM a n JOIN a o ON n.s = 1 AND o.s = 0""")
def adoption_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07: odd users as the challenger of even ones."""
    scores = evaluate.attribution_errors(_pairs(spark, sf_dir), ["user_id"]).withColumn("strategy", F.when(F.col("user_id") % 2 == 1, "new").otherwise("old"))
    return evaluate.decide(scores, "strategy", "new", "old")


@query(PAIRED + " SELECT coalesce(CAST(user_id AS VARCHAR), 'TOTAL') AS record, CAST(sum(matched_words) AS BIGINT) AS matched_words, CAST(sum(wrong_words) AS BIGINT) AS wrong_words, round(100 * sum(wrong_words) / sum(matched_words), 2) AS word_error_pct FROM w GROUP BY ROLLUP (user_id)")
def micro_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07: errors per user and in total, in one pass."""
    return evaluate.micro_average(evaluate.attribution_errors(_pairs(spark, sf_dir), ["user_id"]), "user_id")


LINES = """
    WITH o AS (SELECT l_orderkey AS k, list(CAST(l_linenumber AS INT) ORDER BY l_partkey, l_suppkey, l_linenumber) AS found, CAST(max(l_quantity) % 8 AS INT) AS n FROM lineitem GROUP BY 1),
    c AS (SELECT k, n, found, list_sort(list_distinct(list_filter(found, lambda x: len(list_filter(found, lambda y: y = x)) > 1))) AS twice FROM o)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber"))).alias("x"), (F.max("l_quantity") % 8).cast("int").alias("n"))
    return rows.select("k", "n", F.transform("x", lambda r: r["l_linenumber"].cast("int")).alias("found"))


@query(LINES + """
    SELECT k, array_to_string(CASE WHEN n > 0 THEN list_sort(list_filter(range(1, n + 1), lambda p: NOT list_contains(found, p))) ELSE [] END, ',') AS missing,
           CASE WHEN list_max(found) > n THEN 'file_page ' || CAST(list_max(found) AS VARCHAR) || ' exceeds the ' || CAST(n AS VARCHAR) || '-page document' WHEN len(twice) > 0 THEN 'file_page numbers repeat: [' || array_to_string(twice, ', ') || ']' END AS impossible FROM c""")
def page_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06, WIN-07: line numbers as page markers of orders: what is missing, and what cannot be true."""
    rows = _orders(spark, sf_dir)
    return rows.select("k", F.array_join(F.transform(pages.missing(F.col("found"), F.col("n")), lambda x: x.cast("string")), ",").alias("missing"), pages.impossible(F.col("found"), F.col("n")).alias("impossible"))


@query(LINES + """,
    w AS (SELECT k, found, CASE WHEN k % 3 = 0 THEN len(found) ELSE n END AS pc FROM o)
    SELECT k, CASE WHEN len(found) = pc AND pc > 0 AND found <> range(1, pc + 1) THEN array_to_string(list_transform(range(1, pc + 1), lambda i: 'file_page: ' || CAST(i AS VARCHAR)), chr(10)) ELSE array_to_string(list_transform(found, lambda i: 'file_page: ' || CAST(i AS VARCHAR)), chr(10)) END AS renumbered,
           array_to_string(list_transform(found, lambda i: 'file_page: ' || CAST(i + 20 AS VARCHAR)), chr(10)) AS shifted FROM w""")
def renumber_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04, WIN-05: bodies of markers renumbered where they are complete but out of order, and shifted by twenty."""
    rows = _orders(spark, sf_dir)
    body = F.array_join(F.transform("found", lambda i: F.concat(F.lit("file_page: "), i.cast("string"))), "\n")
    count = F.when(F.col("k") % 3 == 0, F.size("found")).otherwise(F.col("n"))
    return rows.select("k", body.alias("b"), count.alias("pc")).select("k", pages.renumber(F.col("b"), F.col("pc")).alias("renumbered"), pages.shift(F.col("b"), F.lit(20)).alias("shifted"))


@query("SELECT p_partkey, CAST(ceil(p_size / 20.0) AS INT) AS chunks, CAST(p_size - (ceil(p_size / 20.0) - 1) * 20 AS INT) AS last_pages, CAST((ceil(p_size / 20.0) - 1) * 20 AS INT) AS last_offset FROM part")
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09: part sizes as page counts in chunks of twenty."""
    rows = table(spark, sf_dir, "part").select("p_partkey", pages.chunk_plan(F.col("p_size"), 20).alias("c"))
    last = F.element_at("c", -1)
    return rows.select("p_partkey", F.size("c").alias("chunks"), (last["last"] - last["first"] + 1).alias("last_pages"), last["page_offset"].alias("last_offset"))


@query("""
    WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS no, unnest(string_split(text, chr(10))) AS line FROM documents),
    h AS (SELECT doc_id, no, CASE WHEN no % 20 = 2 THEN '# head ' || CAST(no AS VARCHAR) WHEN no % 20 = 5 THEN '' ELSE line END AS line FROM l),
    c AS (SELECT *, sum(CASE WHEN no % 20 = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS chapter FROM h),
    f AS (SELECT *, coalesce(sum(CASE WHEN trim(line) <> '' AND NOT regexp_matches(line, '^#{1,6}\\s+\\S') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, chapter ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM c WHERE chapter > 0)
    SELECT doc_id, CAST(chapter AS BIGINT) AS chapter, CAST(min(no) AS INT) AS line_no, '# head ' || CAST(min(no) AS VARCHAR) AS heading, CAST(max(CASE WHEN trim(line) <> '' THEN no END) - min(no) + 1 AS BIGINT) AS lines FROM f WHERE b < 12 GROUP BY doc_id, chapter""")
def chapter_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-18: openings of chapters that begin at every twentieth line."""
    lines = pages.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    no = F.col("line_no")
    headed = lines.withColumn("text", F.when(no % 20 == 2, F.concat(F.lit("# head "), no.cast("string"))).when(no % 20 == 5, "").otherwise(F.concat(F.lit("."), F.col("text"))))
    headed = headed.withColumn("text", F.when(F.col("text").rlike(r"^\.\s*$"), "").otherwise(F.col("text")))
    out = pages.boundaries(headed, "doc_id")
    blank_end = F.size(F.split("region", "\n", -1)).cast("long")
    return out.select("doc_id", "chapter", "line_no", "heading", blank_end.alias("lines"))


SEEN = "SELECT page_id, url FROM pages UNION ALL SELECT 1000000 + page_id, 'https://www.agency' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 2 = 0 THEN '.gov/a/b' ELSE '.mil.example.org/gov' END FROM pages WHERE page_id % 10 = 0"


@query(f"""
    WITH u AS ({SEEN}), h AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]*)', 1)) AS host FROM u)
    SELECT page_id, host, regexp_replace(host, '^www\\.', '') AS site, host LIKE '%.gov' OR host LIKE '%.mil' AS government, 'url:' || substr(sha256(url), 1, 12) AS source_id, trim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') AS path FROM h""")
def host_and_source_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03, SCL-02: hosts, government test, source ids and paths of pages and of some agencies."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url")
    more = rows.filter("page_id % 10 = 0").select((F.col("page_id") + 1_000_000).alias("page_id"), F.concat(F.lit("https://www.agency"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".gov/a/b").otherwise(".mil.example.org/gov")).alias("url"))
    u = F.col("url")
    return rows.union(more).select("page_id", urls.host(u).alias("host"), urls.site(u).alias("site"), urls.is_us_government(u).alias("government"), urls.url_source_id(u).alias("source_id"), urls.path(u).alias("path"))


@query("""
    WITH p AS (SELECT a.page_id, a.url AS requested, CASE a.page_id % 4 WHEN 0 THEN a.url || '/more' WHEN 1 THEN b.url WHEN 2 THEN regexp_extract(a.url, '^[a-z]+://[^/]*', 0) || '/' ELSE a.url END AS final FROM pages a JOIN pages b ON b.page_id = a.page_id + 1),
    s AS (SELECT *, trim(regexp_extract(requested, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS rp, trim(regexp_extract(final, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS fp FROM p)
    SELECT page_id, CASE WHEN rp = '' THEN false WHEN fp = '' THEN true ELSE list_slice(string_split(fp, '/'), 1, len(string_split(rp, '/'))) <> string_split(rp, '/') END AS away FROM s""")
def redirected_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06: each page against a deeper page, the next page, its site's root, or itself."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    b = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    k = F.col("page_id") % 4
    final = F.when(k == 0, F.concat("url", F.lit("/more"))).when(k == 1, F.col("next")).when(k == 2, F.concat(F.regexp_extract("url", "^[a-z]+://[^/]*", 0), F.lit("/"))).otherwise(F.col("url"))
    return p.join(b, "page_id").select("page_id", urls.redirected_away(F.col("url"), final).alias("away"))


@query("""
    WITH t AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)), '^www\\.', '') AS site FROM pages)
    SELECT page_id, title, site, CASE page_id % 4 WHEN 0 THEN 'The Site' WHEN 1 THEN 'The Site' WHEN 2 THEN 'The Daily Example' ELSE '' END AS publisher, title AS stripped FROM t""")
def title_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-09, SCL-10, JOI-12: page titles with a site's name put behind them and taken away again."""
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    k, u = F.col("page_id") % 4, F.col("url")
    rows = table(spark, sf_dir, "pages").select("page_id", title.alias("title"), "url", urls.site(u).alias("site"))
    name = F.when(k == 0, "The  Site").when(k == 1, "The Site | News").otherwise("")
    at = F.when(k == 2, "https://www.daily.example/x").otherwise(u)
    shown = F.concat("title", F.when(k == 0, " - The Site").when(k == 1, " — The Site | News (Published 2020)").when(k == 2, " | The Daily Example").otherwise(F.concat(F.lit(" – "), "site")))
    known = {"daily.example": "The Daily Example", "other.example": "Another"}
    return rows.select("page_id", "title", "site", urls.canonical_publisher(name, at, known).alias("publisher"), urls.strip_site_suffix(shown, name, at, known).alias("stripped"))


@query("""
    SELECT page_id, coalesce(nullif(CASE page_id % 5 WHEN 0 THEN 'text/html' WHEN 1 THEN '' ELSE NULL END, ''), CASE WHEN page_id % 5 IN (1, 2) THEN 'text/html' WHEN page_id % 5 = 3 THEN 'application/pdf' ELSE 'audio/ogg' END) AS mime,
           CASE WHEN page_id % 5 IN (0, 1, 2) THEN 'page' WHEN page_id % 5 = 3 THEN 'document' ELSE 'sound' END AS handler,
           CASE WHEN page_id % 5 IN (0, 2) THEN NULL WHEN page_id % 5 = 1 THEN 'URL names application/pdf, but the response is text/html' END AS rejected
    FROM pages""")
def mime_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-14, JOI-17, FLT-05: types by header, first bytes or extension; the handler of each; responses that are not what their URL names."""
    k = F.col("page_id") % 5
    head = F.when(k == 3, "  %PDF-1.7 x").when(k == 4, "OggS").otherwise(F.concat(F.lit("\n <!DOCTYPE html>"), F.substring("html", 1, 64)))
    name = F.when(k == 1, "https://x.org/a/paper.pdf").when(k == 4, "https://x.org/a/talk.opus").otherwise("https://x.org/a/page")
    declared = F.when(k == 0, " Text/HTML; charset=utf-8").when(k == 1, "")
    rows = table(spark, sf_dir, "pages").select("page_id", head.alias("head"), name.alias("name"), declared.alias("declared"))
    rows = rows.withColumn("mime", rights.detect_mime(F.col("declared"), F.col("head"), F.col("name")))
    handlers = spark.sql("SELECT * FROM VALUES (1, 'page', array('text/html', 'application/xhtml+xml')), (2, 'document', array('application/pdf', 'text/html')), (3, 'sound', array('audio/ogg')) AS t(ord, name, handles)")
    return audit.route(rows, handlers, "mime").select("page_id", "mime", "handler", rights.html_rejection(F.col("name"), F.col("head"), F.col("mime")).alias("rejected"))


@query("SELECT page_id, CAST(coalesce(list_sum(list_transform(regexp_extract_all(html, '(?s)<style[^>]*>(.*?)</style>', 1), lambda x: length(x))), 0) AS BIGINT) AS css, CAST(coalesce(list_sum(list_transform(regexp_extract_all(replace(html, 'script', 'style'), '(?s)<style[^>]*>(.*?)</style>', 1), lambda x: length(x))), 0) AS BIGINT) AS css_and_scripts FROM pages")
def page_css(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-17: style sizes, and those with scripts taken as styles."""
    return table(spark, sf_dir, "pages").select("page_id", text.css_size(F.col("html")).alias("css"), text.css_size(F.replace("html", F.lit("script"), F.lit("style"))).alias("css_and_scripts"))


@query("""
    WITH v AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS body FROM pages),
    w AS (SELECT page_id, list_distinct(regexp_extract_all(lower(regexp_replace(body, '<!--.*?-->', ' ', 'gs')), '[a-z'']{4,}')) AS words FROM v)
    SELECT a.page_id, round(CASE WHEN len(a.words) = 0 THEN 1.0 ELSE len(list_intersect(a.words, b.words)) / len(a.words) END, 6) AS coverage FROM w a JOIN w b ON b.page_id = a.page_id + 1""")
def page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-16: how much of each page's vocabulary the next page shows."""
    p = table(spark, sf_dir, "pages").select("page_id", text.visible(F.col("html")).alias("body"))
    b = table(spark, sf_dir, "pages").select((F.col("page_id") - 1).alias("page_id"), F.col("html").alias("next"))
    return p.join(b, "page_id").select("page_id", F.round(text.vocabulary_coverage(F.col("next"), F.col("body")), 6).alias("coverage"))


@query("""
    WITH m AS (SELECT source, CAST(count(*) AS BIGINT) AS count, CAST(sum(n_chars) AS BIGINT) AS total_bytes FROM documents GROUP BY source) SELECT * FROM m""")
def media_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11: documents as media of their source."""
    return audit.media_summary(table(spark, sf_dir, "documents").select("source", F.col("n_chars").alias("size_bytes")), "source")


@query("SELECT conv_id, count(*) AS segments, CAST(sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS BIGINT) AS words, CAST(sum(turn * 0.5 + 1.0) AS DOUBLE) AS voiced FROM conversations GROUP BY conv_id")
def segment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10: conversation lines as segments."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "text", F.col("turn").cast("double").alias("start"), (F.col("turn") * 1.5 + 1.0).cast("double").alias("end"))
    return turns.segment_stats(rows, "conv_id")


@query("""
    WITH k AS (SELECT page_id, lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS d, page_id % 5 AS k FROM pages)
    SELECT page_id, CASE k WHEN 0 THEN 'http://o.org/a?b=1' WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE NULL END AS original, CASE WHEN k = 0 THEN CAST('2020-03-' || d AS DATE) END AS archived,
           CASE WHEN k = 0 THEN 'https://web.archive.org/web/202003' || d || '101010id_/http://o.org/a?b=1' END AS raw, CASE WHEN k = 1 THEN 'https://europepmc.org/api/getPdf?pmcid=PMC12' || d END AS pmc, k = 2 AS video, k IN (2, 3) AS supported, CASE WHEN k = 2 THEN 'abcdefghi' || d END AS video_id, page_id % 100 < 99 AND page_id % 7 = 0 AS truncated FROM k""")
def archive_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-02, SCL-03, SRC-13, SRC-14, FLT-07, FLT-08: URLs of five kinds."""
    k, d = F.col("page_id") % 5, F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    u = F.when(k == 0, F.concat(F.lit("https://web.archive.org/web/202003"), d, F.lit("101010/http://o.org/a?b=1"))).when(k == 1, F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/pmc12"), d, F.lit("/pdf/a.pdf"))).when(k == 2, F.concat(F.lit("https://www.youtube.com/watch?v=abcdefghi"), d)).when(k == 3, "https://archive.org/details/x").otherwise("https://example.org/watch?v=1")
    declared = F.when(F.col("page_id") % 7 == 0, "100").when(F.col("page_id") % 7 == 1, "x")
    p = table(spark, sf_dir, "pages").select("page_id", u.alias("u"), declared.alias("declared"))
    c = F.col("u")
    return p.select("page_id", urls.archived_original(c).alias("original"), urls.archived_at(c).alias("archived"), F.when(k == 0, urls.raw_archive_url(c)).alias("raw"), urls.pmc_pdf_url(c).alias("pmc"), urls.is_video_platform(c).alias("video"), urls.is_supported_media(c).alias("supported"), urls.video_id(c).alias("video_id"), urls.truncated_capture(F.col("page_id") % 100, F.col("declared")).alias("truncated"))

"""Queries of a store's upkeep: receipts, backups, pairings, books' tables, fetch decisions, refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import temporal
from ..operators import audit, evaluate, lifecycle, pages, turns, validate
from ..sources import records, seams, sinks
from . import handlers
from .registry import query, table

def _doc() -> Column:
    return F.col("doc_id")


@query("""
    SELECT '00000000-0000-4000-8000-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS run_uuid, CASE WHEN doc_id % 7 = 0 THEN 'outcome must be committed or no-op' WHEN doc_id % 7 = 1 THEN 'record_path must be a normalised relative POSIX path' WHEN doc_id % 7 = 2 THEN 'commit_sha must be a full lowercase Git object ID' END AS error,
           '{"commit_sha":"' || CASE WHEN doc_id % 7 = 2 THEN 'ABC' ELSE substr(sha256(text), 1, 40) END || '","completed_at":"2024-01-01T00:00:00.000Z","content_hash":"sha256:' || sha256(text) || '","outcome":"' || CASE WHEN doc_id % 7 = 0 THEN 'done' ELSE 'committed' END || '","record_path":"' || CASE WHEN doc_id % 7 = 1 THEN '../x.md' ELSE 'store/' || CAST(doc_id AS VARCHAR) || '.md' END || '","run_uuid":"00000000-0000-4000-8000-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '","schema":"ingest-result/1"}' AS json
    FROM documents""")
def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-25: receipts of every document, some of them broken."""
    k, digest = _doc() % 7, F.sha2(F.col("text").cast("binary"), 256)
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(_doc().cast("string"), 12, "0")).alias("run_uuid"), F.when(k == 0, "done").otherwise("committed").alias("outcome"), F.when(k == 1, "../x.md").otherwise(F.concat(F.lit("store/"), _doc().cast("string"), F.lit(".md"))).alias("record_path"),
        F.concat(F.lit("sha256:"), digest).alias("content_hash"), F.when(k == 2, "ABC").otherwise(F.substring(digest, 1, 40)).alias("commit_sha"), F.lit("2024-01-01T00:00:00.000Z").alias("completed_at"), F.lit(None).cast("string").alias("schema"),
    )
    return sinks.receipts(rows)


@query("""
    WITH r AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS h, CASE WHEN doc_id % 3 = 0 THEN 'open' ELSE 'gated' END AS zone, doc_id IN (SELECT doc_id FROM labels) AS has FROM documents)
    SELECT h AS record_hash, zone, CASE WHEN has THEN 'sources/' || h || '.pdf' END AS key, CASE WHEN NOT has THEN 'no-original' WHEN doc_id % 5 = 0 AND zone = 'open' THEN 'exists' ELSE 'would-push' END AS action FROM r""")
def push_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-27, FLT-01: what a backup of documents would push; labelled ones have an original, every fifth is stored openly."""
    h = _doc().cast("string")
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(h.alias("record_hash"), F.when(_doc() % 3 == 0, "public_domain").alias("status"), h.alias("original"))
    originals = table(spark, sf_dir, "labels").select(h.alias("stem"), F.lit("pdf").alias("ext"))
    stored = docs.filter(_doc() % 5 == 0).select(F.lit("open").alias("zone"), F.concat(F.lit("sources/"), h, F.lit(".pdf")).alias("key"))
    return sinks.push_plan(rows, originals, stored)


@query("""
    WITH c AS (SELECT doc_id, doc_id % 6 AS k FROM documents)
    SELECT doc_id, CASE k WHEN 0 THEN NULL WHEN 1 THEN 'content identity does not match the record path' WHEN 2 THEN 'source type changed' WHEN 3 THEN 'candidate does not declare the current extraction generation' WHEN 4 THEN 'changed reviewed body has no valid review_carryover' ELSE 'candidate does not validate: e' END AS error, k <> 5 AS protected FROM c""")
def canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-07, SET-05: candidates of six kinds against their parents."""
    k = _doc() % 6
    side = lambda h, t, v: F.struct(h.alias("content_hash"), F.lit("record/1").alias("schema"), t.alias("source_type"), v.alias("pipeline_version"), F.lit(None).cast("string").alias("carryover_from"))
    parent = side(F.lit("sha256:h"), F.lit("pdf"), F.lit(1))
    child = side(F.when(k == 1, "sha256:x").otherwise("sha256:h"), F.when(k == 2, "web").otherwise("pdf"), F.when(k == 3, 9).otherwise(1))
    errors = F.when(k == 5, F.array(F.lit("e"))).otherwise(F.expr("cast(array() as array<string>)"))
    meta = lambda title, q: F.create_map(F.lit("title"), title, F.lit("quality.x"), q)
    same = validate.protected_equal(meta(F.lit("t"), F.lit("1")), meta(F.when(k == 5, "u").otherwise("t"), F.lit("2")))
    return table(spark, sf_dir, "documents").select("doc_id", lifecycle.canary_errors(parent, child, F.lit("h"), F.lit(True), k != 4, F.lit(True), errors).alias("error"), same.alias("protected"))


@query("""
    SELECT d.doc_id AS path, (CASE WHEN d.doc_id % 2 = 0 THEN 'v1' ELSE NULL END) IS NOT DISTINCT FROM (CASE WHEN d.doc_id % 2 = 0 THEN CASE WHEN d.doc_id % 3 = 0 THEN 'v2' ELSE 'v1' END ELSE CASE WHEN l.doc_id IS NOT NULL THEN 'v1' END END) AS ok
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-08: changes whose base is still what is stored; even documents were there, labelled odd ones came since."""
    docs = table(spark, sf_dir, "documents")
    base = docs.filter(_doc() % 2 == 0).select(_doc().alias("path"), F.lit("v1").alias("digest"))
    came = table(spark, sf_dir, "labels").filter(_doc() % 2 == 1).select(_doc().alias("path"), F.lit("v1").alias("digest"))
    now = docs.filter(_doc() % 2 == 0).select(_doc().alias("path"), F.when(_doc() % 3 == 0, "v2").otherwise("v1").alias("digest")).union(came)
    return lifecycle.publishable(docs.select(_doc().alias("path"), F.lit("new").alias("digest")), base, now).select("path", "ok")


@query("""
    WITH a AS (SELECT l_orderkey AS k, l_linenumber AS p, l_quantity AS q FROM lineitem WHERE l_partkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) = 1),
    b AS (SELECT l_orderkey AS k, l_linenumber AS p FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY ALL)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.p, b.p) AS p, CASE WHEN a.k IS NULL THEN 'extra' WHEN b.k IS NULL THEN 'missing' ELSE 'both' END AS side FROM a FULL JOIN b ON a.k = b.k AND a.p = b.p""")
def page_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-13: reviewed against candidate pages of orders."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("p"), "l_partkey", "l_suppkey")
    page = lambda df: df.groupBy("k", "p").agg(F.min(F.lit("t")).alias("text"))
    return evaluate.match_pages(page(rows.filter("l_partkey % 3 <> 0")), page(rows.filter("l_suppkey % 4 <> 0")), ["k", "p"]).select("k", "p", "side")


@query("""
    WITH e AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events WHERE event_id % 2 = 0),
    o AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events WHERE event_id % 2 = 1)
    SELECT coalesce(e.user_id, o.user_id) AS user_id, coalesce(e.event_type, o.event_type) AS event_type, e.event_id AS old_ord, o.event_id AS new_ord FROM e FULL JOIN o USING (user_id, event_type, n)""")
def one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-09: even events of a user and type against odd ones, the n-th against the n-th."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return evaluate.pair_one_to_one(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), "user_id", "event_type", "event_id")


@query("""
    WITH i AS (SELECT p_partkey AS k, unnest([0, 1, 2]) AS ord, unnest(['x' || CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 3 = 0 THEN 'urn:doi:10.1/' || CAST(p_partkey AS VARCHAR) ELSE 'y' END, CASE WHEN p_partkey % 2 = 0 THEN '978-0-306-40615-7' ELSE 'z' END]) AS v, unnest([NULL, NULL, CASE WHEN p_partkey % 2 = 1 THEN 'Calibre' END]) AS s FROM part)
    SELECT k, CASE WHEN k % 2 = 0 THEN 'isbn:9780306406157' WHEN k % 3 = 0 THEN 'doi:10.1/' || CAST(k AS VARCHAR) ELSE 'calibre:z' END AS identifier FROM i GROUP BY k""")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-02: the best of three identifiers of every part."""
    k = F.col("p_partkey")
    three = F.array(
        F.struct(F.lit(0).alias("ord"), F.concat(F.lit("x"), k.cast("string")).alias("value"), F.lit(None).cast("string").alias("scheme")),
        F.struct(F.lit(1).alias("ord"), F.when(k % 3 == 0, F.concat(F.lit("urn:doi:10.1/"), k.cast("string"))).otherwise("y").alias("value"), F.lit(None).cast("string").alias("scheme")),
        F.struct(F.lit(2).alias("ord"), F.when(k % 2 == 0, "978-0-306-40615-7").otherwise("z").alias("value"), F.when(k % 2 == 1, "Calibre").alias("scheme")),
    )
    rows = table(spark, sf_dir, "part").select(k.alias("k"), F.explode(three).alias("i")).select("k", "i.*")
    return audit.pick_identifier(rows, "k")


@query("""
    WITH t AS (SELECT l_orderkey AS k, 'c' || CAST(l_linenumber AS VARCHAR) || '.xhtml' AS f, CASE WHEN l_quantity < 10 THEN '' ELSE 't' || CAST(l_partkey AS VARCHAR) END AS title, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS o FROM lineitem)
    SELECT k, f AS file_name, arg_min(title, o) AS toc_title FROM t WHERE title <> '' GROUP BY ALL""")
def contents_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-15: the first title of each file in a table of contents made of order lines."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), F.concat(F.lit("text/c"), F.col("l_linenumber").cast("string"), F.lit(".xhtml#a")).alias("href"), F.when(F.col("l_quantity") < 10, " ").otherwise(F.concat(F.lit("t"), F.col("l_partkey").cast("string"))).alias("title"))
    return audit.toc_titles(rows, "k")


@query("""
    WITH a AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS id FROM lineitem WHERE l_quantity > 5), p AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS id FROM lineitem WHERE l_discount > 0.02)
    SELECT a.k, count(*) AS anchors, count(p.id) AS pulled, count(p.id) > 0 AND count(p.id) >= 0.8::DOUBLE * count(*) AS spent FROM a LEFT JOIN p USING (k, id) GROUP BY a.k""")
def spent_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-14: order lines as a notes document's anchors, the discounted ones pulled."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("id"), F.when(F.col("l_quantity") > 5, "t").otherwise("").alias("text"), "l_discount")
    return audit.notes_spent(rows, rows.filter("l_discount > 0.02"), ["k"])


@query("""
    SELECT url, CASE page_id % 4 WHEN 0 THEN 'http' WHEN 1 THEN 'wayback' WHEN 2 THEN 'patchright' END AS method, CASE WHEN page_id % 4 < 3 THEN 'text/html' END AS detected_type, CASE WHEN page_id % 4 < 3 THEN sha256(repeat(html, 3)) END AS asset_hash, CASE WHEN page_id % 4 = 3 THEN 'All fetch methods exhausted' END AS error FROM pages""")
def fetch_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11, FLT-05, FLT-06: which of three ways to fetch a page gave the first acceptable response; pages may share a URL."""
    k = F.col("page_id") % 4
    whole, away = F.repeat("html", 3), F.concat(F.regexp_extract("url", "^[a-z]+://[^/]*", 0), F.lit("/"))
    ways = F.array(
        F.struct(F.lit("patchright").alias("method"), F.when(k != 3, whole).alias("content"), F.lit("text/html").alias("content_type"), F.lit(None).cast("string").alias("final_url")),
        F.struct(F.lit("http").alias("method"), F.when(k == 0, whole).otherwise("<html>short").alias("content"), F.lit(None).cast("string").alias("content_type"), F.lit(None).cast("string").alias("final_url")),
        F.struct(F.lit("wayback").alias("method"), F.when(k.isin(1, 2), whole).alias("content"), F.lit("text/html").alias("content_type"), F.when(k == 2, away).alias("final_url")),
    )
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(ways).alias("w")).select("page_id", "url", "w.*")
    return seams.choose_response(rows, "page_id").select("url", "method", "detected_type", "asset_hash", "error")


@query("""
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN CAST(2000 + p_partkey % 20 AS VARCHAR) || '-03-14' WHEN 1 THEN '2018-04-07' WHEN 2 THEN NULL WHEN 3 THEN '2010-12-31' ELSE '1999-05-06' END AS found FROM part""")
def slug_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-06, SRT-05: dates in URL slugs of five kinds."""
    k = F.col("p_partkey") % 5
    url = F.when(k == 0, F.concat(F.lit("https://x/"), (F.col("p_partkey") % 20 + 2000).cast("string"), F.lit("/03/14/story"))).when(k == 1, "https://x/a-040718-b").when(k == 2, "https://x/20230231/19850101").when(k == 3, "https://x/20101231-20300101").otherwise("https://x/a-050699")
    return table(spark, sf_dir, "part").select("p_partkey", temporal.dates_in_slug(url, F.lit("2024-06-01")).alias("found"))


@query("""
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'opus' WHEN 1 THEN 'html' ELSE 'pdf' END AS add_format, CASE WHEN doc_id % 3 = 0 THEN 'podcast' WHEN doc_id % 3 = 2 THEN 'form' END AS add_type, doc_id % 3 = 1 AS strip_article FROM documents""")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-13, SCL-12: what documents of three kinds would gain."""
    k = _doc() % 3
    rows = table(spark, sf_dir, "documents").select(_doc().alias("record_hash"), F.when(k == 0, "audio").when(k == 1, "web").otherwise("pdf").alias("source_type"), F.when(k == 0, "Talk Ep. 3").when(k == 2, "Form 9").otherwise("A").alias("title"), F.when(k == 1, "article").alias("document_type"), F.lit(None).cast("string").alias("file_format"), F.when(k == 2, ".PDF").alias("archived_ext"), F.when(k == 0, "ogg").alias("codec"))
    return audit.backfill_plan(rows).withColumnRenamed("record_hash", "doc_id")


@query("""
    SELECT doc_id, 'opus' AS codec, CAST(CASE WHEN doc_id % 2 = 0 THEN 64000 ELSE 32000 END AS INT) AS bitrate, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS duration, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '2024-01-31' END AS posted_date, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Ann' END AS creators FROM documents""")
def media_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-19, SCL-15: probe and video JSON built from documents."""
    s = lambda c: c.cast("string")
    rate = F.when(_doc() % 2 == 0, '"64000"').otherwise('"N/A"')
    long = F.when(_doc() % 3 == 0, F.lit("0")).otherwise(s(F.col("n_chars")))
    probe = F.concat(F.lit('{"format": {"bit_rate": '), rate, F.lit('}, "streams": [{"codec_type": "audio", "codec_name": "opus", "bit_rate": "32000"}]}'))
    info = F.concat(F.lit('{"duration": '), long, F.lit(', "channel": "Ch", "upload_date": "'), F.when(_doc() % 4 == 0, "2024").otherwise("20240131"), F.lit('", "creators": ["ch", "'), F.when(_doc() % 5 == 0, "CH").otherwise("Ann"), F.lit('"]}'))
    rows = table(spark, sf_dir, "documents").select("doc_id", audit.probe_fields(probe).alias("p"), audit.video_fields(info).alias("v"))
    return rows.select("doc_id", "p.codec", "p.bitrate", "v.duration", "v.posted_date", F.array_join("v.creators", ",").alias("creators"))


@query("""
    WITH r AS (SELECT doc_id, 'a: ' || CAST(doc_id AS VARCHAR) || chr(10) || 'b:' || chr(10) || '  c: 1' || chr(10) || 'd: 2' AS fm, text FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE fm END AS frontmatter, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE sha256(text) END AS body_digest, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE replace(fm, 'b:' || chr(10) || '  c: 1', 'b: 9') END AS replaced, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE replace(fm, 'b:' || chr(10) || '  c: 1' || chr(10), '') END AS dropped FROM r""")
def frontmatter_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-16, SCL-17: documents as records, split, with a block replaced and dropped; every third has no frontmatter."""
    fm = F.concat(F.lit("a: "), _doc().cast("string"), F.lit("\nb:\n  c: 1\nd: 2"))
    whole = F.when(_doc() % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("---\n"), fm, F.lit("\n---\n"), "text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", records.split(whole).alias("s"))
    return rows.select("doc_id", "s.frontmatter", F.sha2(F.col("s.body").cast("binary"), 256).alias("body_digest"), records.replace_block(F.col("s.frontmatter"), "b", F.lit("b: 9")).alias("replaced"), records.replace_block(F.col("s.frontmatter"), "b", None).alias("dropped"))


@query("""
    WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g')) AS lines, substr(regexp_replace(lower(string_split(text, chr(10))[2]), '[^\\p{L}\\p{N}]+', '', 'g'), 1, 60) AS anchor FROM documents WHERE contains(text, chr(10))),
    n AS (SELECT doc_id, anchor, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM l)
    SELECT doc_id, CAST(min(no) AS INT) AS line_no FROM n WHERE anchor <> '' AND contains(line, anchor) AND (length(anchor) >= 40 OR length(anchor) * 2 >= length(line)) GROUP BY doc_id""")
def anchor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-16: where the first sixty letters of each document's second line stand."""
    docs = table(spark, sf_dir, "documents")
    letters = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    lines = pages.lines_of(docs, "doc_id", "text").select("doc_id", "line_no", letters(F.col("text")).alias("letters"))
    anchors = docs.filter(F.contains("text", F.lit("\n"))).select("doc_id", F.lit(0).alias("anchor"), F.substring(letters(F.split_part("text", F.lit("\n"), F.lit(2))), 1, 60).alias("letters"))
    return audit.containment(lines, anchors, "doc_id").select("doc_id", "line_no")


@query("""
    WITH x AS (SELECT l_orderkey AS k, list(l_linenumber ORDER BY l_partkey, l_suppkey, l_linenumber) AS found FROM lineitem GROUP BY 1)
    SELECT k, array_to_string(list_transform(range(1, len(found) + 1), lambda i: CASE WHEN i = 1 OR found[i] > list_max(found[1:i - 1]) THEN CAST(found[i] AS VARCHAR) ELSE '-' END), ',') AS numbers FROM x""")
def rising_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-08: line numbers of orders as chapter numbers of a body; without contents an accepted one is a new maximum."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber"))).alias("x"))
    numbers = F.transform("x", lambda r: F.struct(F.lit(None).cast("int").alias("toc"), r["l_linenumber"].cast("int").alias("body")))
    return rows.select("k", F.array_join(F.transform(pages.accepted_numbers(numbers), lambda n: F.coalesce(n.cast("string"), F.lit("-"))), ",").alias("numbers"))


@query(r"""
    WITH RECURSIVE w AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY ALL),
    p AS (SELECT conv_id, turn, string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)) AS said, regexp_split_to_array(text, '\s+') AS all_words FROM w),
    c AS (SELECT *, list_filter(range(0, len(all_words)), lambda i: i % 7 <> 3) AS starts FROM p),
    r AS (SELECT conv_id, turn, 1 AS k, 0::BIGINT AS here, '' AS times FROM c
          UNION ALL
          SELECT conv_id, turn, k + 1, CASE WHEN hit IS NULL THEN here ELSE hit + n END, times || CASE WHEN k > 1 THEN '|' ELSE '' END || CAST(CASE WHEN hit IS NULL THEN -1 ELSE starts[hit + 1] END AS VARCHAR) FROM (
              SELECT r.*, starts, len(regexp_split_to_array(trim(said[k]), '\s+')) AS n, list_min(list_filter(range(here, len(starts)), lambda i: trim(lower(all_words[starts[i + 1] + 1]), '.,!?;:''"') = trim(lower(regexp_split_to_array(trim(said[k]), '\s+')[1]), '.,!?;:''"'))) AS hit
              FROM r JOIN c USING (conv_id, turn) WHERE k <= len(said)))
    SELECT conv_id, turn, times FROM r JOIN c USING (conv_id, turn) WHERE k = len(said) + 1""")
def sentence_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-15: sentences of conversation lines timed by their words, one a second, of which every seventh was not heard; -1 where no word is found."""
    lines = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    words = F.filter(F.transform(F.split("text", r"\s+"), lambda w, i: F.struct(w.alias("text"), i.cast("double").alias("start"))), lambda w: w["start"].cast("int") % 7 != 3)
    rows = lines.select("conv_id", "turn", F.split("text", r"(?<=[.?!])\s+").alias("s"), words.alias("w"))
    at = turns.sentence_starts(F.col("s"), F.col("w"), F.lit(-1.0))
    return rows.select("conv_id", "turn", F.array_join(F.transform(at, lambda t: t.cast("int").cast("string")), "|").alias("times"))


@query(r"""
    WITH i AS (SELECT item_id, regexp_split_to_array(text, '\s+')[1:60] AS w FROM benchmark), p AS (SELECT a.item_id, a.w AS a, b.w AS b, list_distinct(a.w || b.w) AS v FROM i a JOIN i b ON b.item_id = a.item_id + 1)
    SELECT item_id, CAST(levenshtein(array_to_string(list_transform(a, lambda x: chr(CAST(list_position(v, x) AS INT))), ''), array_to_string(list_transform(b, lambda x: chr(CAST(list_position(v, x) AS INT))), '')) AS INT) AS errors FROM p""")
def word_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-23: word edit distance of the first sixty words of neighbouring benchmark items, for which SQL has letters enough."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.slice(F.split("text", r"\s+"), 1, 60).alias("a"))
    other = items.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return items.join(other, "item_id").select("item_id", evaluate.word_edit_distance(F.col("a"), F.col("b")).alias("errors"))


@query("""
    WITH d AS (SELECT doc_id, doc_id % 5 AS k, sha256(CAST(doc_id AS VARCHAR)) AS h, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '') AS words FROM documents),
    n AS (SELECT *, list_distinct(list_filter(words, lambda w: starts_with(w, 'th') AND k = 4)) AS dropped FROM d),
    g AS (SELECT *, list_sort(list_filter(dropped, lambda w: NOT regexp_full_match(w, '[ivxlcdm]{1,8}') AND NOT (length(w) >= 5 AND contains(array_to_string(list_filter(words, lambda x: NOT starts_with(x, 'th')), ''), w)))) AS gone FROM n),
    c AS (SELECT *, len(list_filter(words, lambda w: list_contains(gone, w))) AS lost, least(30, greatest(5, CAST(floor(len(words) * 0.1::DOUBLE) AS BIGINT))) AS bound FROM g)
    SELECT doc_id, CASE k WHEN 1 THEN false WHEN 2 THEN false WHEN 4 THEN lost <= bound AND len(dropped) > 0 OR len(dropped) = 0 ELSE true END AS written,
           CASE WHEN k = 2 THEN 'refused: declared content_hash is absent, malformed, or differs from the record path' WHEN k = 1 THEN 'unchanged' WHEN k = 0 OR k = 4 AND len(dropped) = 0 THEN 'body unchanged, stamps brought up to date' WHEN k = 4 AND lost > bound
                THEN 'refused: ' || CAST(lost AS VARCHAR) || ' word(s) of the stored body are absent from the fresh extraction (bound ' || CAST(bound AS VARCHAR) || '): ' || array_to_string(gone[1:40], ' ') ELSE 'refreshed in place' END AS reason, lost FROM c""")
def refresh_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-01, SET-03, AGG-03: the whole refresh of documents' words: as they were, as they were and current, under a wrong hash, with a line more, and without the words that begin with th."""
    k, h = _doc() % 5, F.sha2(_doc().cast("string").cast("binary"), 256)
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    rows = table(spark, sf_dir, "documents").withColumn("words", words).withColumn("h", h)
    line = lambda w: F.concat(F.array_join(w, " "), F.lit("\n"))
    stored = rows.select("doc_id", F.col("h").alias("record_hash"), F.concat(F.lit("/s/"), "h", F.lit(".md")).alias("path"), F.concat(F.lit("sha256:"), F.when(k == 2, "x").otherwise(F.col("h"))).alias("content_hash"), F.lit("web").alias("source_type"), F.when(k == 1, 7).otherwise(6).alias("declared"), F.lit(False).alias("reviewed"), F.lit("").alias("carried"), line(F.col("words")).alias("body"))
    kept = F.when(k == 4, F.filter("words", lambda w: ~w.startswith("th"))).otherwise(F.col("words"))
    fresh = rows.select(F.col("h").alias("record_hash"), F.concat(line(kept), F.when(k == 3, "One more line.\n").otherwise("")).alias("body"), F.expr("cast(array() as array<string>)").alias("introduced"))
    out = handlers.refresh(stored.drop("doc_id"), fresh)
    return stored.select("doc_id", "record_hash").join(out, "record_hash").select("doc_id", "written", "reason", "lost")

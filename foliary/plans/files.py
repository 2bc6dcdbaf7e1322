"""Queries of sources, sinks and seams. Files are rows of (path, content) made of the tables; tests read and write real folders."""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rights, text
from ..operators import assemble, audit, books, html, lifecycle, validate
from ..sources import fetch, media, pdf_text, records, scratch, seams, sinks
from . import handlers
from .registry import query, table


def _doc() -> Column:
    return F.col("doc_id")


def _said(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record file of each document; some are stubs, superseded, nested or without frontmatter."""
    i, n = _doc().cast("string"), _doc()
    head = _said(
        '---\ntitle: "T ', i, '"\nsource_type: ', F.when(n % 2 == 0, "web").otherwise("pdf"), F.when(n % 3 == 0, _said("\nsource_url: http://x.org/", i)).otherwise(""), "\nprovenance:\n  source_id: url:", i,
        F.when(n % 7 == 0, "\nsuperseded_by: next").otherwise(""), F.when(n % 5 != 0, "\ncontent_hash: 2024").otherwise(""), "\n---\n",
    )
    name = _said("store/", F.lpad(i, 8, "0"), F.when(n % 3 == 0, ".v2").otherwise(""), ".md")
    return records.parse_store(table(spark, sf_dir, "documents").select(name.alias("path"), _said(F.when(n % 11 == 0, "").otherwise(head), F.col("text")).alias("value")))


@query("""
    WITH d AS (SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS h, text FROM documents WHERE doc_id % 11 <> 0)
    SELECT h AS record_hash, CASE WHEN doc_id % 3 = 0 THEN 'v2' END AS variant, CASE WHEN doc_id % 7 = 0 THEN 'next' END AS superseded_by, doc_id % 5 = 0 AS stub, CASE WHEN doc_id % 3 = 0 THEN 'http://x.org/' || CAST(doc_id AS VARCHAR) END AS source_url,
           'url:' || CAST(doc_id AS VARCHAR) AS source_id, CASE WHEN doc_id % 2 = 0 THEN 'web' ELSE 'pdf' END AS source_type, sha256(text) AS body FROM d""")
def store_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02, SCL-16: the records of a store with a file for each document."""
    return _store(spark, sf_dir).select("record_hash", "variant", "superseded_by", "stub", "source_url", "source_id", "source_type", F.sha2(F.col("body").cast("binary"), 256).alias("body"))


@query("""
    SELECT CASE WHEN doc_id % 7 = 0 THEN 'store/v1' ELSE 'store' END AS root, CASE WHEN doc_id % 2 = 0 THEN 'web' ELSE 'pdf' END AS source_type, count(*) AS n FROM documents WHERE doc_id % 11 <> 0 GROUP BY ALL""")
def store_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03: records of the live and the retired store, by type."""
    found = _store(spark, sf_dir)
    return records.generations(found.filter("superseded_by is null"), found.filter("superseded_by is not null")).groupBy("root", "source_type").agg(F.count("*").alias("n"))


@query("SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS record_hash FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 2 = 0 AND doc_id % 7 <> 0")
def web_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04: live web records of a store."""
    return records.web_heads(_store(spark, sf_dir)).select("record_hash")


@query("""
    SELECT doc_id, 'T "' || source || '" ' || CAST(n_chars AS VARCHAR) AS title, n_chars / 4 AS duration, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END AS n_creators, CASE WHEN doc_id % 2 = 0 THEN lang END AS first_creator, CASE WHEN doc_id % 3 = 0 THEN 'page' END AS role FROM documents""")
def manifest_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: acquisition manifests as JSON, read by their schema; unknown fields and missing ones among them."""
    n = _doc()
    body = F.struct(
        _said('T "', F.col("source"), '" ', F.col("n_chars").cast("string")).alias("title"), (F.col("n_chars") / 4).alias("duration"), F.when(n % 2 == 0, F.array("lang", F.lit("x"))).alias("creators"), F.lit(1).alias("unknown"),
        F.when(n % 3 == 0, F.array(F.struct(F.lit("p.html").alias("path"), F.lit("page").alias("role"), F.lit(7).alias("odd")))).alias("snapshots"),
    )
    rows = media.parse_manifests(table(spark, sf_dir, "documents").select("doc_id", F.to_json(body).alias("json")))
    size = F.coalesce(F.size("creators"), F.lit(0))
    return rows.select("doc_id", "title", "duration", F.when(size > 0, size).otherwise(0).alias("n_creators"), F.get("creators", F.lit(0)).alias("first_creator"), F.get("snapshots", F.lit(0))["role"].alias("role"))


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive for each order: a segment and a track for each line, a timed and an untimed word in each segment."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("p"))
    at = F.col("n") * 10.0
    words = F.array(F.struct(_said(" w", F.col("p").cast("string"), " ").alias("word"), at.alias("start"), (at + 1).alias("end")), F.struct(F.lit("untimed").alias("word"), (at + 2).alias("start"), F.lit(None).cast("double").alias("end")))
    segment = F.struct(_said(" w", F.col("p").cast("string"), " untimed ").alias("text"), at.alias("start"), (at + 5).alias("end"), words.alias("words"))
    track = F.struct(at.alias("start"), (at + 4).alias("end"), _said("S", (F.col("p") % 3).cast("string")).alias("speaker"), F.lit("t").alias("track"))
    rows = lines.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("n", segment.alias("s"), track.alias("t")))).alias("x"))
    body = F.struct(F.struct(F.struct(F.transform("x", lambda r: r["s"]).alias("segments")).alias("aligned")).alias("whisperx"), F.struct(F.transform("x", lambda r: r["t"]).alias("tracks")).alias("pyannote"))
    return media.parse_transcripts(rows.select(F.col("k").cast("string").alias("stem"), F.to_json(body).alias("json")))


_LINES = "l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL), o AS (SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY n) - 1 AS INT) AS ord FROM l)"


@query(f"""WITH {_LINES} SELECT CAST(k AS VARCHAR) AS stem, ord, 'w' || CAST(p AS VARCHAR) || ' untimed' AS text, n * 10.0::DOUBLE AS start, n * 10.0::DOUBLE + 5 AS stop, 1 AS n_words, 'w' || CAST(p AS VARCHAR) AS word FROM o""")
def transcript_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06, SRC-17: segments and timed words of transcript archives."""
    return media.segments(_transcripts(spark, sf_dir)).select("stem", "ord", "text", "start", F.col("end").alias("stop"), F.size("words").alias("n_words"), F.get("words", F.lit(0))["text"].alias("word"))


@query(f"""WITH {_LINES} SELECT CAST(k AS VARCHAR) AS stem, ord, n * 10.0::DOUBLE AS start, n * 10.0::DOUBLE + 4 AS stop, 'S' || CAST(p % 3 AS VARCHAR) AS speaker FROM o""")
def diarised_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06, SRC-18: speakers' tracks of transcript archives."""
    return media.tracks(_transcripts(spark, sf_dir)).withColumnRenamed("end", "stop")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'api' WHEN p_size % 2 = 0 THEN 'vision' ELSE 'claude-code' END AS provider, CASE WHEN p_size % 3 = 0 THEN 50 WHEN p_size % 2 = 0 THEN 10 ELSE 20 END AS pages FROM part")
def provider_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-20, UDF-04: who reads a document's pages, and how many at a time."""
    model = F.when(F.col("p_size") % 3 == 0, "api:m").otherwise("m")
    who = seams.choose_provider(model, F.col("p_size") % 2 == 0)
    return table(spark, sf_dir, "part").select("p_partkey", who.alias("provider"), F.element_at(F.create_map(*[F.lit(x) for kv in seams.CHUNK_PAGES.items() for x in kv]), who).alias("pages"))


@query("SELECT DISTINCT lower(trim(w)) AS word FROM (SELECT unnest(string_split(p_name || '  ' || p_brand, ' ')) AS w FROM part) WHERE trim(w) <> ''")
def word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-22: a word list with repeats, blanks and capitals."""
    return media.wordlist(table(spark, sf_dir, "part").select(F.explode(F.split(F.concat_ws("  ", "p_name", "p_brand"), " ")).alias("value")))


@query("""
    SELECT CASE WHEN doc_id % 8 = 0 THEN 'x' ELSE 'h' END || CAST(doc_id AS VARCHAR) AS record_hash, CASE WHEN doc_id % 8 = 0 THEN 'refused' ELSE 'written' END AS state, CASE WHEN doc_id % 3 = 0 THEN 'web' ELSE 'pdf' END AS source_type
    FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 8 = 0""")
def record_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-23: records written by type and read again, beside those whose alias another record holds; every fourth is stored already."""
    docs, i = table(spark, sf_dir, "documents"), _doc().cast("string")
    rows = docs.select(_said(F.when(_doc() % 8 == 0, "x").otherwise("h"), i).alias("record_hash"), _said("a", i).alias("alias"), F.when(_doc() % 3 == 0, "web").otherwise("pdf").alias("source_type"))
    existing = docs.filter(_doc() % 4 == 0).select(_said("h", i).alias("record_hash"), _said("a", i).alias("alias"))
    path = scratch.new_path(spark, "records")
    refused = sinks.write_records(rows, existing, path)
    written = spark.read.parquet(path).withColumn("state", F.lit("written"))
    return written.select("record_hash", "state", "source_type").unionByName(refused.select("record_hash", F.lit("refused").alias("state"), "source_type"))


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS record_hash, '{"algorithm":"cloze-v1","challenge_count":30,"context_words":4,"sha256":"' || CAST(doc_id AS VARCHAR) || '","size_bytes":' || CAST(n_chars AS VARCHAR)
           || CASE WHEN doc_id % 2 = 0 THEN ',"challenges":[{"id":1,"before":"b","after":"a","answer":"' || source || '"},{"id":2,"before":"c","after":"d","answer":"' || lang || '"}]' ELSE '' END || '}' AS json FROM documents""")
def sidecar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-24: verification sidecars of documents, half of them with two challenges."""
    docs, h = table(spark, sf_dir, "documents"), _doc().cast("string").alias("record_hash")
    two = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(b).alias("before"), F.lit(a).alias("after"), F.col(c).alias("answer")) for i, b, a, c in ((2, "c", "d", "lang"), (1, "b", "a", "source"))])
    return sinks.sidecars(docs.select(h, F.col("n_chars").alias("size_bytes")), docs.filter(_doc() % 2 == 0).select(h, F.explode(two).alias("x")).select("record_hash", "x.*"))


@query("SELECT source, count(*) AS n, max(CASE WHEN doc_id % 2 = 0 THEN lang END) AS most FROM documents GROUP BY source")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-07, SRC-28: a report by source, written as JSON and read again."""
    path = scratch.new_path(spark, "report")
    made = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.max(F.when(_doc() % 2 == 0, F.col("lang"))).alias("most"))
    sinks.write_report(made, path)
    return spark.read.schema(made.schema).json(path)


@query("""
    WITH l AS (SELECT conv_id AS log, CASE WHEN turn % 3 = 0 THEN 'p/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn % 2 AS VARCHAR) || '.md' END AS p FROM conversations)
    SELECT log, CAST(count(DISTINCT p) AS INT) AS n, CASE WHEN count(DISTINCT p) = 1 THEN max(p) END AS path, CASE WHEN count(DISTINCT p) > 1 THEN 'handler reported ' || CAST(count(DISTINCT p) AS VARCHAR) || ' different record paths' END AS error FROM l GROUP BY log""")
def handler_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-29: the record that each handler's log says it wrote; every third turn says so."""
    path = _said("Written:  p/", F.col("conv_id").cast("string"), "-", (F.col("turn") % 2).cast("string"), ".md ")
    lines = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("log"), F.when(F.col("turn") % 3 == 0, path).otherwise(_said("not Written: ", F.col("role"))).alias("value"))
    return media.paths_said(lines)


def _epub(title: pd.Series, body: pd.Series) -> pd.Series:
    """Small EPUBs: two chapters, the second listed twice, a contents list and an image."""

    def one(t: str, b: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/b.opf"/></rootfiles></container>')
            items = '<item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/><item id="n" href="t.ncx" media-type="application/x-dtbncx+xml"/><item id="i" href="i.png" media-type="image/png"/>'
            z.writestr("OEBPS/b.opf", f'<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata><dc:title>{t}</dc:title><dc:creator>A</dc:creator><dc:creator>B</dc:creator><dc:identifier>urn:isbn:1</dc:identifier></metadata><manifest>{items}</manifest><spine><itemref idref="a"/><itemref idref="b"/><itemref idref="b"/></spine></package>')
            z.writestr("OEBPS/a.xhtml", f"<body><p>{b}</p></body>")
            z.writestr("OEBPS/b.xhtml", "<body><p>two</p></body>")
            z.writestr("OEBPS/t.ncx", '<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><navMap><navPoint><navLabel><text>One</text></navLabel><content src="a.xhtml"/></navPoint></navMap></ncx>')
            z.writestr("OEBPS/i.png", b"12345")
        return out.getvalue()

    return pd.Series([one(t, b) for t, b in zip(title, body)])


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 9 > 0 THEN 'Title ' || CAST(doc_id AS VARCHAR) END AS title, CASE WHEN doc_id % 9 > 0 THEN 2 END AS n_chapters, CASE WHEN doc_id % 9 > 0 THEN sha256('<body><p>' || regexp_replace(text, '[^A-Za-z ]', '', 'g') || '</p></body>') END AS first,
           CASE WHEN doc_id % 9 > 0 THEN 'A,B' END AS authors, CASE WHEN doc_id % 9 > 0 THEN 'One' END AS toc, CASE WHEN doc_id % 9 > 0 THEN 5::BIGINT END AS image_bytes FROM documents""")
def book_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08: an EPUB of each document's letters, and every ninth file no EPUB."""
    made = F.pandas_udf(_epub, "binary")(_said("Title ", _doc().cast("string")), F.regexp_replace("text", "[^A-Za-z ]", ""))
    files = table(spark, sf_dir, "documents").select(_doc().cast("string").alias("path"), F.when(_doc() % 9 == 0, F.lit(b"no zip")).otherwise(made).alias("content"))
    got = books.parse_books(files)
    return got.select("path", "title", F.when(F.col("chapters").isNotNull(), F.size("chapters")).alias("n_chapters"), F.sha2(F.get("chapters", F.lit(0))["xhtml"].cast("binary"), 256).alias("first"), F.array_join("authors", ",").alias("authors"), F.get("toc", F.lit(0))["title"].alias("toc"), F.get("images", F.lit(0))["size_bytes"].alias("image_bytes"))


@query("""
    WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'no ' ELSE '' END || '---' || chr(10) || 'title: x' || chr(10) || '---' || chr(10) || regexp_replace(text, '[^A-Za-z ]', '', 'g') || 'end' AS t, 1 + doc_id % 6 AS pages FROM documents)
    SELECT doc_id, NOT (doc_id % 3 = 0) AND length(t) >= greatest(500, pages * 200) AS ok, CASE WHEN doc_id % 3 = 0 THEN 'no frontmatter (doesn''t start with ---)' WHEN length(t) < greatest(500, pages * 200) THEN 'content too short (expected at least ' || CAST(greatest(500, pages * 200) AS VARCHAR) || ' chars)' ELSE '' END AS reason FROM d""")
def minimum_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-10: whether what a page reader gave can be a record of so many pages; every third has no frontmatter, some come in a code fence."""
    body = _said(F.when(_doc() % 3 == 0, "no ").otherwise(""), "---\ntitle: x\n---\n", F.regexp_replace("text", "[^A-Za-z ]", ""), "end")
    fenced = F.when(_doc() % 5 == 1, _said("```markdown\n", body, "\n```")).otherwise(body)
    return table(spark, sf_dir, "documents").select("doc_id", validate.minimum_content(fenced, (1 + _doc() % 6).cast("int")).alias("x")).select("doc_id", "x.*")


@query("""
    WITH f AS (SELECT p_partkey, p_size % 7 AS k FROM part)
    SELECT p_partkey, k IN (0, 1, 3) AS is_image, CASE k WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'svg' WHEN 3 THEN 'webp' WHEN 4 THEN 'tiff' WHEN 5 THEN 'bin' ELSE 'gif' END AS extension FROM f""")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-15, SCL-44: image files by name, and the extension by type or URL."""
    k = F.col("p_size") % 7
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k + 1).cast("int"))
    name, mime, url = pick("a.JPG", "b.png", "c.svg", "d.Webp", "e.tiff", "png", "jpg.gif"), pick("image/jpeg", None, "image/svg+xml", None, "image/TIFF", None, "text/x"), pick("http://x/a.png", "http://x/b.PNG?w=1", "", "http://x/d.webp#a", "", "http://x/none", "http://x/y.gif")
    return table(spark, sf_dir, "part").select("p_partkey", html.is_image_file(name).alias("is_image"), html.image_extension(mime, url).alias("extension"))


@query("""
    SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS INT) AS label, n AS ord, CASE WHEN n % 3 <> 0 THEN 'note ' || CAST(p AS VARCHAR) END AS note
    FROM (SELECT l_orderkey, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL)""")
def note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-14: note references of books made of orders, with the notes of another file; every third note is missing."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("p"))
    refs = lines.select("k", F.col("n").alias("ord"), F.lit("text/c1.xhtml").alias("file"), _said("../text/notes.xhtml#n", F.col("n").cast("string")).alias("href"))
    anchors = lines.filter("n % 3 <> 0").select("k", F.lit("text/notes.xhtml").alias("file"), _said("n", F.col("n").cast("string")).alias("id"), _said(F.col("n").cast("string"), ".  note\n", F.col("p").cast("string")).alias("text"))
    return audit.resolve_notes(refs, anchors, "k").select("k", "label", "ord", "note")


@query("""
    SELECT page_id, 0 AS ord, substr(sha256('img' || CAST(page_id AS VARCHAR)), 1, 12) || '.png' AS file, CAST(3 + length(CAST(page_id AS VARCHAR)) AS INT) AS size_bytes FROM pages WHERE page_id % 4 <> 0""")
def fetched_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-18, UDF-01: an image of each page with what was fetched for it; every fourth fetch failed."""
    p = F.col("page_id").cast("string")
    pages_ = table(spark, sf_dir, "pages").select("page_id", _said('<p>x</p><img src="/i/', p, '.jpg" width="300">').alias("html"), F.lit("http://x.org/a").alias("url"))
    media_ = table(spark, sf_dir, "pages").filter("page_id % 4 <> 0").select(_said("http://x.org/i/", p, ".jpg").alias("url"), _said("img", p).cast("binary").alias("content"), F.lit("image/png").alias("content_type"))
    return seams.attach_media(html.harvest_images(pages_, "page_id"), media_).select("page_id", "ord", "file", "size_bytes")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 3 END AS n_captures, 'h' || CAST(doc_id % 2 AS VARCHAR) AS page, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'p' END AS replaced, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 3 END AS n_snapshots FROM documents""")
def snapshot_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-19, SCL-48: captures told apart by digest, and snapshots by role."""
    entry = lambda a, b, names: F.struct(F.lit(a).alias(names[0]) if isinstance(a, str) else a.alias(names[0]), F.lit(b).alias(names[1]) if isinstance(b, str) else b.alias(names[1]))
    shas, roles = ("sha256", "name"), ("role", "hash")
    captures = lifecycle.append_by_sha(F.array(entry("a", "1", shas), entry("b", "2", shas)), entry(F.when(_doc() % 2 == 0, "b").otherwise("c"), "3", shas))
    held = F.array(entry("page", _said("h", (_doc() % 2).cast("string")), roles), entry("pdf", "p", roles))
    now = lifecycle.replace_snapshot(held, entry(F.when(_doc() % 3 == 0, "pdf").otherwise("css"), "new", roles))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(captures).alias("n_captures"), lifecycle.snapshot_hash(now, "page").alias("page"), lifecycle.snapshot_hash(now, "pdf").alias("replaced"), F.size(now).alias("n_snapshots"))


@query("""
    SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '\\n+\\z', ''), '(?m)[ \\t\\r\\f\\x0B]+$', '', 'g') || chr(10)) AS tidied, sha256(regexp_replace(text, '(?m)^([B-HJ-Z])\\n([a-z])', '\\1\\2', 'g')) AS joined FROM documents""")
def body_cleanups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-22, SCL-31: bodies tidied, and drop caps joined to their words."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return table(spark, sf_dir, "documents").select("doc_id", digest(text.tidy(F.col("text"))).alias("tidied"), digest(text.rejoin_dropcaps(F.col("text"))).alias("joined"))


@query("""
    SELECT page_id, 'line ' || url || chr(10) AS trimmed, 'rest of ' || url AS headless, '\\(a{ {b} }\\) and {{c}} ' || url || chr(10) || '-->' AS plain FROM pages""")
def mail_cleanups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-26, SCL-47: raw tails of mail cut, leading headings that repeat the subject dropped, braces in mathematics set apart, empty lines before the end of notes taken out."""
    tail = _said("line ", F.col("url"), "\n[link](http://x)\n\nReceived: from x\nMIME-Version: 1")
    head = _said("\n## Re:  A  Subject \n\nrest of ", F.col("url"))
    maths = _said(r"\(a{{b}}\) and {{c}} ", F.col("url"), "\n\n-->")
    return table(spark, sf_dir, "pages").select("page_id", text.trim_raw_tail(tail).alias("trimmed"), text.drop_leading_heading(head, F.lit("re: a subject")).alias("headless"), text.clean_annotations(text.clean_math(maths)).alias("plain"))


@query("""
    WITH d AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z]+', ' ', 'g') AS t FROM documents), c AS (SELECT doc_id, trim(regexp_replace('A & B ' || t, ' +', ' ', 'g')) AS b FROM d)
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND length(b) > 200 THEN rtrim(regexp_replace(substr(b, 1, 200), '\\s\\S*$', '')) || '…' ELSE b END AS blurb, CASE WHEN doc_id % 3 = 0 THEN 'video' ELSE 'audio' END AS kind,
           CASE doc_id % 4 WHEN 0 THEN 'Named' WHEN 1 THEN 'http://x/' || CAST(doc_id AS VARCHAR) WHEN 2 THEN 'id' ELSE 'Untitled pdf' END AS title FROM c""")
def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-37, SCL-40, SCL-43: descriptions out of HTML, cut where a record is gated; types by MIME; titles with what stands in for them."""
    k = _doc() % 4
    plain = text.strip_html(_said("<p>A &amp; <b>B</b></p>\n&nbsp;", F.regexp_replace("text", "[^A-Za-z]+", " ")))
    title = text.resolve_title(F.when(k == 0, "Named").otherwise(""), F.when(k == 1, _said("http://x/", _doc().cast("string"))), F.when(k == 2, "id").otherwise(""), F.lit("pdf"))
    return table(spark, sf_dir, "documents").select("doc_id", text.gated_blurb(plain, _doc() % 2 == 0).alias("blurb"), rights.source_type_of(F.when(_doc() % 3 == 0, "video/mp4").otherwise("audio/ogg")).alias("kind"), title.alias("title"))


@query("""
    WITH p AS (SELECT page_id, '<!--' || chr(10) || 'image:' || chr(10) || '  file: a.png' || chr(10) || '  alt: A' || chr(10) || '  caption: Cap' || chr(10) || '-->' AS one, '<!--' || chr(10) || 'image:' || chr(10) || '  file: b.png' || chr(10) || '-->' AS two, url FROM pages)
    SELECT page_id, 'Text of ' || url || '.' || chr(10) || chr(10) || one || chr(10) || chr(10) || 'The anchor line.' || chr(10) || chr(10) || two || chr(10) || chr(10) || 'End.' || chr(10) AS body FROM p""")
def rendered_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-45: images in the place of their links with the caption folded in, and behind the line that their anchor names."""
    pages_ = table(spark, sf_dir, "pages")
    bodies = pages_.select("page_id", _said("Text of ", F.col("url"), ".\n\n![A](http://x/a.png)\n\nCap\n\nThe anchor line.\n\nEnd.").alias("body"))
    image = lambda i, f, alt, cap, anchor: F.struct(F.lit(i).alias("ord"), F.lit(f"http://x/{f}").alias("url"), F.lit(f).alias("file"), F.lit(alt).cast("string").alias("alt"), F.lit(cap).cast("string").alias("caption"), F.lit(anchor).alias("anchor"))
    two = F.array(image(0, "a.png", "A", "Cap", "x"), image(1, "b.png", None, None, "The anchor line."))
    return html.with_images(bodies, pages_.select("page_id", F.explode(two).alias("x")).select("page_id", "x.*"), "page_id")


@query("""
    WITH b AS (SELECT doc_id, doc_id % 4 AS k FROM documents)
    SELECT doc_id, CASE k WHEN 0 THEN 'clean' WHEN 1 THEN 'fixed' ELSE 'unparseable inspector output: no json' END AS detail FROM b WHERE k IN (0, 1, 2)""")
def chapter_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-11, UDF-03: chapter openings that need a look, and what the inspector says; one in four needs none."""
    k = _doc() % 4
    region = F.when(k == 0, "B\negan the day").when(k == 1, "see printed_page 4 here").when(k == 2, "T\nhe end").otherwise("plain <!-- printed_page: 3 --> words")
    rows = table(spark, sf_dir, "documents").select("doc_id", region.alias("region"))
    told = lambda r: F.when(r.startswith("B"), '{"issues":[{"type":"dropcap","detail":"clean","corrected":"Began"}]}').when(r.startswith("see"), '{"issues":[{"type":"page","detail":"fixed"}]}').otherwise("no json")
    return seams.inspect(rows, told).select("doc_id", F.get("issues", F.lit(0))["detail"].alias("detail"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5")
def report_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-08: the five sources with most documents; the limit is the report's."""
    return handlers.worst(table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")), "n", "source", 5)


def _pdf(text_: pd.Series, odd: pd.Series) -> pd.Series:
    """PDF files with a page for every 1,000 characters and a line for every 100; odd ones code their letters in two bytes, with a table."""

    def one(t: str, coded: bool) -> bytes:
        pages_ = [t[i : i + 1000] for i in range(0, len(t), 1000)] or [""]
        objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"}
        if coded:
            table = b"begincmap 1 beginbfrange <0120> <01FF> <0020> endbfrange 1 beginbfchar <0001> <00660069> endbfchar endcmap"
            objects |= {3: b"<< /Type /Font /Subtype /Type0 /ToUnicode 4 0 R >>", 4: b"<< /Length %d >>\nstream\n%s\nendstream" % (len(table), table)}
        kids = []
        for i, p in enumerate(pages_):
            show = lambda x: b"<" + b"".join(b"%04X" % (ord(c) + 256) for c in x) + b"> Tj" if coded else b"[(" + x[:3].encode() + b") -20 (" + x[3:].replace("x", "\\170").encode() + b")] TJ"
            body = b"BT /F1 12 Tf 72 720 Td " + b" 0 -14 Td ".join(show(p[k : k + 100]) for k in range(0, len(p), 100)) + b" ET"
            packed = zlib.compress(body)
            objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * i)
            objects[11 + 2 * i] = b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(packed), packed)
            kids.append(b"%d 0 R" % (10 + 2 * i))
        objects[2] = b"<< /Type /Pages /Kids [" + b" ".join(kids) + b"] /Count %d /Resources << /Font << /F1 3 0 R >> >> >>" % len(kids)
        return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % kv for kv in objects.items()) + b"trailer << /Root 1 0 R >>\n%%EOF"

    return pd.Series([one(t, o) for t, o in zip(text_, odd)])


@query("""
    WITH d AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS t FROM documents), p AS (SELECT doc_id, unnest(range(0, greatest(length(t), 1), 1000)) AS a, t FROM d WHERE doc_id % 9 > 0),
    l AS (SELECT doc_id, a, t, unnest(range(0, 1000, 100)) AS b FROM p)
    SELECT CAST(doc_id AS VARCHAR) AS path, CAST(a // 1000 + 1 AS INT) AS page, sha256(coalesce(string_agg(substr(t, a + b + 1, 100), chr(10) ORDER BY b) FILTER (length(t) > a + b), '')) AS text FROM l GROUP BY doc_id, a
    UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL FROM documents WHERE doc_id % 9 = 0""")
def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10: the pages of a PDF file of each document's letters; every ninth file is no PDF."""
    made = F.pandas_udf(_pdf, "binary")(F.regexp_replace("text", "[^A-Za-z]", ""), _doc() % 2 == 1)
    files = table(spark, sf_dir, "documents").select(_doc().cast("string").alias("path"), F.when(_doc() % 9 == 0, F.lit(b"no pdf")).otherwise(made).alias("content"))
    return pdf_text.parse_pdfs(files).select("path", "page", F.sha2(F.col("text").cast("binary"), 256).alias("text"))


@query(r"""
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS pages, CASE WHEN p_size % 3 = 0 THEN p_size / 4 END AS duration, '"' || replace(replace(p_name || '\ "' || p_brand, '\', '\\'), '"', '\"') || '"' AS quoted,
           '    - name: reader' || chr(10) || '      version: "1.2"' || chr(10) || '      model: m' || chr(10) || '      role: extraction' || chr(10) || '      provider: local' AS tool FROM part""")
def stated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-49, SCL-50, SCL-51: pages and duration that a record states, a producer's stamp and quoted values."""
    size = F.col("p_size")
    record = _said("---\ntitle: x", F.when(size % 2 == 0, _said("\npages: ", size.cast("string"))).otherwise(""), F.when(size % 3 == 0, _said("\nduration: ", (size / 4).cast("string"))).otherwise("\n  duration: 9"), "\n---\n")
    return table(spark, sf_dir, "part").select("p_partkey", assemble.body_fields(record).alias("f"), text.yaml_quote(_said(F.col("p_name"), '\\ "', F.col("p_brand"))).alias("quoted"), assemble.tool("reader", "1.2", "extraction", "m").alias("tool")).select("p_partkey", "f.*", "quoted", "tool")


@query("""
    SELECT doc_id, '---' || chr(10) || 'title: "T ' || CAST(doc_id AS VARCHAR) || '"' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'date_published: "2020-01-02"' || chr(10) ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN 'creators:' || chr(10) || '  - "a"' || chr(10) || '  - "' || lang || '"' || chr(10) ELSE '' END
           || 'copyright:' || chr(10) || '  status: s' || CASE WHEN doc_id % 5 = 0 THEN chr(10) || '  detail: "d"' ELSE '' END || chr(10) || '---' || chr(10) || chr(10) || 'Body of ' || source AS record FROM documents""")
def record_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-06: record text from columns; what is null leaves no line."""
    n, A = _doc(), assemble
    lines = [A.quoted("title", _said("T ", n.cast("string"))), A.dated("date_published", F.when(n % 2 == 0, "2020-01-02").otherwise("")), A.listed("creators", F.when(n % 3 == 0, F.array(F.lit("a"), F.col("lang"))).otherwise(F.array().cast("array<string>"))), A.plain("none", F.lit(None).cast("string")), A.block("copyright", A.plain("status", F.lit("s"), 2), A.quoted("detail", F.when(n % 5 == 0, "d"), 2)), A.block("empty", F.lit(None).cast("string"))]
    return table(spark, sf_dir, "documents").select("doc_id", A.record_text(lines, _said("Body of ", F.col("source"))).alias("record"))


@query("""
    SELECT doc_id, '2024-05-06T00:00:00Z' AS extracted, NULL::VARCHAR AS refused, 'v9' AS version, CASE WHEN doc_id % 2 = 0 THEN 'old' ELSE 't' END AS kept, '3.1' AS tool_version FROM documents""")
def restamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-02: records stamped anew; what the stamps do not name stays."""
    tools = F.array(F.struct(F.lit("reader").alias("name"), F.lit("1.0").alias("version")))
    fm = F.struct(F.when(_doc() % 2 == 0, "old").otherwise("t").alias("title"), F.lit("pdf").alias("source_type"), F.lit("2001").alias("date_extracted"), F.lit("lost words").alias("refresh_refused"), F.struct(F.lit("v1").alias("version"), F.lit(0).alias("pipeline_version"), tools.alias("tools")).alias("processing"))
    done = lifecycle.restamp(table(spark, sf_dir, "documents").select("doc_id", fm.alias("fm")), F.lit("2024-05-06T00:00:00Z"), "v9", "3.1")
    return done.select("doc_id", F.col("fm.date_extracted").alias("extracted"), F.col("fm.refresh_refused").alias("refused"), F.col("fm.processing.version").alias("version"), F.col("fm.title").alias("kept"), F.get("fm.processing.tools", F.lit(0))["version"].alias("tool_version"))


@query("""
    SELECT page_id, sha256('A page of words about things, number ' || CAST(page_id AS VARCHAR) || '.' || chr(10)) AS record_hash, 'web' AS source_type, 'Story ' || CAST(page_id AS VARCHAR) AS title, 0 AS n_errors,
           '---' || chr(10) || 'schema: record/1' || chr(10) || 'title: "Story ' || CAST(page_id AS VARCHAR) || '"' || chr(10) || 'date_published: "2021-03-04T05:06:07Z"' || chr(10) || 'source_type: web' || chr(10) || 'file_format: html' AS head FROM pages""")
def web_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-09: the handler of web pages from manifests and captures to record text."""
    p = F.col("page_id").cast("string")
    rows = table(spark, sf_dir, "pages").select("page_id", _said("http://x.org/", p).alias("url"), F.sha2(p.cast("binary"), 256).alias("asset_hash"))
    made = _said('<head><meta property="og:title" content="Story ', p, '"><meta property="article:published_time" content="2021-03-04T05:06:07Z"></head><body><article><p>A page of <b>words</b> about things, number ', p, ".</p></article></body>")
    manifests = media.parse_manifests(rows.select(F.to_json(F.struct(F.col("url").alias("source"), "asset_hash", F.lit("2024-01-01T00:00:00Z").alias("fetched_at"))).alias("json")))
    found = handlers.web_records(manifests, rows.select("asset_hash", made.alias("html")))
    number = F.regexp_extract("title", r"(\d+)$", 1).cast("long")
    return found.select(number.alias("page_id"), "record_hash", "source_type", "title", F.size("errors").alias("n_errors"), F.regexp_extract("text", r"(?s)^(.*?file_format: html)", 1).alias("head"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 > 0 AND doc_id % 7 > 0 THEN regexp_replace(text, '[^A-Za-z]', '', 'g') END AS content, CASE WHEN doc_id % 3 > 0 AND doc_id % 7 > 0 THEN 'text/plain;p=' || CAST(doc_id AS VARCHAR) END AS content_type FROM documents""")
def http_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12: what the fetcher gives for URLs that hold their response; every third is HTML, every seventh of a kind that it does not take."""
    kind = F.when(_doc() % 3 == 0, "text/html").otherwise("text/plain")
    url = _said(F.when(_doc() % 7 == 0, "file:///etc/").otherwise("data:"), kind, ";p=", _doc().cast("string"), ",", F.regexp_replace("text", "[^A-Za-z]", ""))
    got = fetch.fetch_http(table(spark, sf_dir, "documents").select(url.alias("url")), ("data",))
    return got.select(F.regexp_extract("url", r";p=(\d+),", 1).cast("long").alias("doc_id"), F.col("content").cast("string").alias("content"), "content_type")

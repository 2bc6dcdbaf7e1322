"""Queries on documents as records: quality, identity, bags, rights, types, validation and lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rights, temporal, text, urls
from ..operators import audit, bags, dedup, lifecycle, pages, quality, validate
from .registry import query, table

TYPES = ("ebook", "pdf", "web", "audio", "image")
BODY = "concat('<!-- chapter: ', cast(doc_id % 7 as string), ' -->\n<!-- chapter_title: x -->\n', replace(text, 'the', '�'), '\n<!-- printed_page: ', cast(doc_id % 9 as string), ' -->{{note}}')"
KIND = "case doc_id % 5 when 0 then 'ebook' when 1 then 'pdf' when 2 then 'web' when 3 then 'audio' else 'image' end"


def _sql(expr: str) -> str:
    return expr.replace("as string", "as varchar")


@query(f"""
    WITH d AS (SELECT doc_id, {_sql(BODY)} AS body, {KIND} AS source_type FROM documents)
    SELECT doc_id, source_type,
           CAST((len(regexp_replace(body, '<!--.*?-->', ' ', 'gs')) - len(replace(regexp_replace(body, '<!--.*?-->', ' ', 'gs'), '�', ''))) AS BIGINT) AS replacement_chars,
           CASE WHEN source_type = 'ebook' THEN CAST(len(regexp_extract_all(body, '<!--\\s*chapter:')) AS BIGINT) END AS chapter_markers,
           CASE WHEN source_type = 'ebook' THEN CAST(len(regexp_extract_all(body, '<!--\\s*chapter_title:')) AS BIGINT) END AS chapter_titles,
           CASE WHEN source_type IN ('ebook', 'pdf') THEN CAST(len(regexp_extract_all(body, 'printed_page:')) AS BIGINT) END AS page_anchors
    FROM d""")
def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, SCL-20: damage and structure counts of every document."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{BODY} AS body", f"{KIND} AS source_type")
    return docs.select("doc_id", "source_type", *[c.alias(n) for n, c in quality.measures(F.col("body"), F.col("source_type")).items()])


CONFUSED = ", ".join(f"'{a}{b}', '{b}{a}'" for a, b in quality.CONFUSABLE)


@query(f"""
    WITH t AS (SELECT source, unnest(regexp_split_to_array(regexp_replace(text, '([a-z])e([a-z]*t)\\b', '\\1c\\2', 'g'), '[^\\p{{L}}\\p{{N}}_]+')) AS noun FROM documents),
    n AS (SELECT source, noun, count(*) AS n FROM t WHERE regexp_full_match(noun, '[A-Z][a-zA-Z]{{4,}}') GROUP BY ALL),
    p AS (SELECT a.source, a.noun, min(b.noun) AS other FROM n a JOIN n b ON a.source = b.source AND length(a.noun) = length(b.noun) AND a.n <= 2 AND b.n >= 2 AND b.n > a.n
          WHERE len(list_filter(range(1, length(a.noun) + 1), lambda i: substr(a.noun, i, 1) <> substr(b.noun, i, 1))) BETWEEN 1 AND 2
            AND len(list_filter(range(1, length(a.noun) + 1), lambda i: substr(a.noun, i, 1) <> substr(b.noun, i, 1) AND lower(substr(a.noun, i, 1) || substr(b.noun, i, 1)) NOT IN ({CONFUSED}))) = 0
          GROUP BY ALL)
    SELECT n.source, CAST(sum(n.n) AS BIGINT) AS nouns, count(p.noun) AS flagged, round(count(p.noun) / sum(n.n) * 1000, 2) AS substitution_score,
           coalesce(array_to_string(list_slice(list_sort(list_distinct(list(n.noun || '->' || p.other) FILTER (p.noun IS NOT NULL))), 1, 6), ','), '') AS examples
    FROM n LEFT JOIN p ON n.source = p.source AND n.noun = p.noun GROUP BY n.source""")
def ocr_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-08, AGG-01, SRT-04: rare proper nouns that look like a scan's misreading of a frequent one, by source, with some e turned into c."""
    docs = table(spark, sf_dir, "documents").select("source", F.regexp_replace("text", r"([a-z])e([a-z]*t)(?![a-zA-Z0-9_])", "$1c$2").alias("text"))
    nouns = quality.proper_nouns(docs, "source", "text")
    score = quality.substitution_score(nouns, quality.substitutions(nouns, "source"), "source")
    return score.withColumn("examples", F.array_join("examples", ","))


@query("""
    WITH h AS (SELECT doc_id, sha256(text) AS content_hash FROM documents)
    SELECT doc_id, content_hash, min(doc_id) OVER w AS first_key, count(*) OVER w AS n FROM h WINDOW w AS (PARTITION BY content_hash)""")
def content_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-01, SRT-01: content hash and first holder of every document."""
    return dedup.same_content(table(spark, sf_dir, "documents"), "doc_id", "text")


STORE = "WITH s AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS path, sha256(text) AS source_hash FROM documents WHERE doc_id % 2 = 0 AND doc_id % 10 <> 4), i AS (SELECT doc_id, CASE WHEN doc_id % 15 = 0 THEN '' ELSE sha256(text) END AS source_hash FROM documents WHERE doc_id % 2 = 1)"


def _store_and_intake(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    store = docs.filter("doc_id % 2 = 0").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("source_hash"), F.when(F.col("doc_id") % 10 == 4, "newer").alias("superseded_by"))
    intake = docs.filter("doc_id % 2 = 1").select("doc_id", F.when(F.col("doc_id") % 15 == 0, "").otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("source_hash"))
    return store, intake


@query(STORE + " SELECT i.doc_id, i.source_hash, min(s.path) AS existing FROM i JOIN s USING (source_hash) GROUP BY ALL")
def intake_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-01: odd documents whose text a live even document has, with the first one's path."""
    store, intake = _store_and_intake(spark, sf_dir)
    return dedup.known(intake, store, "source_hash").select("doc_id", "source_hash", "existing")


@query(STORE + " SELECT i.doc_id, i.source_hash FROM i WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.source_hash = i.source_hash)")
def intake_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-01, SRC-01: odd documents that no live even document matches; empty keys match nothing."""
    store, intake = _store_and_intake(spark, sf_dir)
    return dedup.unknown(intake, store, "source_hash").select("doc_id", "source_hash")


@query("""
    WITH b AS (SELECT page_id, unnest([url, replace(url, 'https://', 'http://'), regexp_replace(url, '[?#].*$', '')]) AS u FROM pages WHERE page_id % 2 = 0),
    s AS (SELECT trim(u) AS url, min(lpad(CAST(page_id AS VARCHAR), 9, '0')) AS path FROM b WHERE trim(u) <> '' GROUP BY ALL),
    i AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(url, 'https://', 'http://') ELSE url END AS url FROM pages)
    SELECT i.page_id, i.url, s.path AS existing FROM i JOIN s USING (url)""")
def url_alias_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-02, SET-01: pages that an alias of an even page equals."""
    rows = table(spark, sf_dir, "pages")
    store = rows.filter("page_id % 2 = 0").select(F.lpad(F.col("page_id").cast("string"), 9, "0").alias("path"), F.lit(None).cast("string").alias("superseded_by"), "url")
    fields = [F.array("url"), F.array(F.replace("url", F.lit("https://"), F.lit("http://"))), F.array(F.regexp_replace("url", "[?#].*$", ""))]
    intake = rows.select("page_id", F.when(F.col("page_id") % 3 == 0, F.replace("url", F.lit("https://"), F.lit("http://"))).otherwise(F.col("url")).alias("url"))
    return dedup.known_by_url(intake, dedup.alias_bridge(store, dedup.aliases(fields))).select("page_id", "url", "existing")


@query("""
    WITH r AS (SELECT item_id, lpad(CAST(item_id AS VARCHAR), 6, '0') AS path, sha256(text) AS h, 'id:' || CAST(item_id % 20 AS VARCHAR) AS sid, 'http://x/' || CAST(item_id // 2 AS VARCHAR) AS url FROM benchmark),
    q AS (SELECT item_id AS query, sha256(text) AS h, CASE WHEN item_id % 3 = 0 THEN 'id:' || CAST(item_id % 20 AS VARCHAR) ELSE '' END AS sid, CASE WHEN item_id % 4 = 1 THEN 'http://x/' || CAST(item_id // 2 AS VARCHAR) ELSE '' END AS url FROM benchmark),
    m AS (SELECT query, path FROM q JOIN r ON q.h = r.h UNION SELECT query, path FROM q JOIN r ON q.sid <> '' AND q.sid = r.sid UNION SELECT query, path FROM q JOIN r ON q.url <> '' AND q.url = r.url)
    SELECT q.query, count(m.path) AS n, CASE WHEN count(m.path) = 1 THEN min(m.path) END AS path FROM q LEFT JOIN m USING (query) GROUP BY q.query""")
def resolve_exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-03, SET-02: benchmark items by hash, id and URL against each other."""
    items = table(spark, sf_dir, "benchmark")
    digest = F.concat(F.lit("sha256:"), F.sha2(F.col("text").cast("binary"), 256))
    sid, url = F.concat(F.lit("id:"), (F.col("item_id") % 20).cast("string")), F.concat(F.lit("http://x/"), F.floor(F.col("item_id") / 2).cast("string"))
    records = items.select(F.lpad(F.col("item_id").cast("string"), 6, "0").alias("path"), digest.alias("content_hash"), F.lit(None).cast("string").alias("source_hash"), sid.alias("source_id"), F.array(url).alias("urls"))
    asked = items.select(F.col("item_id").alias("query"), digest.alias("asset_hash"), F.when(F.col("item_id") % 3 == 0, sid).otherwise("").alias("source_id"), F.when(F.col("item_id") % 4 == 1, url).otherwise("").alias("source_url"))
    return dedup.resolve_one(asked, records)


PAIRS = "SELECT a.doc_id, a.text AS old, b.text AS new FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"
BAG = "unnest(regexp_split_to_array(lower(regexp_replace({0}, '\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')), '[^\\p{{L}}\\p{{N}}]+'))"


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    a, b = docs.select("doc_id", F.col("text").alias("old")), docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("new"))
    return a.join(b, "doc_id")


@query(f"WITH w AS (SELECT doc_id, {BAG.format('text')} AS word FROM documents) SELECT doc_id, count(*) AS words, count(DISTINCT word) AS distinct_words FROM w WHERE word <> '' GROUP BY doc_id")
def word_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02: words and distinct words of every document's bag."""
    bag = bags.word_bag(table(spark, sf_dir, "documents"), "doc_id", "text")
    return bag.groupBy("doc_id").agg(F.sum("n").alias("words"), F.count("*").alias("distinct_words"))


@query(f"""
    WITH p AS ({PAIRS}),
    o AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, {BAG.format('old')} AS word FROM p) WHERE word <> '' GROUP BY ALL),
    h AS (SELECT DISTINCT doc_id, word FROM (SELECT doc_id, {BAG.format('new')} AS word FROM p)),
    l AS (SELECT doc_id, lower(regexp_replace(new, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS letters FROM p),
    g AS (SELECT o.* FROM o JOIN l USING (doc_id)
          WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.doc_id = o.doc_id AND h.word = o.word)
            AND NOT EXISTS (SELECT 1 FROM h WHERE h.doc_id = o.doc_id AND regexp_full_match(o.word, '[a-z]{{3,}}[0-9]{{1,3}}') AND h.word = regexp_replace(o.word, '[0-9]+$', ''))
            AND NOT regexp_full_match(o.word, '[ivxlcdm]{{1,8}}') AND NOT (length(o.word) >= 5 AND contains(l.letters, o.word)))
    SELECT doc_id, count(*) AS words_gone, CAST(sum(n) AS BIGINT) AS occurrences FROM g GROUP BY doc_id""")
def words_gone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03: what each document's next one no longer says."""
    gone = bags.words_gone(_neighbours(spark, sf_dir), "doc_id", "old", "new")
    return gone.groupBy("doc_id").agg(F.count("*").alias("words_gone"), F.sum("n").alias("occurrences"))


@query(f"""
    WITH p AS ({PAIRS}),
    o AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, {BAG.format('old')} AS word FROM p) WHERE word <> '' GROUP BY ALL),
    c AS (SELECT doc_id, word, count(*) AS m FROM (SELECT doc_id, {BAG.format('new')} AS word FROM p) WHERE word <> '' GROUP BY ALL),
    b AS (SELECT doc_id, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM o FULL JOIN c USING (doc_id, word))
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS reference_words, CAST(sum(m) AS BIGINT) AS candidate_words, CAST(sum(least(n, m)) AS BIGINT) AS shared,
           round(sum(least(n, m)) / greatest(sum(m), 1) * 100, 2) AS precision_pct, round(sum(least(n, m)) / greatest(sum(n), 1) * 100, 2) AS recall_pct FROM b GROUP BY doc_id""")
def overlap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04: multiset precision and recall of each document against the next."""
    return bags.overlap(_neighbours(spark, sf_dir), "doc_id", "old", "new")


@query(rf"""
    WITH r AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, 'example\.[a-z]+', 'agency.gov') WHEN 1 THEN url WHEN 2 THEN 'file-' || CAST(page_id AS VARCHAR) || '.pdf' ELSE regexp_replace(url, '^https?', 'ftp') END AS source,
                      CASE WHEN page_id % 7 = 0 THEN 'licensed' WHEN page_id % 5 = 0 THEN ' ' END AS explicit, CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, 'example\.[a-z]+', CASE WHEN page_id % 2 = 0 THEN 'x.mil' ELSE 'gov.example.org' END) END AS source_url, CASE WHEN page_id % 11 = 0 THEN 'doi:1' ELSE '' END AS sid FROM pages),
    h AS (SELECT *, CASE WHEN trim(coalesce(explicit, '')) <> '' THEN explicit WHEN regexp_matches(source, '^https?://') THEN CASE WHEN regexp_matches(lower(regexp_extract(source, '^https?://([^/:?#]*)', 1)), '(^|\.)(gov|mil)$') THEN 'public_domain' ELSE 'publicly_accessible' END
                      WHEN regexp_matches(source_url, '^https?://') THEN CASE WHEN regexp_matches(lower(regexp_extract(source_url, '^https?://([^/:?#]*)', 1)), '(^|\.)(gov|mil)$') THEN 'public_domain' ELSE 'publicly_accessible' END END AS st FROM r)
    SELECT page_id, coalesce(st, 'restricted') AS status, CASE WHEN st IS NULL AND coalesce(source_url, '') = '' AND sid = '' THEN '{rights.NO_ORIGIN}' END AS detail, coalesce(st, 'restricted') NOT IN ('public_domain', 'publicly_accessible') AS gated,
           CASE WHEN coalesce(st, 'restricted') IN ('public_domain', 'publicly_accessible') THEN 'open' ELSE 'gated' END AS zone FROM h""")
def rights_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-11, FLT-01, FLT-03, FLT-04, SRC-27: status, reason, gate and zone of pages by their URLs, some of them of governments, some no URLs."""
    k, url = F.col("page_id"), F.col("url")
    at = lambda site: F.regexp_replace("url", F.lit(r"example\.[a-z]+"), site)
    source = F.when(k % 4 == 0, at(F.lit("agency.gov"))).when(k % 4 == 1, url).when(k % 4 == 2, F.concat(F.lit("file-"), k.cast("string"), F.lit(".pdf"))).otherwise(F.regexp_replace(url, "^https?", "ftp"))
    other = F.when(k % 3 == 0, at(F.when(k % 2 == 0, "x.mil").otherwise("gov.example.org")))
    status = rights.resolve_status(F.when(k % 7 == 0, "licensed").when(k % 5 == 0, " "), source, other, F.when(k % 11 == 0, "doi:1").otherwise(""))
    out = table(spark, sf_dir, "pages").select("page_id", status.alias("r"))
    return out.select("page_id", "r.status", "r.detail", rights.is_gated(F.col("r.status")).alias("gated"), rights.storage_zone(F.col("r.status")).alias("zone"))


SUFFIXES = (" Report", " footage of x", " (Documentary)", " slide deck", " letter to y", " Ep. 12", " transcription", "", " statement", " press conference", " Interviewed by Z", " Form 7")


@query(f"""
    WITH p AS (SELECT p_partkey, p_name || list_extract([{", ".join(f"'{s}'" for s in SUFFIXES)}], CAST(p_partkey % 12 + 1 AS INT)) AS title, CASE WHEN p_partkey % 2 = 0 THEN 'pdf' ELSE 'audio' END AS source_type FROM part)
    SELECT p_partkey, title, source_type, CASE
        WHEN source_type = 'audio' THEN CASE WHEN title ILIKE '%interviewed by%' THEN 'interview' WHEN title ILIKE '%(documentary%' THEN 'documentary' WHEN regexp_matches(title, '(?i)Podcast|\\bEp\\.?\\s*\\d+') THEN 'podcast' WHEN title ILIKE '%press conference%' THEN 'broadcast' WHEN regexp_matches(title, '(?i)\\bfootage\\b') THEN 'footage' END
        ELSE CASE WHEN regexp_matches(title, '(?i)\\bslide\\b') THEN 'slide' WHEN regexp_matches(title, '(?i)\\bform\\b') THEN 'form' WHEN regexp_matches(title, '(?i)\\btranscript(ion)?\\b') THEN 'transcript' WHEN regexp_matches(title, '(?i)\\b(letter|correspondence)\\b') THEN 'letter' WHEN regexp_matches(title, '(?i)\\bstatement\\b') THEN 'statement' WHEN regexp_matches(title, '(?i)\\bReport\\s*$') THEN 'report' END
    END AS document_type FROM p""")
def document_type_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-06: parts with titles of twelve kinds."""
    name = F.concat("p_name", F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.col("p_partkey") % 12 + 1).cast("int")))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("title"), F.when(F.col("p_partkey") % 2 == 0, "pdf").otherwise("audio").alias("source_type"))
    return rows.withColumn("document_type", rights.document_type(F.col("source_type"), F.col("title")))


@query("""
    WITH r AS (SELECT p_partkey % 5 AS k, p_partkey % 12 AS m FROM part), t AS (SELECT CASE WHEN k = 0 THEN '(none)' WHEN k = 1 THEN 'opus' WHEN k = 2 THEN 'jpg' WHEN k = 3 THEN 'pdf' ELSE 'html' END AS file_format, CASE WHEN m = 0 THEN 'report' WHEN m = 3 THEN 'slide' ELSE '(none)' END AS document_type FROM r)
    SELECT file_format, document_type, count(*) AS n FROM t GROUP BY ALL""")
def type_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, SRT-09, SCL-12: parts by derived file format and document type."""
    k, m = F.col("p_partkey") % 5, F.col("p_partkey") % 12
    ext = F.when(k == 1, ".OGG").when(k == 2, "jpeg").when(k == 3, " .pdf ").when(k == 4, "htm").otherwise(".")
    title = F.when(m == 0, "Incident Report").when(m == 3, "a slide").otherwise(F.col("p_name"))
    rows = table(spark, sf_dir, "part").select(rights.normalise_format(ext).alias("file_format"), rights.document_type(F.lit("pdf"), title).alias("document_type"))
    return audit.type_census(rows)


@query("""
    SELECT substr(sha256(text), 1, 16) AS hash16, lang AS source_type, CASE WHEN doc_id % 4 = 0 THEN '(no title)' ELSE substr(text, 1, 20) END AS title FROM documents
    WHERE doc_id % 3 = 0 AND doc_id % 7 <> 0 AND doc_id % 5 <> 0""")
def missing_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02: restricted documents without URL and id."""
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("record_hash"), F.col("lang").alias("source_type"), F.when(n % 4 != 0, F.substring("text", 1, 20)).alias("title"), F.when(n % 3 == 0, "restricted").otherwise("licensed").alias("status"), F.when(n % 7 == 0, "http://x").alias("source_url"), F.when(n % 5 == 0, "id").otherwise("").alias("source_id"))
    return audit.missing_provenance(rows)


@query("""
    WITH r AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'ebook' ELSE 'web' END AS source_type,
        CASE WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 's' || CAST(doc_id AS VARCHAR) WHEN doc_id % 3 = 2 THEN 'w' || CAST(doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) END AS original FROM documents)
    SELECT * FROM r WHERE original NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AND original NOT IN (SELECT 's' || CAST(doc_id AS VARCHAR) FROM labels)""")
def archive_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-10: documents whose original the archive of labelled ids lacks."""
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(n % 3 == 0, "pdf").when(n % 3 == 1, "ebook").otherwise("web").alias("source_type"))
    original = audit.original_of(F.col("source_type"), n.cast("string"), F.when(n % 2 == 0, F.concat(F.lit("s"), n.cast("string"))), F.concat(F.lit("w"), n.cast("string")))
    labels = table(spark, sf_dir, "labels").select(n.cast("string").alias("stem"))
    archive = labels.union(labels.select(F.concat(F.lit("s"), "stem")))
    return audit.absent_originals(rows.withColumn("original", original), archive)


@query("""
    SELECT d.doc_id, CASE WHEN d.doc_id % 10 = 0 AND l.doc_id IS NOT NULL THEN d.source WHEN l.quality = 1 THEN 'good ' || CAST(l.doc_id AS VARCHAR) ELSE d.source END AS title,
           'id' || CAST(d.doc_id AS VARCHAR) AS source_id, CASE WHEN d.doc_id % 10 = 0 AND l.doc_id IS NOT NULL THEN 'source_id' ELSE '' END AS conflict
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def override_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-11, LIF-05: labels as supplied metadata over documents; every tenth contradicts the id."""
    n = F.col("doc_id").cast("string")
    records = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.concat(F.lit("id"), n).alias("source_id"))
    supplied = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, F.concat(F.lit("good "), n)).alias("title"), F.when(F.col("doc_id") % 10 == 0, "other").otherwise(F.concat(F.lit("id"), n)).alias("source_id"))
    out = lifecycle.merge_metadata(records, supplied, "doc_id", ["title", "source_id"])
    return out.select("doc_id", "title", "source_id", F.array_join("conflict", ",").alias("conflict"))


@query("""
    WITH r AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ebook' WHEN 1 THEN 'pdf' WHEN 2 THEN 'web' WHEN 3 THEN 'audio' ELSE 'scroll' END AS source_type, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(doc_id % 8 AS INT) END AS declared FROM documents),
    g AS (SELECT *, CASE source_type WHEN 'ebook' THEN 6 WHEN 'pdf' THEN 1 WHEN 'web' THEN 7 WHEN 'audio' THEN 2 END AS target FROM r)
    SELECT doc_id, source_type, declared, declared IS DISTINCT FROM target AS stale, doc_id IN (SELECT doc_id FROM labels) AS reviewed,
           CASE WHEN target IS NULL OR (declared IS DISTINCT FROM 1) THEN declared ELSE target END AS version, target IS NOT NULL AND declared IS NOT DISTINCT FROM 1 AND target <> 1 AS changed,
           CASE WHEN target IS NULL THEN 'unsupported source_type: scroll' WHEN declared IS DISTINCT FROM 1 THEN 'record pipeline_version is ' || coalesce(CAST(declared AS VARCHAR), 'none') || ', expected 1' END AS error FROM g""")
def version_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-17, LIF-04: staleness, review and a compare-and-set stamp that expects version 1."""
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", n.alias("record_hash"), F.when(n % 5 == 0, "ebook").when(n % 5 == 1, "pdf").when(n % 5 == 2, "web").when(n % 5 == 3, "audio").otherwise("scroll").alias("source_type"), F.when(n % 11 != 0, (n % 8).cast("int")).alias("declared"))
    rows = lifecycle.with_reviews(rows, table(spark, sf_dir, "labels").select(n.alias("record_hash")))
    stamp = lifecycle.stamp_generation(F.col("declared"), F.lit(1), F.col("source_type"))
    return rows.select("doc_id", "source_type", "declared", lifecycle.is_stale(F.col("source_type"), F.col("declared")).alias("stale"), "reviewed", stamp.alias("s")).select("doc_id", "source_type", "declared", "stale", "reviewed", "s.version", "s.changed", "s.error")


@query("""
    WITH l AS (SELECT 'a' || CAST(doc_id AS VARCHAR) AS alias, 'h' || CAST(doc_id AS VARCHAR) AS record_hash FROM documents WHERE doc_id % 2 = 0),
    i AS (SELECT 'a' || CAST(doc_id AS VARCHAR) AS alias, CASE WHEN doc_id % 3 = 0 THEN 'h' ELSE 'n' END || CAST(doc_id AS VARCHAR) AS record_hash FROM documents WHERE doc_id % 5 < 2)
    SELECT l.alias, l.record_hash, i.record_hash AS superseded_by, CAST(NULL AS VARCHAR) AS supersedes, CASE WHEN i.alias IS NULL THEN 'live' ELSE 'retired' END AS generation FROM l LEFT JOIN i USING (alias) WHERE i.alias IS NULL OR i.record_hash <> l.record_hash
    UNION ALL SELECT i.alias, i.record_hash, NULL, CASE WHEN l.record_hash <> i.record_hash THEN l.record_hash END, 'live' FROM i LEFT JOIN l USING (alias)""")
def supersession(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIF-03: forced replacement of even documents by alias."""
    n, none = F.col("doc_id").cast("string"), F.lit(None).cast("string")
    docs = table(spark, sf_dir, "documents")
    row = lambda df, h: df.select(F.concat(F.lit("a"), n).alias("alias"), h.alias("record_hash"), none.alias("superseded_by"), none.alias("supersedes"))
    return lifecycle.supersede(row(docs.filter("doc_id % 2 = 0"), F.concat(F.lit("h"), n)), row(docs.filter("doc_id % 5 < 2"), F.concat(F.when(F.col("doc_id") % 3 == 0, "h").otherwise("n"), n)))


@query("""
    WITH d AS (SELECT unnest(['pdf', 'web', 'ebook', 'audio']) AS source_type, unnest([1, 7, 6, 2]) AS a), s AS (SELECT CASE source WHEN 'src1' THEN 'web' WHEN 'src2' THEN 'pdf' WHEN 'src3' THEN 'image' ELSE 'scroll' END AS source_type, CAST(max(doc_id % 9) AS INT) AS b FROM documents WHERE source IN ('src1', 'src2', 'src3', 'src4') GROUP BY 1)
    SELECT source_type, greatest(coalesce(a, 0), coalesce(b, 0)) AS version FROM d FULL JOIN s USING (source_type) WHERE source_type <> 'scroll'""")
def version_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-26: declared versions against stored ones; none regresses."""
    declared = spark.sql("SELECT * FROM VALUES ('pdf', 1), ('web', 7), ('ebook', 6), ('audio', 2) AS t(source_type, version)")
    kind = F.when(F.col("source") == "src1", "web").when(F.col("source") == "src2", "pdf").when(F.col("source") == "src3", "image").otherwise("scroll")
    stored = table(spark, sf_dir, "documents").filter(F.col("source").isin("src1", "src2", "src3", "src4")).groupBy(kind.alias("source_type")).agg(F.max(F.col("doc_id") % 9).cast("int").alias("version"))
    return lifecycle.merge_versions(declared, stored)


@query("""
    WITH c AS (SELECT source, CASE WHEN doc_id % 4 = 0 THEN 'm-large-2' WHEN doc_id % 4 = 1 THEN 'm-small' ELSE 'other' END AS model, n_chars AS i, n_chars // 3 AS o, doc_id % 100 AS k FROM documents)
    SELECT source, CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens, CAST(sum(k) AS BIGINT) AS cache_tokens,
           round(sum(CASE model WHEN 'm-large-2' THEN (i * 3.0 + o * 15.0 + k * 0.3) WHEN 'm-small' THEN (i * 1.0 + o * 2.0 + k * 0.1) END / 1000000), 6) AS usd FROM c GROUP BY source""")
def cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12: characters as tokens, priced by model prefix."""
    n = F.col("doc_id")
    calls = table(spark, sf_dir, "documents").select("source", F.when(n % 4 == 0, "m-large-2").when(n % 4 == 1, "m-small").otherwise("other").alias("model"), F.col("n_chars").alias("input_tokens"), F.expr("n_chars div 3").alias("output_tokens"), (n % 100).alias("cache_tokens"))
    prices = spark.sql("SELECT * FROM VALUES ('m-', 1.0D, 2.0D, 0.1D), ('m-large', 3.0D, 15.0D, 0.3D) AS t(prefix, usd_in, usd_out, usd_cache)")
    return audit.usage_cost(calls, prices, "source").withColumn("usd", F.round("usd", 6))


@query("SELECT p_partkey, p_size * 900 AS est_input_tokens, p_size * 1800 AS est_output_tokens, round(p_size * 900 / 1000000 * 3.0 + p_size * 1800 / 1000000 * 15.0, 6) AS usd, round((p_size * 900 / 1000000 * 3.0 + p_size * 1800 / 1000000 * 15.0) * 0.6, 6) AS usd_low, round((p_size * 900 / 1000000 * 3.0 + p_size * 1800 / 1000000 * 15.0) * 1.4, 6) AS usd_high FROM part")
def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13: part sizes as page counts."""
    e = table(spark, sf_dir, "part").select("p_partkey", audit.estimate(F.col("p_size"), 3.0, 15.0).alias("e")).select("p_partkey", "e.*")
    return e.select("p_partkey", "est_input_tokens", "est_output_tokens", *[F.round(c, 6).alias(c) for c in ("usd", "usd_low", "usd_high")])




@query("""
    WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
    v AS (SELECT k, CASE k % 9 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN strftime(d, '%Y') WHEN 3 THEN strftime(d, '%Y%m%d') WHEN 4 THEN strftime(d, '%Y-%m-%d') || ' 10:20:30+02:00' WHEN 5 THEN strftime(d, '%Y-%m-%d') || 'T10:20:30Z' WHEN 6 THEN '2024-02-31' WHEN 7 THEN 'spring 1999' ELSE CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-' || CAST(day(d) AS VARCHAR) END AS v, d FROM o)
    SELECT k AS o_orderkey, v AS value,
        CASE k % 9 WHEN 3 THEN strftime(d, '%Y-%m-%d') WHEN 4 THEN replace(v, ' ', 'T') WHEN 8 THEN strftime(d, '%Y-%m-%d') ELSE v END AS published,
        CASE k % 9 WHEN 4 THEN strftime(d, '%Y-%m-%d') WHEN 5 THEN strftime(d, '%Y-%m-%d') WHEN 3 THEN strftime(d, '%Y-%m-%d') WHEN 8 THEN strftime(d, '%Y-%m-%d') ELSE v END AS alias,
        CASE k % 9 WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'year' WHEN 5 THEN 'instant' WHEN 8 THEN CASE WHEN length(v) = 10 THEN 'day' END END AS precision,
        k % 9 = 5 AS is_instant, k % 9 IN (0, 1, 2, 5) OR (k % 9 = 8 AND length(v) = 10) AS evidenced,
        CAST(CASE k % 9 WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d) WHEN 2 THEN date_trunc('year', d) WHEN 5 THEN d WHEN 8 THEN CASE WHEN length(v) = 10 THEN d END END AS DATE) AS first_day FROM v""")
def temporal_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-09, SCL-04, SCL-05: order dates written in nine ways."""
    k, d = F.col("o_orderkey") % 9, F.col("o_orderdate").cast("date")
    f = lambda p: F.date_format(d, p)
    value = F.when(k == 0, f("yyyy-MM-dd")).when(k == 1, f("yyyy-MM")).when(k == 2, f("yyyy")).when(k == 3, f("yyyyMMdd")).when(k == 4, F.concat(f("yyyy-MM-dd"), F.lit(" 10:20:30+02:00"))).when(k == 5, F.concat(f("yyyy-MM-dd"), F.lit("T10:20:30Z"))).when(k == 6, "2024-02-31").when(k == 7, "spring 1999").otherwise(f("yyyy-M-d"))
    v = F.col("value")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))
    return rows.select("o_orderkey", "value", temporal.normalise_published(v).alias("published"), temporal.date_alias(v).alias("alias"), temporal.precision(v).alias("precision"), temporal.is_instant(v).alias("is_instant"), temporal.is_evidenced_date(v).alias("evidenced"), temporal.date_lower(v).alias("first_day"))


@query("""
    WITH f AS (SELECT doc_id, doc_id % 6 AS k FROM documents)
    SELECT doc_id, array_to_string(list_filter([
        CASE WHEN k = 5 THEN 'Body-annotation syntax ({{...}}) in frontmatter value: title - {{...}} is body-only; a described person is [bracketed], a withheld one is [redacted]' END,
        CASE WHEN k = 1 THEN 'Missing required frontmatter field: title' END,
        CASE WHEN k = 2 THEN 'Invalid date_published: expected YYYY, YYYY-MM, YYYY-MM-DD, or an RFC 3339 timestamp with Z or an explicit offset' END,
        CASE WHEN k = 3 THEN 'Invalid date_extracted: expected an RFC 3339 UTC timestamp ending in Z' END,
        CASE WHEN k = 4 THEN 'Wrong schema version: record/9 (expected record/1)' END,
        CASE WHEN doc_id % 10 = 0 THEN 'Invalid document_type: expected one of book, paper, report, article, letter, email, statement, form, transcript, slide, interview, documentary, podcast, lecture, broadcast, recording, footage' END], lambda x: x IS NOT NULL), '|') AS errors,
        CASE WHEN doc_id % 4 = 0 THEN 'No content after frontmatter (empty body)' WHEN doc_id % 4 = 1 THEN 'HTML tags found (should use markdown instead): <b>, <br>' ELSE '' END AS warnings,
        array_to_string(list_filter([CASE WHEN k = 2 THEN 'Invalid date_published: expected YYYY, YYYY-MM, YYYY-MM-DD, or an RFC 3339 timestamp with Z or an explicit offset' END], lambda x: x IS NOT NULL), '|') AS introduced,
        CASE WHEN k = 1 THEN 'title' ELSE '' END AS dropped
    FROM f""")
def validation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-18, SET-03, SET-04, SET-06: documents as frontmatter with six kinds of fault, against a parent that lacks one of them."""
    n = F.col("doc_id")
    k = n % 6
    base = {"schema": F.when(k == 4, "record/9").otherwise("record/1"), "title": F.when(k == 5, "a {{b}} c").when(k != 1, "t"), "source_type": F.lit("pdf"), "date_published": F.when(k == 2, "2024-13").otherwise("2024-12"), "date_extracted": F.when(k == 3, "2024-01-01T00:00:00+01:00").otherwise("2024-01-01T00:00:00Z"), "document_type": F.when(n % 10 == 0, "scroll").otherwise("book")}
    fields = F.map_filter(F.create_map(*[x for c, v in base.items() for x in (F.lit(c), v)]), lambda _, v: v.isNotNull())
    parent = F.map_filter(F.create_map(*[x for c, v in (base | {"title": F.when(k == 5, "a {{b}} c").otherwise("t"), "date_published": F.lit("2024-12")}).items() for x in (F.lit(c), v)]), lambda _, v: v.isNotNull())
    body = F.when(n % 4 == 0, " \n ").when(n % 4 == 1, "a <b>x</b> <br/> <bold>").otherwise(F.col("text"))
    errs = lambda m: validate.field_errors(m, "record/1")
    old_errors = F.concat(errs(parent), F.when(k == 1, F.array(F.lit("Missing required frontmatter field: title"))).otherwise(F.expr("cast(array() as array<string>)")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(errs(fields), "|").alias("errors"), F.array_join(validate.warnings(body), "|").alias("warnings"), F.array_join(validate.introduced(errs(fields), old_errors), "|").alias("introduced"), F.array_join(validate.dropped_fields(parent, fields), ",").alias("dropped"))


@query("""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
    m AS (SELECT *, CASE WHEN no % 7 = 3 THEN true WHEN no % 7 = 5 THEN false END AS state FROM l),
    s AS (SELECT *, coalesce(last_value(state IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY no), false) AS inside FROM m)
    SELECT doc_id, count(*) AS lines, CAST(count_if(inside AND state IS NULL) AS BIGINT) AS inside, round(CASE WHEN sum(n) <= 1 THEN 1.0 ELSE greatest(sum(CASE WHEN NOT inside AND state IS NULL THEN n ELSE 0 END) - 1, 0) / (sum(n) - 1) END, 6) AS share
    FROM (SELECT *, CASE state WHEN true THEN 26 WHEN false THEN 24 ELSE length(line) END + 1 AS n FROM s) GROUP BY doc_id""")
def irrelevant_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-10, AGG-15: every seventh line from the third opens a region that the fifth closes."""
    lines = pages.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    marked = lines.withColumn("text", F.when(F.col("line_no") % 7 == 3, "<!-- irrelevant: start -->").when(F.col("line_no") % 7 == 5, "<!-- irrelevant: end -->").otherwise(F.col("text")))
    found = pages.irrelevant(marked, "doc_id").groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if("inside").alias("inside"))
    return found.join(pages.materialised_share(marked, "doc_id"), "doc_id").select("doc_id", "lines", "inside", F.round("share", 6).alias("share"))


@query("""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
    k AS (SELECT doc_id, no, CASE no % 6 WHEN 2 THEN '<!-- a' WHEN 3 THEN 'inner' WHEN 4 THEN 'b --> tail' ELSE trim(line) END AS line, no % 6 IN (2, 3) OR (no % 6 = 4) AS inside FROM l)
    SELECT doc_id, count(*) AS lines, CAST(sum(length(lower(regexp_replace(line, '[^\\p{L}\\p{N}]+', '', 'g')))) AS BIGINT) AS letters FROM k WHERE NOT inside AND line <> '' GROUP BY doc_id""")
def layout_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-11, WIN-20, FLT-18: content lines and their letters, with a comment block through every sixth line."""
    lines = pages.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    k = F.col("line_no") % 6
    noted = lines.withColumn("text", F.when(k == 2, "<!-- a").when(k == 3, "inner").when(k == 4, "b --> tail").otherwise(F.col("text")))
    whole = noted.groupBy("doc_id").agg(F.max("line_no").alias("_last"))
    noted = noted.join(whole, "doc_id").drop("_last")
    return pages.layout(noted, "doc_id").groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("letters")).alias("letters"))


@query("""
    WITH n AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'undefined ' WHEN doc_id % 3 = 1 THEN 'None - ' ELSE '' END || regexp_replace(text, '\\s+', ' ', 'g') AS title FROM documents),
    c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(title, '(?i)\\b(?:undefined|null|none)\\b[-\\s]*', '', 'g'), '\\s{2,}', ' ', 'g'), ' -–—') AS t FROM n),
    s AS (SELECT doc_id, t, trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM c)
    SELECT doc_id, t AS clean, CASE WHEN length(s) > 60 THEN regexp_replace(substr(s, 1, 60), '-[^-]*$', '') ELSE s END AS slug FROM s""")
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-07, SCL-08: whole texts as titles with placeholders, cleaned and as slugs."""
    k = F.col("doc_id") % 3
    t = F.concat(F.when(k == 0, "undefined ").when(k == 1, "None - ").otherwise(""), F.regexp_replace("text", r"\s+", " "))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_title(t).alias("clean")).withColumn("slug", text.slug(F.col("clean")))


@query("SELECT doc_id, regexp_replace(lower(regexp_replace(text, '\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')), '[^\\p{L}\\p{N}]+', '', 'g') AS letters, 'sha256:' || sha256(text) AS label FROM documents")
def squash_and_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-01, SCL-21: letters of every document, and its labelled hash."""
    return table(spark, sf_dir, "documents").select("doc_id", text.squash(F.col("text")).alias("letters"), text.sha_label(F.col("text")).alias("label"))


@query("""
    WITH s AS (SELECT doc_id, replace(text, ' of ', CASE WHEN doc_id % 2 = 0 THEN ' *** **** ' ELSE ' ***** ' END) AS t FROM documents)
    SELECT doc_id, CAST(len(regexp_extract_all(t, '\\*{5,}(?:\\s+\\*+)*|\\*{3,}(?:\\s+\\*+)+')) AS BIGINT) AS redactions,
           CAST(coalesce(list_sum(list_transform(regexp_extract_all(t, '\\*{5,}(?:\\s+\\*+)*|\\*{3,}(?:\\s+\\*+)+'), lambda h: len(regexp_extract_all(h, '\\*+')))), 0) AS BIGINT) AS words FROM s""")
def redactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-35, SCL-36: asterisk runs in place of a frequent word, as annotations that count words."""
    t = F.replace("text", F.lit(" of "), F.when(F.col("doc_id") % 2 == 0, F.lit(" *** **** ")).otherwise(F.lit(" ***** ")))
    marked = table(spark, sf_dir, "documents").select("doc_id", text.mark_redactions(t).alias("t"))
    counts = F.regexp_extract_all("t", F.lit(r"\{\{redacted: ~(\d+) words\}\}"), F.lit(1))
    return marked.select("doc_id", F.size(counts).cast("long").alias("redactions"), F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")).alias("words"))

"""Queries of operators that need a parser or a fold. SQL stands where it gives their rows on the shared tables; tests hold all of them against fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import books, carry, casing, html, mail, pages
from .registry import query, table


@query(r"""
    WITH p AS (SELECT page_id, trim(replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&quot;', '"'), '&amp;', '&')) AS title, replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '<br>', chr(10)) AS body, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS head FROM pages),
    b AS (SELECT *, list_filter(list_transform(regexp_split_to_array(body, '<h1>.*</h1>|</?p>'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM p),
    t AS (SELECT *, trim(replace(replace(head, '&quot;', '"'), '&amp;', '&')) AS h, replace(replace(array_to_string(blocks, chr(10) || chr(10)), '&quot;', '"'), '&amp;', '&') AS t FROM b)
    SELECT page_id, title, NULL::VARCHAR AS author, NULL::VARCHAR AS date, NULL::VARCHAR AS sitename, CASE WHEN lower(h) = lower(title) THEN t ELSE '# ' || h || chr(10) || chr(10) || t END AS text FROM t""")
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-28, SCL-29: the article of every page."""
    return html.articles(table(spark, sf_dir, "pages"), "page_id")


@query("SELECT page_id, 0 AS ord, regexp_extract(url, '^(https?://[^/]+)', 1) || '/a/photo.jpg' AS url, 'A' AS alt, 'Cap' AS caption, 'Before it.' AS anchor FROM pages")
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-12, SCL-44, AGG-20: images of pages into which two are put, one of them a logo."""
    shown = F.concat(F.lit('<p>Before it.</p><figure><img data-src="/a/photo.jpg" alt="A"><figcaption>Cap</figcaption></figure><img src="/logo.png">'), "html")
    return html.harvest_images(table(spark, sf_dir, "pages").select("page_id", shown.alias("html"), "url"), "page_id")


@query(r"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: regexp_matches(w, '\p{L}')) AS words FROM documents),
    p AS (SELECT doc_id, words, list_transform(words, lambda w: lower(trim(w, '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~“”‘’'))) AS plain FROM d WHERE len(words) >= 100),
    x AS (SELECT doc_id, unnest(words) AS w, unnest(plain) AS a, generate_subscripts(words, 1) AS i FROM p),
    c AS (SELECT doc_id, i, a AS answer, lag(w, 4) OVER s || ' ' || lag(w, 3) OVER s || ' ' || lag(w, 2) OVER s || ' ' || lag(w, 1) OVER s AS before, lead(w, 1) OVER s || ' ' || lead(w, 2) OVER s || ' ' || lead(w, 3) OVER s || ' ' || lead(w, 4) OVER s AS after,
                 bool_and(length(a) >= 4 AND regexp_full_match(a, '\p{L}+')) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS usable FROM x WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
    u AS (SELECT doc_id, lower(before) AS b, lower(after) AS a FROM c WHERE before || after IS NOT NULL GROUP BY ALL HAVING count(DISTINCT answer) = 1),
    o AS MATERIALIZED (SELECT c.doc_id, c.i, row_number() OVER (PARTITION BY c.doc_id ORDER BY md5('seed/' || CAST(c.doc_id AS VARCHAR) || '/' || CAST(i - 1 AS VARCHAR))) AS k FROM c JOIN u ON u.doc_id = c.doc_id AND u.b = lower(before) AND u.a = lower(after) WHERE usable),
    r AS (SELECT doc_id, 0::BIGINT AS k, []::BIGINT[] AS taken, 0 AS id, NULL::BIGINT AS picked FROM p
          UNION ALL
          SELECT doc_id, k, CASE WHEN free THEN taken || [i] ELSE taken END, id + free::INT, CASE WHEN free THEN i END FROM (
              SELECT r.doc_id, o.k, o.i, taken, id, len(list_filter(taken, lambda t: abs(t - o.i) <= 9)) = 0 AS free FROM r JOIN o ON o.doc_id = r.doc_id AND o.k = r.k + 1 WHERE id < 30))
    SELECT doc_id, r.id, before, answer, after FROM r JOIN c USING (doc_id) WHERE c.i = picked""")
def cloze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-07, FLT-13: words to guess in every document."""
    return carry.cloze(table(spark, sf_dir, "documents"), "doc_id", "text", "seed")


_CARRY = """
    WITH d AS (SELECT doc_id, doc_id % 4 AS k, CAST(doc_id AS VARCHAR) AS i FROM documents),
    m AS (SELECT *, 'Intro line for document ' || i AS intro, 'advert number ' || i || ' that goes on' AS ad, 'quoted words of ' || i AS quoted FROM d)"""


@query(_CARRY + """
    SELECT doc_id, k <> 1 AS region_found, CASE WHEN k = 2 THEN 0 ELSE 2 END AS markers, CASE WHEN k = 2 THEN 1 ELSE 0 END AS pairs_lost,
           intro || chr(10) || chr(10) || CASE WHEN k = 1 THEN '' ELSE '<!-- irrelevant: start -->' || chr(10) || chr(10) || ad || chr(10) || chr(10) || '<!-- irrelevant: end -->' || chr(10) || chr(10) END
           || 'Then come ' || CASE WHEN k = 2 THEN 'none of them' ELSE '{{highlight-start: h}}' || quoted || '{{highlight-end: h}}' END || ' and so on' AS body FROM m""")
def review_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-16, WIN-17: a region and a marked span of every document's record carried to a fresh body, which lacks the region's text, or the span's, in a quarter each."""
    i, k = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    said = lambda *x: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in x])
    intro, ad, quoted = said("Intro line for document ", i), said("advert number ", i, " that goes on"), said("quoted words of ", i)
    old = said(intro, "\n<!-- irrelevant: start -->\n", ad, "\n<!-- irrelevant: end -->\nThen come {{highlight-start: h}}", quoted, "{{highlight-end: h}} and so on")
    new = said(intro, "\n\n", F.when(k == 1, "").otherwise(said(ad, "\n\n")), "Then come ", F.when(k == 2, "none of them").otherwise(quoted), " and so on")
    done = carry.carry(table(spark, sf_dir, "documents").select("doc_id", old.alias("old"), new.alias("new")), "doc_id")
    return done.select("doc_id", (F.col("regions") == 1).alias("region_found"), F.col("markers").cast("int").alias("markers"), F.col("pairs_lost").cast("int").alias("pairs_lost"), "body")


@query()
def review_carry_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-16, WIN-17, JOI-09: a region and a marked span of every whole document carried to the same text with its lines set apart."""
    lines = F.split("text", "\n", -1)
    marked = F.array_join(F.transform(lines, lambda x, i: F.when(i == 1, F.concat(F.lit("<!-- irrelevant: start -->\n"), x, F.lit("\n<!-- irrelevant: end -->"))).otherwise(x)), "\n")
    old = F.concat(F.lit("{{highlight-start: h1}}"), F.substring(marked, F.lit(1), F.lit(30)), F.lit("{{highlight-end: h1}}"), F.substring(marked, F.lit(31), F.length(marked)))
    new = F.regexp_replace("text", "\n", "\n\n")
    pairs = table(spark, sf_dir, "documents").select("doc_id", old.alias("old"), new.alias("new"))
    return carry.carry(pairs, "doc_id").select("doc_id", "regions", "regions_lost", "markers", "pairs_lost")


@query(r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS t FROM documents)
    SELECT doc_id, array_to_string(list_transform(range(1, len(t) + 1), lambda i: CASE WHEN lower(t[i]) = 'and' THEN 'AND' WHEN lower(t[i]) = 'the' AND t[i + 1] = ' ' AND lower(t[i + 2]) = 'of' THEN 'The'
                                            WHEN i > 2 AND lower(t[i]) = 'of' AND t[i - 1] = ' ' AND lower(t[greatest(i - 2, 1)]) = 'the' THEN 'OF' ELSE t[i] END), '') AS cased FROM t""")
def casing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-30, SRT-03, UDF-02: two terms in their own case, the longer first, in every document."""
    return table(spark, sf_dir, "documents").select("doc_id", casing.build_caser(["AND", "The OF"])(F.col("text")).alias("cased"))


@query("SELECT doc_id, 'SECRET//NOFORN' AS banner, ' A.' || chr(10) || '{{classification: U}} B {{classification: TOP SECRET}} c.' || chr(10) || chr(10) || text AS body FROM documents")
def classification_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-19: whole documents under a banner and portion marks."""
    body = F.concat(F.lit("(SECRET//NOFORN) A.\n(U) B (TOP SECRET) c.\n~~(SECRET//NOFORN)~~\n"), "text")
    r = casing.reconcile_classification(F.when(F.col("doc_id") % 2 == 0, "SECRET//NOFORN"), body)
    return table(spark, sf_dir, "documents").select("doc_id", r.alias("r")).select("doc_id", "r.*")


@query("""
    SELECT conv_id, '<!-- message: {n: 1, from: "top@x.org", quoted: false} -->' || chr(10) || chr(10) || 'Hello.' || chr(10) || chr(10) || string_agg('<!-- message: {n: ' || CAST(k + 1 AS VARCHAR) || ', from: "' || role || ' <' || role || '@x.org>", date: "2024-01-01T10:00:00+00:00", quoted: true} -->' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY k) || chr(10) AS body
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations) GROUP BY conv_id""")
def mail_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-14, SCL-27: conversations as quoted threads, cut and rendered again."""
    lines = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    said = F.transform("t", lambda r: F.concat(F.lit('On Mon, 1 Jan 2024 10:00:00 +0000, "'), r["role"], F.lit('" <'), r["role"], F.lit("@x.org> wrote:\n> "), r["text"]))
    author = F.struct(F.lit("top@x.org").alias("address"), F.lit(None).cast("string").alias("name"))
    bodies = lines.select("conv_id", F.concat(F.lit("Hello.\n"), F.array_join(said, "\n")).alias("body"), author.alias("author"))
    return mail.render_thread(mail.segment_thread(bodies, "conv_id"), "conv_id")


@query("""
    SELECT page_id, 'email:' || chr(10) || '  from: "A B <a@x.org>"' || chr(10) || '  to:' || chr(10) || '    - "c@x.org"' || chr(10) || '    - "A@X.org"' || chr(10) || '  subject: "' || url || '"' || chr(10) || '  message_id: "<' || CAST(page_id AS VARCHAR) || '@x>"' AS block, 2 AS n_to, '2024-01-01T10:00:00+01:00' AS date FROM pages""")
def mail_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-24, SCL-25, SCL-27, AGG-18: a message inside a page, its headers, people and frontmatter block."""
    raw = F.concat(F.lit("<p>x</p><pre>From: A B &lt;a@x.org&gt;\nTo: c@x.org, A@X.org\nDate: Mon, 1 Jan 2024 10:00:00 +0100\nSubject: "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("\nMessage-ID: &lt;"), F.col("page_id").cast("string"), F.lit("@x&gt;\n\nbody</pre>"))
    rows = table(spark, sf_dir, "pages").select("page_id", mail.parse_headers(mail.embedded_message(raw)).alias("h"))
    return rows.select("page_id", mail.render_headers(F.col("h")).alias("block"), F.size("h.to").alias("n_to"), F.col("h.date").alias("date"))


@query("""
    WITH RECURSIVE l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) % 4 + 1 AS page FROM lineitem GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n) AS ord FROM l),
    r AS (SELECT k, 0::BIGINT AS ord, [0::BIGINT] AS awaited, 1::BIGINT AS here, []::BIGINT[] AS used, NULL::BIGINT AS switch FROM o WHERE ord = 1
          UNION ALL
          SELECT k, ord, CASE WHEN now > len(awaited) THEN awaited || [page + 1] ELSE list_slice(awaited, 1, now - 1) || [page + 1] || list_slice(awaited, now + 1, len(awaited)) END, now, used || [page], switch FROM (
              SELECT *, coalesce(switch, here) AS now FROM (
                  SELECT r.k, o.ord, o.page, awaited, here, used, coalesce(list_filter(range(1, len(awaited) + 1), lambda i: awaited[i] = o.page AND i <> here)[1], CASE WHEN o.page + 1 < awaited[here] AND list_contains(used, o.page) THEN len(awaited) + 1 END) AS switch
                  FROM r JOIN o ON o.k = r.k AND o.ord = r.ord + 1)))
    SELECT o.k, CAST(o.n AS INT) AS ordinal, coalesce('<!-- printed_page_sequence: ' || CAST(switch AS VARCHAR) || ' -->' || chr(10), '') || '<!-- printed_page: ' || CAST(page AS VARCHAR) || ' -->' AS markdown FROM r JOIN o USING (k, ord)""")
def page_label_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-09: page labels of books made of orders, a chapter a line; labels that start again open sequences and return to them."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("int").alias("ordinal")).agg((F.min("l_partkey") % 4 + 1).alias("page"))
    return books.disambiguate_pages(lines.select("k", "ordinal", F.concat(F.lit("<!-- printed_page: "), F.col("page").cast("string"), F.lit(" -->")).alias("markdown")), "k")


@query("""
    SELECT p_partkey, '## Part ' || p_name || chr(10) || chr(10) || 'one <!-- printed_page: 12 --> two' || CASE WHEN p_size % 2 = 0 THEN '[^1]' ELSE '[1](http://x.org/#n)' END || ' end' || chr(10) || chr(10) || 'x ' || CASE WHEN p_size % 2 = 0 THEN '[^2]' ELSE '[^1]' END || chr(10) || chr(10) || '- item' || chr(10) || chr(10) || '> said' || chr(10) || chr(10) || '<!-- printed_page: 33 -->' AS markdown,
           'Part ' || p_name AS heading, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS n_refs, 'page33' AS anchor FROM part""")
def xhtml_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-16, SCL-34: XHTML of books as markdown, with links that are note references and links that are none, and page breaks."""
    link = F.when(F.col("p_size") % 2 == 0, F.lit('<a epub:type="noteref" href="#n1">1</a>')).otherwise(F.lit('<a href="http://x.org/#n">1</a>'))
    xhtml = F.concat(F.lit("<body><nav>gone</nav><h2>Part "), "p_name", F.lit('</h2><p>one<span epub:type="pagebreak" title="12"/>two'), link, F.lit(' end</p><p>x <a href="n.xhtml#a"><sup>2</sup></a></p><ul><li>item</li></ul><blockquote><p>said</p></blockquote><div role="doc-pagebreak" id="page33"/></body>'))
    docs = table(spark, sf_dir, "part").select("p_partkey", F.lit(1).alias("ordinal"), F.lit("c.xhtml").alias("file_name"), xhtml.alias("xhtml"))
    return books.chapters(docs, "p_partkey").select("p_partkey", "markdown", "heading", F.size("refs").alias("n_refs"), F.get("anchors", F.lit(0))["id"].alias("anchor"))


@query()
def book_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-32 to SCL-36, WIN-08, WIN-09: conversations as books whose turns are chapters with page labels that start again."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    n = F.col("turn").cast("int")
    xhtml = F.concat(F.lit("<body><h1>Chapter "), F.element_at(F.array(*[F.lit(x) for x in ("One", "II", "3", "four", "V", "2")]), (n % 6 + 1)), F.lit(": Title</h1><span epub:type='pagebreak' title='"), (n % 4 + 1).cast("string"), F.lit("'/><p>"), "text", F.lit(" ***** <a href='#n'><sup>1</sup></a></p></body>"))
    docs = c.select("conv_id", n.alias("ordinal"), F.lit("c.xhtml").alias("file_name"), xhtml.alias("xhtml"))
    made = books.chapters(docs, "conv_id").withColumn("toc_title", F.lit(None).cast("string"))
    numbered = books.numbered(made, "conv_id").select("conv_id", "ordinal", "number", "section_title")
    return numbered.join(books.disambiguate_pages(made, "conv_id"), ["conv_id", "ordinal"])


@query("""
    WITH w AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'XIV' WHEN 1 THEN 'twenty-one' WHEN 2 THEN '7.' WHEN 3 THEN 'IIX' ELSE 'Ninety' END AS token FROM part)
    SELECT p_partkey, token, CASE p_partkey % 5 WHEN 0 THEN 14 WHEN 1 THEN 21 WHEN 2 THEN 7 WHEN 3 THEN NULL ELSE 90 END AS number,
           CASE p_partkey % 5 WHEN 3 THEN NULL WHEN 0 THEN '14' WHEN 1 THEN '21' WHEN 2 THEN '7' ELSE '90' END AS chapter, CASE WHEN p_partkey % 5 = 3 THEN 'Chapter IIX: A Title' ELSE 'A Title' END AS title FROM w""")
def designations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-32, SCL-33: enumerators of five kinds and the headings made of them."""
    k = F.col("p_partkey") % 5
    token = F.when(k == 0, "XIV").when(k == 1, "twenty-one").when(k == 2, "7.").when(k == 3, "IIX").otherwise("Ninety")
    rows = table(spark, sf_dir, "part").select("p_partkey", token.alias("token"))
    d = text.designation(F.concat(F.lit("Chapter "), F.col("token"), F.lit(": A Title")))
    return rows.select("p_partkey", "token", text.enumerator(F.col("token")).alias("number"), d["number"].alias("chapter"), d["title"].alias("title"))


@query("""
    WITH s AS (SELECT doc_id, 'Dr. Smith of the U.S. Army met J. Doe. ' || CASE WHEN doc_id % 2 = 0 THEN 'Was it late? Yes!' ELSE 'No etc. more' END AS t FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Dr. Smith of the U.S. Army met J. Doe.|Was it late?|Yes!' ELSE 'Dr. Smith of the U.S. Army met J. Doe.|No etc. more' END AS sentences FROM s""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-38: sentences around titles, initials and acronyms."""
    t = F.concat(F.lit("Dr. Smith of the U.S. Army met J. Doe. "), F.when(F.col("doc_id") % 2 == 0, "Was it late? Yes!").otherwise("No etc. more"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.sentences(t), "|").alias("sentences"))


@query("""
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Ann Lee,Bob Ray' WHEN 1 THEN 'Cy Day,Jo Roe' WHEN 2 THEN 'Eve Fox' ELSE '' END AS speakers FROM documents""")
def known_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-42, FLT-14: names in titles, descriptions and publishers of four kinds."""
    k = F.col("doc_id") % 4
    title = F.when(k == 0, "Talk (ft. Ann Lee & Bob Ray)").when(k == 1, "Cy Day: on things").when(k == 2, "The News | Of It").otherwise("plain")
    desc = F.when(k == 1, "Jo Roe is a pilot.\nx").when(k == 0, "the end")
    who = F.when(k == 2, "Eve Fox").when(k == 3, "Fox News Channel").otherwise("ACME TV")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.known_speakers(title, desc, who), ",").alias("speakers"))


@query("""
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'the video is private' WHEN 1 THEN 'the video is geo-blocked' WHEN 2 THEN 'last one' ELSE 'yt-dlp failed with no error output' END AS reason FROM pages""")
def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-46: downloader logs of four kinds."""
    k = F.col("page_id") % 4
    log = F.when(k == 0, "x\nERROR: Private video. Sign in").when(k == 1, "ERROR: not available in your country").when(k == 2, "ERROR: first\nERROR:  last one\nbye").otherwise("nothing")
    return table(spark, sf_dir, "pages").select("page_id", text.failure_reason(log).alias("reason"))


@query("""
    WITH c AS (SELECT l_orderkey AS k, (l_linenumber - 1) * 2 AS off FROM lineitem GROUP BY ALL)
    SELECT k, sha256('---' || chr(10) || 'title: x' || chr(10) || '---' || chr(10) || chr(10) || array_to_string(list('file_page: ' || CAST(off + 1 AS VARCHAR) || chr(10) || 'file_page: ' || CAST(off + 2 AS VARCHAR) ORDER BY off), chr(10) || chr(10))) AS digest FROM c GROUP BY k""")
def chunk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-19, WIN-05: lines of an order as chunks of two pages, put together with their offsets."""
    chunks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), ((F.col("l_linenumber") - 1) * 2).alias("page_offset")).distinct()
    body = F.lit("---\ntitle: x\n---\n\nfile_page: 1\nfile_page: 2\n")
    return pages.merge_chunks(chunks.withColumn("body", body), "k").select("k", F.sha2(F.col("body").cast("binary"), 256).alias("digest"))

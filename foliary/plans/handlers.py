"""LIF-09: the per-format pipelines as composed DataFrame jobs, from what was acquired to record text.

Each takes tables and gives (record_hash, source_type, title, text, errors); a row with errors is for the reader, not for
the store. What fetches, transcribes or transcribes pages lies behind the seams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rights, temporal, text, urls
from ..operators import assemble as A
from ..operators import audit, books, html, intervals, lifecycle, pages, turns, validate
from ..sources import media

VERSION = "1"


def _finish(rows: DataFrame, hash_: Column, lines: list[Column], body: Column, required: tuple[str, ...], schema: str = "record/1") -> DataFrame:
    """Put the record together and validate its fields and body."""
    fields = F.map_filter(
        F.create_map(F.lit("schema"), F.lit(schema), F.lit("title"), F.col("title"), F.lit("source_type"), F.col("source_type"), *[x for k in required for x in (F.lit(k), F.col(k).cast("string"))], F.lit("date_published"), F.nullif(F.col("published"), F.lit("")), F.lit("document_type"), F.col("document_type")),
        lambda _, v: v.isNotNull(),
    )
    head = [A.plain("schema", F.lit(schema)), A.quoted("title", F.col("title")), A.dated("date_published", F.col("published")), A.plain("source_type", F.col("source_type")), A.plain("file_format", F.col("file_format")), A.plain("document_type", F.col("document_type"))]
    status = F.col("rights")
    tail = [
        A.plain("content_hash", F.concat(F.lit("sha256:"), hash_)),
        A.block("copyright", A.plain("status", status["status"], 2), A.quoted("detail", status["detail"], 2)),
        A.block("processing", A.plain("version", F.lit(VERSION), 2), A.plain("pipeline_version", lifecycle.current_generation(F.col("source_type")), 2)),
    ]
    made = rows.select(hash_.alias("record_hash"), "source_type", "title", A.record_text([*head, *lines, *tail], body).alias("text"), F.concat(validate.field_errors(fields, schema, required), validate.body_errors(body)).alias("errors"))
    return made


def _described(manifests: DataFrame, source_type: Column, fallback: str) -> DataFrame:
    """Manifest columns that all records share."""
    web = F.when(urls.is_web(F.col("source")), F.col("source"))
    rows = manifests.withColumn("source_url", F.coalesce("source_url", web)).withColumn("source_type", source_type)
    rows = rows.withColumn("source_id", F.coalesce("source_id", urls.url_source_id(F.col("source_url"))))
    return rows.withColumn("published", temporal.normalise_published(F.col("date_published"))).withColumn("rights", rights.resolve_status(F.col("copyright_status"), F.col("source"), F.col("source_url"), F.col("source_id"), fallback))


def web_records(manifests: DataFrame, pages_: DataFrame, mastheads: dict[str, str] | None = None) -> DataFrame:
    """Web pages: the article's text is the identity. pages_: asset_hash, html; mastheads: publishers' names by host."""
    docs = pages_.join(manifests.select("asset_hash", F.coalesce("source_url", "source").alias("url")), "asset_hash")
    found = html.articles(docs, "asset_hash").filter("text is not null").select("asset_hash", F.col("title").alias("page_title"), "author", "date", "sitename", F.col("text").alias("body"))
    rows = _described(manifests, F.lit("web"), "publicly_accessible").join(found, "asset_hash")
    name = F.coalesce("publisher", "sitename")
    rows = rows.withColumn("publisher", F.nullif(urls.canonical_publisher(name, F.col("source_url"), mastheads), F.lit("")))
    title = text.clean_title(urls.strip_site_suffix(F.coalesce("title", "page_title"), F.col("sitename"), F.col("source_url"), mastheads))
    rows = rows.withColumn("title", text.resolve_title(title, F.col("source_url"), F.col("source_id"), F.col("source_type"))).withColumn("published", F.coalesce(F.nullif(F.col("published"), F.lit("")), temporal.normalise_published(F.col("date")))).withColumn("file_format", F.lit("html")).withColumn("document_type", F.lit(None).cast("string"))
    body = text.tidy(F.col("body"))
    lines = [A.quoted("publisher", F.col("publisher")), A.listed("creators", F.filter(F.coalesce(F.col("creators"), F.array("author")), lambda c: c.isNotNull())), A.plain("source_url", F.col("source_url")), A.plain("source_id", F.col("source_id")), A.plain("source_hash", F.concat(F.lit("sha256:"), "asset_hash")), A.dated("date_accessed", F.col("fetched_at"))]
    return _finish(rows, F.sha2(body.cast("binary"), 256), lines, body, ("source_url",))


def speaker_turns(transcripts: DataFrame, exclusive: bool = False) -> DataFrame:
    """Transcript archives as turns: words to speakers, short runs folded, segments cut, sentences timed, turns built."""
    seg, tracks = media.segments(transcripts), media.tracks(transcripts, exclusive).withColumn("ord", F.col("ord").cast("long"))
    words = seg.select("stem", F.col("ord").alias("seg"), F.posexplode("words").alias("no", "w")).select("stem", "seg", "no", "w.text", "w.start", "w.end")
    points = words.select("stem", F.struct("seg", "no").alias("p"), ((F.col("start") + F.col("end")) / 2).alias("t")).select("stem", (F.col("p.seg").cast("long") * 1_000_000 + F.col("p.no")).alias("point"), "t")
    said = intervals.point_in_interval(points, tracks, "stem").select("stem", F.floor(F.col("point") / 1_000_000).cast("int").alias("seg"), (F.col("point") % 1_000_000).cast("int").alias("no"), "speaker")
    labelled = words.join(said, ["stem", "seg", "no"])
    runs = turns.fold_short_runs(labelled, ["stem", "seg"], ["no"], "speaker", F.col("start"), F.col("end"))
    one = F.max("run").over(turns.W.partitionBy("stem", "seg")) == 1
    parts = runs.withColumn("_one", one).groupBy("stem", "seg", "run", "_one").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("folded", "no").alias("speaker"), F.array_sort(F.collect_list(F.struct("no", "text", "start"))).alias("w"))
    whole = seg.select("stem", F.col("ord").alias("seg"), F.col("text").alias("_text"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    parts = parts.join(whole, ["stem", "seg"], "right")
    cut = F.coalesce(~F.col("_one"), F.lit(False))
    spoken = F.when(cut, F.array_join(F.transform("w", lambda x: x["text"]), " ")).otherwise(F.col("_text"))
    spans = parts.select("stem", (F.col("seg").cast("long") * 10_000 + F.coalesce("run", F.lit(0))).alias("span"), F.when(cut, F.col("start")).otherwise(F.col("_start")).alias("start"), F.when(cut, F.col("end")).otherwise(F.col("_end")).alias("end"), spoken.alias("text"), F.coalesce(F.transform("w", lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"))), F.expr("cast(array() as array<struct<text:string,start:double>>)")).alias("w")).filter(F.trim("text") != "")
    best = intervals.overlap_majority(spans, tracks, "stem").select("stem", "span", F.col("speaker").alias("by_overlap"))
    middle = spans.select("stem", F.col("span").alias("point"), ((F.col("start") + F.col("end")) / 2).alias("t"))
    near = intervals.point_in_interval(middle, tracks, "stem").select("stem", F.col("point").alias("span"), F.col("speaker").alias("nearest"))
    who = spans.join(best, ["stem", "span"], "left").join(near, ["stem", "span"], "left").withColumn("speaker", F.coalesce("by_overlap", "nearest"))
    split = who.withColumn("s", text.sentences(F.col("text"))).withColumn("at", turns.sentence_starts(F.col("s"), F.col("w"), F.col("start")))
    said = split.select("stem", "span", "speaker", F.posexplode(F.arrays_zip("s", "at")).alias("k", "x")).select("stem", "span", "k", "speaker", F.col("x.s").alias("text"), F.col("x.at").alias("time"))
    runs = turns.islands(said, ["stem"], ["span", "k"], "speaker", "turn")
    return runs.groupBy("stem", "turn", "speaker").agg(F.min_by("time", F.struct("span", "k")).alias("start"), F.array_sort(F.collect_list(F.struct("span", "k", "time", "text"))).alias("lines"))


def audio_records(manifests: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Recordings: the asset's hash is the identity, the body is the speakers' turns under `[speaker k]`."""
    made = speaker_turns(transcripts)
    names = turns.roster(made, ["stem"]).select("stem", "speaker", "label")
    named = made.join(names, ["stem", "speaker"]).withColumn("speaker", F.col("label"))
    bodies = turns.render(named, ["stem"], F.transform("lines", lambda x: F.concat(text.timecode(x["time"], True), F.lit(" "), x["text"])))
    ends = media.segments(transcripts).groupBy("stem").agg(F.max("end").alias("last"))
    kind = F.coalesce("original_type", rights.source_type_of(F.col("detected_type")))
    rows = _described(manifests, kind, "publicly_accessible").join(bodies, F.col("asset_hash") == F.col("stem")).join(ends, "stem")
    rows = rows.withColumn("duration", F.round(F.coalesce("duration", "last"), 2)).withColumn("title", text.resolve_title(F.col("title"), F.col("source_url"), F.col("source_id"), F.col("source_type"))).withColumn("file_format", F.lit("opus"))
    rows = rows.withColumn("document_type", rights.document_type(F.col("source_type"), F.col("title"))).withColumn("people", text.known_speakers(F.col("title"), F.col("description"), F.coalesce("posted_by", "publisher")))
    lines = [A.quoted("publisher", F.col("publisher")), A.quoted("posted_by", F.col("posted_by")), A.dated("posted_date", temporal.normalise_published(F.col("posted_date"))), A.listed("creators", F.col("creators")), A.listed("speakers", F.col("people")), A.plain("source_url", F.col("source_url")), A.plain("source_id", F.col("source_id")), A.plain("duration", F.col("duration")), A.dated("date_accessed", F.col("fetched_at"))]
    return _finish(rows, F.col("asset_hash"), lines, F.col("body"), ("duration",))


def pdf_records(manifests: DataFrame, chunks: DataFrame) -> DataFrame:
    """SRC-20: documents of pages: chunks (asset_hash, page_count, page_offset, body) that a page reader gave, put in order and checked."""
    bodies = pages.merge_chunks(chunks.withColumn("body", text.clean_math(text.clean_annotations(F.col("body")))), "asset_hash")
    counts = chunks.groupBy("asset_hash").agg(F.max("page_count").alias("pages"))
    rows = _described(manifests, F.when(F.col("detected_type").startswith("image/"), "image").otherwise("pdf"), "restricted").join(bodies, "asset_hash").join(counts, "asset_hash")
    rows = rows.withColumn("body", pages.renumber(F.col("body"), F.col("pages"))).withColumn("title", text.clean_title(text.resolve_title(F.col("title"), F.col("source_url"), F.col("source_id"), F.col("source_type"))))
    rows = rows.withColumn("file_format", F.coalesce(rights.normalise_format(F.regexp_extract("asset", r"(\.[^.]+)$", 1)), F.lit("pdf"))).withColumn("document_type", rights.document_type(F.col("source_type"), F.col("title")))
    lines = [A.plain("pages", F.col("pages")), A.listed("creators", F.col("creators")), A.plain("source_url", F.col("source_url")), A.plain("source_id", F.col("source_id")), A.dated("date_accessed", F.col("fetched_at"))]
    out = _finish(rows, F.col("asset_hash"), lines, text.tidy(F.col("body")), ())
    why = pages.impossible(pages.markers(F.col("text")), A.body_fields(F.col("text"))["pages"])
    return out.withColumn("errors", F.array_compact(F.concat("errors", F.array(why))))


def book_records(books_: DataFrame, overrides: DataFrame) -> DataFrame:
    """Books (as read_books gives them): the chapters' text is the identity. overrides: identifier, title, publisher, date."""
    ids = books_.select("path", F.explode("identifiers").alias("i")).select("path", "i.*")
    best = audit.pick_identifier(ids, "path")
    toc = audit.toc_titles(books_.select("path", F.explode("toc").alias("t")).select("path", "t.*"), "path").select(F.col("path").alias("_b"), F.col("file_name").alias("_f"), "toc_title")
    docs = books_.select("path", F.explode("chapters").alias("c")).select("path", "c.*")
    made = books.chapters(docs, "path").filter(F.trim("markdown") != "")
    made = made.join(toc, (F.col("path") == F.col("_b")) & (F.regexp_extract("file_name", r"([^/]+)$", 1) == F.col("_f")), "left").drop("_b", "_f")
    heads = books.numbered(made, "path").select("path", "ordinal", "number", "section_title")
    parts = books.disambiguate_pages(made, "path").join(heads, ["path", "ordinal"])
    mark = F.concat_ws("\n", F.concat(F.lit("<!-- chapter: "), F.col("number").cast("string"), F.lit(" -->")), F.concat(F.lit("<!-- chapter_title: "), F.col("section_title"), F.lit(" -->")))
    bodies = parts.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.concat_ws("\n\n", F.nullif(mark, F.lit("")), "markdown").alias("b")))).alias("x")).select("path", text.tidy(F.array_join(F.transform("x", lambda r: r["b"]), "\n\n")).alias("body"))
    known = overrides.select("identifier", F.col("title").alias("_t"), F.col("publisher").alias("_p"), F.col("date").alias("_d"))
    rows = books_.join(bodies, "path").join(best, "path", "left").join(known, "identifier", "left")
    rows = rows.withColumn("title", F.coalesce("_t", "title")).withColumn("publisher", F.coalesce("_p", "publisher")).withColumn("published", temporal.normalise_published(F.coalesce("_d", "date"))).withColumn("source_type", F.lit("ebook")).withColumn("file_format", F.lit("epub")).withColumn("document_type", F.lit("book"))
    rows = rows.withColumn("rights", rights.resolve_status(F.lit(None).cast("string"), F.col("path"), F.lit(None).cast("string"), F.col("identifier")))
    blurb = text.gated_blurb(text.strip_html(F.col("description")), rights.is_gated(F.col("rights")["status"]))
    lines = [A.quoted("publisher", F.col("publisher")), A.listed("creators", F.col("authors")), A.plain("source_id", F.col("identifier")), A.quoted("description", blurb)]
    return _finish(rows, F.sha2(F.col("body").cast("binary"), 256), lines, F.col("body"), ())


def worst(report: DataFrame, n: Column | str, key: str, limit: int = 40) -> DataFrame:
    """SRT-08: the first rows of a report by size, then key: a limit that is the report's feature."""
    return report.orderBy(F.desc(n), key).limit(limit)


def refresh(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """LIF-01, SET-03: the outcome of a refresh for each stored record that a fresh body came for.

    stored: record_hash, path, content_hash, source_type, declared (generation), reviewed, carried (words of the
    frontmatter), body. fresh: record_hash, body, introduced (errors that the fresh record adds). Gives record_hash,
    written, reason, body (to store, null unless written) and the counts behind it.
    """
    from ..operators import bags, carry

    kept_body = F.when(F.col("reviewed") & F.col("source_type").isin("audio", "video"), F.col("old")).otherwise(F.col("_fresh"))
    rows = stored.withColumnRenamed("body", "old").join(fresh.select("record_hash", text.tidy(F.col("body")).alias("_fresh"), "introduced"), "record_hash").withColumn("new", kept_body)
    done = carry.carry(rows, "record_hash")
    pairs = rows.select("record_hash", "old", "carried").join(done.select("record_hash", text.tidy(F.col("body")).alias("new")), "record_hash")
    kept = lambda c: pages.lines_of(pairs.select("record_hash", c), "record_hash", c)
    outside = pages.irrelevant(kept("old"), "record_hash").filter(~F.col("inside") & ~F.col("mark"))
    visible = outside.groupBy("record_hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("old"))
    gone = bags.words_gone(visible.join(pairs.select("record_hash", "new", "carried"), "record_hash"), "record_hash", "old", "new", "carried")
    said = F.array_join(F.slice(F.array_sort(F.collect_list("word")), 1, 40), " ")
    lost = gone.groupBy("record_hash").agg(F.sum("n").alias("lost"), said.alias("sample"))
    total = bags.word_bag(visible, "record_hash", "old").groupBy("record_hash").agg(F.sum("n").alias("total"))
    was = pages.materialised_share(kept("old"), "record_hash").withColumnRenamed("share", "was")
    now = pages.materialised_share(kept("new"), "record_hash").withColumnRenamed("share", "now")
    out = rows.select("record_hash", "path", "content_hash", "source_type", "declared", "reviewed", "old", "introduced").join(done.drop("body"), "record_hash").join(pairs.select("record_hash", "new"), "record_hash")
    for part in (lost, total, was, now):
        out = out.join(part, "record_hash", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    outcome = lifecycle.refresh_outcome(
        F.col("new") == F.col("old"), ~lifecycle.is_stale(F.col("source_type"), F.col("declared")), F.coalesce("was", F.lit(1.0)), F.coalesce("now", F.lit(1.0)), zero(F.col("lost")), bags.loss_allowed(zero(F.col("total")), F.col("reviewed")),
        F.col("pairs_lost"), F.col("reviewed"), F.col("introduced"), lifecycle.identity_holds(F.col("content_hash"), F.col("path")), F.col("sample"),
    )
    return out.withColumn("o", outcome).select("record_hash", "o.written", "o.reason", F.when(F.col("o.written"), F.col("new")).alias("body"), zero(F.col("lost")).alias("lost"), "regions", "regions_lost", "markers", "pairs_lost")

"""Queues, audits, censuses and cost reports over a whole store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import cases, nonempty


def missing_provenance(records: DataFrame) -> DataFrame:
    """FLT-02: restricted records without URL and id: (hash16, source_type, title)."""
    rows = records.filter((F.col("status") == "restricted") & nonempty(F.col("source_url")).isNull() & nonempty(F.col("source_id")).isNull())
    return rows.select(F.substring("record_hash", 1, 16).alias("hash16"), F.coalesce("source_type", F.lit("?")).alias("source_type"), F.coalesce("title", F.lit("(no title)")).alias("title"))


def original_of(source_type: Column, content_hash: Column, source_hash: Column, single_file: Column) -> Column:
    """JOI-10: the hash under which a record's original is archived."""
    return cases([(source_type == "ebook", F.coalesce(source_hash, content_hash)), (source_type == "web", F.coalesce(single_file, source_hash))], content_hash)


def absent_originals(records: DataFrame, archive: DataFrame) -> DataFrame:
    """JOI-10: records (with `original`) of which the archive lists no file whose stem is that hash."""
    return records.join(archive.select(F.col("stem").alias("_s")).distinct(), F.col("original") == F.col("_s"), "left_anti")


def type_census(records: DataFrame) -> DataFrame:
    """AGG-08, SRT-09: records by file format and document type, the most frequent first."""
    n = records.groupBy(F.coalesce("file_format", F.lit("(none)")).alias("file_format"), F.coalesce("document_type", F.lit("(none)")).alias("document_type")).agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "file_format", "document_type")


def media_summary(media: DataFrame, key: str) -> DataFrame:
    """AGG-11: (key, count, total_bytes)."""
    return media.groupBy(key).agg(F.count("*").alias("count"), F.sum("size_bytes").alias("total_bytes"))


def usage_cost(calls: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    """AGG-12: tokens of all kinds and their price, each model priced by the longest prefix that it begins with.

    calls: key, call, model, input_tokens, output_tokens, cache_tokens. prices: prefix, usd_in, usd_out, usd_cache a million
    tokens. A model without a price costs null.
    """
    best = calls.select("model").distinct().join(prices, F.col("model").startswith(F.col("prefix"))).groupBy("model").agg(F.max_by(F.struct("usd_in", "usd_out", "usd_cache"), F.struct(F.length("prefix"), "prefix")).alias("p"))
    rows = calls.join(best, "model", "left")
    usd = (F.col("input_tokens") * F.col("p.usd_in") + F.col("output_tokens") * F.col("p.usd_out") + F.col("cache_tokens") * F.col("p.usd_cache")) / 1_000_000
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cache_tokens")], F.sum(usd).alias("usd"))


def estimate(pages: Column, usd_in: float, usd_out: float) -> Column:
    """AGG-13: 900 tokens in and 1,800 out a page, and a band of 40 % around the price."""
    tokens_in, tokens_out = pages * 900, pages * 1800
    usd = tokens_in / 1_000_000 * F.lit(usd_in) + tokens_out / 1_000_000 * F.lit(usd_out)
    return F.struct(pages.alias("pages"), tokens_in.alias("est_input_tokens"), tokens_out.alias("est_output_tokens"), usd.alias("usd"), (usd * 0.6).alias("usd_low"), (usd * 1.4).alias("usd_high"))


def route(assets: DataFrame, handlers: DataFrame, mime: str) -> DataFrame:
    """JOI-17: the first handler, in their order, that handles each asset's type; null if none does. handlers: ord, name, handles ARRAY."""
    one = handlers.select("ord", "name", F.explode("handles").alias("_m")).groupBy("_m").agg(F.min_by("name", "ord").alias("handler"))
    return assets.join(one, F.col(mime) == F.col("_m"), "left").drop("_m")


def notes_spent(anchors: DataFrame, pulled: DataFrame, keys: list[str], share: float = 0.8) -> DataFrame:
    """AGG-14: per notes document, whether the notes that were pulled are 80 % of its filled anchors; false if none was."""
    a = anchors.filter(F.trim("text") != "").select(*keys, "id").distinct()
    p = pulled.select(*keys, "id").distinct().withColumn("_p", F.lit(1))
    rows = a.join(p, [*keys, "id"], "left").groupBy(*keys).agg(F.count("*").alias("anchors"), F.count("_p").alias("pulled"))
    return rows.withColumn("spent", (F.col("pulled") > 0) & (F.col("pulled") >= share * F.col("anchors")))


def pick_identifier(identifiers: DataFrame, key: str) -> DataFrame:
    """SRT-02: each book's best identifier: isbn, doi, uuid, calibre, another scheme, none; the first wins ties.

    identifiers: key, ord, value, scheme (of the element's attribute, may be null).
    """
    v = F.trim("value")
    prefixed = v.rlike(r"^(?i)(?:urn:)?(isbn|uuid|doi|calibre|asin|amazon|google):(.+)$")
    digits = F.regexp_replace(v, "[- ]", "")
    scheme = cases(
        [
            (prefixed, F.lower(F.regexp_extract(v, r"^(?:[uU][rR][nN]:)?([A-Za-z][\w-]*):", 1))),
            (nonempty(F.col("scheme")).isNotNull(), F.lower(F.trim("scheme"))),
            (digits.rlike(r"^97[89]\d{10}$"), F.lit("isbn")),
            (v.rlike("^(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.lit("uuid")),
        ]
    )
    bare = cases([(prefixed, F.trim(F.regexp_replace(v, r"^(?:[uU][rR][nN]:)?[A-Za-z][\w-]*:", ""))), (nonempty(F.col("scheme")).isNull() & digits.rlike(r"^97[89]\d{10}$"), digits)], v)
    rank = cases([(F.col("_s") == s, F.lit(i)) for i, s in enumerate(("isbn", "doi", "uuid", "calibre"))] + [(F.col("_s").isNotNull(), F.lit(8))], F.lit(9))
    rows = identifiers.filter(v != "").withColumn("_s", scheme).withColumn("_v", bare)
    best = rows.groupBy(key).agg(F.min_by(F.concat_ws(":", "_s", "_v"), F.struct(rank, "ord")).alias("identifier"))
    return best


def toc_titles(entries: DataFrame, key: str) -> DataFrame:
    """JOI-15: the first title of each file of a table of contents. entries: key, ord, href, title."""
    name = F.regexp_extract(F.split_part("href", F.lit("#"), F.lit(1)), r"([^/]+)$", 1)
    return entries.filter(F.trim("title") != "").groupBy(key, name.alias("file_name")).agg(F.min_by(F.trim("title"), "ord").alias("toc_title"))


def resolve_notes(refs: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """JOI-14: note references, numbered through the book, with the text that each points to. refs: key, ord, file, href; anchors: key, file, id, text."""
    from pyspark.sql import Window as W

    target = F.split_part("href", F.lit("#"), F.lit(1))
    at = refs.select(key, "ord", F.when(target == "", F.col("file")).otherwise(F.regexp_replace(F.concat(F.regexp_extract("file", r"^(.*/)?", 0), target), r"[^/]+/\.\./", "")).alias("file"), F.nullif(F.substring_index("href", "#", -1), F.col("href")).alias("id"))
    label = F.row_number().over(W.partitionBy(key).orderBy("ord"))
    text = F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), r"^(?:[-*]\s+)?(?:fn\s*)?\d+[.\s]*", "")
    return at.withColumn("label", label).join(anchors.select(key, "file", "id", text.alias("note")), [key, "file", "id"], "left").select(key, "ord", "label", "file", "id", "note")


def distinct_images(images: DataFrame, page: str) -> DataFrame:
    """AGG-20: the first of each page's images with a URL. images: page, ord, url, alt, caption."""
    return images.groupBy(page, "url").agg(F.min_by(F.struct("ord", "alt", "caption"), "ord").alias("x")).select(page, "url", "x.*")


def participants(messages: DataFrame, key: str) -> DataFrame:
    """AGG-18: people of a message, sender first, then to, then cc; the first of an address in any case. Columns from_, to, cc of (address, name)."""
    people = F.filter(F.concat(F.array("from_"), "to", "cc"), lambda p: p.isNotNull() & (F.trim(p["address"]) != ""))
    rows = messages.select(key, F.posexplode(people).alias("pos", "p"))
    return rows.groupBy(key, F.lower("p.address").alias("_a")).agg(F.min_by(F.struct("pos", "p.address", "p.name"), "pos").alias("x")).select(key, "x.pos", "x.address", "x.name")


def containment(lines: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """JOI-16: the first line of a document that holds each anchor's letters, if the anchor is strong there: 40 letters, or half the line.

    lines: key, line_no, letters. anchors: key, anchor, letters.
    """
    a = anchors.filter("letters <> ''").select(key, "anchor", F.col("letters").alias("_a"))
    hits = lines.join(a, key).filter(F.contains(F.col("letters"), F.col("_a")) & ((F.length("_a") >= 40) | (F.length("_a") * 2 >= F.length("letters"))))
    return hits.groupBy(key, "anchor").agg(F.min("line_no").alias("line_no"))


def backfill_plan(records: DataFrame) -> DataFrame:
    """SCL-13: what a record of before the type split would gain: file_format, document_type, and whether a legacy `article` goes."""
    from ..functions.rights import derive_format, document_type

    fmt = derive_format(F.col("archived_ext"), F.col("codec"), F.col("source_type"), F.col("title"))
    strip = (F.col("document_type") == "article") & (F.col("source_type") == "web")
    new_type = F.when(nonempty(F.col("document_type")).isNull(), document_type(F.col("source_type"), F.col("title")))
    return records.select("record_hash", F.when(nonempty(F.col("file_format")).isNull(), fmt).alias("add_format"), new_type.alias("add_type"), F.coalesce(strip, F.lit(False)).alias("strip_article"))


def probe_fields(raw: Column) -> Column:
    """SRC-19: codec, container, bit rate, sample rate, channels and duration of a media probe's JSON; the format's value before the stream's."""
    p = F.from_json(raw, "format STRUCT<format_name: STRING, bit_rate: STRING, duration: STRING>, streams ARRAY<STRUCT<codec_type: STRING, codec_name: STRING, bit_rate: STRING, sample_rate: STRING, channels: INT, duration: STRING>>")
    s = F.get(F.filter(p["streams"], lambda x: x["codec_type"] == "audio"), F.lit(0))
    return F.struct(
        s["codec_name"].alias("codec"),
        F.split_part(p["format"]["format_name"], F.lit(","), F.lit(1)).alias("container"),
        F.coalesce(p["format"]["bit_rate"].try_cast("int"), s["bit_rate"].try_cast("int")).alias("bitrate"),
        s["sample_rate"].try_cast("int").alias("sample_rate"),
        s["channels"].alias("channels"),
        F.coalesce(p["format"]["duration"].try_cast("double"), s["duration"].try_cast("double")).alias("duration"),
    )


def video_fields(info: Column) -> Column:
    """SCL-15: what a video's info JSON says: absent things stay null; creators are those that are not the channel."""
    p = F.from_json(info, "title STRING, upload_date STRING, duration DOUBLE, channel STRING, uploader STRING, description STRING, extractor STRING, id STRING, creators ARRAY<STRING>")
    some = lambda c: F.nullif(c, F.lit(""))
    d = p["upload_date"]
    date = F.when(d.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2)))
    channel = F.lower(F.trim(F.coalesce(some(p["channel"]), p["uploader"], F.lit(""))))
    people = F.filter(F.transform(p["creators"], F.trim), lambda c: (c != "") & (F.lower(c) != channel))
    return F.struct(
        some(p["title"]).alias("title"),
        date.alias("posted_date"),
        F.when(p["duration"] > 0, p["duration"]).alias("duration"),
        some(p["channel"]).alias("posted_by"),
        some(p["description"]).alias("description"),
        F.when(some(p["extractor"]).isNotNull() & some(p["id"]).isNotNull(), F.concat_ws(":", p["extractor"], p["id"])).alias("source_id"),
        people.alias("creators"),
    )

"""Rights, provenance, formats and types of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import cases, nonempty
from .urls import is_us_government, is_web

#: Fixed values.
PUBLIC = ("publicly_accessible", "public_domain")
STATUSES = ("public_domain", "open_licence", "publicly_accessible", "licensed", "restricted")
SOURCE_TYPES = ("pdf", "audio", "video", "web", "ebook", "image")
DOCUMENT_TYPES = ("book", "paper", "report", "article", "letter", "email", "statement", "form", "transcript", "slide", "interview", "documentary", "podcast", "lecture", "broadcast", "recording", "footage")
NO_ORIGIN = (
    "No source URL or source ID was supplied at ingest, so the origin could not be established and the status defaulted to restricted. "
    "Supply a source URL (a public or government one may make it publicly accessible or public domain), or confirm the licence, to take it out of this queue."
)
FORMAT_ALIASES = {"ogg": "opus", "oga": "opus", "jpeg": "jpg", "htm": "html"}
FORMAT_BY_TYPE = {"web": "html", "ebook": "epub", "pdf": "pdf", "image": "jpg", "document": "pdf"}
AV_TITLES = (
    ("interview", r"DEBRIEFED|Interviewed by"),
    ("documentary", r"Full Documentary|\(Documentary"),
    ("podcast", r"Podcast|\bEp\.?\s*\d+"),
    ("broadcast", r"press conference"),
    ("footage", r"\bfootage\b"),
)
TEXT_TITLES = (
    ("slide", r"\bslide\b"),
    ("form", r"\bform\b"),
    ("transcript", r"\btranscript(ion)?\b"),
    ("letter", r"\b(letter|correspondence)\b"),
    ("statement", r"\bstatement\b"),
    ("report", r"\bReport\s*$|\bReport\s*:|\bReport\s+No\.|^Report\s+|Incident Report|Sighting Report|Conference Report"),
)
MAGIC = (
    (b"%PDF-", "application/pdf"),
    (b"<!DOCTYPE", "text/html"),
    (b"<!doctype", "text/html"),
    (b"<html", "text/html"),
    (b"<HTML", "text/html"),
    (b"\xff\xd8\xff", "image/jpeg"),
    (b"\x89PNG\r\n\x1a\n", "image/png"),
)
EXTENSIONS = {
    ".html": "text/html", ".htm": "text/html", ".xhtml": "application/xhtml+xml", ".pdf": "application/pdf", ".mp3": "audio/mpeg", ".mp4": "video/mp4", ".m4a": "audio/mp4",
    ".wav": "audio/wav", ".webm": "video/webm", ".ogg": "audio/ogg", ".opus": "audio/ogg", ".oga": "audio/ogg", ".epub": "application/epub+zip", ".mobi": "application/x-mobipocket-ebook",
    ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp",
}
MIN_HTML_BYTES = 1024


def default_status(explicit: Column, source: Column, source_url: Column) -> Column:
    """SCL-11: the stated status, else public domain for a government URL, publicly accessible for a web URL, else null."""
    web = [(is_web(u), F.when(is_us_government(u), F.lit("public_domain")).otherwise(F.lit("publicly_accessible"))) for u in (source, source_url)]
    return cases([(nonempty(explicit).isNotNull(), explicit), *web])


def has_provenance(source: Column, source_url: Column, source_id: Column) -> Column:
    """FLT-04: a source URL, a source id or a web source."""
    return nonempty(source_url).isNotNull() | nonempty(source_id).isNotNull() | is_web(source)


def resolve_status(explicit: Column, source: Column, source_url: Column, source_id: Column, fallback: str = "restricted") -> Column:
    """SCL-11: STRUCT<status, detail>; the detail says why a record is restricted only for want of an origin."""
    status = default_status(explicit, source, source_url)
    lost = status.isNull() & F.lit(fallback == "restricted") & ~has_provenance(source, source_url, source_id)
    return F.struct(F.coalesce(status, F.lit(fallback)).alias("status"), F.when(lost, F.lit(NO_ORIGIN)).alias("detail"))


def is_gated(status: Column) -> Column:
    """FLT-01: true unless the status is a public one; no status is gated."""
    return F.coalesce(~F.lower(F.trim(status, F.lit("\"' "))).isin(*PUBLIC), F.lit(True))


def normalise_format(ext: Column) -> Column:
    """SCL-12: an extension in lower case without dots, aliases resolved; null for none."""
    token = nonempty(F.lower(F.ltrim(F.trim(ext), F.lit("."))))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FORMAT_ALIASES.items() for x in kv]), token), token)


def derive_format(archived_ext: Column, codec: Column, source_type: Column, title: Column) -> Column:
    """SCL-12: from the archived extension, the codec of recordings (opus without one), the type, or the title's suffix."""
    by_type = F.try_element_at(F.create_map(*[F.lit(x) for kv in FORMAT_BY_TYPE.items() for x in kv]), source_type)
    recorded = F.when(source_type.isin("audio", "video"), F.coalesce(normalise_format(codec), F.lit("opus")))
    suffix = normalise_format(F.nullif(F.regexp_extract(title, r"[^./]\.([^./\s]+)$", 1), F.lit("")))
    return F.coalesce(normalise_format(archived_ext), recorded, by_type, suffix)


def document_type(source_type: Column, title: Column) -> Column:
    """SRT-06: the first rule that the title meets, by the kind of source; null if none is evidenced."""
    t = F.coalesce(title, F.lit(""))
    rules = lambda pairs: cases([(t.rlike(f"(?i){p}"), label) for label, p in pairs])
    return F.when(source_type.isin("audio", "video"), rules(AV_TITLES)).when(source_type.isin("pdf", "image"), rules(TEXT_TITLES))


def mime_from_bytes(head: Column) -> Column:
    """SCL-14: by the first bytes after white space; `head` is binary or text."""
    code = F.regexp_replace(F.hex(head.cast("binary")), r"^(?:20|09|0A|0B|0C|0D)+", "")
    return cases([(code.startswith(sign.hex().upper()), kind) for sign, kind in MAGIC])


def mime_from_extension(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, r"[^./](\.[^./?#]+)$", 1))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), ext)


def detect_mime(content_type: Column, head: Column, name: Column) -> Column:
    """SCL-14: the declared type, else the first bytes, else the extension."""
    return F.coalesce(nonempty(F.lower(F.split_part(content_type, F.lit(";"), F.lit(1)))), mime_from_bytes(head), mime_from_extension(name))


def source_type_of(mime: Column) -> Column:
    """SCL-40: video for video types, else audio."""
    return F.when(mime.startswith("video/"), F.lit("video")).otherwise(F.lit("audio"))


def html_rejection(url: Column, content: Column, detected: Column) -> Column:
    """FLT-05: why a response that is HTML cannot be what its URL names, or null."""
    html = ("text/html", "application/xhtml+xml")
    sign = mime_from_bytes(content)
    kind = F.when(sign.isin(*html), sign).when(detected.isin(*html), detected)
    named = mime_from_extension(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    other = named.isNotNull() & ~named.isin(*html)
    body = content.cast("string")
    wall = F.contains(body, F.lit("Preparing to download")) & F.contains(body, F.lit("HHS Vulnerability Disclosure"))
    lied = sign.isin(*html) & ~F.coalesce(detected.isin(*html), F.lit(False))
    return cases(
        [
            (kind.isNull(), F.lit(None).cast("string")),
            (wall, F.lit("PMC download proof-of-work interstitial")),
            (other & lied, F.concat(F.lit("URL names "), named, F.lit(" and the response declares "), detected, F.lit(", but its bytes are "), sign)),
            (other, F.concat(F.lit("URL names "), named, F.lit(", but the response is "), kind)),
        ]
    )


def storage_zone(status: Column) -> Column:
    """SRC-27: open for public statuses, gated for all else."""
    return F.when(is_gated(status), F.lit("gated")).otherwise(F.lit("open"))

"""URLs, hosts, sites and fetch decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import cases, collapse, group

#: Separators between a title and its site in order of trial, video and supported URL patterns.
SEPARATORS = (" | ", " — ", " – ", " - ")
VIDEO_URLS = r"https?://(?:www\.)?youtube\.com/watch\?|https?://youtu\.be/|https?://(?:www\.)?youtube\.com/shorts/|https?://(?:www\.)?youtube\.com/live/"
SUPPORTED_URLS = VIDEO_URLS + r"|https?://(?:www\.)?archive\.org/details/"
ARCHIVE = "https://web.archive.org/web/"


def host(url: Column) -> Column:
    """The host name in lower case, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def site(url: Column) -> Column:
    """The host without a leading www."""
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    """The path without slashes at its ends."""
    return F.trim(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))


def is_us_government(url: Column) -> Column:
    """FLT-03: the host is gov or mil or ends in one as a label."""
    return host(url).rlike(r"(^|\.)(gov|mil)$")


def is_web(url: Column) -> Column:
    return F.coalesce(url.rlike("^https?://"), F.lit(False))


def is_video_platform(url: Column) -> Column:
    """FLT-08, strict list."""
    return F.coalesce(url.rlike(VIDEO_URLS), F.lit(False))


def is_supported_media(url: Column) -> Column:
    """FLT-08, supported list."""
    return F.coalesce(url.rlike(SUPPORTED_URLS), F.lit(False))


def url_source_id(url: Column) -> Column:
    """SCL-02: `url:` and the first twelve hex digits of the URL's SHA-256."""
    return F.concat(F.lit("url:"), F.substring(F.sha2(url.cast("binary"), 256), 1, 12))


def video_id(url: Column) -> Column:
    """SCL-02: the id that a video platform's URL carries."""
    return group(url, r"(?:[?&]v=|youtu\.be/|/shorts/|/live/)([A-Za-z0-9_-]{11})")


def redirected_away(requested: Column, final: Column) -> Column:
    """FLT-06: the final path is neither the requested one nor below it; a request for the root never is, no final URL never is."""
    want, got = F.split(path(requested), "/"), F.split(path(final), "/")
    away = cases([(path(requested) == "", F.lit(False)), (path(final) == "", F.lit(True))], F.slice(got, F.lit(1), F.size(want)) != want)
    return F.coalesce(away, F.lit(False))


def archived_original(url: Column) -> Column:
    """SCL-03: the page that an archive URL holds, or null."""
    return group(url, rf"^{ARCHIVE.replace('.', chr(92) + '.')}[^/]+/(http.*)$")


def archived_at(url: Column) -> Column:
    """SCL-03: the capture date of an archive URL, or null."""
    return F.try_to_timestamp(group(url, r"/web/(\d{8})"), F.lit("yyyyMMdd")).cast("date")


def raw_archive_url(url: Column) -> Column:
    """SRC-13: the archive URL of the stored bytes, without the archive's own frame."""
    return F.when(url.rlike(r"/web/\d{14}(?:id_|if_|im_)/"), url).otherwise(F.regexp_replace(url, r"(/web/\d{14})/", "$1id_/"))


def archive_candidates(url: Column, year: Column) -> Column:
    """SRC-13: archive lookups by year, this one and the three before."""
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.concat(F.lit(ARCHIVE), (year - k).cast("string"), F.lit("/"), url))


def pmc_pdf_url(url: Column) -> Column:
    """SRC-14: the public download that a PubMed Central PDF link stands for, or null."""
    ours = host(url).isin("pmc.ncbi.nlm.nih.gov", "www.ncbi.nlm.nih.gov")
    name = group(F.concat(F.lit("/"), path(url)), r"(?i)^/(?:pmc/)?articles/(PMC\d+)/pdf/[^/]+\.pdf$")
    return F.when(ours, F.concat(F.lit("https://europepmc.org/api/getPdf?pmcid="), F.upper(name)))


def truncated_capture(stored: Column, declared: Column) -> Column:
    """FLT-07: fewer bytes than 99 % of what the archive says the original had."""
    n = declared.try_cast("long")
    return F.coalesce((n > 0) & (stored < n * F.lit(0.99)), F.lit(False))


def canonical_publisher(sitename: Column, url: Column, mastheads: dict[str, str] | None = None) -> Column:
    """SCL-09, JOI-12: the masthead of a known host, else the site name up to the first separator that it has.

    `mastheads` (host without www: name) is the lookup that a deployment keeps.
    """
    known = F.create_map(*[F.lit(x) for kv in (mastheads or {"": ""}).items() for x in kv])
    name = collapse(F.coalesce(sitename, F.lit("")))
    heads = [(F.contains(name, F.lit(s)), F.coalesce(F.nullif(F.trim(F.substring_index(name, s, 1)), F.lit("")), name)) for s in SEPARATORS]
    return F.coalesce(F.nullif(F.try_element_at(known, site(url)), F.lit("")), cases(heads, name))


def strip_site_suffix(title: Column, sitename: Column, url: Column, mastheads: dict[str, str] | None = None) -> Column:
    """SCL-10: drop a trailing separator and site name, if something is left; separators in order, then the names."""
    clean = F.regexp_replace(collapse(F.coalesce(title, F.lit(""))), r"\s*\(Published\s+\d{4}\)\s*$", "")
    h = site(url)
    tails = [collapse(F.coalesce(sitename, F.lit(""))), canonical_publisher(sitename, url, mastheads), h, F.concat(F.lit("www."), h)]
    rules = []
    for s in SEPARATORS:
        for i, t in enumerate(tails):
            end = F.concat(F.lit(s), t)
            head = F.trim(F.substring(clean, F.lit(1), F.length(clean) - F.length(end)))
            real = (t != "") if i < 3 else (h != "")
            rules.append((real & F.endswith(clean, end) & (head != ""), head))
    return cases(rules, clean)

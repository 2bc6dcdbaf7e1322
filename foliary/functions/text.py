"""Text of records: annotations, words, titles, dates in words, transcript lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import cases, collapse, let, nonempty

COMMENT, INLINE = r"(?s)<!--.*?-->", r"(?s)\{\{.*?\}\}"
MARKER = r"\{\{[^{}]*\}\}"
LINK = r"\[([^\]]*)\]\([^)]*\)"
#: Words after which a full stop ends no sentence, words that no person's name has, words of channels.
ABBREVIATIONS = ("dr", "mr", "mrs", "ms", "mx", "prof", "sr", "jr", "rev", "fr", "hon", "st", "sen", "rep", "gov", "gen", "col", "lt", "sgt", "capt", "cmdr", "adm", "maj", "cpl", "det", "supt", "pres", "etc", "vs", "al", "inc", "ltd", "co", "corp", "vol", "fig", "dept", "est")
NOT_NAMES = ("the", "a", "an", "of", "in", "on", "for", "and", "or", "with", "at", "to", "from", "by")
CHANNEL_WORDS = ("channel", "clips", "files", "media", "news", "podcast", "radio", "show", "tv")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
FAILURES = (
    (r"n challenge solving failed|pot:bgutil|youtubepot-bgutil|127\.0\.0\.1:4416", "PO-token provider unreachable - yt-dlp couldn't sign the media URLs, so YouTube offered no fetchable formats. A toolchain fault, NOT the video: check the bgutil script at /opt/bgutil/server/build/generate_once.js"),
    (r"confirm you.?re not a bot|not a bot", "YouTube bot check - needs cookies from a signed-in session"),
    (r"HTTP Error 403|403:\s*Forbidden", "YouTube blocked the media download (HTTP 403) - the no-token client is being rate-limited; needs a PO token or cookies"),
    (r"experiment that applies DRM|DRM protected|DRM", "YouTube applied a DRM experiment to the client used - another client or cookies may still work"),
    (r"Requested format is not available", "no downloadable audio format was offered (PO-token / format gating)"),
    (r"Private video", "the video is private"),
    (r"members-only|join this channel", "the video is members-only (needs a signed-in, subscribed session)"),
    (r"confirm your age|age-restricted|inappropriate for some", "the video is age-restricted (needs a signed-in session)"),
    (r"not available in your country|geo|geo-?restrict", "the video is geo-blocked"),
    (r"This live event|premieres in|will begin", "a livestream or premiere that has not started yet"),
    (r"Video unavailable|has been removed|no longer available|terminated", "the video is unavailable or has been removed"),
)


def sha_label(value: Column) -> Column:
    """SCL-01: `sha256:` and the hex digest."""
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def strip_annotations(body: Column) -> Column:
    """SCL-20: block and inline annotations become blanks."""
    return F.regexp_replace(F.regexp_replace(body, COMMENT, " "), INLINE, " ")


def strip_for_cloze(content: Column) -> Column:
    """SCL-20: frontmatter, annotations and leading timestamps removed."""
    body = F.regexp_replace(content, r"(?s)\A---\n.*?\n---\n", "")
    body = F.regexp_replace(F.regexp_replace(body, COMMENT, " "), MARKER, " ")
    return F.regexp_replace(body, r"(?m)^\d{2}:\d{2}:\d{2}\.\d\s+", "")


def squash(line: Column) -> Column:
    """SCL-21: markers dropped, links as their text, then letters and digits only, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(line, MARKER, ""), LINK, "$1"), r"[^\p{L}\p{N}]+", ""))


def tidy(body: Column) -> Column:
    """SCL-22: no white space at line ends, one line feed at the end."""
    return F.concat(F.regexp_replace(F.regexp_replace(body, r"\n+\z", ""), r"(?m)[ \t\r\f\u000B ]+$", ""), F.lit("\n"))


def slug(title: Column, most: int = 60) -> Column:
    """SCL-07: lower-case letters and digits joined by hyphens, cut at a hyphen."""
    s = F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), F.lit("-"))
    head = F.substring(s, 1, most)
    return F.when(F.length(s) > most, F.regexp_replace(head, "-[^-]*$", "")).otherwise(s)


def record_alias(date: Column, source_type: Column, title: Column, variant: str = "") -> Column:
    """The readable name of a record; null without an evidenced date."""
    known = nonempty(date).isNotNull() & ~F.lower(F.trim(date)).isin("none", "null", "undefined")
    return F.when(known, F.concat(date, F.lit("-"), source_type, F.lit("-"), slug(title), F.lit(f"{variant}.md")))


def clean_title(title: Column) -> Column:
    """SCL-08: placeholder words dropped, unless nothing would be left."""
    t = F.regexp_replace(title, r"(?i)\b(?:undefined|null|none)\b[-\s]*", "")
    t = F.trim(F.regexp_replace(t, r"\s{2,}", " "), F.lit(" -–—"))
    return F.coalesce(F.nullif(t, F.lit("")), title)


def resolve_title(title: Column, url: Column, source_id: Column, source_type: Column) -> Column:
    """SCL-43: the title, else the URL, else the id, else `Untitled` and the type."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(some(title), some(url), some(source_id), F.concat(F.lit("Untitled "), source_type))


def timecode(seconds: Column, tenths: bool = False) -> Column:
    """SCL-39: HH:MM:SS, or HH:MM:SS.D; truncating."""
    whole = F.floor(seconds).cast("long")
    parts = [F.floor(whole / 3600).cast("long"), F.floor(whole % 3600 / 60).cast("long"), (whole % 60).cast("long")]
    if tenths:
        return F.format_string("%02d:%02d:%02d.%d", *parts, F.floor((seconds - whole) * 10).cast("long"))
    return F.format_string("%02d:%02d:%02d", *parts)


def rejoin_dropcaps(text: Column) -> Column:
    """SCL-31: a capital alone on its line joins the word below; A and I are words and stay."""
    return F.regexp_replace(text, r"(?m)^([B-HJ-Z])\n(?=[a-z])", "$1")


def needs_inspection(region: Column) -> Column:
    """FLT-11: an unresolved drop cap, or a page marker's name without a well-formed marker."""
    named = region.rlike("printed_page|file_page") & ~region.rlike(r"<!--\s*(?:printed_page|file_page):")
    return region.rlike(r"(?m)^[A-Z]\n[a-z]") | named


def mark_redactions(text: Column) -> Column:
    """SCL-36, SCL-35: runs of asterisks as annotations that count the words they stand for."""
    pattern = r"\*{5,}(?:\s+\*+)*|\*{3,}(?:\s+\*+)+"

    def rebuilt(hits: Column, pieces: Column) -> Column:
        note = F.transform(hits, lambda h: F.concat(F.lit("{{redacted: ~"), F.size(F.regexp_extract_all(h, F.lit(r"(\*+)"), F.lit(1))).cast("string"), F.lit(" words}}")))
        return F.array_join(F.zip_with(pieces, F.concat(note, F.array(F.lit(""))), lambda p, n: F.concat(p, n)), "")

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda h: F.when(F.size(h) == 0, text).otherwise(rebuilt(h, F.split(text, pattern, -1))))


def expand_tokens(text: Column) -> Column:
    """SCL-35: page and note tokens as annotations, page markers before the heading that holds them."""
    t = F.regexp_replace(text, r"\[\[page:([0-9A-Za-z]+)\]\]", "<!-- printed_page: $1 -->")
    t = F.regexp_replace(t, r"\[\[note:(\d+)\]\]", "[^$1]")
    t = F.regexp_replace(t, r"(?m)^(#{1,6})[ \t]+((?:<!-- printed_page: \S+ -->[ \t]*)*<!-- printed_page: \S+ -->)[ \t]*(\S.*)$", "$2\n$1 $3")
    return F.regexp_replace(t, r"(?m)^#{1,6}[ \t]+((?:<!-- printed_page: \S+ -->[ \t]*)+)$", "$1")


def strip_html(text: Column) -> Column:
    """SCL-37: tags as blanks, white space collapsed, null if nothing is left."""
    plain = F.regexp_replace(text, r"<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(char))
    return F.nullif(collapse(plain), F.lit(""))


def gated_blurb(text: Column, gated: Column, most: int = 200) -> Column:
    """SCL-37: a gated record's description cut at a word within the limit."""
    cut = F.regexp_replace(F.substring(text, 1, most), r"\s\S*$", "")
    return F.when(gated & (F.length(text) > most), F.concat(F.rtrim(cut), F.lit("…"))).otherwise(text)


def css_size(html: Column) -> Column:
    """AGG-17: characters of all style blocks."""
    return F.aggregate(F.regexp_extract_all(html, F.lit(r"(?s)<style[^>]*>(.*?)</style>"), F.lit(1)), F.lit(0), lambda a, x: a + F.length(x)).cast("long")


def words_of_four(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z']{4,})"), F.lit(1)))


def visible(html: Column) -> Column:
    """HTML without scripts, styles and tags."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " "), r"(?is)<style[^>]*>.*?</style>", " "), r"<[^>]+>", " ")


def vocabulary_coverage(html: Column, body: Column) -> Column:
    """AGG-16: share of the body's distinct words of four letters or more that the capture shows; 1 for a body without any."""
    want = words_of_four(F.regexp_replace(body, COMMENT, " "))
    return let(want, lambda w: F.when(F.size(w) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(w, words_of_four(visible(html)))) / F.size(w)))


def sentences(text: Column) -> Column:
    """SCL-38: cut after . ? ! and white space, joined again after titles, initials and dotted acronyms."""
    pieces = F.filter(F.transform(F.split(F.trim(text), r"(?<=[.?!])\s+"), F.trim), lambda s: s != "")
    core = lambda s: F.rtrim(F.regexp_extract(s, r"(\S+)$", 1), F.lit("."))
    open_ = lambda s: F.coalesce(F.lower(core(s)).isin(*ABBREVIATIONS) | core(s).rlike(r"^\p{L}$|^[A-Za-z](?:\.[A-Za-z])+$"), F.lit(False))
    start = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("held"))

    def step(a: Column, s: Column) -> Column:
        held = F.when(a["held"] == "", s).otherwise(F.concat_ws(" ", a["held"], s))
        return F.when(open_(s), F.struct(a["done"].alias("done"), held.alias("held"))).otherwise(F.struct(F.array_append(a["done"], held).alias("done"), F.lit("").alias("held")))

    return F.aggregate(pieces, start, step, lambda a: F.when(a["held"] == "", a["done"]).otherwise(F.array_append(a["done"], a["held"])))


def looks_like_name(text: Column) -> Column:
    """FLT-14: two or three capitalised words, none of them a word that names lack."""
    words = F.split(F.trim(text), r"\s+")
    bare = lambda w: F.lower(F.trim(w, F.lit(".:-")))
    return F.size(words).between(2, 3) & F.forall(words, lambda w: w.rlike(r"^\p{Lu}") & ~F.lower(w).isin(*NOT_NAMES) & ~bare(w).isin("q&a", "qa"))


def looks_like_channel(text: Column) -> Column:
    """FLT-14: all capitals, or a word that channels have."""
    loud = text.rlike(r"\p{Lu}") & ~text.rlike(r"\p{Ll}")
    return loud | F.exists(F.split(F.trim(text), r"\s+"), lambda w: F.lower(F.trim(w, F.lit("."))).isin(*CHANNEL_WORDS))


def known_speakers(title: Column, description: Column, publisher: Column) -> Column:
    """SCL-42: featured names, else the name at the title's head; the name that a description begins with; a publisher that is a person."""
    names = lambda arr: F.filter(F.transform(arr, lambda s: F.trim(F.trim(s), F.lit('"'))), looks_like_name)
    credits = F.regexp_extract_all(title, F.lit(r"(?i)\((?:ft|feat|featuring)\.?\s+([^)]+)\)"), F.lit(1))
    featured = names(F.flatten(F.transform(credits, lambda c: F.split(c, "&|,| and "))))
    head = F.when(F.contains(title, F.lit(":")), F.split_part(title, F.lit(":"), F.lit(1))).when(F.contains(title, F.lit("|")), F.split_part(title, F.lit("|"), F.lit(1)))
    line = F.split_part(F.trim(description), F.lit("\n"), F.lit(1))
    intro = cases([(F.contains(line, F.lit(p)), F.split_part(line, F.lit(p), F.lit(1))) for p in (" is a ", " is an ", " reports on ", " interviews ", " speaks with ")])
    one = lambda c: names(F.filter(F.array(c), lambda x: x.isNotNull()))
    person = F.filter(one(publisher), lambda p: ~looks_like_channel(p))
    return let(F.coalesce(featured, F.expr("cast(array() as array<string>)")), lambda f: F.array_sort(F.array_distinct(F.concat(f, F.when(F.size(f) == 0, one(head)).otherwise(F.expr("cast(array() as array<string>)")), one(intro), person))))


def failure_reason(log: Column) -> Column:
    """SCL-46: the first known reason in a downloader's log, else its last ERROR line, else a fixed sentence."""
    errors = F.filter(F.transform(F.split(log, r"\r?\n"), F.trim), lambda x: x.startswith("ERROR"))
    last = F.substring(F.regexp_replace(F.element_at(errors, -1), r"^ERROR:\s*", ""), 1, 200)
    return cases([(log.rlike(f"(?i){p}"), reason) for p, reason in FAILURES] + [(F.size(errors) > 0, last)], F.lit("yt-dlp failed with no error output"))


def clean_math(text: Column) -> Column:
    """SCL-47: braces that stand together inside a math span are set apart, so that no annotation begins there."""
    span = r"(?s)\\\[.*?\\\]|\\\(.*?\\\)"

    def apart(h: Column) -> Column:
        for _ in range(2):  # three in a row need two passes
            h = F.replace(F.replace(h, F.lit("{{"), F.lit("{ {")), F.lit("}}"), F.lit("} }"))
        return h

    return let(
        F.regexp_extract_all(text, F.lit(f"({span})".replace("((?s)", "(?s)(")), F.lit(1)),
        lambda h: F.when(F.size(h) == 0, text).otherwise(F.array_join(F.zip_with(F.split(text, span, -1), F.concat(F.transform(h, apart), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")),
    )


def clean_annotations(text: Column) -> Column:
    """SCL-47: no empty line before the end of a block annotation."""
    return F.regexp_replace(text, "\n\n(-->)", "\n$1")


def roman(text: Column) -> Column:
    """SCL-32: value of a well-formed Roman numeral, or null."""
    values = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    good = F.upper(F.trim(text)).rlike(r"^(?=.)M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$")
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    step = lambda a, c: let(F.try_element_at(values, c), lambda v: F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), v.alias("last")))
    chars = F.reverse(F.filter(F.split(F.upper(F.trim(text)), ""), lambda c: c != ""))
    return F.when(good, F.aggregate(chars, start, step)["sum"])


ONES = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")


def enumerator(text: Column) -> Column:
    """SCL-32: an Arabic, Roman or spelled number (1 to 99) as an integer, or null."""
    t = F.rtrim(F.trim(text), F.lit("."))
    table = {w: i + 1 for i, w in enumerate(ONES)} | {w: 10 * (i + 2) for i, w in enumerate(TENS)} | {f"{t} {o}": 10 * (i + 2) + j + 1 for i, t in enumerate(TENS) for j, o in enumerate(ONES[:9])}
    spelled = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), collapse(F.replace(F.lower(t), F.lit("-"), F.lit(" "))))
    return F.coalesce(F.when(t.rlike(r"^\d+$"), t.try_cast("int")), roman(t), spelled)


def designation(text: Column) -> Column:
    """SCL-33: STRUCT<number, title, is_part> of a chapter heading or table-of-contents entry."""
    t = F.trim(F.coalesce(text, F.lit("")))
    token, rest = r"([0-9]{1,4}|[A-Za-z]+(?:-[A-Za-z]+)?)", r"\b[\s:.–—-]*(.*)$"
    part, chapter = rf"(?i)^part\s+{token}{rest}", rf"(?i)^chapter\s+{token}{rest}"
    arabic, rom, bare = r"^(\d{1,4})[.:)]\s+(.*\S)$", r"^([IVXLCDM]+)\.\s+(.*\S)$", rf"^{token}\.?$"
    got = lambda p, n: F.nullif(F.trim(F.regexp_extract(t, p, n)), F.lit(""))
    null = F.lit(None).cast("string")
    row = lambda number, title, is_part: F.struct(number.alias("number"), title.alias("title"), F.lit(is_part).alias("is_part"))
    number = lambda p: enumerator(F.regexp_extract(t, p, 1))
    return cases(
        [
            (t == "", row(null, null, False)),
            (t.rlike(part), row(null, got(part, 2), True)),
            (t.rlike(chapter) & number(chapter).isNotNull(), row(number(chapter).cast("string"), got(chapter, 2), False)),
            (t.rlike(arabic), row(got(arabic, 1), got(arabic, 2), False)),
            (t.rlike(rom), row(null, got(rom, 2), True)),
            (t.rlike(bare) & F.coalesce(number(bare) <= 99, F.lit(False)), row(number(bare).cast("string"), null, False)),
        ],
        row(null, t, False),
    )


def yaml_quote(value: Column) -> Column:
    """SCL-51: a double-quoted YAML scalar."""
    return F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def trim_raw_tail(text: Column) -> Column:
    """SCL-26: a mail's raw source at the end of a page is cut, and the link-only lines before it."""
    tail = r"(?m)^[ \t]*(?:MIME-Version:\s|Delivered-To:\s|Received:\s+(?:by|from)\s|Content-Type:\s*multipart/)"
    head = F.regexp_replace(F.element_at(F.split(text, tail, 2), 1), r"(?:\n?[ \t]*(?:\[[^\]]*\]\([^)]*\))?[ \t]*)*\z", "")
    return F.when(text.rlike(tail), F.concat(F.rtrim(head), F.lit("\n"))).otherwise(text)


def drop_leading_heading(text: Column, title: Column) -> Column:
    """SCL-26: a first heading that says what the title says goes."""
    body = F.regexp_replace(text, r"\A\n+", "")
    head = F.regexp_extract(body, r"\A#{1,6}[ \t]+(.+?)[ \t]*(?:\n|\z)", 1)
    same = (head != "") & (F.lower(collapse(head)) == F.lower(collapse(title)))
    rest = F.regexp_replace(F.regexp_replace(body, r"\A[^\n]*(?:\n|\z)", ""), r"\A\n+", "")
    return F.when(F.coalesce(same, F.lit(False)), rest).otherwise(text)

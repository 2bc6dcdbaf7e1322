import pytest
from pyspark.sql import functions as F

from foliary.functions import rights, temporal, text, urls


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def test_instants_and_dates(spark):
    rows = ["2024-05-01T10:00:00Z", "2024-05-01T10:00:00.123+02:00", "2024-05-01T10:00:00", "2024-02-30T10:00:00Z", "2024-05-01T10:00:00+25:00", "2024", "2024-13", "2024-12", "2024-02-30", "0000", None, ""]
    assert values(spark, temporal.is_instant, rows) == [True, True, *[False] * 10]
    assert values(spark, temporal.is_utc_instant, rows)[:2] == [True, False]
    assert values(spark, temporal.is_evidenced_date, rows) == [True, True, False, False, False, True, False, True, False, False, False, False]
    assert values(spark, temporal.precision, ["2024", "2024-01", "2024-01-31", "2024-01-31T00:00:00Z", "x"]) == ["year", "month", "day", "instant", None]


@pytest.mark.parametrize("given,want", [(" 20240131 ", "2024-01-31"), ("20240231", "20240231"), ("2024-1-5", "2024-01-05"), ("2024-5", "2024-05"), ("2024", "2024"), ("May 2024", "May 2024"), ("2024-01-02 03:04:05Z", "2024-01-02T03:04:05Z"), (None, ""), ("  ", "")])
def test_publication_dates_keep_their_precision(spark, given, want):
    assert values(spark, temporal.normalise_published, [given]) == [want]


def test_date_alias_and_scalar(spark):
    assert values(spark, temporal.date_alias, ["2024-01-02T03:04:05Z", "2024-01", None]) == ["2024-01-02", "2024-01", None]
    assert values(spark, temporal.temporal_scalar, ['a"b\\c']) == ['"a\\"b\\\\c"']


def test_dates_in_slugs(spark):
    rows = ["/2019/05/01/story", "/news-20230231-20230115", "/x-040718-y", "/1985/01/01/", "none"]
    assert values(spark, lambda c: temporal.dates_in_slug(c, F.lit("2024-06-01")), rows) == ["2019-05-01", "2023-01-15", "2018-04-07", None, None]


def test_hosts(spark):
    rows = ["https://User:p@WWW.State.GOV:80/a", "https://notgov.com/x.gov", "http://a.mil", "ftp//x", None]
    assert values(spark, urls.host, rows) == ["www.state.gov", "notgov.com", "a.mil", "", ""]
    assert values(spark, urls.is_us_government, rows) == [True, False, True, False, False]
    assert values(spark, urls.site, rows)[0] == "state.gov"


def test_redirects(spark):
    pairs = [("https://x.org/a/b", "https://x.org/a/b/c", False), ("https://x.org/a/b", "https://x.org/a", True), ("https://x.org/a", "https://x.org/", True), ("https://x.org/", "https://x.org/z", False), ("https://x.org/a", None, False)]
    df = spark.createDataFrame(pairs, "r string, f string, w boolean")
    assert all(r["g"] == r["w"] for r in df.select("w", urls.redirected_away(F.col("r"), F.col("f")).alias("g")).collect())


def test_site_suffixes(spark):
    rows = [("Big Story | The Site", "The Site", None, "Big Story"), ("The Site", "The Site", None, "The Site"), ("A - B", "C", None, "A - B"), ("Q – daily.example (Published 1999)", "", "https://www.daily.example/x", "Q"), ("Q - The Daily Example", "", "https://daily.example/x", "Q"), ("", "x", None, "")]
    df = spark.createDataFrame(rows, "t string, s string, u string, w string")
    assert all(r["g"] == r["w"] for r in df.select("w", urls.strip_site_suffix(F.col("t"), F.col("s"), F.col("u"), {"daily.example": "The Daily Example"}).alias("g")).collect())


def test_pmc_and_archive(spark):
    assert values(spark, urls.pmc_pdf_url, ["https://pmc.ncbi.nlm.nih.gov/articles/PMC123/pdf/main.pdf", "https://www.ncbi.nlm.nih.gov/pmc/articles/pmc9/pdf/x.PDF", "https://x.org/articles/PMC1/pdf/a.pdf"]) == ["https://europepmc.org/api/getPdf?pmcid=PMC123", "https://europepmc.org/api/getPdf?pmcid=PMC9", None]
    assert values(spark, urls.raw_archive_url, ["https://web.archive.org/web/20200101000000/http://a", "https://web.archive.org/web/20200101000000if_/http://a"]) == ["https://web.archive.org/web/20200101000000id_/http://a", "https://web.archive.org/web/20200101000000if_/http://a"]
    assert values(spark, lambda c: urls.archive_candidates(c, F.lit(2024)), ["http://a"])[0][3] == "https://web.archive.org/web/2021/http://a"


def test_rights(spark):
    rows = [(None, "https://a.gov/x", None, None), (None, "x", "http://b.org", None), ("licensed", "https://a.gov", None, None), (None, "x", None, None), (None, "x", None, "doi:1")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, e string, s string, u string, d string")
    got = [tuple(r["r"]) for r in df.select("i", rights.resolve_status(*[F.col(c) for c in "esud"]).alias("r")).orderBy("i").collect()]
    assert got == [("public_domain", None), ("publicly_accessible", None), ("licensed", None), ("restricted", rights.NO_ORIGIN), ("restricted", None)]
    assert values(spark, rights.is_gated, ["public_domain", "'Publicly_Accessible'", "restricted", None]) == [False, False, True, True]


def test_formats_and_types(spark):
    assert values(spark, rights.normalise_format, [".OGG", " jpeg ", "htm", ".", None, "Pdf"]) == ["opus", "jpg", "html", None, None, "pdf"]
    cases = [("audio", "The Show Ep. 12", "podcast"), ("video", "DEBRIEFED with X", "interview"), ("pdf", "Incident Report 7", "report"), ("pdf", "Letter report", "letter"), ("pdf", "reporting", None), ("web", "A Report", None), ("image", None, None)]
    df = spark.createDataFrame(cases, "s string, t string, w string")
    assert all(r["g"] == r["w"] for r in df.select("w", rights.document_type(F.col("s"), F.col("t")).alias("g")).collect())


def test_mime(spark):
    cases = [("Text/HTML; charset=x", "%PDF-", "a.pdf", "text/html"), (None, " \n%PDF-1.4", "a.html", "application/pdf"), ("", "<!doctype html>", None, "text/html"), (None, "zz", "http://x/A.MP3", "audio/mpeg"), (None, "zz", "a", None)]
    df = spark.createDataFrame(cases, "c string, b string, n string, w string")
    assert all(r["g"] == r["w"] for r in df.select("w", rights.detect_mime(F.col("c"), F.col("b"), F.col("n")).alias("g")).collect())
    cases = [("https://x/a.pdf", "<html>", "application/pdf", "URL names application/pdf and the response declares application/pdf, but its bytes are text/html"), ("https://x/a.pdf", "<html>", "text/html", "URL names application/pdf, but the response is text/html"), ("https://x/a", "<html>", "text/html", None), ("https://x/a.pdf", "%PDF-", "application/pdf", None), ("https://x/", "<html>Preparing to download HHS Vulnerability Disclosure", "text/html", "PMC download proof-of-work interstitial")]
    df = spark.createDataFrame(cases, "u string, b string, d string, w string")
    assert all(r["g"] == r["w"] for r in df.select("w", rights.html_rejection(F.col("u"), F.col("b"), F.col("d")).alias("g")).collect())


def test_text_forms(spark):
    assert values(spark, text.slug, ["Hello, World!", "--x--", "a" * 50 + "-" + "b" * 20, "é"]) == ["hello-world", "x", "a" * 50, ""]
    assert values(spark, text.clean_title, ["undefined - A", "None", "a  null b", "nullable"]) == ["A", "None", "a b", "nullable"]
    assert values(spark, text.squash, ["{{t:1.0}}Hé [l-i](http://x) 9_"]) == ["héli9"]
    assert values(spark, text.strip_annotations, ["a<!-- b\nc -->d{{e}}"]) == ["a d "]
    assert values(spark, text.tidy, ["a  \nb\t\n\n\n"]) == ["a\nb\n"]
    assert values(spark, text.rejoin_dropcaps, ["W\nhile\nI\nwas"]) == ["While\nI\nwas"]
    assert values(spark, text.timecode, [3661.97], "double") == ["01:01:01"]
    assert values(spark, lambda c: text.timecode(c, True), [3661.97, 0.0], "double") == ["01:01:01.9", "00:00:00.0"]
    assert values(spark, text.mark_redactions, ["a *** **** b ***** c ** d"]) == ["a {{redacted: ~2 words}} b {{redacted: ~1 words}} c ** d"]
    assert values(spark, text.strip_html, ["<p>a&amp;b</p> <i>c</i>", "<br>"]) == ["a&b c", None]
    assert values(spark, text.clean_math, [r"\(a{{b}}\) {{c}} \[x}}}\]"]) == [r"\(a{ {b} }\) {{c}} \[x} } }\]"]
    assert values(spark, text.clean_annotations, ["a\n\n-->"]) == ["a\n-->"]
    assert values(spark, text.expand_tokens, ["# [[page:3]] Head\nx[[note:2]]"]) == ["<!-- printed_page: 3 -->\n# Head\nx[^2]"]


def test_sentences(spark):
    rows = ["Mr. A met Dr. B. They left! Why?", "He lives in the U.S. now. Ok.", "J. R. Smith came.", "no end", "etc."]
    assert values(spark, text.sentences, rows) == [["Mr. A met Dr. B. They left!", "Why?"], ["He lives in the U.S. now.", "Ok."], ["J. R. Smith came."], ["no end"], ["etc."]]


def test_numbers_and_designations(spark):
    assert values(spark, text.enumerator, ["12", "xiv", "IIII", "forty-two", "Seven.", "zero", "M"]) == [12, 14, None, 42, 7, None, 1000]
    rows = ["Chapter Five: The End", "PART TWO", "3. Three", "IV. Four", "12", "1984", "Prologue", "", "Chapter and verse"]
    assert [tuple(x) for x in values(spark, text.designation, rows)] == [("5", "The End", False), (None, None, True), ("3", "Three", False), (None, "Four", True), ("12", None, False), (None, "1984", False), (None, "Prologue", False), (None, None, False), (None, "Chapter and verse", False)]


def test_mail_text(spark):
    assert values(spark, text.trim_raw_tail, ["Hi\n\n[x](http://y)\n\n  MIME-Version: 1.0\nz", "Hi"]) == ["Hi\n", "Hi"]
    assert values(spark, lambda c: text.drop_leading_heading(c, F.lit("A  b")), ["\n# a B\n\nrest", "# c\nrest"]) == ["rest", "# c\nrest"]

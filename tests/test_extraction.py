import io
import random
import zipfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliary.operators import books, carry, casing, html, mail
from foliary.plans import extraction, records


# carrying review work

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()


def paragraph(rng):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(rng.randint(4, 9)))


def test_region_follows_its_text():
    old = "one opening line here\n<!-- irrelevant: start -->\nbuy our newsletter today please\nshort\n<!-- irrelevant: end -->\nlast closing line here"
    new = "intro that is new\none opening line here\nbuy our newsletter today please\n\nshort\nlast closing line here"
    body, placed, lost = carry.carry_regions(old, new)
    assert (placed, lost) == (1, 0)
    assert carry.regions(body) == [["buy our newsletter today please", "short"]]
    assert carry.carry_regions(old, "nothing of it")[1:] == (0, 1)


def test_region_takes_whole_annotations_and_refuses_to_outgrow():
    old = "<!-- irrelevant: start -->\nfirst anchor sentence\nlast anchor sentence\n<!-- irrelevant: end -->"
    new = "<!--\nimage:\n  alt: x\n-->\nfirst anchor sentence <!-- a\nb -->\nlast anchor sentence"
    assert "b -->\nlast anchor sentence\n\n<!-- irrelevant: end -->" in carry.carry_regions(old, new)[0]
    far = "first anchor sentence\n" + "filler text that goes on\n" * 60 + "last anchor sentence"
    assert carry.carry_regions(old, far)[1:] == (0, 1)


@given(st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_carrying_changes_no_text(seed):
    rng = random.Random(seed)
    paras = [paragraph(rng) for _ in range(rng.randint(2, 9))]
    at = rng.randrange(len(paras))
    old = "\n".join([*paras[:at], carry.START, paras[at], carry.END, *paras[at + 1 :]])
    fresh = [p for p in paras if rng.random() < 0.9]
    rng.random() < 0.5 and fresh.insert(rng.randint(0, len(fresh)), paragraph(rng))
    new = "\n".join(fresh)
    body, placed, lost = carry.carry_regions(old, new)
    bare = [x for x in body.split("\n") if x not in ("", carry.START, carry.END)]
    assert bare == [x for x in fresh if x] and placed + lost == 1
    if placed:
        assert carry.regions(body) == carry.regions(carry.carry_regions(old, body.replace(carry.START, "").replace(carry.END, ""))[0])


def test_markers_find_their_place_or_die_together():
    old = "The {{highlight-start: a}}quick brown{{highlight-end: a}} fox jumps over the {{note-start: [b, 1]}}lazy{{note-end: [b, 1]}} dog again and again"
    new = "Now the quick, BROWN fox jumps over the lazy dog again and again"
    body, placed, dropped = carry.carry_markers(old, new)
    assert (placed, dropped) == (4, 0)
    assert "{{highlight-start: a}}quick, BROWN{{highlight-end: a}} fox" in body and "{{note-start: [b, 1]}}lazy{{note-end: [b, 1]}} dog" in body
    body, placed, dropped = carry.carry_markers(old, "Now the quick brown fox jumped elsewhere entirely")
    assert dropped >= 1 and "{{note" not in body


def test_articles_keep_prose_together_and_leave_furniture(spark):
    pages = [
        (1, '<body><article><p>He said <del>old</del> <ins>new</ins> things, <s>not</s> <strike>these</strike> but <em>those</em>.</p></article></body>', "He said old new things, not these but those."),
        (2, '<body><article><p>Prose that stays in place.</p><div class="x latest-posts y"><p>Teaser one here</p></div><div class="inline-recirc"><p>Teaser two here</p></div>'
            '<section data-mrf-recirculation="z"><p>Teaser three</p></section><p class="Newsletter">Case counts in class names.</p><div class="comments related"><p>A comment stays.</p></div></article></body>',
         "Prose that stays in place.\n\nCase counts in class names.\n\nA comment stays."),
        (3, '<head><meta property="og:title" content="Some Headline — The Site | A Motto"><meta property="og:site_name" content="The Site | A Motto"></head><body><article><h1>some  Headline</h1><p>The body of it all.</p></article></body>', "The body of it all."),
        (4, '<head><meta property="og:title" content="Another"></head><body><article><h1>Section One</h1><p>The body of it all.</p></article></body>', "# Section One\n\nThe body of it all."),
        (5, "<div>" * 5000 + "<b>" * 5000 + "deep words stay here" + "</b></div>" * 5000 + "</x>" * 20_000, "deep words stay here"),
    ]
    docs = spark.createDataFrame([(k, h, "http://s.org/x") for k, h, _ in pages], "k int, html string, url string")
    got = {r["k"]: r["text"] for r in html.articles(docs, "k").collect()}
    assert got == {k: t for k, _, t in pages}
    assert html.harvest_images(docs, "k").count() == 0


def test_images_keep_their_files():
    note = lambda **k: "<!--\nimage:\n" + "".join(f"  {a}: {b}\n" for a, b in k.items()) + "-->"
    old = "\n\n".join([note(file="a.png", alt="A"), note(file="b.png"), note(file="c.png", alt="C")])
    new = "x\n\n" + "\n\n".join([note(alt="A"), note(), note(alt="new"), note(file="d.png", alt="D")]) + "\n"
    body, paired, dropped, added = carry.carry_images(old, new)
    assert (paired, dropped, added) == (2, 1, 1)
    assert "  file: a.png\n  alt: A\n" in body and "  file: b.png\n" in body and "d.png" in body and body.rstrip().endswith(note(file="c.png", alt="C"))


def test_cloze_items_are_sound_and_repeatable(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(600)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "too short to ask"), (3, None), (4, "word " * 300)], "doc long, t string")
    got = carry.cloze(docs, "doc", "t", "s").collect()
    assert {r["doc"] for r in got} == {1, 4}  # one word alone leaves one answer
    got = [r for r in got if r["doc"] == 1]
    assert 5 < len(got) <= 30
    again = carry.cloze(docs.repartition(3), "doc", "t", "s").filter("doc = 1").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    places = sorted(words.index(r["answer"]) for r in got if words.count(r["answer"]) == 1)
    assert all(b - a > 9 for a, b in zip(places, places[1:]))
    for r in got:
        assert f"{r['before']} {r['answer']} {r['after']}" in " ".join(words) and len(r["answer"]) >= 4


# casing and marks


def test_casing(spark):
    df = spark.createDataFrame([("the nasa budget of us air force, usa",), (None,)], "t string")
    caser = casing.build_caser(["NASA", "US", "US Air Force"])
    assert [r[0] for r in df.select(caser(F.col("t"))).collect()] == ["the NASA budget of US Air Force, usa", None]
    assert df.select(casing.build_caser([])(F.col("t"))).first()[0].startswith("the nasa")


def cased_by_hand(text):
    """The terms wherever they stand between characters that are no part of a word."""
    out, i, part = [], 0, lambda c: c.isalnum() or c == "_"
    while i < len(text):
        for term in ("The OF", "AND"):
            end = i + len(term)
            if text[i:end].lower() == term.lower() and not (i and part(text[i - 1])) and not (end < len(text) and part(text[end])):
                out.append(term)
                i = end
                break
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_casing_of_every_document(spark, tmp_path):
    texts = {1: "salt and the of it", 2: "Käse and Brot, The of", 3: "éand andé ñ_and and\u00a0the OF", 4: "x " * 5000 + "é and", 5: "", 6: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["cased"] for r in extraction.casing_terms(spark, str(tmp_path)).collect()}
    assert got == {k: t if t is None else cased_by_hand(t) for k, t in texts.items()} and got[2] == "Käse AND Brot, The OF" and got[3] == "éand andé ñ_and AND\u00a0The OF"
    sf = "/root/testdata/sf0.01"
    want = {r["doc_id"]: cased_by_hand(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: r["cased"] for r in extraction.casing_terms(spark, sf).collect()} == want
    assert any(not t.isascii() for t in want.values())


def test_classification():
    banner, body = casing.reconcile(None, "(SECRET//NOFORN)\n# (U) Head\n(TOP SECRET) text (S) in line  x \n~~(SECRET//NOFORN)~~ end")
    assert banner == "SECRET//NOFORN"
    assert body == "\n# {{classification: U}} Head\n{{classification: TOP SECRET}} text (S) in line x\n end"
    assert casing.reconcile("X", "plain") == ("X", "plain") and casing.reconcile(None, None) == (None, None)


def test_marks_of_whole_documents(spark, tmp_path):
    texts = {1: "a" * 50 + " (SECRET//SI) x\n(S) y " + "z" * 3000, 2: "é" * 60 + "\n# (TS) Head (SECRET//NOFORN) end", 3: "short"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in extraction.classification_marks(spark, str(tmp_path)).collect()}
    for k, t in texts.items():
        top = "(SECRET//NOFORN) A.\n(U) B (TOP SECRET) c.\n~~(SECRET//NOFORN)~~\n"
        assert (got[k]["banner"], got[k]["body"]) == casing.reconcile("SECRET//NOFORN" if k % 2 == 0 else None, top + t)
    assert "{{classification: SECRET//SI}}" in got[1]["body"] and "\n{{classification: S}} y zz" in got[1]["body"] and got[1]["body"].endswith("z" * 3000)
    assert got[2]["body"].endswith("é\n# {{classification: TS}} Head end")


def test_titles_of_whole_texts(spark, tmp_path):
    spark.createDataFrame([(0, "word " * 40 + "null - end\nnone")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    row = records.titles(spark, str(tmp_path)).first()
    assert row["clean"] == "word " * 40 + "end" and row["slug"] == "-".join(["word"] * 12)


# mail


def test_header_has_the_whole_url(spark, tmp_path):
    urls = {1: "https://x.org/" + "a" * 60 + "?b=1&reg=2&lt=3", 2: "https://x.org/"}
    spark.createDataFrame(list(urls.items()), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["block"] for r in extraction.mail_headers(spark, str(tmp_path)).collect()}
    assert all(f'\n  subject: "{u}"\n' in got[k] for k, u in urls.items())


def test_headers(spark):
    raw = 'From: "Doe, J" <j@x.org>\nTo: a@x.org, B <A@X.ORG>\nCc:\nDate: Mon, 1 Jan 2024 10:00:00 +0200\nSubject: Hi "you"\nReferences: <1@x> <2@x>\nDKIM-Signature: v=1\n\nbody'
    df = spark.createDataFrame([(raw,), ("Date: Mon, 1 Jan 2024 10:00:00\n\nx",), (None,)], "r string").select(mail.parse_headers(F.col("r")).alias("h"))
    a, b, c = [r["h"] for r in df.collect()]
    assert (a["from_"]["name"], a["date"], a["subject"], a["references"], a["dkim"]) == ("Doe, J", "2024-01-01T10:00:00+02:00", 'Hi "you"', ["<1@x>", "<2@x>"], True)
    assert b["date"] is None and c["from_"] is None
    block = df.select(mail.render_headers(F.col("h"))).first()[0]
    assert block.split("\n")[:4] == ["email:", '  from: "Doe, J <j@x.org>"', "  to:", '    - "a@x.org"'] and '  subject: "Hi \\"you\\""' in block
    people = df.select(F.lit(1).alias("k"), "h.from_", "h.to", "h.cc").limit(1)
    from foliary.operators.audit import participants

    assert sorted((r["pos"], r["address"]) for r in participants(people, "k").collect()) == [(0, "j@x.org"), (1, "a@x.org")]


def test_embedded_message(spark):
    pages = ["<pre>code</pre><PRE class=x>From: a@x.org\nDate: Mon, 1 Jan 2024 10:00:00 +0000\n\n&lt;b&gt;</PRE>", "<p>From: a</p>", None]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in pages], "p string").select(mail.embedded_message(F.col("p"))).collect()]
    assert got[0].endswith("<b>") and got[1:] == [None, None]


def test_threads(spark):
    body = 'Top text.\n    deep\nOn Mon, 1 Jan 2024 10:00:00 +0000, "Doe, J" <j@x.org> wrote:\n> quoted one\n>> deeper\nOn some day Ann <ann@x.org> wrote:\n> older'
    df = spark.createDataFrame([("m", body, ("me@x.org", None))], "k string, body string, author struct<address:string,name:string>")
    got = mail.segment_thread(df, "k").orderBy("n").collect()
    assert [(r["author"]["address"], r["quoted"], r["said_at"]) for r in got] == [("me@x.org", False, None), ("j@x.org", True, "2024-01-01T10:00:00+00:00"), ("ann@x.org", True, None)]
    assert got[0]["text"] == "Top text.\ndeep" and got[1]["text"] == "quoted one\n> deeper" and got[2]["text"] == "On some day Ann <ann@x.org> wrote:\nolder"
    out = mail.render_thread(mail.segment_thread(df, "k"), "k").first()["body"]
    assert '<!-- message: {n: 2, from: "Doe, J <j@x.org>", date: "2024-01-01T10:00:00+00:00", quoted: true} -->' in out
    evil = spark.createDataFrame([("a --> b",)], "t string").select(mail.quote(F.col("t"))).first()[0]
    assert "-->" not in evil


# pages

PAGE = """<html><head><title>The Story | Site</title><meta property="og:title" content="The Story"><meta name="author" content="Ann"></head><body>
<nav><a href="/">home</a></nav><div class="sidebar">Buy things</div><div class="article-sidebar-content"><h1>The Story</h1><p>A <b>bold</b> start with a <a href="http://x.org">link</a>.</p>
<figure><img data-src="/img/p.jpg" src="data:x" alt="P"><figcaption>The cap</figcaption></figure><p>More text follows here.</p><ul><li>one</li></ul></div><aside><img src="/a.jpg"></aside>
<img src="/site-logo.png"><img src="/tiny.jpg" width="50"><img srcset="/big.jpg 2x, /b.jpg 1x" width="300"><footer>foot</footer></body></html>"""


def test_article(spark):
    page = spark.createDataFrame([(1, PAGE, "http://s.org/x")], "k int, html string, url string")
    assert html.articles(page, "k").first()["text"].startswith("A bold start with a [link](http://x.org).")  # the title's heading goes
    got = html.article(PAGE, "http://s.org/x")
    assert got["title"] == "The Story" and got["author"] == "Ann"
    assert got["text"].startswith("# The Story\n\nA bold start with a [link](http://x.org).") and "- one" in got["text"]
    assert not any(x in got["text"] for x in ("Buy things", "home", "foot"))
    assert html.article("<p>tiny</p>") is None and html.article("") is None and html.article("<div><p>unclosed but long enough") is not None


def test_images_of_a_page(spark):
    got = html.page_images(PAGE, "http://s.org/x/y")
    assert [(i["url"], i["alt"], i["caption"]) for i in got] == [("http://s.org/img/p.jpg", "P", "The cap"), ("http://s.org/big.jpg", None, None)]
    body = "Intro.\n\n![P](http://s.org/img/p.jpg)\n\nThe cap\n\nMore text follows here.\n"
    images = [{"url": "http://s.org/img/p.jpg", "file": "1.jpg", "alt": "P", "caption": "The cap", "anchor": ""}, {"url": "http://s.org/big.jpg", "file": "2.jpg", "alt": None, "caption": None, "anchor": "More text follows here."}]
    out = html.render_images(body, images)
    assert out == "Intro.\n\n<!--\nimage:\n  file: 1.jpg\n  alt: P\n  caption: The cap\n-->\n\nMore text follows here.\n\n<!--\nimage:\n  file: 2.jpg\n-->\n"
    bodies = spark.createDataFrame([(1, body), (2, "plain")], "k int, body string")
    rows = spark.createDataFrame([(1, n, i["url"], i["file"], i["alt"], i["caption"], i["anchor"]) for n, i in enumerate(images)], "k int, ord int, url string, file string, alt string, caption string, anchor string")
    assert {r["k"]: r["body"] for r in html.with_images(bodies, rows, "k").collect()} == {1: out, 2: "plain\n"}
    names = spark.createDataFrame([("image/png", "x", "png"), ("a/b", "http://x/y.GIF?z", "gif"), (None, "x", "bin")], "m string, u string, w string")
    assert all(r["g"] == r["w"] for r in names.select("w", html.image_extension(F.col("m"), F.col("u")).alias("g")).collect())


# books

CHAPTER = '<html xmlns:epub="e"><body><h1>Chapter {n}</h1><span epub:type="pagebreak" id="page{p}"/><p>W</p><p>Text ***** more<a href="notes.xhtml#n{n}"><sup>1</sup></a>. <a href="x.xhtml">inside</a></p></body></html>'


def epub():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        z.writestr("OPS/p.opf", '<package xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata><dc:title>Book</dc:title><dc:creator>Ann</dc:creator><dc:identifier>urn:isbn:9780306406157</dc:identifier></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/><item id="i" href="i.png" media-type="image/png"/><item id="t" href="t.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/><itemref idref="b"/><itemref idref="i"/></spine></package>')
        z.writestr("OPS/t.ncx", "<ncx><navMap><navPoint><navLabel><text>One</text></navLabel><content src='b.xhtml'/><navPoint><navLabel><text>Two</text></navLabel><content src='a.xhtml'/></navPoint></navPoint></navMap></ncx>")
        z.writestr("OPS/a.xhtml", CHAPTER.format(n=2, p=2))
        z.writestr("OPS/b.xhtml", CHAPTER.format(n=1, p=1))
        z.writestr("OPS/i.png", b"png")
    return out.getvalue()


def test_books(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(epub())
    (tmp_path / "y.epub").write_bytes(b"no zip")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in books.read_books(spark, str(tmp_path)).collect()}
    x = got["x.epub"]
    assert got["y.epub"]["title"] is None and x["title"] == "Book" and [c["file_name"] for c in x["chapters"]] == ["OPS/b.xhtml", "OPS/a.xhtml"]
    assert [(t["href"], t["title"]) for t in x["toc"]] == [("b.xhtml", "One"), ("a.xhtml", "Two")] and x["images"][0]["size_bytes"] == 3
    docs = books.read_books(spark, str(tmp_path)).select("path", F.explode("chapters").alias("c")).select("path", "c.*")
    made = books.chapters(docs, "path").orderBy("ordinal").collect()
    assert "<!-- printed_page: 1 -->" in made[0]["markdown"] and "{{redacted: ~1 words}}" in made[0]["markdown"] and "[^1]" in made[0]["markdown"] and "](x.xhtml)" not in made[0]["markdown"]
    assert made[0]["refs"] == ["notes.xhtml#n1"] and made[0]["heading"] == "Chapter 1"
    numbered = books.numbered(books.chapters(docs, "path").withColumn("toc_title", F.when(F.col("ordinal") == 1, "Part One")), "path")
    assert [(r["ordinal"], r["number"]) for r in numbered.orderBy("ordinal").collect()] == [(1, None), (2, 2)]


def test_page_sequences_that_start_again():
    page = lambda n: f"<!-- printed_page: {n} -->"
    got = books.mark_sequences(["".join(map(page, ["i", 1, 2, 3])), "".join(map(page, [1, 2])), "".join(map(page, [4, 3]))])
    assert got[0].count("sequence") == 0
    assert got[1].startswith("<!-- printed_page_sequence: 2 -->\n" + page(1))
    assert got[2] == "<!-- printed_page_sequence: 1 -->\n" + page(4) + "<!-- printed_page_sequence: 2 -->\n" + page(3)


def test_page_sequences_of_many_books_in_one_stream(spark):
    rng = random.Random(5)
    page = lambda n: f"<!-- printed_page: {n} -->"
    made = {k: ["".join(page(rng.randint(1, 4)) for _ in range(rng.randint(0, 3))) or None for _ in range(rng.randint(1, 9))] for k in [None, *range(40)]}
    rows = [(k, i, b) for k, bodies in made.items() for i, b in enumerate(bodies)]
    rng.shuffle(rows)
    df = books.disambiguate_pages(spark.createDataFrame(rows, "k long, ordinal int, markdown string"), "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "MapInArrow" in plan  # a call and a frame for each book took 118 s for 147,236 books
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # books go on in the next batch
    try:
        got = {(r["k"], r["ordinal"]): r["markdown"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(k, i): b for k, bodies in made.items() for i, b in enumerate(books.mark_sequences(bodies))}


def test_character_references_end_in_a_semicolon(spark):
    text = lambda s: html.Tree(s).root.text()
    assert text("a &amp; &quot;b&quot; &#38; &#x26; &eacute; &amp;amp") == 'a & "b" & & é &amp'
    assert [text(x) for x in ("R&&amp", "&quot", "&lt b", "&#38 b", "&copyright;", "&nosuch;", "A & B&", "\ufdd0&amp", "&ampx;")] == ["R&&amp", "&quot", "&lt b", "&#38 b", "&copyright;", "&nosuch;", "A & B&", "\ufdd0&amp", "&ampx;"]
    node = next(html.Tree('<a href="/x?a=1&copy=2&amp;b=3" title="&lt">y</a>').root.walk())
    assert node.attrs == {"href": "/x?a=1&copy=2&b=3", "title": "&lt"}
    assert next(html.Tree("<script>a &amp; b &lt c</script>").root.walk()).text() == "a &amp; b &lt c"
    cut = "<html><head><title>Bread &amp; butter &amp</title></head><body><article><h1>Bread &amp; butter &amp</h1><p>Enough of it to read, &amp; more.</p></article></body></html>"
    pages = spark.createDataFrame([(1, "http://a.example/p", cut)], "page_id long, url string, html string")
    assert [tuple(r) for r in html.articles(pages, "page_id").select("title", "text").collect()] == [("Bread & butter &amp", "Enough of it to read, & more.")]


def test_element_tests():
    tree = html.Tree('<a epub:type="noteref" href="x">1</a><a href="#n"><sup>2</sup></a><a href="http://x#n"><sup>3</sup></a><span role="doc-pagebreak" title="iv"/>').root
    nodes = [n for n in tree.walk() if n.tag in ("a", "span")]
    assert [books.is_note_reference(n) for n in nodes] == [True, True, False, False]
    assert [books.is_pagebreak(n) for n in nodes] == [False, False, False, True] and books.page_label(nodes[3]) == "iv"

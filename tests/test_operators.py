import random
from collections import Counter

from pyspark.sql import functions as F

from foliary.functions import text
from foliary.operators import audit, bags, dedup, evaluate, intervals, lifecycle, pages, quality, turns, validate


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# quality


def test_ocr_variants_by_brute_force(spark):
    rng = random.Random(1)
    nouns = {("d", "".join([rng.choice("ABE"), *(rng.choice("ceoailt") for _ in range(5))])): rng.randint(1, 6) for _ in range(300)}
    df = spark.createDataFrame([(k, n, c) for (k, n), c in nouns.items()], "k string, noun string, n long")
    pairs = {frozenset(p) for p in quality.CONFUSABLE}

    def like(a, b):
        d = [(x, y) for x, y in zip(a, b) if x != y]
        return len(a) == len(b) and 1 <= len(d) <= 2 and all(frozenset((x.lower() + y.lower())) in pairs for x, y in d)

    want = sorted((a, min(bs)) for (_, a), n in nouns.items() if n <= 2 and (bs := [b for (_, b), m in nouns.items() if m >= 2 and m > n and like(a, b)]))
    assert rows(quality.substitutions(df, "k"), "noun", "other") == want and want
    words = spark.createDataFrame([(want[0][0].lower(),)], "word string")
    assert rows(quality.substitutions(df, "k", words), "noun", "other") == want[1:]


def test_quality_counts_tell_zero_from_absent(spark):
    df = spark.createDataFrame([("a<!-- chapter: 1 -->� {{�}}", "ebook"), ("printed_page: 3", "pdf"), ("x", "web")], "b string, t string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in quality.measures(F.col("b"), F.col("t")).items()]).collect()]
    assert got == [(1, 1, 0, 0), (0, None, None, 1), (0, None, None, None)]


# bags


def test_words_gone(spark):
    old = "# Title\nkept word lost lost jammed note12 xiv gone7 <!--\nimage:\n  alt: picture words\n-->"
    new = "kept word injammedside note gone8"
    df = spark.createDataFrame([(1, old, new, "carried")], "k int, old string, new string, c string")
    assert rows(bags.words_gone(df, "k", "old", "new"), "word", "n") == [("gone7", 1), ("lost", 2), ("picture", 1), ("words", 1)]
    df = spark.createDataFrame([(1, "carried lost", "x", "carried")], "k int, old string, new string, c string")
    assert rows(bags.words_gone(df, "k", "old", "new", "c"), "word", "n") == [("lost", 1)]


def test_overlap_counts_multisets(spark):
    df = spark.createDataFrame([(1, "a a b c", "a b b d e")], "k int, r string, c string")
    assert rows(bags.overlap(df, "k", "r", "c"), "reference_words", "candidate_words", "shared", "precision_pct", "recall_pct") == [(4, 5, 2, 40.0, 50.0)]


def test_loss_bounds(spark):
    df = spark.createDataFrame([(10, False), (100, False), (1000, False), (1000, True)], "n long, r boolean")
    assert [r[0] for r in df.select(bags.loss_allowed(F.col("n"), F.col("r"))).collect()] == [5, 10, 30, 0]


# intervals


def made_tracks(seed, n):
    rng = random.Random(seed)
    out, t = [], 0.0
    for i in range(n):
        t += rng.choice([0.0, 1.0, 2.5, 30.0])
        out.append(("r", i, t, t + rng.choice([0.5, 3.0, 9.0]), f"S{rng.randint(0, 3)}"))
        t += rng.choice([0.0, 1.0])
    rng.shuffle(out)
    return [(k, i, s, e, p) for i, (k, _, s, e, p) in enumerate(out)]


def test_points_and_spans_by_brute_force(spark):
    for seed in range(3):
        tracks = made_tracks(seed, 40)
        rng = random.Random(seed)
        points = [("r", i, rng.uniform(-20, 500)) for i in range(150)] + [("r", 1000 + i, t[2]) for i, t in enumerate(tracks)] + [("r", 2000 + i, t[3]) for i, t in enumerate(tracks)]
        schema = "k string, ord long, start double, end double, speaker string"
        tdf = spark.createDataFrame(tracks, schema)

        def speaker(t):
            inside = [x for x in tracks if x[2] <= t <= x[3]]
            return inside[0][4] if inside else min(tracks, key=lambda x: (x[2] - t if x[2] > t else t - x[3], x[1]))[4]

        got = intervals.point_in_interval(spark.createDataFrame(points, "k string, point long, t double"), tdf, "k", 7.0)
        assert {r["point"]: (r["speaker"], r["inside"]) for r in got.collect()} == {p: (speaker(t), any(x[2] <= t <= x[3] for x in tracks)) for _, p, t in points}
        spans = [("r", i, s, s + rng.choice([0.0, 2.0, 40.0])) for i, s in enumerate(rng.uniform(0, 400) for _ in range(80))]
        want = {}
        for _, i, s, e in spans:
            ov, first = {}, {}
            for _, o, a, b, p in tracks:
                if s < b and a < e:
                    ov[p] = ov.get(p, 0) + min(e, b) - max(s, a)
                    first.setdefault(p, o)
            if ov:
                best = max(ov.values())
                want[i] = {p for p in ov if abs(ov[p] - best) < 1e-9}
        got = {r["span"]: r["speaker"] for r in intervals.overlap_majority(spark.createDataFrame(spans, "k string, span long, start double, end double"), tdf, "k", 7.0).collect()}
        assert got.keys() == want.keys() and all(got[i] in want[i] for i in want)


def test_unheard_gaps(spark):
    seg = spark.createDataFrame([("r", 0, 0.0, 10.0), ("r", 1, 14.0, 15.0), ("r", 2, 16.0, 17.0), ("r", 3, 30.0, 31.0), ("q", 0, 0.0, 1.0)], "k string, ord int, start double, end double")
    tr = spark.createDataFrame([("r", 9.0, 12.0), ("r", 15.0, 16.0), ("r", 20.0, 20.5), ("r", 25.0, 25.5)], "k string, start double, end double")
    assert rows(intervals.unheard_gaps(seg, tr, "k", width=2.0), "k", "gaps", "seconds") == [("q", 0, 0.0), ("r", 1, 2.0)]


# turns


def test_short_runs_fold_into_the_one_before(spark):
    def folded(labels, spans=None):
        w = spark.createDataFrame([("r", i, x, float(i), i + 1.0) for i, x in enumerate(labels)], "k string, i int, s string, a double, b double")
        out = turns.fold_short_runs(w, ["k"], ["i"], "s", F.col("a"), F.col("b"))
        return "".join(r["folded"] for r in out.orderBy("i").collect()), max(r["run"] for r in out.collect())

    assert folded("AAAAABAAAAA") == ("A" * 11, 1)  # a flicker
    assert folded("BAAAAA") == ("BAAAAA", 2)  # the first run stays
    assert folded("AAAABBBB") == ("AAAABBBB", 2)
    assert folded("AAAABBCCDDDD") == ("AAAAAAAADDDD", 2)


def test_sentence_clock(spark):
    df = spark.createDataFrame([(["Hello there.", "Hello again.", "Unheard."], [("hello", 1.0), ("there", 2.0), ("hello", 3.0), ("again", 4.0)], 0.5)], "s array<string>, w array<struct<text:string,start:double>>, t double")
    assert df.select(turns.sentence_starts(F.col("s"), F.col("w"), F.col("t"))).first()[0] == [1.0, 3.0, 0.5]


def test_turns_roster_and_rendering(spark):
    said = spark.createDataFrame([("r", 0, "B", "one", 0.0), ("r", 1, "B", " ", 1.0), ("r", 2, "B", "two", 2.0), ("r", 3, "A", "three", 3.5)], "k string, i int, s string, t string, at double")
    made = turns.build_turns(said, ["k"], ["i"], "s", "t", "at")
    assert rows(made, "turn", "speaker", "start", "n", "text") == [(1, "B", 0.0, 2, "one two"), (2, "A", 3.5, 1, "three")]
    assert rows(turns.roster(made, ["k"]), "speaker", "label", "first_time") == [("A", "[speaker 2]", 3.5), ("B", "[speaker 1]", 0.0)]
    line = F.array(F.concat(text.timecode(F.col("start"), True), F.lit(" "), F.col("text")))
    assert turns.render(made, ["k"], line).first()["body"] == "<!-- speaker: B -->\n00:00:00.0 one two\n\n<!-- speaker: A -->\n00:00:03.5 three\n"
    w = spark.createDataFrame([([("a", 1.0), ("b", 2.345)],)], "w array<struct<text:string,start:double>>")
    assert w.select(turns.word_line(F.col("w"))).first()[0] == "{{t:1.00}}a {{t:2.35}}b"


# evaluation


def test_two_track_sets_as_published(spark):
    # twelve words of two people; one track set hears one speaker, the other both
    truth = spark.createDataFrame([("r", f"{i:.2f}", "X" if i < 6 else "Y") for i in range(12)], "k string, t string, real string")
    words = [("r", i, float(i), "S0" if s == "one" or i < 6 else "S1", 0 if s == "one" or i < 6 else 1, s) for s in ("one", "two") for i in range(12)]
    df = spark.createDataFrame(words, "k string, ord int, start double, label string, turn int, strategy string")
    got = {}
    for s in ("one", "two"):
        pairs = evaluate.match_truth(df.filter(F.col("strategy") == s), truth, ["k"])
        got[s] = evaluate.attribution_errors(pairs, ["k"]).first()
    assert (got["one"]["word_error_pct"], got["one"]["turns"], got["one"]["wrong_turns"]) == (50.0, 1, 0)
    assert (got["two"]["word_error_pct"], got["two"]["turns"], got["two"]["wrong_turns"]) == (0.0, 2, 0)
    both = spark.createDataFrame([(s, got[s]["matched_words"], got[s]["wrong_words"], got[s]["turns"], got[s]["wrong_turns"]) for s in got], "strategy string, matched_words long, wrong_words long, turns long, wrong_turns long")
    assert evaluate.decide(both, "strategy", "two", "one").first()["adopt"] is True


def test_word_edit_distance(spark):
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    cases = [([rng.choice("abcd") * 2 for _ in range(rng.randint(0, 9))], [rng.choice("abcd") * 2 for _ in range(rng.randint(0, 9))]) for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a array<string>, b array<string>")
    got = df.select("i", evaluate.word_edit_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == [plain(a, b) for a, b in cases]


def test_pages_and_pairs_match_one_to_one(spark):
    a = spark.createDataFrame([("d", 1, "x"), ("d", 2, "y")], "k string, page int, text string")
    b = spark.createDataFrame([("d", 2, "y"), ("d", 3, "z")], "k string, page int, text string")
    assert rows(evaluate.match_pages(a, b, ["k", "page"]), "page", "side") == [(1, "missing"), (2, "both"), (3, "extra")]
    old = spark.createDataFrame([("d", "k", 1), ("d", "k", 2), ("d", None, 3), ("d", "m", 4)], "doc string, key string, o int")
    new = spark.createDataFrame([("d", "k", 10), ("d", None, 11), ("d", None, 12)], "doc string, key string, o int")
    got = {(r["old_ord"], r["new_ord"]) for r in evaluate.pair_one_to_one(old, new, "doc", "key", "o").collect()}
    assert got == {(1, 10), (2, None), (3, 11), (None, 12), (4, None)}


# pages


def test_page_sequences(spark):
    df = spark.createDataFrame([("file_page: 3 a file_page: 1", 2), ("file_page: 1 file_page: 1", 2), ("x", 2), ("file_page: 1", 3), ("file_page: 9", 3)], "b string, n int")
    m = pages.markers(F.col("b"))
    got = df.select(pages.renumber(F.col("b"), F.col("n")), pages.missing(m, F.col("n")), pages.impossible(m, F.col("n")), pages.shift(F.col("b"), F.lit(2))).collect()
    assert [r[0] for r in got] == ["file_page: 1 a file_page: 2", "file_page: 1 file_page: 2", "x", "file_page: 1", "file_page: 9"]
    assert [r[1] for r in got] == [[2], [2], [1, 2], [2, 3], [1, 2, 3]]
    assert [r[2] for r in got] == ["file_page 3 exceeds the 2-page document", "file_page numbers repeat: [1]", None, None, "file_page 9 exceeds the 3-page document"]
    assert got[0][3] == "file_page: 5 a file_page: 3"


def test_chapter_numbers_rise(spark):
    df = spark.createDataFrame([([(None, 1), (None, 1), (3, None), (None, 2), (None, 4)],)], "x array<struct<toc:int,body:int>>")
    assert df.select(pages.accepted_numbers(F.col("x"))).first()[0] == [1, None, 3, None, 4]


def test_lines(spark):
    body = "a\n<!-- irrelevant: start -->\nb\n<!-- irrelevant: end -->\nc <!-- x\ny -->\n\n<!-- irrelevant: start -->\nd"
    lines = pages.lines_of(spark.createDataFrame([("k", body)], "k string, b string"), "k", "b")
    got = pages.irrelevant(lines, "k").orderBy("line_no").collect()
    assert [r["inside"] for r in got] == [False, False, True, False, False, False, False, False, True]
    assert [r["closed"] for r in got if r["inside"]] == [True, False]
    share = pages.materialised_share(lines, "k").first()["share"]
    kept = "a\nc <!-- x\ny -->\n"
    assert abs(share - len(kept) / len(body)) < 1e-9
    noted = pages.annotation_lines(lines, "k").orderBy("line_no").collect()
    assert [r["inside_note"] for r in noted] == [False, False, False, False, True, True, False, False, False]
    assert [r["skippable"] for r in noted] == [False, True, False, True, False, False, True, True, False]
    assert rows(pages.layout(lines, "k"), "line_no", "letters") == [(1, "a"), (3, "b"), (5, "cx"), (6, "y"), (9, "d")]


# dedup, validation, lifecycle, audit


def test_identity(spark):
    store = spark.createDataFrame([("b", "h1", None), ("a", "h1", None), ("0", "h1", "new"), ("c", "", None)], "path string, source_hash string, superseded_by string")
    new = spark.createDataFrame([(1, "h1"), (2, ""), (3, "h9"), (4, None)], "id int, source_hash string")
    assert rows(dedup.known(new, store, "source_hash"), "id", "existing") == [(1, "a")]
    assert rows(dedup.unknown(new, store, "source_hash"), "id") == [(2,), (3,), (4,)]


def test_aliases_lose_blanks_and_no_digits(spark):
    schema = "path string, superseded_by string, a string, b string, c array<string>"
    store = spark.createDataFrame([("p", None, "http://x/0", " http://x/161", ["http://x/202 ", "http://x/33", None, " "]), ("q", None, "http://x/0", "1", []), ("r", "p", "http://x/9", None, [])], schema)
    bridge = dedup.alias_bridge(store, dedup.aliases([F.array("a"), F.array("b"), F.col("c")]))
    want = [("1", "q"), ("http://x/0", "p"), ("http://x/161", "p"), ("http://x/202", "p"), ("http://x/33", "p")]
    assert rows(bridge, "url", "path") == want
    asked = spark.createDataFrame([(1, "http://x/161"), (2, "http://x/16"), (3, "http://x/202"), (4, "http://x/20")], "id int, url string")
    assert rows(dedup.known_by_url(asked, bridge), "id", "existing") == [(1, "p"), (3, "p")]


def test_validation_messages(spark):
    m = {"schema": "record/1", "title": "t", "source_type": "pdf"}
    cases = [(m, []), ({}, [f"Missing required frontmatter field: {k}" for k in ("schema", "title", "source_type")]), (m | {"snapshots[1].captured_at": "2024"}, ["Invalid snapshots[1].captured_at: expected an RFC 3339 UTC timestamp ending in Z"]), (m | {"date_accessed": "2024-01-01T00:00:00+01:00", "copyright.expires": "2024-1-1"}, ["Invalid copyright.expires: expected YYYY-MM-DD"])]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, m map<string,string>")
    got = df.select("i", validate.field_errors(F.col("m"), "record/1").alias("e")).orderBy("i").collect()
    assert [r["e"] for r in got] == [e for _, e in cases]
    df = spark.createDataFrame([("```yaml\n---\na: 1\n---\nx\n```",), ("x",), ("---\na: 1",), ("---\na: 1\n---\nb",)], "c string")
    assert [r[0] for r in df.select(validate.structure_errors(F.col("c"))).collect()] == [["Content wrapped in code fence - should be stripped"], ["No YAML frontmatter found (must start with ---)"], ["Incomplete YAML frontmatter (missing closing ---)"], []]
    assert df.select(validate.strip_code_fences(F.col("c"))).first()[0] == "---\na: 1\n---\nx"
    df = spark.createDataFrame([('title: A: b "c"\nother: "q: r"\nx: plain',)], "f string")
    assert df.select(validate.quote_colons(F.col("f"))).first()[0] == 'title: "A: b \\"c\\""\nother: "q: r"\nx: plain'
    df = spark.createDataFrame([('<!-- message: {n: 1, date: "2024-01-01T00:00:00Z"} --> <!-- message: {n: 2, date: "2024"} -->',)], "b string")
    assert len(df.select(validate.body_errors(F.col("b"))).first()[0]) == 1
    df = spark.createDataFrame([({"title": " ", "x": "1", "source_url": "ftp:a", "copyright.status": "free"},)], "m map<string,string>")
    assert len(df.select(validate.metadata_errors(F.col("m"))).first()[0]) == 4


def test_protected_metadata(spark):
    df = spark.createDataFrame([({"title": "a", "processing.version": "1"}, {"title": "a", "processing.version": "2", "quality.x": "3"}), ({"title": "a"}, {"title": "b"})], "a map<string,string>, b map<string,string>")
    assert [r[0] for r in df.select(validate.protected_equal(F.col("a"), F.col("b"))).collect()] == [True, False]


def test_refresh_outcomes(spark):
    cases = [
        ((True, True, 1.0, 1.0, 0, 5, 0, False, [], True), (False, "unchanged")),
        ((True, False, 1.0, 1.0, 0, 5, 0, False, [], True), (True, "body unchanged, stamps brought up to date")),
        ((False, False, 1.0, 0.8, 0, 5, 0, False, [], True), (False, "refused: carrying the reviewer's irrelevant regions would leave 80% of the body materialising, against 100% before - a region has been placed over text it did not cover")),
        ((False, False, 1.0, 1.0, 6, 5, 0, False, [], True), (False, "refused: 6 word(s) of the stored body are absent from the fresh extraction (bound 5): ")),
        ((False, False, 1.0, 1.0, 0, 0, 2, True, [], True), (False, "refused: 2 of the reviewer's marker pair(s) have no home in the fresh extraction")),
        ((False, False, 1.0, 1.0, 0, 5, 0, False, ["bad"], True), (False, "refused: the refreshed record does not validate: bad")),
        ((False, False, 1.0, 1.0, 0, 5, 2, False, [], False), (False, "refused: declared content_hash is absent, malformed, or differs from the record path")),
        ((False, False, 1.0, 1.0, 5, 5, 2, False, [], True), (True, "refreshed in place")),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, u boolean, g boolean, a double, b double, l long, m long, p long, r boolean, e array<string>, id boolean")
    got = df.select("i", lifecycle.refresh_outcome(*[F.col(c) for c in ("u", "g", "a", "b", "l", "m", "p", "r", "e", "id")]).alias("o")).orderBy("i").collect()
    assert [tuple(r["o"]) for r in got] == [w for _, w in cases]


def test_canary_and_publication(spark):
    s = "struct<content_hash:string,schema:string,source_type:string,pipeline_version:int,carryover_from:string>"
    p = ("sha256:h", "record/1", "pdf", 1, None)
    cases = [(p, p, True, True, [], None), (p, ("sha256:x", *p[1:]), True, True, [], "content identity does not match the record path"), (p, (*p[:3], 9, None), True, True, [], "candidate does not declare the current extraction generation"), (p, p, False, True, [], "changed reviewed body has no valid review_carryover"), (p, (*p[:4], "h"), False, True, [], None), (p, p, True, False, [], "identity, provenance, rights, or curated metadata changed"), (p, p, True, True, ["e"], "candidate does not validate: e")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"i int, a {s}, b {s}, same boolean, prot boolean, e array<string>, w string")
    got = df.select("i", "w", lifecycle.canary_errors(F.col("a"), F.col("b"), F.lit("h"), F.lit(True), F.col("same"), F.col("prot"), F.col("e")).alias("g")).collect()
    assert all(r["g"] == r["w"] for r in got)
    t = lambda *x: spark.createDataFrame(list(x), "path string, digest string")
    assert rows(lifecycle.publishable(t(("a", "2"), ("b", "2"), ("c", "1")), t(("a", "1"), ("b", "1")), t(("a", "1"), ("b", "x"))), "path", "ok") == [("a", True), ("b", False), ("c", True)]


def test_stamps_and_snapshots(spark):
    fm = "struct<source_type:string,date_extracted:string,refresh_refused:struct<at:string>,processing:struct<version:string,pipeline_version:int,tools:array<struct<name:string,version:string>>>>"
    df = spark.createDataFrame([(("web", "old", ("x",), ("v0", 1, [("t", "1")])),)], f"fm {fm}")
    got = lifecycle.restamp(df, F.lit("now"), "v1", "2").first()["fm"].asDict(True)
    assert got == {"source_type": "web", "date_extracted": "now", "refresh_refused": None, "processing": {"version": "v1", "pipeline_version": 7, "tools": [{"name": "t", "version": "2"}]}}
    snap = "array<struct<role:string,hash:string>>"
    df = spark.createDataFrame([([("a", "1"), ("b", "2")], ("b", "9")), ([("a", "1")], ("b", "9")), (None, ("b", "9"))], f"s {snap}, e struct<role:string,hash:string>")
    got = df.select(lifecycle.replace_snapshot(F.col("s"), F.col("e")).alias("s")).select(lifecycle.snapshot_hash(F.col("s"), "b").alias("h"), F.size("s").alias("n")).collect()
    assert [(r["h"], r["n"]) for r in got] == [("9", 2), ("9", 2), ("9", 1)]
    df = spark.createDataFrame([([("x", 1)], ("x", 2)), ([("x", 1)], ("y", 2))], "a array<struct<sha256:string,n:int>>, e struct<sha256:string,n:int>")
    assert [r[0] for r in df.select(F.size(lifecycle.append_by_sha(F.col("a"), F.col("e")))).collect()] == [1, 2]
    df = spark.createDataFrame([("sha256:" + "a" * 64, "/s/" + "a" * 64 + ".v2.md"), ("sha256:" + "a" * 64, "/s/b.md"), (None, "x.md")], "h string, p string")
    assert [r[0] for r in df.select(lifecycle.identity_holds(F.col("h"), F.col("p"))).collect()] == [True, False, False]


def test_books_tables(spark):
    ids = spark.createDataFrame([("b", 0, "urn:uuid:12345678-1234-1234-1234-123456789012", None), ("b", 1, "978-0-306-40615-7", None), ("c", 0, "x9", "MOBI-ASIN"), ("c", 1, "10.1/x", "DOI"), ("d", 0, "plain", None)], "k string, ord int, value string, scheme string")
    assert rows(audit.pick_identifier(ids, "k"), "k", "identifier") == [("b", "isbn:9780306406157"), ("c", "doi:10.1/x"), ("d", "plain")]
    toc = spark.createDataFrame([("b", 0, "text/c1.xhtml#a", " One "), ("b", 1, "c1.xhtml", "Late"), ("b", 2, "c2.xhtml", "")], "k string, ord int, href string, title string")
    assert rows(audit.toc_titles(toc, "k"), "file_name", "toc_title") == [("c1.xhtml", "One")]
    refs = spark.createDataFrame([("b", 0, "t/c1.xhtml", "notes.xhtml#n1"), ("b", 1, "t/c1.xhtml", "#local"), ("b", 2, "t/c1.xhtml", "../x.xhtml#q")], "k string, ord int, file string, href string")
    anchors = spark.createDataFrame([("b", "t/notes.xhtml", "n1", "1. The  note"), ("b", "t/c1.xhtml", "local", "here"), ("b", "x.xhtml", "q", "far")], "k string, file string, id string, text string")
    assert rows(audit.resolve_notes(refs, anchors, "k"), "label", "note") == [(1, "The note"), (2, "here"), (3, "far")]
    spent = audit.notes_spent(spark.createDataFrame([("b", str(i), "t") for i in range(5)], "k string, id string, text string"), spark.createDataFrame([("b", str(i)) for i in range(4)], "k string, id string"), ["k"])
    assert spent.first()["spent"] is True


def test_probe_and_video_fields(spark):
    raw = '{"format": {"format_name": "ogg,oga", "bit_rate": "N/A", "duration": "12.5"}, "streams": [{"codec_type": "video"}, {"codec_type": "audio", "codec_name": "opus", "bit_rate": "64000", "sample_rate": "48000", "channels": 2}]}'
    assert tuple(spark.createDataFrame([(raw,)], "r string").select(audit.probe_fields(F.col("r")).alias("p")).first()["p"]) == ("opus", "ogg", 64000, 48000, 2, 12.5)
    cases = ['{"title": "T", "upload_date": "20240131", "duration": 0, "channel": "Ch", "id": "x", "extractor": "yt", "creators": ["ch", "Ann"]}', '{"upload_date": "2024", "duration": 3.5}', "{}"]
    got = [tuple(r["v"]) for r in spark.createDataFrame([(c,) for c in cases], "j string").select(audit.video_fields(F.col("j")).alias("v")).collect()]
    assert got == [("T", "2024-01-31", None, "Ch", None, "yt:x", ["Ann"]), (None, None, 3.5, None, None, None, None), (None,) * 7]


def test_containment_and_backfill(spark):
    lines = spark.createDataFrame([("d", 1, "x" * 100), ("d", 2, "abcdef"), ("d", 3, "abcdefgh")], "k string, line_no int, letters string")
    anchors = spark.createDataFrame([("d", 0, "x" * 40), ("d", 1, "abcd"), ("d", 2, "ab"), ("d", 3, "")], "k string, anchor int, letters string")
    assert rows(audit.containment(lines, anchors, "k"), "anchor", "line_no") == [(0, 1), (1, 2)]
    recs = spark.createDataFrame([("1", "audio", "Talk Ep. 3", None, None, None, "vorbis"), ("2", "web", "A", "article", "html", None, None), ("3", "pdf", "Form 9", None, None, ".PDF", None)], "record_hash string, source_type string, title string, document_type string, file_format string, archived_ext string, codec string")
    assert rows(audit.backfill_plan(recs), "record_hash", "add_format", "add_type", "strip_article") == [("1", "vorbis", "podcast", False), ("2", None, None, True), ("3", "pdf", "form", False)]


def test_bags_of_one_row_against_counters(spark):
    rng = random.Random(9)
    words = ["alpha", "beta", "gamma12", "gamma", "delta", "xiv", "epsilonzeta", "epsilon", "zeta", "é"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), " ".join(rng.choice(words[: rng.randint(1, 10)]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    df = spark.createDataFrame([*texts, (900, None, "a b"), (901, "a b", None), (902, None, None)], "k long, old string, new string")
    want = set()
    for i, old, new in [*texts, (901, "a b", "")]:
        there, letters = set(new.split()), "".join(new.split())
        for w, n in Counter(old.split()).items():
            if w not in there and w != "xiv" and not (w == "gamma12" and "gamma" in there) and not (len(w) >= 5 and w in letters):
                want.add((i, w, n))
    assert {tuple(r) for r in bags.words_gone(df, "k", "old", "new").collect()} == want
    got = {r["k"]: (r["reference_words"], r["candidate_words"], r["shared"]) for r in bags.overlap(df, "k", "old", "new").collect()}
    count = {i: (Counter((a or "").split()), Counter((b or "").split())) for i, a, b in [*texts, (900, None, "a b"), (901, "a b", None)]}
    assert got == {i: (a.total(), b.total(), (a & b).total()) for i, (a, b) in count.items() if a or b}


def test_wrong_ends_make_few_rows(spark):
    inf, nan = float("inf"), float("nan")
    tracks = [("r", 0, 0.0, 10.0, "A"), ("r", 1, 20.0, 1e15, "B"), ("r", 2, 5.0, inf, "C"), ("r", 3, nan, 7.0, "C"), ("r", 4, None, 7.0, "C"), ("r", 5, 15.0, 100_000.0, "D")]
    tdf = spark.createDataFrame(tracks, "k string, ord long, start double, end double, speaker string")
    assert intervals.spread(tdf, "start", "end", 1.0).count() < 300
    points = spark.createDataFrame([("r", 1, 5.0), ("r", 2, 16.0), ("r", 3, 1e12), ("r", 4, inf), ("r", 5, nan), ("r", 6, 90_000.0)], "k string, point long, t double")
    got = {r["point"]: (r["speaker"], r["inside"]) for r in intervals.point_in_interval(points, tdf, "k", 1.0).collect()}
    assert got == {1: ("A", True), 2: ("D", True), 3: ("B", True), 6: ("B", True)}
    spans = spark.createDataFrame([("r", 1, 0.0, 12.0), ("r", 2, 14.0, 18.0), ("r", 3, 16.0, 1e14), ("r", 4, 99_990.0, 99_999.0)], "k string, span long, start double, end double")
    got = {r["span"]: (r["speaker"], r["overlap"]) for r in intervals.overlap_majority(spans, tdf, "k", 1.0).collect()}
    assert got == {1: ("A", 10.0), 2: ("D", 3.0), 3: ("B", 1e14 - 20), 4: ("B", 9.0)}


def test_edit_distance_of_long_pages(spark):
    a = [f"w{i}" for i in range(9000)]
    b = a[:100] + ["x"] + a[100:4000] + a[4003:] + ["y", "z"]
    got = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(evaluate.word_edit_distance(F.col("a"), F.col("b"))).first()[0]
    assert got == 6

import json

import pytest
from pyspark.sql import functions as F

from foliary.operators import dedup, evaluate, intervals
from foliary.plans import upkeep
from foliary.sources import media, records, seams, sinks
from foliary.streaming import intake


def record(**fields):
    return "---\n" + "\n".join(f"{k}: {v}" for k, v in fields.items()) + "\n---\nbody --- rule\n"


def test_store_scan(spark, tmp_path):
    (tmp_path / "v1").mkdir()
    (tmp_path / "b.md").write_text(record(schema="record/1", title='"A: b"', date_published=2024, content_hash="sha256:b", source_type="web", creators="[x, y]", provenance="{source_url: http://p}"))
    (tmp_path / "a.v2.md").write_text(record(title="t", superseded_by="b", source_type="pdf"))
    (tmp_path / "c.md").write_text("no frontmatter")
    (tmp_path / "d.md").write_text("---\n- a list\n---\nx")
    (tmp_path / "v1" / "old.md").write_text(record(title="old", content_hash="sha256:o", source_type="web", also_published_at="[http://q, http://q]"))
    rows = {r["record_hash"]: r for r in records.read_store(spark, str(tmp_path)).collect()}
    assert rows.keys() == {"a", "b"} and rows["a"]["variant"] == "v2" and rows["a"]["stub"] and not rows["b"]["stub"]
    assert rows["b"]["fm"]["date_published"] == "2024" and rows["b"]["fm"]["creators[1]"] == "y" and rows["b"]["source_url"] == "http://p" and rows["b"]["body"] == "body --- rule\n"
    assert [r["record_hash"] for r in dedup.live(records.read_store(spark, str(tmp_path))).collect()] == ["b"]
    assert {r["root"] for r in records.read_generations(spark, str(tmp_path)).collect()} == {"store", "store/v1"}
    assert records.read_store(spark, str(tmp_path), recursive=True).count() == 3
    assert records.web_heads(records.read_store(spark, str(tmp_path))).count() == 1
    old = records.read_store(spark, str(tmp_path / "v1")).select(records.urls_of(F.col("fm")).alias("u")).first()["u"]
    assert old == ["http://q"]


def test_frontmatter_text(spark):
    df = spark.createDataFrame([("---\na: x --- y\nb: 1\n---\nbody",), ("none",)], "t string")
    assert [tuple(r[0]) for r in df.select(records.split(F.col("t"))).collect()] == [("a: x --- y\nb: 1", "body"), (None, None)]
    assert df.select(records.split_anywhere(F.col("t"))).first()[0]["frontmatter"] == "\na: x "
    fm = spark.createDataFrame([("a: 1\nb:\n  c: 2\n  d: 3\ne: 4",), ("a: 1",)], "f string")
    got = fm.select(records.replace_block(F.col("f"), "b", F.lit("b: 9")).alias("r"), records.replace_block(F.col("f"), "b", None).alias("d")).collect()
    assert [r["r"] for r in got] == ["a: 1\nb: 9\ne: 4", "a: 1\nb: 9"] and [r["d"] for r in got] == ["a: 1\ne: 4", "a: 1"]


def test_transcripts(spark, tmp_path):
    words = [{"word": " hi ", "start": 0.0, "end": 0.5}, {"word": "lost"}, {"word": "you", "start": 1.0, "end": 1.5}]
    track = lambda s, a, b: {"start": a, "end": b, "speaker": s, "track": "t"}
    data = {"schema": "x", "meta": {"a": "b"}, "whisperx": {"language": "en", "aligned": {"segments": [{"text": " hi you ", "start": 0.0, "end": 1.5, "words": words}, {"text": "x", "start": 2.0, "end": 3.0}]}}, "pyannote": {"model": "m", "tracks": [track("S0", 0.0, 3.0)], "exclusive_tracks": [track("S0", 0.0, 0.9), track("S1", 0.9, 3.0)]}, "reviewed_words": {"0.00": "Ann", "1.00": "Bob"}}
    (tmp_path / "h1.transcript.json").write_text(json.dumps(data))
    t = media.read_transcripts(spark, str(tmp_path))
    seg = media.segments(t).orderBy("ord").collect()
    assert [w["text"] for w in seg[0]["words"]] == ["hi", "you"] and seg[1]["words"] == []
    points = media.segments(t).select("stem", "ord", F.posexplode("words").alias("p", "w")).select("stem", (F.col("ord") * 1000 + F.col("p")).cast("long").alias("point"), ((F.col("w.start") + F.col("w.end")) / 2).alias("t"), "w.start")
    errors = {}
    for exclusive in (False, True):
        said = intervals.point_in_interval(points, media.tracks(t, exclusive).withColumn("ord", F.col("ord").cast("long")), "stem").join(points, ["stem", "point"])
        pairs = evaluate.match_truth(said.select("stem", F.col("point").alias("ord"), "start", F.col("speaker").alias("label"), F.lit(0).alias("turn")), media.truth(t), ["stem"])
        errors[exclusive] = evaluate.attribution_errors(pairs, ["stem"]).first()["word_error_pct"]
    assert errors == {False: 50.0, True: 0.0}


def test_reviewed_words(spark):
    body = ["<!-- speaker: Ann -->", "{{t:1.00}}hi {{t:2.50}}you", "<!-- speaker: [irrelevant] -->", "{{t:3.00}}ad", "<!-- speaker: Bob -->", "{{t:4.00}}bye"]
    lines = spark.createDataFrame([("r", i, x) for i, x in enumerate(body)], "k string, line_no int, text string")
    assert sorted((r["t"], r["real"]) for r in media.reviewed_words(lines, "k").collect()) == [("1.00", "Ann"), ("2.50", "Ann"), ("4.00", "Bob")]


def test_manifests_logs_and_archive(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "manifest.json").write_text(json.dumps({"source": "http://x", "asset": None, "error": "gone", "snapshots": [{"role": "single_file", "hash": "h"}]}, indent=2))
    r = media.read_manifests(spark, str(tmp_path / "m")).first()
    assert r["error"] == "gone" and r["snapshots"][0]["role"] == "single_file" and r["asset"] is None
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "one.log").write_text("x\nWritten: store/a.md\nWritten: store/a.md \n")
    (tmp_path / "logs" / "two.log").write_text("Written: a\nWritten: b\n")
    (tmp_path / "logs" / "none.log").write_text("nothing\n")
    got = {r["log"].rsplit("/", 1)[-1]: r for r in media.written_paths(spark, str(tmp_path / "logs")).collect()}
    assert got["one.log"]["path"] == "store/a.md" and got["two.log"]["error"] == "handler reported 2 different record paths" and got["none.log"]["n"] == 0
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "h1.opus").write_bytes(b"123")
    assert [tuple(r) for r in media.read_archive(spark, str(tmp_path / "arc")).collect()] == [("h1", "opus", 3)]
    (tmp_path / "t.yaml").write_text("terms:\n  a: [NASA, US]\n  b: [X]\ncandidates: [no]\n")
    assert media.read_terms(str(tmp_path / "t.yaml")) == ["NASA", "US", "X"]
    (tmp_path / "w.txt").write_text("Word\nword\n\nTwo\n")
    assert sorted(r[0] for r in media.read_wordlist(spark, str(tmp_path / "w.txt")).collect()) == ["two", "word"]


def test_choice_of_responses(spark):
    page = "<html>" + "x" * 2000
    rows = [
        ("http://a/p", "http", page, "text/html", "http://a/p"), ("http://a/p", "wayback", "<html>short", "text/html", "http://a/p"),
        ("http://b/p.pdf", "http", page, "text/html", "http://b/p.pdf"), ("http://c/p", "wayback", page, None, "http://c/"), ("http://c/p", "patchright", page, None, None),
        ("https://youtu.be/abcdefghijk", "http", page, "text/html", None), ("https://youtu.be/abcdefghijk", "ytdlp", "OggS", "audio/ogg", None), ("http://d/p", "http", None, None, None),
    ]
    df = spark.createDataFrame(rows, "url string, method string, content string, content_type string, final_url string")
    got = {r["url"]: r for r in seams.choose_response(df).collect()}
    assert {u: r["method"] for u, r in got.items()} == {"http://a/p": "http", "http://b/p.pdf": None, "http://c/p": "patchright", "https://youtu.be/abcdefghijk": "ytdlp", "http://d/p": None}
    assert got["http://b/p.pdf"]["error"].startswith("All fetch methods exhausted: rejected HTML (URL names application/pdf") and got["http://d/p"]["error"] == "All fetch methods exhausted"


def test_requests_of_one_url_choose_apart(spark):
    page = "<html>" + "x" * 2000
    rows = [(1, "http://a/p", "http", page), (1, "http://a/p", "patchright", page), (2, "http://a/p", "http", "<html>short"), (2, "http://a/p", "patchright", page), (3, "http://a/p", "http", None), (4, "http://b/p.pdf", "http", page), (5, "http://b/p.pdf", "other", page)]
    df = spark.createDataFrame(rows, "id int, url string, method string, content string").withColumns({"content_type": F.lit("text/html"), "final_url": F.lit(None).cast("string")})
    got = {r["id"]: r for r in seams.choose_response(df, "id").collect()}
    assert {k: (r["url"], r["method"]) for k, r in got.items()} == {1: ("http://a/p", "http"), 2: ("http://a/p", "patchright"), 3: ("http://a/p", None), 4: ("http://b/p.pdf", None), 5: ("http://b/p.pdf", None)}
    assert "rejected HTML" in got[4]["error"] and got[5]["error"] == got[3]["error"] == "All fetch methods exhausted"


def test_fetch_choice_keeps_pages_that_share_a_url(spark, tmp_path):
    pages = [(k, "http://a.example/p", "<html>" + "x" * 500 + str(k)) for k in range(8)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = [r["method"] for r in upkeep.fetch_choice(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == ["None", "None", "http", "http", "patchright", "patchright", "wayback", "wayback"]


def test_seams_take_callbacks_and_tables(spark):
    df = spark.createDataFrame([("W\nhile it", "a"), ("plain", "b")], "region string, id string")
    out = seams.inspect(df, lambda c: F.lit('{"issues": [{"type": "dropcap_split", "detail": "d"}]}')).collect()
    assert [(r["id"], r["issues"][0]["type"]) for r in out] == [("a", "dropcap_split")]
    assert seams.inspect(df, lambda c: F.lit("junk")).first()["issues"][0]["type"] == "other"
    images = spark.createDataFrame([("http://x/a.png",), ("http://x/b.png",)], "url string")
    media_ = spark.createDataFrame([("http://x/a.png", "data", "image/png")], "url string, content string, content_type string")
    assert [(r["url"], r["file"][-4:], r["size_bytes"]) for r in seams.attach_media(images, media_).collect()] == [("http://x/a.png", ".png", 4)]
    assert [r[0] for r in spark.createDataFrame([("api:x", False), ("v", True), ("v", False)], "m string, k boolean").select(seams.choose_provider(F.col("m"), F.col("k"))).collect()] == ["api", "vision", "claude-code"]


def test_sinks(spark, tmp_path):
    schema = "record_hash string, alias string, source_type string"
    old = spark.createDataFrame([("h1", "a1", "pdf")], schema)
    new = spark.createDataFrame([("h2", "a1", "pdf"), ("h1", "a1", "pdf"), ("h3", "a3", "web")], schema)
    refused = sinks.write_records(new, old, str(tmp_path / "store"))
    assert [r["record_hash"] for r in refused.collect()] == ["h2"]
    assert [(r["record_hash"], r["source_type"]) for r in spark.read.parquet(str(tmp_path / "store")).collect()] == [("h3", "web")]
    side = sinks.sidecars(spark.createDataFrame([("h", 5)], "record_hash string, size_bytes long"), spark.createDataFrame([("h", 2, "b", "c", "a"), ("h", 1, "x", "y", "z")], "record_hash string, id int, before string, after string, answer string"))
    assert [c["id"] for c in json.loads(side.first()["json"])["challenges"]] == [1, 2]
    good = ("12345678-1234-1234-1234-123456789012", "committed", "store/a.md", "sha256:" + "a" * 64, "b" * 40, "2024-01-01T00:00:00.000Z", None)
    rows = [good, ("X", *good[1:]), (*good[:2], "../a", *good[3:]), (*good[:1], "maybe", *good[2:])]
    df = spark.createDataFrame(rows, "run_uuid string, outcome string, record_path string, content_hash string, commit_sha string, completed_at string, schema string")
    got = sinks.receipts(df).collect()
    assert [r["error"] for r in got] == [None, "run_uuid must be a canonical lowercase UUID", "record_path must be a normalised relative POSIX path", "outcome must be committed or no-op"]
    keys = list(json.loads(got[0]["json"]))
    assert keys == sorted(keys)
    one = spark.createDataFrame([good], df.schema)
    sinks.write_receipts(one, str(tmp_path / "receipts"))
    with pytest.raises(Exception, match="result already exists"):
        sinks.write_receipts(one, str(tmp_path / "receipts"))
    plan = sinks.push_plan(spark.createDataFrame([("h1", "public_domain", "o1"), ("h2", "restricted", "o2"), ("h3", None, "o9")], "record_hash string, status string, original string"), spark.createDataFrame([("o1", "pdf"), ("o2", "opus")], "stem string, ext string"), spark.createDataFrame([("open", "sources/h1.pdf")], "zone string, key string"))
    assert sorted((r["record_hash"], r["zone"], r["action"]) for r in plan.collect()) == [("h1", "open", "exists"), ("h2", "gated", "would-push"), ("h3", "gated", "no-original")]
    sinks.write_report(df.select("run_uuid"), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 4


def test_intake_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda i, sid, t: json.dumps({"source": f"http://x/{i}", "source_id": sid, "fetched_at": t, "detected_type": "text/html"})
    (tmp_path / "in" / "a.json").write_text("\n".join([row(1, "s1", "2024-01-01T00:00:00Z"), row(2, "s1", "2024-01-01T01:00:00Z"), row(3, "known", "2024-01-01T00:00:00Z"), row(4, None, "2024-01-01T00:00:00Z"), json.dumps({"source": "x", "error": "e"})]))
    known = spark.createDataFrame([("known",)], "source_id string")
    admitted = intake.admit(intake.manifest_stream(spark, str(tmp_path / "in")), known)
    q = admitted.writeStream.format("memory").queryName("admitted").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(r["source_id"][:4] for r in spark.sql("SELECT source_id FROM admitted").collect())
    assert got == ["s1", "url:"]
    counts = intake.arrivals(spark.read.schema(intake.MANIFEST).json(str(tmp_path / "in")))
    assert sorted((r["detected_type"] or "", r["n"]) for r in counts.collect()) == [("text/html", 1), ("text/html", 3)]


def test_http_fetcher(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from foliary.sources.fetch import USER_AGENT, fetch_http

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/away":
                self.send_response(302)
                self.send_header("Location", "/file.pdf")
                self.end_headers()
                return
            self.send_response(404 if self.path == "/none" else 200)
            self.send_header("Content-Type", "text/html; charset=utf-8" if self.path == "/page" else "application/pdf")
            self.end_headers()
            self.wfile.write(b"%PDF " + self.headers["User-Agent"].encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    rows = spark.createDataFrame([(f"{base}{p}",) for p in ("/file.pdf", "/away", "/none", "/page")] + [("ftp://x",), ("http://127.0.0.1:1/x",), (None,), ("no url",)], "url string")
    got = {r["url"]: (r["content"], r["content_type"], r["final_url"]) for r in fetch_http(rows, timeout=5).collect()}
    server.shutdown()
    body = b"%PDF " + USER_AGENT.encode()
    assert len(got) == 8 and {u for u, r in got.items() if r != (None, None, None)} == {f"{base}/file.pdf", f"{base}/away"}
    assert bytes(got[f"{base}/file.pdf"][0]) == body and got[f"{base}/away"][1:] == ("application/pdf", f"{base}/file.pdf")

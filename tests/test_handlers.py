import json

from foliary.operators import books as B
from foliary.plans import handlers as H
from foliary.sources import media
from foliary.sources.schemas import MANIFEST

from .test_extraction import PAGE, epub


def manifests(spark, *rows):
    return spark.read.schema(MANIFEST).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def test_web(spark):
    m = manifests(spark, {"source": "https://s.gov/x", "asset_hash": "h1", "detected_type": "text/html", "fetched_at": "2024-01-01T00:00:00Z", "date_published": "20240102"}, {"source": "https://s.org/y", "asset_hash": "h2"})
    pages = spark.createDataFrame([("h1", PAGE), ("h2", "<p>no</p>")], "asset_hash string, html string")
    (r,) = H.web_records(m, pages).collect()
    assert r["errors"] == [] and r["title"] == "The Story"
    assert r["text"].startswith('---\nschema: record/1\ntitle: "The Story"\ndate_published: "2024-01-02"\nsource_type: web\nfile_format: html\n')
    assert "copyright:\n  status: public_domain\n" in r["text"] and "  pipeline_version: 7\n---\n\nA bold start" in r["text"]


def test_audio(spark, tmp_path):
    word = lambda t, a: {"word": t, "start": a, "end": a + 0.5}
    one = [word(w, i * 1.0) for i, w in enumerate("Hello there my dear friend.".split())]
    two = [word(w, 10.0 + i) for i, w in enumerate("Yes I am here now. Really so.".split())]
    track = lambda s, a, b: {"start": a, "end": b, "speaker": s}
    data = {"whisperx": {"aligned": {"segments": [{"text": " ".join(w["word"] for w in one + two), "start": 0.0, "end": 17.0, "words": one + two}, {"text": " ", "start": 18.0, "end": 19.0}, {"text": "Far away.", "start": 40.0, "end": 41.0}]}}, "pyannote": {"tracks": [track("B", 0.0, 6.0), track("A", 9.0, 20.0)]}}
    (tmp_path / "h1.transcript.json").write_text(json.dumps(data))
    t = media.read_transcripts(spark, str(tmp_path))
    m = manifests(spark, {"source": "f.ogg", "asset_hash": "h1", "detected_type": "audio/ogg", "title": "Talk (ft. Ann Lee)", "fetched_at": "2024-01-01T00:00:00Z"})
    (r,) = H.audio_records(m, t).collect()
    assert r["errors"] == [] and "duration: 41.0\n" in r["text"] and 'speakers:\n  - "Ann Lee"\n' in r["text"]
    body = r["text"].split("\n---\n\n", 1)[1]
    assert body == "<!-- speaker: [speaker 1] -->\n00:00:00.0 Hello there my dear friend.\n\n<!-- speaker: [speaker 2] -->\n00:00:10.0 Yes I am here now.\n00:00:15.0 Really so.\n00:00:40.0 Far away.\n"


def test_pdf(spark):
    m = manifests(spark, {"source": "a.pdf", "asset": "asset.pdf", "asset_hash": "h1", "detected_type": "application/pdf", "title": "Incident Report"}, {"source": "b.pdf", "asset": "b.pdf", "asset_hash": "h2", "detected_type": "application/pdf", "title": "x"})
    chunks = spark.createDataFrame([("h1", 4, 2, "---\nt: x\n---\n\n<!-- file_page: 1 -->\nc\n<!-- file_page: 2 -->\nd"), ("h1", 4, 0, "<!-- file_page: 1 -->\na\n<!-- file_page: 2 -->\nb"), ("h2", 1, 0, "<!-- file_page: 7 --> <!-- file_page: 8 -->")], "asset_hash string, page_count int, page_offset int, body string")
    got = {r["record_hash"]: r for r in H.pdf_records(m, chunks).collect()}
    assert got["h1"]["errors"] == [] and [f"file_page: {i}" in got["h1"]["text"] for i in range(1, 6)] == [True] * 4 + [False]
    assert "document_type: report\n" in got["h1"]["text"] and "detail: " in got["h1"]["text"]
    assert got["h2"]["errors"] == ["file_page 8 exceeds the 1-page document"]


def test_books(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(epub())
    over = spark.createDataFrame([("isbn:9780306406157", "Better Title", None, "1999")], "identifier string, title string, publisher string, date string")
    (r,) = H.book_records(B.read_books(spark, str(tmp_path)), over).collect()
    assert r["title"] == "Better Title" and r["errors"] == [] and 'date_published: "1999"' in r["text"]
    assert "<!-- chapter: 1 -->\n\n" in r["text"] and "<!-- chapter: 2 -->" in r["text"]  # a bare number is no title
    assert r["text"].index("printed_page: 1") < r["text"].index("printed_page: 2")


def test_worst(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "k string, n int")
    assert [r["k"] for r in H.worst(df, "n", "k", 2).collect()] == ["b", "c"]


def test_refresh(spark):
    good, other = "a" * 64, "b" * 64
    lines = [f"sentence number {i} of the stored body stands here" for i in range(12)]
    old = "\n".join([*lines[:4], "<!-- irrelevant: start -->", lines[4], "<!-- irrelevant: end -->", *lines[5:]]) + "\n"
    stored = [(h, f"/s/{h}.md", f"sha256:{h}", "web", d, r, "carried words", b) for h, d, r, b in ((good, 6, False, old), (other, 7, True, "\n".join(lines) + "\n"), ("c" * 64, 7, False, "same\n"), ("d" * 64, 7, False, "one two three four five six seven eight"))]
    df = spark.createDataFrame(stored, "record_hash string, path string, content_hash string, source_type string, declared int, reviewed boolean, carried string, body string")
    fresh = [(good, "\n".join(lines[:-1] + ["carried words instead"])), (other, "\n".join(lines[:-1])), ("c" * 64, "same"), ("d" * 64, "nothing of it")]
    new = spark.createDataFrame([(h, b, []) for h, b in fresh], "record_hash string, body string, introduced array<string>")
    got = {r["record_hash"][0]: r for r in H.refresh(df, new).collect()}
    assert got["c"]["reason"] == "unchanged" and not got["c"]["written"]
    assert got["a"]["written"] and got["a"]["reason"] == "refreshed in place" and got["a"]["regions"] == 1 and "<!-- irrelevant: start -->\n\n" + lines[4] in got["a"]["body"]
    assert got["b"]["reason"].startswith("refused: 1 word(s) of the stored body are absent from the fresh extraction (a reviewed record keeps every word): 11") and got["b"]["body"] is None
    assert got["d"]["reason"].startswith("refused: 8 word(s)") and "(bound 5): eight five" in got["d"]["reason"]

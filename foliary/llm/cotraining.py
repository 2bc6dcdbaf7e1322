"""Quality classification by co-training two views of a document.

One classifier sees the text's content (hashed byte trigrams and shares of kinds of characters and words), the other its
page metadata (source, language, declared and measured sizes, line layout). Both start from the labelled rows that serve
for learning. In every round each scores all unlabelled rows of the table and hands the other a set number of those it is
surest of (the top `SHARE` of all rows by its odds, in the proportion of the classes) as pseudo-labelled examples. Then
each view is calibrated on labelled rows that neither has learned from, their calibrated log-odds are combined on the same
rows, a third fold of labelled rows sets the threshold, and all documents are scored.

The views of all rows are written once (about 700 bytes a row) and read twice a round: once for the histogram of odds,
once for the rows to hand over. The driver holds `max_labelled` labelled rows and 2 * `exchange` more a round.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize, sample_hash, sample_limit

GRAMS, SOURCES, LANGS = 256, 48, 12
N_TEXT, N_META = GRAMS + 10, SOURCES + LANGS + 6
_BLOCK = 1 << 20
#: Share of all unlabelled rows that a view counts as its surest in a round; and the share of the calibration fold's rows,
#: of so many at least that luck is below LUCK, beyond the odds of such rows that must bear the label: a view that is sure
#: but wrong teaches nothing.
SHARE, RIGHT, LEAST, LUCK = 0.05, 0.99, 10, 0.01
#: Share of the bad documents of the threshold's fold that the threshold may keep.
MOST_BAD = 0.05
#: Bins of a histogram of log-odds from -ODDS to ODDS.
ODDS, ODDS_BINS = 15.0, 1200
LEARN, CALIBRATE, DECIDE = 0, 1, 2


def text_view(text: bytes) -> np.ndarray:
    """Square roots of trigram shares, and shares of kinds of characters and words, of a whole text."""
    out = np.zeros(N_TEXT, np.float32)
    if not text:
        return out
    grams, kinds = np.zeros(GRAMS, np.int64), np.zeros(256, np.int64)
    for at in range(0, len(text), _BLOCK):
        b = np.frombuffer(text[at : at + _BLOCK + 2], np.uint8)
        kinds += np.bincount(b[:_BLOCK], minlength=256)
        if len(b) > 2:
            w = b.astype(np.uint32)
            h = (w[:-2] * np.uint32(0x9E3779B1) + w[1:-1] * np.uint32(0x85EBCA77) + w[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)
            grams += np.bincount((h ^ (h >> np.uint32(8))) & np.uint32(GRAMS - 1), minlength=GRAMS)
    words = text.split()
    n, m = len(text), max(len(words), 1)
    out[:GRAMS] = np.sqrt(grams / max(n - 2, 1))
    upper, lower, digit = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    symbols = kinds[[35, 36, 37, 38, 42, 60, 62, 124]].sum()
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[GRAMS:] = [
        upper / max(upper + lower, 1),
        digit / n * 5,
        min(symbols / m, 2.0),
        kinds[[33, 63]].sum() / m,
        len(set(words)) / m,
        math.log1p(m) / 10,
        min((n - kinds[32]) / m / 20, 2.0),
        1 - len(set(lines)) / max(len(lines), 1),
        kinds[kinds.nonzero()[0]].max() / n,
        kinds[128:].sum() / n,
    ]
    return out


def meta_view(source: str | None, lang: str | None, n_chars: int | None, n_bytes: int, n_lines: int) -> np.ndarray:
    """Hashed source and language, declared and measured sizes and line layout."""
    out = np.zeros(N_META, np.float32)
    out[zlib.crc32(repr(source).encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32(repr(lang).encode()) % LANGS] = 1
    chars = n_chars if n_chars is not None and n_chars >= 0 else 0
    out[SOURCES + LANGS :] = [n_chars is None, math.log1p(chars) / 10, math.log1p(n_bytes) / 10, min(n_bytes / max(chars, 1), 4) / 4, math.log1p(n_lines) / 5, math.log1p(n_bytes / max(n_lines, 1)) / 10]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, steps: int = 400, rising: bool = False) -> np.ndarray:
    """Weights and, last, the bias of a ridge logistic regression, by Adam over all rows; rising: no weight is negative."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    share, ridge = weight / weight.sum(), np.r_[np.full(x.shape[1] - 1, decay), 0]
    for i in range(1, steps + 1):
        g = x.T @ (share * (sigmoid(x @ w) - y)) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (1 - 0.9 * i / steps) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        if rising:
            w[:-1] = np.maximum(w[:-1], 0)
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def odds_of(x: np.ndarray, fit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Log-odds of good quality by one view; fit: mean, spread and weights."""
    mean, spread, w = fit
    return np.clip(logit(np.clip((x - mean) / spread, -6, 6), w), -ODDS, ODDS)


@dataclass
class CoModel:
    """For each view its fit, and slope and offset of its calibration; then weights of the combination.

    threshold: the score that a document needs to be kept: the least, up to a half, by which at most MOST_BAD of the bad
    documents of the fold that serves nothing else would be kept; a half if that cannot be had.
    """

    views: list[tuple[tuple, np.ndarray]]
    joint: np.ndarray
    exchanged: list[int]
    threshold: float = 0.5

    def score(self, texts: np.ndarray, metas: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: by text, by metadata, combined."""
        odds = np.column_stack([odds_of(x, fit) * cal[0] + cal[1] for x, (fit, cal) in zip((texts, metas), self.views)])
        return sigmoid(odds[:, 0]), sigmoid(odds[:, 1]), sigmoid(logit(odds, self.joint))


def sure(odds: np.ndarray, label: np.ndarray) -> dict[int, float]:
    """For each class the least log-odds beyond which RIGHT of the rows bear it, LEAST rows at least and more if as many in a row are likely by luck; ODDS and more if there are none."""
    out = {}
    for y in (0, 1):
        order = np.argsort(-odds if y else odds, kind="stable")
        n, rate = np.arange(1, len(order) + 1), float(np.clip((label == y).mean(), 0.01, 0.99))
        ok = np.flatnonzero((np.cumsum(label[order] == y) >= RIGHT * n) & (n >= max(LEAST, math.log(LUCK) / math.log(rate))))
        edge = odds[order[ok[-1]]] if len(ok) else (ODDS + 1) * (1 if y else -1)
        at = (edge + ODDS) / (2 * ODDS) * ODDS_BINS  # outwards to the edge of a bin
        out[y] = float((np.ceil(at) if y else np.floor(at)) * 2 * ODDS / ODDS_BINS - ODDS)
    return out


def cuts(histograms: np.ndarray, rate: float, least: list[dict[int, float]]) -> dict[tuple[int, int], tuple[float, int]]:
    """For each view and class the odds beyond which lie its surest rows, and how many do; histograms: (view, bin) counts; least: `sure` of each view."""
    out = {}
    edges = np.linspace(-ODDS, ODDS, ODDS_BINS + 1)
    for view, h in enumerate(histograms):
        for y, part in ((1, rate), (0, 1 - rate)):
            outermost = np.cumsum(h[::-1] if y else h)
            k = max(1, int(np.searchsorted(outermost, SHARE * part * h.sum(), "right")))  # so many whole bins hold no more than the share
            edge = max(edges[ODDS_BINS - k], least[view][1]) if y else min(edges[k], least[view][0])
            inside = h[edges[:-1] >= edge - 1e-9] if y else h[edges[1:] <= edge + 1e-9]
            out[view, y] = (float(edge), int(inside.sum()))
    return out


def bins(odds: np.ndarray) -> np.ndarray:
    return np.clip(((odds + ODDS) / (2 * ODDS) * ODDS_BINS).astype(np.int64), 0, ODDS_BINS - 1)


def beyond(odds: np.ndarray, edge: float, y: int) -> np.ndarray:
    """Rows whose bin lies beyond the edge, which is a bin's."""
    at = round((edge + ODDS) / (2 * ODDS) * ODDS_BINS)
    return bins(odds) >= at if y else bins(odds) < at


#: What a round gets of the unlabelled rows: given the fits, the number of rows wanted of each class, the share of good
#: ones and the least odds of sure ones, the two views of some of the surest rows for each view and class.
Pool = Callable[[list, dict[int, int], float, list], dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]]


def co_train(views: list[np.ndarray], label: np.ndarray, fold: np.ndarray, pool: Pool, rounds: int = 4, exchange: int = 600) -> CoModel | None:
    """views: labelled rows in each view; label: 1 or 0; fold: LEARN, CALIBRATE or DECIDE. None without both classes in the first two.

    Of `exchange` rows that a view hands over in a round each class has its share among the labels, ten at least.
    """
    learn, keep = fold == LEARN, fold == CALIBRATE
    if any(len(set(label[part].tolist())) < 2 for part in (learn, keep)):
        return None
    stats = [(x[learn].mean(axis=0), np.maximum(x[learn].std(axis=0), 1e-3)) for x in views]
    given = [[(x[learn], label[learn], np.ones(int(learn.sum())))] for x in views]  # what each view learns from
    rate, fits, exchanged = float(label[learn].mean()), [], []
    for turn in range(rounds + 1):
        fits = []
        for (mean, spread), examples in zip(stats, given):
            x, y, w = map(np.concatenate, zip(*examples))
            fits.append((mean, spread, logistic(np.clip((x - mean) / spread, -6, 6), y.astype(float), w)))
        if turn == rounds:
            break
        moved, want = 0, {k: max(10, round(exchange * part)) for k, part in ((1, rate), (0, 1 - rate))}
        least = [sure(odds_of(x[keep], fit), label[keep]) for x, fit in zip(views, fits)]
        for (me, y), rows in pool(fits, want, rate, least).items():
            n = len(rows[0])
            if n:
                given[1 - me].append((rows[1 - me], np.full(n, y), np.full(n, 0.5)))
                moved += n
        exchanged.append(moved)
    odds = [odds_of(x, fit) for x, fit in zip(views, fits)]
    y, one = label[keep].astype(float), np.ones(int(keep.sum()))
    cal = [logistic(o[keep][:, None], y, one, 1e-4, rising=True) for o in odds]
    joint = logistic(np.column_stack([o[keep] * c[0] + c[1] for o, c in zip(odds, cal)]), y, one, 1e-4, rising=True)
    model = CoModel(list(zip(fits, cal)), joint, exchanged)
    bad = np.sort(model.score(*(x[(fold == DECIDE) & (label == 0)] for x in views))[2])
    if len(bad):
        model.threshold = min(0.5, float(np.nextafter(bad[-1 - int(MOST_BAD * len(bad))], 1)))
    return model


def _inputs(docs: DataFrame) -> DataFrame:
    """The columns that the views need, with text as bytes; columns that a table lacks are null."""
    own = lambda c, kind: (F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(c)
    return docs.select(own("doc_id", "long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), own("source", "string"), own("lang", "string"), own("n_chars", "long"))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = [x.as_py() for x in batch.column(1)]
    metas = [meta_view(s, g, n, len(t), t.count(b"\n") + 1) for t, s, g, n in zip(texts, *(batch.column(i).to_pylist() for i in (2, 3, 4)))]
    return np.array([text_view(t) for t in texts]).reshape(-1, N_TEXT), np.array(metas).reshape(-1, N_META)


def fold_of(doc_id: Column) -> Column:
    """Of the labelled rows half to learn from, a quarter to calibrate, a quarter to set the threshold, by hash of the id."""
    return F.element_at(F.array(*map(F.lit, (LEARN, LEARN, CALIBRATE, DECIDE))), F.pmod(F.xxhash64(F.lit("fold"), doc_id), F.lit(4)).cast("int") + 1)


def views_of(docs: DataFrame) -> DataFrame:
    """(doc_id, h, t, m) for each row with an id: its sample hash and its two views as float16 bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                raw = [pa.array([r.tobytes() for r in v.astype(np.float16)], pa.binary()) for v in _views(part)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(5), *raw], ["doc_id", "h", "t", "m"])

    base = _inputs(docs).filter("doc_id is not null").withColumn("h", sample_hash("sample", F.col("doc_id")))
    return base.mapInArrow(each, "doc_id long, h long, t binary, m binary")


def _arrays(texts, metas) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x), np.float16).reshape(len(x), n).astype(np.float32) for x, n in ((texts, N_TEXT), (metas, N_META))]


def table_pool(rows: DataFrame, known: DataFrame) -> Pool:
    """The Pool of all rows of a table of `views_of` whose ids are not in `known` (_id).

    Of the surest rows those with the smallest hashes are handed over, twice as many being fetched as are wanted, since
    some may be labelled; of rows with one id the least counts.
    """

    def pool(fits: list, want: dict[int, int], rate: float, least: list) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros((2, ODDS_BINS), np.int64)
            for b in batches:
                for view, x in enumerate(_arrays(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    count[view] += np.bincount(bins(odds_of(x, fits[view])), minlength=ODDS_BINS)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count.reshape(-1)[at])], ["bin", "n"])

        found = rows.select("t", "m").mapInArrow(histogram, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # 2 * ODDS_BINS rows at most
        count = np.zeros(2 * ODDS_BINS, np.int64)
        for r in found:
            count[r["bin"]] = r["n"]
        edge = cuts(count.reshape(2, -1), rate, least)
        limit = {k: sample_limit(2 * want[k[1]], n) for k, (_, n) in edge.items()}

        def surest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x, h = _arrays(b.column(2).to_pylist(), b.column(3).to_pylist()), b.column(1).to_numpy()
                for (view, y), (cut, _) in edge.items():
                    at = pa.array(np.flatnonzero(beyond(odds_of(x[view], fits[view]), cut, y) & (h < limit[view, y])))
                    part = pa.RecordBatch.from_arrays([c.take(at) for c in b.columns], ["doc_id", "h", "t", "m"])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), 2 * view + y)), *part.columns], ["kind", "doc_id", "h", "t", "m"])

        near = rows.select("doc_id", "h", "t", "m").mapInArrow(surest, "kind long, doc_id long, h long, t binary, m binary")
        near = near.groupBy("kind", "doc_id", "h").agg(F.min(F.struct("t", "m")).alias("x"))  # repeated rows meet before any shuffle
        got = near.select("kind", "doc_id", "h", "x.t", "x.m").toPandas().sort_values(["kind", "h", "doc_id"], kind="stable")  # about 4 * want + 64 of each kind
        ids = rows.sparkSession.createDataFrame([(int(d),) for d in set(got.doc_id)], "_got long")
        labelled = {r[0] for r in known.join(F.broadcast(ids), F.col("_id") == F.col("_got"), "left_semi").collect()}
        got = got[~got.doc_id.isin(labelled)]
        out = {}
        for view, y in edge:
            part = got[got.kind == 2 * view + y].head(want[y])
            out[view, y] = tuple(_arrays(part.t.tolist(), part.m.tolist()))
        return out

    return pool


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8_000, exchange: int = 600, rounds: int = 4) -> CoModel | None:
    """A model from the `max_labelled` labelled rows with the smallest hashes of their ids, and from all unlabelled rows.

    Labels other than 0 and 1, null ids and ids without a row say nothing; of labels that disagree on an id the worse one
    counts, of rows that share one the least. None if the labels cannot support both views.
    """
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("int").alias("label"))
    rows = materialize(views_of(docs), "views")
    h = sample_hash("sample", F.col("_id"))
    chosen = known.filter(h < sample_limit(max_labelled, known.count())).orderBy(h, "_id").limit(max_labelled)  # so many rows at most, so a broadcast bears them
    labelled = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "label").agg(F.min(F.struct("t", "m")).alias("x"))
    got = labelled.select("doc_id", "label", fold_of(F.col("doc_id")).alias("fold"), "x.t", "x.m").toPandas().sort_values("doc_id", kind="stable")
    model = None
    if len(got):
        model = co_train(_arrays(got.t.tolist(), got.m.tolist()), got.label.to_numpy(), got.fold.to_numpy(), table_pool(rows, known), rounds, exchange)
    forget(rows)
    return model


def score(docs: DataFrame, model: CoModel | None) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) for each row; kept is score >= the model's threshold. Without a model scores are null and all is kept.

    Null and empty texts are scored like any other, and null metadata is a value of its own. Whole texts are read, however
    long; repeated rows repeat; an empty table gives an empty result. Other columns, whatever their names, are ignored.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                scores = model.score(*_views(part)) if model else [[None] * part.num_rows] * 3
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(s, pa.float64()) for s in scores]], ["doc_id", "text_score", "meta_score", "score"])

    out = _inputs(docs).mapInArrow(each, "doc_id long, text_score double, meta_score double, score double")
    return out.withColumn("kept", F.coalesce(F.col("score") >= (model.threshold if model else 0.0), F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, max_labelled: int = 8_000, exchange: int = 600, rounds: int = 4) -> DataFrame:
    """Train, and score every row of `docs`; see `train` and `score` for odd rows."""
    return score(docs, train(docs, labels, max_labelled, exchange, rounds))

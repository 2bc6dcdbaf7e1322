"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of `WINDOW` bytes. Over each window one recurrent network runs forwards and one backwards; at
every position their states together give a probability for each language. A document's probabilities are the means of
those at its letter positions over the whole text. The network is trained here, in numpy, by backpropagation through time
on whole texts of a bounded sample: the `per_lang` rows of each language with the smallest hashes of their ids, for the
`max_langs` most frequent languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import sample_hash, sample_limit

WINDOW, HIDDEN, BATCH = 64, 8, 2048
#: Bytes as the network sees them: ASCII letters in lower case; and which of them are letters or parts of one.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
LETTER = np.array([97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])


class ByteGru:
    """Two gated recurrent networks and a softmax at every position. Parameters are float32 arrays by name."""

    def __init__(self, langs: list[str], params: dict[str, np.ndarray] | None = None, seed: int = 7):
        self.langs, rng, h = langs, np.random.default_rng(seed), HIDDEN
        draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.p = params or {
            **{f"{d}{k}": v for d in "fb" for k, v in (("x", draw(256, 3 * h, s=0.3)), ("u", draw(h, 3 * h, s=0.35)), ("c", np.zeros(h, np.float32)))},
            "o": draw(2 * h, len(langs), s=0.3),
            "a": np.zeros(len(langs), np.float32),
        }

    def _run(self, way: str, data: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (time, unit, row) of one direction; data: (time, row) bytes. Units come first so that gates lie together."""
        x, u, c, h = self.p[way + "x"].T.copy(), self.p[way + "u"].T.copy(), self.p[way + "c"][:, None], HIDDEN
        steps, n = data.shape
        out, state, kind = np.empty((steps, h, n), x.dtype), np.zeros((h, n), x.dtype), x.dtype
        a, g, index = np.empty((3 * h, n), kind), np.empty((3 * h, n), kind), data.astype(np.intp)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            np.take(x, index[t], axis=1, out=a, mode="clip")
            np.matmul(u, state, out=g)
            gate, inner, new = a[: 2 * h], g[2 * h :], a[2 * h :]
            gate += g[: 2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            z, r = gate[:h], gate[h:]
            inner += c
            if trace is not None:
                trace.append((t, state, z.copy(), r.copy(), inner.copy()))
            inner *= r
            new += inner
            np.tanh(new, out=new)
            if trace is not None:
                trace[-1] += (new.copy(),)
            np.subtract(state, new, out=out[t])
            out[t] *= z
            out[t] += new
            state = out[t]
        return out

    def _probabilities(self, both: np.ndarray) -> np.ndarray:
        logit = np.matmul(self.p["o"].T, both)
        logit += self.p["a"][:, None]
        logit -= logit.max(axis=1, keepdims=True)
        np.exp(logit, out=logit)
        logit /= logit.sum(axis=1, keepdims=True)
        return logit

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (time, language, row) at every position."""
        return self._probabilities(np.concatenate([self._run("f", data), self._run("b", data)], axis=1))

    def gradient(self, data: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss and its gradient; weight: (time, row), label: row."""
        traces: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(d, data, traces[d]) for d in "fb"], axis=1)
        err = self._probabilities(both)
        total, rows, h = max(float(weight.sum()), 1.0), np.arange(data.shape[1]), HIDDEN
        loss = -float((weight * np.log(err[:, label, rows] + 1e-9)).sum()) / total
        err[:, label, rows] -= 1
        err *= (weight / total)[:, None, :]
        grad = {"o": np.einsum("thn,tcn->hc", both, err), "a": err.sum(axis=(0, 2))}
        back = np.matmul(self.p["o"], err)
        for i, d in enumerate("fb"):
            u = self.p[d + "u"]
            gx, gu, gc = np.zeros_like(self.p[d + "x"]), np.zeros_like(u), np.zeros_like(self.p[d + "c"])
            carry = np.zeros((h, data.shape[1]), back.dtype)
            for t, before, z, r, inner, new in reversed(traces[d]):
                s = back[t, i * h : (i + 1) * h] + carry
                dn = s * (1 - z) * (1 - new * new)
                dz = s * (before - new) * z * (1 - z)
                dr = dn * inner * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r])
                np.add.at(gx, data[t], np.concatenate([dz, dr, dn]).T)
                gu += before @ dg.T
                gc += dg[2 * h :].sum(axis=1)
                carry = s * z + u @ dg
            grad |= {d + "x": gx, d + "u": gu, d + "c": gc}
        return loss, grad

    def fit(self, data: np.ndarray, label: np.ndarray, owner: np.ndarray, steps: int = 300, size: int = 192, rate: float = 0.02, seed: int = 3) -> list[float]:
        """Adam over random batches of windows (row, WINDOW) of texts `owner`, which ascend; returns the losses.

        Languages are drawn alike, then texts of one alike, then windows of one alike, wherever in the text they lie.
        """
        rng, losses = np.random.default_rng(seed), []
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        length = np.diff(np.r_[first, len(owner)])
        texts = [np.flatnonzero(label[first] == k) for k in range(len(self.langs))]
        for i in range(1, steps + 1):
            text = np.array([texts[k][int(x * len(texts[k]))] for k, x in zip(rng.integers(0, len(texts), size), rng.random(size))])
            pick = first[text] + (rng.random(size) * length[text]).astype(np.int64)
            part = np.ascontiguousarray(FOLD[data[pick]].T)
            loss, grad = self.gradient(part, LETTER[data[pick]].T.astype(np.float32), label[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            pace = rate * min(1.0, i / 20) * (1 - 0.9 * i / steps)
            for k, g in grad.items():
                g = g / max(1.0, norm)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return losses

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (text, language) over the letter positions of whole texts; zeros where there is none."""
        out, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for owner, data in windows(texts):
            prob = self.positions(np.ascontiguousarray(FOLD[data].T))
            weight = LETTER[data].T.astype(np.float32)
            np.add.at(out, owner, np.einsum("tn,tcn->nc", weight, prob))
            np.add.at(letters, owner, weight.sum(axis=0))
        return out / np.maximum(letters, 1)[:, None]


def windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bytes) of all windows of whole texts, BATCH at a time; the last of a text is filled up with zeros."""
    owners: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    held = 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), BATCH * WINDOW):
            piece = t[at : at + BATCH * WINDOW]
            n = -(-len(piece) // WINDOW)
            data = np.zeros(n * WINDOW, np.uint8)
            data[: len(piece)] = np.frombuffer(piece, np.uint8)
            parts.append(data.reshape(n, WINDOW))
            owners.append(np.full(n, i))
            held += n
            if held >= BATCH:
                yield np.concatenate(owners), np.concatenate(parts)
                owners, parts, held = [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(parts)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's digits leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_lang: int = 256, max_langs: int = 256, steps: int = 300) -> ByteGru | None:
    """A network learned from rows with a lang, an id and a text that are not held out; None if there are none.

    The driver holds whole texts of `per_lang` rows of each of `max_langs` languages at most, whatever the size of the
    table. Of rows with one id the least text counts. Ties of hashes go by id, ties of languages' sizes by name.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    usable = usable.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") > 0) & ~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    return _fitted(_sample(usable, {r["lang"]: r["n"] for r in sizes}, per_lang), steps)


def _sample(usable: DataFrame, sizes: dict[str, int], per_lang: int) -> DataFrame:
    """(lang, doc_id, text) of the ids with the `per_lang` smallest hashes of each language in `sizes` (ids by language, about)."""
    if not sizes:
        return usable.select("lang", "doc_id", "text").limit(0)
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, sample_limit(per_lang, n))])
    near = usable.withColumn("h", sample_hash("language", F.col("doc_id"))).filter(F.col("h") < F.element_at(limit, F.col("lang")))
    near = near.groupBy("lang", "doc_id", "h").agg(F.min("text").alias("text"))  # repeated rows meet before any shuffle
    order = W.partitionBy("lang").orderBy("h", "doc_id")  # about 2 * per_lang + 64 rows
    return near.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= per_lang).select("lang", "doc_id", "text")


def _fitted(sample: DataFrame, steps: int) -> ByteGru | None:
    got = sample.select("lang", "doc_id", F.col("text").cast("binary").alias("text")).toPandas()
    if not len(got):
        return None
    got = got.sort_values(["lang", "doc_id"], kind="stable")
    langs = sorted(set(got.lang))
    model = ByteGru(langs)
    owner, data = map(np.concatenate, zip(*windows([bytes(t) for t in got.text])))
    model.fit(data, got.lang.map(langs.index).to_numpy()[owner], owner, steps)
    return model


def predict(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row: the likeliest language by the pooled probabilities, ties by name.

    `und` with score 0 if the text is null or has no letter, or if there is no model. Texts are read whole, however long,
    window by window. Repeated rows repeat, a null id stays null, an empty table gives an empty result. Other columns,
    whatever their names, are ignored.
    """
    langs, params = (model.langs, model.p) if model else ([], {})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = ByteGru(langs, params) if langs else None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                lang, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                some = np.flatnonzero(part.column(3).to_numpy(zero_copy_only=False))
                if net and len(some):
                    prob = net.documents([part.column(2)[i].as_py() for i in some.tolist()])
                    best = prob.argmax(axis=1)
                    score[some] = np.clip(prob[np.arange(len(some)), best], 0, 1)
                    for i, k in zip(some.tolist(), best.tolist()):
                        lang[i] = langs[k]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(each, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, per_lang: int = 256, max_langs: int = 256, steps: int = 300) -> DataFrame:
    """Train on a bounded sample of `docs` and predict every row of it; see `train` and `predict` for odd rows."""
    return predict(docs, train(docs, per_lang, max_langs, steps))

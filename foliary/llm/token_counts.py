"""Token counts of a sentence-piece BPE model by rank-synchronous merging of ragged numpy arrays.

Texts are cut into pre-tokens where no piece of the vocabulary can reach across: before a blank that follows something
else, and at line feeds. The distinct pre-tokens of a batch lie end to end in one array of symbols; each round finds the
lowest-rank pair of every pre-token and merges it in all of them at once, until no pair is left. What survives counts
one token each, or one per byte where the vocabulary lacks the character. Counts of pre-tokens seen before are kept.

A long pre-token is first cut between neighbours that no piece of the vocabulary holds side by side, since no merge can
join them. What is still long is merged alone, by the same rule: its pairs lie in buckets by rank, the lowest bucket is
merged from the left, and only pairs next to a merge are looked up again, so the work grows with the length.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Distinct pre-tokens whose counts a task keeps, and characters of new ones merged at a time.
KEPT, ROUND_CHARS = 400_000, 1 << 18
#: Symbols beyond which a pre-token is cut, and what is left of it merged by buckets.
LONG = 256


class RankMerger:
    """Counts tokens of pre-tokens (blanks already written as BLANK)."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in ids]
        scores = np.array([model.get_score(i) for i in ids])
        self.place = {p: k for k, p in enumerate(pieces)}
        order = np.unique(-scores)
        rank = np.searchsorted(order, -scores)
        self.chars = {p: k for p, k in self.place.items() if len(p) == 1}
        if any(c not in self.chars for p in pieces for c in p):
            raise ValueError("a piece has a character that is no piece")
        if any("\n" in p and len(p) > 1 or re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("pieces reach across pre-tokens")
        made = [(self.place[p[:c]], self.place[p[c:]], k) for p, k in self.place.items() for c in range(1, len(p)) if p[:c] in self.place and p[c:] in self.place]
        left, right, to = np.array(made, np.int64).T
        self.size = len(pieces) + 1
        key = left * self.size + right
        by_key = np.argsort(key)
        self.keys, self.to = key[by_key], to[by_key]
        self.rank = np.append(rank, 1 << 30)
        # after such a merge a pair of lower rank can turn up, or another piece has the same rank: one place at a time
        early = self.rank[to] <= np.maximum(self.rank[left], self.rank[right])
        tied = np.append(np.bincount(rank)[rank] > 1, False)
        self.careful = tied.copy()
        self.careful[np.concatenate([left[early], right[early]])] = True
        self.blank_pieces = {len(p): k for p, k in self.place.items() if p.strip(BLANK) == ""}
        if any(p.startswith(BLANK * 2) and p.strip(BLANK) for p in pieces) or any(rank[k] < rank.max() for n, k in self.blank_pieces.items() if n > 1):
            raise ValueError("several blanks join a word, or each other before the words are done")
        self.runs = {0: 0}
        beside = {(self.chars[a], self.chars[b]) for p in pieces for a, b in zip(p, p[1:])}
        self.beside = np.sort(np.array([a * self.size + b for a, b in beside], np.int64))
        self.merge = dict(zip(self.keys.tolist(), self.to.tolist()))

    def _pairs(self, sym: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The piece that each symbol makes with the next, or -1."""
        key = sym[:-1] * self.size + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(same & (self.keys[at] == key), self.to[at], -1)

    def count(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each pre-token (none is empty), and whether its first symbol is a blank that nothing joined."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        text = "".join(pretokens)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        values, inverse = np.unique(points, return_inverse=True)
        known = np.array([self.chars.get(chr(v), -1) for v in values.tolist()], np.int64)
        n_bytes = np.where(values < 0x80, 1, np.where(values < 0x800, 2, np.where(values < 0x10000, 3, 4)))
        sym, weight = known[inverse], np.where(known < 0, n_bytes, 1)[inverse]
        sym[sym < 0] = self.size - 1  # pairs with nothing
        owner = np.repeat(np.arange(len(pretokens)), lengths)
        first = np.cumsum(lengths) - lengths
        # parts: whole pre-tokens, or what lies between the cuts of a long one
        new = np.zeros(len(sym), bool)
        new[first] = True
        at = np.flatnonzero((lengths[owner] > LONG) & ~new)
        pair = sym[at - 1] * self.size + sym[at]
        near = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
        new[at[self.beside[near] != pair]] = True
        part = np.cumsum(new) - 1
        size = np.bincount(part, minlength=int(part[-1]) + 1 if len(part) else 0)
        out, big = np.zeros(len(pretokens), np.int64), size[part] > LONG
        lead = sym[first].copy() if len(first) else sym
        for k in np.flatnonzero(size > LONG).tolist():
            lo, hi = np.searchsorted(part, [k, k + 1]).tolist()
            left, head = self._buckets(sym[lo:hi].tolist())
            out[owner[lo]] += int(weight[lo:hi][left].sum())
            if lo == first[owner[lo]]:
                lead[owner[lo]] = head
        small = np.flatnonzero(~big)
        if len(small):
            whole, merged = self._rounds(sym[small], part[small])
            np.add.at(out, owner[small][whole], weight[small][whole])
            heads = np.flatnonzero(np.isin(small, first))
            lead[owner[small[heads]]] = merged[heads]
        return out, lead == self.chars[BLANK]

    def _rounds(self, sym: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the symbols that survive in parts that lie end to end, and the symbols as merged."""
        seq, live, gone_ = np.cumsum(np.r_[0, part[1:] != part[:-1]]), np.arange(len(sym)), []
        sym, parts = sym.copy(), int(len(part) and np.sum(part[1:] != part[:-1]) + 1)
        while len(live) > 1:
            s, q = sym[live], seq[live]
            to = self._pairs(s, q[1:] == q[:-1])
            rank = np.append(np.where(to >= 0, self.rank[to], 1 << 30), 1 << 30)
            start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            low = np.minimum.reduceat(rank, start)
            n = np.diff(np.append(start, len(q)))
            best = np.repeat(low, n)
            hit = (rank == best) & (best < 1 << 30)
            # of neighbouring hits every other one, from the left; of careful ones the first in its part
            at = np.flatnonzero(hit)
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) > 1], np.arange(len(at)), 0))
            ok = (np.arange(len(at)) - run) % 2 == 0
            first = np.r_[True, q[at][1:] != q[at][:-1]] if len(at) else ok
            ok &= first | ~self.careful[to[at]] if len(at) else ok
            if len(at) and (first & self.careful[to[at]]).any():  # a careful first hit goes alone
                alone = np.zeros(parts, bool)
                alone[q[at][first & self.careful[to[at]]]] = True
                ok &= first | ~alone[q[at]]
            at = at[ok]
            sym[live[at]] = to[at]
            gone = np.zeros(len(live), bool)
            gone[at + 1] = True
            # a part that has nothing left to merge leaves the round
            done = best == 1 << 30
            gone_.append(live[done])
            live = live[~gone & ~done]
        return np.concatenate([*gone_, live]), sym

    def _buckets(self, sym: list[int]) -> tuple[list[int], int]:
        """Places of the symbols of one part that survive, and the first of them as merged. Buckets hold places by rank; a place whose pair has changed since is passed over."""
        n, size, merge, ranks = len(sym), self.size, self.merge, self.rank.tolist()
        left, right, piece = list(range(-1, n - 1)), list(range(1, n + 1)), [-1] * n
        buckets: dict[int, list[int]] = {}
        order: list[int] = []

        def offer(i: int) -> None:
            j = right[i]
            piece[i] = to = merge.get(sym[i] * size + sym[j], -1) if j < n else -1
            if to >= 0:
                rank = ranks[to]
                if rank not in buckets:
                    buckets[rank] = []
                    heapq.heappush(order, rank)
                heapq.heappush(buckets[rank], i)

        for i in range(n):
            offer(i)
        while order:
            rank = order[0]
            held = buckets[rank]
            while held and order[0] == rank:  # a merge may open a lower bucket, which goes first
                i = heapq.heappop(held)
                if piece[i] < 0 or ranks[piece[i]] != rank:
                    continue
                j = right[i]
                sym[i], piece[j], right[i] = piece[i], -1, right[j]
                if right[i] < n:
                    left[right[i]] = i
                sym[j] = -1
                offer(i)
                if left[i] >= 0:
                    offer(left[i])
            if not held:
                del buckets[rank]
                if order[0] == rank:
                    heapq.heappop(order)
                else:
                    order.remove(rank)
                    heapq.heapify(order)
        return [i for i in range(n) if sym[i] >= 0], sym[0]

    def blanks(self, n: int) -> int:
        """Tokens of n blanks in a row: all their merges have one rank, so the leftmost pair goes first."""
        if n not in self.runs:
            stack: list[int] = []
            for _ in range(n):
                stack.append(1)
                while len(stack) > 1 and stack[-1] + stack[-2] in self.blank_pieces:
                    stack[-2:] = [stack[-1] + stack[-2]]
            self.runs[n] = len(stack)
        return self.runs[n]


class TokenCounter:
    def __init__(self, proto: bytes):
        self.merger, self.seen = RankMerger(proto), {}
        self.cut = re.compile(f"\n|(?:{BLANK})+[^{BLANK}\n]*|[^{BLANK}\n]+")

    def pretokens(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall(BLANK + text.replace(" ", BLANK))

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.pretokens(t) for t in texts]
        if len(self.seen) > KEPT:
            self.seen = {}
        new = list(dict.fromkeys(p for c in cut for p in c if p not in self.seen))
        at, room = 0, 0
        for i, p in enumerate(new):
            room += len(p)
            if room > ROUND_CHARS or i + 1 == len(new):
                self._learn(new[at : i + 1])
                at, room = i + 1, 0
        seen = self.seen
        return [sum([seen[p] for p in c]) for c in cut]

    def _learn(self, new: list[str]) -> None:
        # of several blanks only the last can join a word; it belongs to the run if the word leaves it alone
        bare = [p.lstrip(BLANK) for p in new]
        n, alone = self.merger.count([BLANK + w if p[0] == BLANK else w for p, w in zip(new, bare)])
        for p, w, k, free in zip(new, bare, n.tolist(), alone.tolist()):
            run = len(p) - len(w)
            if run > 1:
                k += self.merger.blanks(run) - 1 if free else self.merger.blanks(run - 1)
            self.seen[p] = k


@lru_cache(maxsize=2)
def _counter(proto: bytes) -> TokenCounter:
    return TokenCounter(proto)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row.

    A null text counts as empty, an empty text has no token; long texts are counted whole, with or without blanks. Repeated
    rows repeat, a null id stays null, an empty table gives an empty result; other columns, whatever their names, are ignored.
    """

    proto = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # the model, half a megabyte

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(proto.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n = counter.counts([x.as_py() or "" for x in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", n_bytes).mapInArrow(each, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

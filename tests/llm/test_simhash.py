import random
import re

import numpy as np
import xxhash

from foliary.llm import simhash as S
from foliary.llm.components import connected_components


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(codes, radius=2):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def clustered(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)[:n]


def test_forest_finds_all_and_only_close_codes():
    codes = np.array(clustered(600, 1), np.uint64)
    group = np.sort(np.random.default_rng(1).integers(0, 7, len(codes)))
    forest = S.GrayForest(codes, group)
    got = set()
    for q, hit in forest.search(codes, np.searchsorted(forest.roots, group), 2):
        got |= set(zip(q.tolist(), hit.tolist()))
    n = len(codes)
    want = {(i, j) for i in range(n) for j in range(n) if group[i] == group[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= 2}
    assert got == want


def test_links_keep_components_even_when_groups_are_split(spark):
    codes = clustered(700, 2)
    base = random.Random(3).getrandbits(64)
    codes = sorted({*codes, *(base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(0, 64, 7))})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in codes], "fp long")
    for cap in (20_000, 40):
        roots = {r["node"] & (2**64 - 1): r["root"] for r in connected_components(S.links(df, 2, cap)).collect()}
        want = components(codes)
        named = {}
        for code, w in zip(codes, want):
            got = roots.get(code, code - (1 << 64) if code >> 63 else code)
            assert named.setdefault(w, got) == got
        assert len(set(named.values())) == len(set(want))


def test_chain_of_links_is_one_component(spark):
    edges = spark.range(200).selectExpr("id as u", "id + 1 as v")
    got = connected_components(edges).collect()
    assert len(got) == 201 and {r["root"] for r in got} == {0}


def test_whole_table_against_brute_force(small):
    docs = small.toPandas()
    got = S.near_duplicates(small).toPandas().set_index("doc_id")
    codes = [plain(t) for t in docs.text]
    root = components(codes)
    least = {}
    for d, r in zip(docs.doc_id, root):
        least[r] = min(d, least.get(r, d))
    for d, c, r in zip(docs.doc_id, codes, root):
        assert (got.fingerprint[d], got.component_id[d]) == (f"{c:016x}", least[r])


def test_odd_rows(odd, none):
    got = S.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    blank = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in blank} == {3} and len(blank) == 4
    kept = S.keep_one_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 6, 7]
    assert S.near_duplicates(none).count() == 0 and S.keep_one_each(none).count() == 0


def test_a_fingerprint_that_most_rows_share(spark, monkeypatch):
    docs = spark.range(2000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same few words for all of these', concat('unlike ', id, ' ', id * 7, ' ', id * 13)) as text")
    want = sorted(map(tuple, S.near_duplicates(docs).collect()))
    monkeypatch.setattr(S, "HOT_ROWS", 100)
    monkeypatch.setattr(S, "HOT_SHARE", 10)
    assert sorted(map(tuple, S.near_duplicates(docs).collect())) == want

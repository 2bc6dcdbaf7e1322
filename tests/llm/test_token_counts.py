import random
import time

import public_tokenizers
import pytest
import sentencepiece

from foliary.llm.token_counts import TokenCounter, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_counts_are_the_library_s(model):
    rng = random.Random(5)
    texts = ["", " ", "  ", "   a", "a   ", "a\nb\n\n c", "x" * 500, "ab" * 3000, "a" * 5001, " " * 3000, "▁▁ x▁", "é\x00q\U0001f600", "<s></s><unk>", "\t\tif  (x ==  y)  {", "日本語 テスト"]
    texts += ["".join(rng.choice("abcetnsr  \n▁.,é日=-_123") for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    texts += ["".join(rng.choice("abcetnsri") for _ in range(3000)) for _ in range(10)]
    assert TokenCounter(open(PATH, "rb").read()).counts(texts) == [len(x) for x in model.encode(texts)]


def test_long_texts_without_blanks(model):
    rng = random.Random(6)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    lower, base64 = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [draw(lower, 100_000), draw("aeinrst", 100_000), draw("ab", 100_000), draw(base64, 100_000), draw("日本語中文字é", 50_000), "ab" * 50_000, "a" * 100_000, "the" * 30_000, "=" * 50_000, "0123456789" * 10_000, "x " + draw("etaoin", 30_000) + "  y"]
    texts += [draw("aeinrst-=", rng.randint(240, 700)) for _ in range(200)]
    began = time.perf_counter()
    got = TokenCounter(open(PATH, "rb").read()).counts(texts)
    assert time.perf_counter() - began < 60
    assert got == [len(x) for x in model.encode(texts)]


def test_table_and_odd_rows(small, odd, none, model):
    docs = small.toPandas()
    got = count_tokens(small, PATH).toPandas().set_index("doc_id")
    for d, t in zip(docs.doc_id, docs.text):
        n = len(model.encode(t))
        assert tuple(got.loc[d]) == (len(t.encode()), n, n > 4096)
    rows = count_tokens(odd, PATH).collect()
    assert len(rows) == odd.count() and {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] in (3, 4)} == {(0, 0, False)}
    assert count_tokens(none, PATH).count() == 0

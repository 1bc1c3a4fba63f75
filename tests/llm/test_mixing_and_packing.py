import hashlib
import math
import zlib
from collections import Counter

import numpy as np
from llm_fixtures import edges, empty, make  # noqa: F401
from quarterline.llm import mixing, packing
from quarterline.llm.queries import tokenizer_path


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def draws(rate, u):
    p = total = math.exp(-rate)
    k = 0
    while total <= u and k < 1000:
        k += 1
        p *= rate / k
        total += p
    return k


def test_counts_are_inverse_poisson(make, spark):
    docs = make([(i, "x" * (1 + i % 50)) for i in range(400)], sources={i: ["a", "b", None][i % 3] for i in range(400)})
    rates = spark.createDataFrame([("a", 0.3), ("b", 1.0), (None, 25.0)], "source string, rate double")
    out = mixing.replicate(docs, rates).collect()
    want = {i: draws([0.3, 1.0, 25.0][i % 3], uniform(i, 17)) for i in range(400)}
    assert Counter(r.doc_id for r in out) == Counter({i: k for i, k in want.items() if k})
    assert {(r.doc_id, r["__copy"]) for r in out} == {(i, c) for i, k in want.items() for c in range(k)}
    assert all(abs(r["__place"] - uniform(r.doc_id, r["__copy"], 18)) < 1e-15 for r in out)


def test_rates_reach_the_target(make, edges, empty):
    docs = make([(i, "x" * 10) for i in range(90)] + [(100 + i, "y" * 10) for i in range(10)] + [(200, None)], sources={**{100 + i: "b" for i in range(10)}, 200: "none"})
    rates = {r.source: (r.chars, r.rate) for r in mixing.source_rates(docs, 0.0).collect()}
    assert rates["a"][0] * rates["a"][1] == rates["b"][0] * rates["b"][1] and rates["none"] == (0.0, 1.0)
    assert mixing.mix(edges).columns == edges.columns
    assert mixing.mix(empty).count() == 0


def test_pieces_against_the_tokenizer(edges):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    data = [(r.doc_id, r.text or "") for r in edges.select("doc_id", "text").collect()]
    want = Counter()
    for i, text in data:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for a in range(0, len(ids), 2048):
            want[i, a, min(2048, len(ids) - a), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids)] += 1
    out = packing.pack_documents(edges, tokenizer_path()).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    for s in {r.sequence_id for r in out}:
        parts = sorted((r.offset, r.length) for r in out if r.sequence_id == s)
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 2048


def test_word_by_word_is_the_whole_text():
    table = packing.WordIds(tokenizer_path())
    texts = ["Don't stop", "a<|endoftext|>b <|ENDOFTEXT|>", "x\x1cy \x0b z\x85w", "naïve ÀB ﬁ é ́x", "Ünï 12,5% we'll'd", "日本 語", "İ ẞ Σς", "", " \n"]
    for t in texts:
        assert np.frombuffer(table.document(t.encode()), "<u4").tolist() == table.whole(t), t


def test_three_limits_hold(spark, empty):
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 2049, 800)
    loss = (tokens * rng.random(800)).astype(int)
    tokens[0] = 3000
    items = spark.createDataFrame([(i, int(t), int(x)) for i, (t, x) in enumerate(zip(tokens, loss))], "number long, tokens long, loss_tokens long")
    out = packing.pack(items, 2048, segments=3, loss=900).collect()
    assert sorted(r.number for r in out) == list(range(800))
    for s in {r.sequence_id for r in out}:
        parts = [r for r in out if r.sequence_id == s]
        assert len(parts) == 1 or (sum(r.tokens for r in parts) <= 2048 and len(parts) <= 3 and sum(r.loss_tokens for r in parts) <= 900)
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_little_padding():
    tokens = np.random.default_rng(4).integers(1, 2048, 4000)
    bins, _ = packing.pack_vectors(np.stack([tokens, np.ones_like(tokens), tokens], 1), np.array([2048, 256, 2048]))
    assert tokens.sum() / ((bins.max() + 1) * 2048) > 0.98


def test_large_rates_do_not_vanish(make, spark, monkeypatch):
    docs = make([(i, "x") for i in range(60)], sources={i: "tiny" for i in range(60)})
    rates = spark.createDataFrame([("tiny", 1500.0)], "source string, rate double")
    counted = Counter(r.doc_id for r in mixing.replicate(docs, rates).select("doc_id").collect())
    # Sixty draws of mean 1500: their mean is normal with a deviation of 5.
    assert len(counted) == 60 and abs(sum(counted.values()) / 60 - 1500) < 30
    monkeypatch.setattr(mixing, "BROADCAST_STEPS", 0)
    assert Counter(r.doc_id for r in mixing.replicate(docs, rates).select("doc_id").collect()) == counted

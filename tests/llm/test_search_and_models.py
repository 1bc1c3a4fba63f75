import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_fixtures import edges, empty, make  # noqa: F401
from quarterline.llm import language_id, language_model, neighbours, quality


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(900, 24))
    data[300:600] = data[299]
    vectors = [(i, [float(x) for x in v], "extra") for i, v in enumerate(data)]
    odd = [(5000, None, ""), (5001, [0.0] * 24, ""), (5002, [float("nan")] * 24, ""), (5003, [1.0] * 3, ""), (None, [1.0] * 24, ""), (5004, [None] * 24, ""), vectors[10]]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>, class string")
    out = neighbours.nearest(df, F.col("vec_id") % 100 == 0, 10, neighbours.Curves(window=256)).collect()
    hit = total = 0
    for q in range(0, 900, 100):
        d = np.sqrt(((data - data[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine)
        if 300 <= q < 600:
            assert [r.vec_id for r in mine] == want
        hit += len({r.vec_id for r in mine} & set(want))
        total += 10
    assert hit / total >= 0.9 and {r.query_id for r in out} == set(range(0, 900, 100))
    few = neighbours.nearest(df.where("vec_id < 3 or vec_id = 5003"), F.col("vec_id") == 0).collect()
    assert sorted((r.rank, r.query_id) for r in few) == [(1, 0), (2, 0)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_hilbert_curve_moves_one_step_at_a_time():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = neighbours.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def brute_kneser_ney(counts):
    """p(gram) for all orders from top-order counts, symbol by symbol."""
    levels = [dict(counts)]
    for _ in range(quality.ORDER - 1):
        levels.insert(0, dict(Counter(g[1:] for g in levels[0])))
    models = []
    for level in levels:
        seen = Counter(level.values())
        y = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] and seen[2] else 0.5
        ratio = lambda a, b, k: min(max(k - (k + 1) * y * b / a, 0.1), k - 0.1) if a and b else min(0.5 * k, k - 0.1)  # noqa: E731, B023
        d = {k: ratio(seen[k], seen[k + 1], k) for k in (1, 2, 3)}
        total, back = Counter(), Counter()
        for g, n in level.items():
            total[g[:-1]] += n
            back[g[:-1]] += d[min(n, 3)]
        models.append((level, d, total, back))

    def p(g):
        if not g:
            return 1 / quality.SYMBOLS
        level, d, total, back = models[len(g) - 1]
        lower = p(g[1:])
        if not total[g[:-1]]:
            return lower
        n = level.get(g, 0)
        return (max(n - d[min(n, 3)], 0) if n else 0) / total[g[:-1]] + back[g[:-1]] / total[g[:-1]] * lower

    return p


def test_kneser_ney_against_brute_force(make):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "of", "Nine.", "été", "a1,"]) for _ in range(30)) for _ in range(12)]
    counts = Counter()
    for t in texts:
        s = [quality.PAD] * (quality.ORDER - 1) + quality.symbols(t.encode()).tolist()
        counts.update(tuple(s[i : i + quality.ORDER]) for i in range(len(s) - quality.ORDER + 1))
    table = quality.surprisal_table(quality.kneser_ney(quality.gram_counts(make(list(enumerate(texts))))))
    p = brute_kneser_ney(counts)
    number = lambda g: sum(x * quality.SYMBOLS ** (quality.ORDER - 1 - i) for i, x in enumerate(g))
    for g in [*list(counts)[:150], *[tuple(rng.randrange(quality.SYMBOLS) for _ in range(quality.ORDER)) for _ in range(150)]]:
        assert abs(table[number(g)] + math.log2(p(g))) < 1e-4
    sums = (2.0 ** -table.astype(float)).reshape(-1, quality.SYMBOLS).sum(1)
    assert np.allclose(sums, 1, atol=1e-4)


def test_quality_on_small_tables(spark, small, edges, empty):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality(docs, labels).join(labels.groupBy("doc_id").agg(F.min("quality").alias("q")), "doc_id").groupBy("q").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    kept = {r.q: r.k for r in out.collect()}
    assert kept[1] > 0.98 and kept[0] < 0.2
    assert quality.quality(edges, labels).count() == edges.count()
    assert {r.kept for r in quality.quality(edges, labels.limit(0)).collect()} == {True}
    assert quality.quality(empty, labels).count() == 0
    good = quality.good_documents(edges, labels)
    assert good.columns == edges.columns and {1, 2} <= {r.doc_id for r in good.collect()}


def test_words_of_a_context_sum_to_one_and_base_scores(make, empty, edges):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)]
    data = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(300)], k=60)).replace("v1 ", "V1\x0b")) for i in range(150)] + [(900, None), (901, "zz unseen")]
    docs = make([*data, data[3]])
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tokens = lambda t: [*"".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split(), b"\n"]
    n = Counter(w for i, t in [*data, data[3]] if not held(i) for w in tokens(t))
    total, types = sum(n.values()), len(n)
    out = language_model.language_scores(docs).collect()
    assert len(out) == len(data) + 1
    texts = dict(data)
    for r in out:
        words = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(words), sum(w in n for w in words), total)
        assert abs(r.base_score - sum(math.log10((n[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)) < 1e-6
    model = language_model.train(docs.select("text"))
    chances = np.zeros(language_model.CONTEXTS + 1)
    for r in language_model.predictions(model).collect():
        row = np.array([(model.back()[:, c] * np.array(r.root)).mean() for c in range(len(chances))])
        for c, x in zip(r.contexts, r.logs):
            row[c] = 10**x
        chances += row
    assert np.allclose(chances + 10 ** model.unknown(), 1, atol=1e-9)
    assert language_model.language_scores(edges).count() == edges.count()
    assert language_model.language_scores(empty).count() == 0


def test_rare_words_are_joined_to_the_same_scores(make, monkeypatch):
    rng = random.Random(4)
    data = [(i, " ".join(f"u{int(rng.paretovariate(0.6)) % 500}" for _ in range(40))) for i in range(60)]
    model = language_model.train(make(data).select("text"))
    a = {r.doc_id: r for r in language_model.score(make(data), model).collect()}
    monkeypatch.setattr(language_model, "FREQUENT", 20)
    for r in language_model.score(make(data), model).collect():
        assert abs(r.score - a[r.doc_id].score) < 1e-3 and abs(r.base_score - a[r.doc_id].base_score) < 1e-6 and r.n_known == a[r.doc_id].n_known


def test_tables_follow_their_exact_conditional():
    rng, d, weight = np.random.default_rng(6), 0.6, 2.5
    logs = language_model.stirling_logs(d)
    drawn = language_model.seat(rng, np.full(40_000, 6), np.full(40_000, weight), 0.0, d, logs)
    want = np.exp(logs[6, 1:7]) * weight ** np.arange(1, 7)
    assert np.allclose(np.bincount(drawn, minlength=7)[1:] / 40_000, want / want.sum(), atol=0.015)
    many = language_model.seat(rng, np.full(50, 5000), np.full(50, 1e-3), 0.0, d, logs)
    assert (many >= 1).all() and (many <= 5000).all()


def test_language_held_out_accuracy(spark, edges, empty, make):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    out = language_id.language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    by = {r.doc_id: r for r in language_id.language_of(edges).collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[11].lang_pred == "und" and all(0 <= r.score <= 1 for r in by.values()) and len(by) == 13
    assert language_id.language_of(empty).count() == 0
    alone = language_id.language_of(make([(1, "words"), (2, "more words"), (3, None)], langs={1: None, 2: None, 3: None})).collect()
    assert {r.lang_pred for r in alone} == {"und"}


def test_codewords_lie_apart():
    for n in (2, 3, 4, 7, 20):
        words = language_id.codewords(n)
        gaps = [(a != b).sum() for i, a in enumerate(words) for b in words[:i]]
        assert min(gaps) >= max(1, words.shape[1] // 4)
        assert all(len(set(c)) == 2 for c in words.T)


def test_close_decoding_is_flagged():
    model = language_id.Codes(["a", "b"], np.array([[1], [-1]]), np.eye(language_id.FEATURES)[:, :1] * 0.1, np.ones(1))
    counts = np.zeros((2, language_id.FEATURES))
    counts[0, 1], counts[1, 0] = 10, 100
    _, share, unsure = language_id.decode(counts, model)
    assert unsure.tolist() == [True, False] and abs(share[0] - 0.5) < 1e-9


def test_fold_of_null_ids(spark):
    from quarterline.llm.common import id_text_remainder

    got = spark.createDataFrame([(None,), (5,), (-7,)], "doc_id long").select("doc_id", id_text_remainder("doc_id", 10).alias("r")).collect()
    assert {r.doc_id: r.r for r in got} == {None: 0, 5: zlib.crc32(b"5") % 10, -7: zlib.crc32(b"-7") % 10}


def test_features_are_counted_in_blocks(monkeypatch):
    text = "Une phrase, assez longue: été 12 fois répétée! ".encode() * 9
    whole = language_id.feature_counts(text)
    for block in (1, 2, 3, 7, 50, len(text), len(text) + 1):
        monkeypatch.setattr(language_id, "BLOCK", block)
        assert (language_id.feature_counts(text) == whole).all()


def test_windows_widen_until_the_nearest_are_settled(spark):
    rng = np.random.default_rng(12)
    # One dense cluster, far smaller than the others lie apart, and vectors without structure: windows of 8 on 4 curves miss most.
    data = np.concatenate([rng.normal(size=(2000, 16)), 3 + 1e-4 * rng.normal(size=(2000, 16))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, F.col("vec_id") % 100 == 0, 10, neighbours.Curves(curves=4, window=8)).collect()
    hit = [0, 0]
    for q in range(0, 4000, 100):
        d = np.sqrt(((data - data[q]) ** 2).sum(1))
        want = set(np.lexsort((np.arange(4000), d))[1:11].tolist())
        hit[q >= 2000] += len(want & {r.vec_id for r in out if r.query_id == q})
    assert hit[0] / 200 >= 0.9 and hit[1] / 200 >= 0.9


def test_byte_keys_sort_as_the_numbers_do():
    grid = np.random.default_rng(13).integers(0, 1 << 7, (500, 8))
    keys = neighbours.hilbert_keys(grid, 7)
    assert [int.from_bytes(x, "big") for x in neighbours.hilbert_bytes(grid, 7)] == keys.tolist()


def test_all_trusted_documents_train_the_quality_model(spark, make, monkeypatch):
    # More trusted documents than the 20,000 that a fit once took; each holds a gram or two.
    n = 20_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    seen = []
    counted = quality.gram_counts
    monkeypatch.setattr(quality, "gram_counts", lambda texts: seen.append(texts.count()) or counted(texts))
    fitted = quality.fit(docs, labels, quality.Quality())
    assert seen == [n] and fitted is not None


def test_contexts_are_chosen_from_all_counts(spark):
    # "spread" is no task's frequent word: 5,000 words precede it in each of two texts, and it still has the largest count of all.
    texts = [" ".join([w for i in range(5000) for w in [f"{part}{i}"] * 3] + ["spread"] * 2) for part in "ab"]
    a, b = (spark.createDataFrame([(t,)], "text string").coalesce(1) for t in texts)
    df = a.unionAll(b)
    assert language_model.context_words(df, 1) == [b"spread"]


@pytest.mark.parametrize("share", [7, 60, 2000])
def test_contexts_are_the_same_from_the_words_that_tasks_pass_on(make, monkeypatch, share):
    rng = random.Random(5)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(300)) for _ in range(40)]
    docs = make(list(enumerate(texts))).repartition(4, "doc_id")
    n = Counter(w.encode() for t in texts for w in t.split())
    monkeypatch.setattr(language_model, "SHARE", share)
    for k in (1, 5, 31, 1000):
        assert language_model.context_words(docs, k) == sorted(n, key=lambda w: (-n[w], w))[:k]
    passed = language_model._word_counts(docs, 7).where("word IS NOT NULL").count()
    assert 0 < passed <= 4 * 7 < len(n)


def test_customers_follow_each_text_from_its_start(make):
    texts = ["b a x a y", "", None, "x", " ".join(["z", "b"] * 60_000), "y b"]
    contexts = [b"a", b"b"]
    expected = Counter()
    for t in texts:
        c = 0
        for w in [*(t or "").encode().split(), b"\n"]:
            expected[w, c] += 1
            c = contexts.index(w) + 1 if w in contexts else c
    found = {(r.word, c): k for r in language_model.customers(make(list(enumerate(texts))), contexts).collect() for c, k in zip(r.contexts, r.counts)}
    assert {(bytes(w), c): k for (w, c), k in found.items()} == dict(expected)

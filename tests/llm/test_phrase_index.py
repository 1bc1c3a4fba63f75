import random
import re

import pytest
from llm_fixtures import edges, empty, make, rows  # noqa: F401

from quarterline.llm import phrase_index


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, length):
    """(doc_id, n_words, n_hit, items) for each document, by trying every window at every place."""
    windows = []
    for item, text in items:
        words = split(text)
        size = min(length, len(words))
        windows += [(item, tuple(words[i : i + size])) for i in range(len(words) - size + 1) if size]
    result = []
    for doc, text in docs:
        words, hit, names = split(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names |= {str(item)} if item is not None else set()
        result.append((doc, len(words), len(hit), tuple(sorted(names))))
    return sorted(result, key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", 1, "w") for i, t in items], "item_id long, text string, term string, n int, window string")


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()), key=str)


def corpus(seed, n=60):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "日本", "Word", "x-y", "a_b", "9"]
    items = [(i, " ".join(chance.choices(words, k=chance.randrange(0, 15)))) for i in range(12)] + [(None, "w1 w2 w3 w4"), (3, "w5 w5 w5 w5 w5"), (50, None), (51, "?!")]
    docs = []
    for i in range(n):
        text = " ".join(chance.choices(words, k=chance.randrange(0, 40)))
        if chance.random() < 0.6:
            text += ".\n" + (chance.choice(items)[1] or "").upper() + "; " + " ".join(chance.choices(words, k=3))
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("length", [1, 3, 10])
def test_phrases_equal_brute_force(spark, make, length):
    docs, items = corpus(length)
    got = found(phrase_index.contaminated(make(docs), benchmark(spark, items), length))
    assert got == brute_force(docs, items, length)
    assert any(r[2] for r in got)


def test_segments_keep_documents_apart(spark, make, monkeypatch):
    docs = [(i, "a b c" if i % 2 else "d e f") for i in range(30)] + [(99, "x a b c d e f " * 40)]
    items = [(1, "a b c d e f"), (2, "c d"), (3, "f x a")]
    whole = phrase_index.build_index(make(docs).coalesce(1))
    cut = phrase_index.build_index(make(docs).coalesce(1), segment_words=7)
    assert whole.select("segment").distinct().count() == 1 < cut.select("segment").distinct().count()
    windows = phrase_index.windows_of(benchmark(spark, items), 6)
    hits = [rows(phrase_index.search(index, windows).select("doc_id", "n_words", "n_hit", "exact")) for index in (whole, cut)]
    assert hits[0] == hits[1]
    assert [(r[0], r[2]) for r in hits[0] if r[2]] == [(99, 240 + 39)]


def test_index_holds_every_place(spark, make):
    docs, _ = corpus(5)
    index = phrase_index.build_index(make(docs)).collect()
    spans = [r for r in index if r["term"] is None]
    assert sorted((r["doc_id"], r["n_words"]) for r in spans) == sorted((d, len(split(t))) for d, t in docs)
    terms = {(r["segment"], p): r["term"] for r in index if r["term"] is not None for p in r["places"]}
    texts = dict(docs)
    for span in spans:
        wanted = [phrase_index.term_of(w.encode()) for w in split(texts[span["doc_id"]])]
        assert [terms.pop((span["segment"], span["places"][0] + i)) for i in range(len(wanted))] == wanted
    assert not terms


def near_by_hand(docs, window, slop):
    """Documents with an occurrence of the window's rarest word from which every word is within `slop` of its place."""
    texts = [(d, split(t)) for d, t in docs]
    counts = [sum(w == x for _, words in texts for x in words) for w in window]
    seed = min(range(len(window)), key=lambda k: (counts[k], k))
    for doc, words in texts:
        starts = [i - seed for i, w in enumerate(words) if w == window[seed]]
        if any(all(window[k] in words[max(s + k - slop, 0) : max(s + k + slop + 1, 0)] for k in range(len(window))) for s in starts):
            yield doc


@pytest.mark.parametrize("slop", [1, 3])
def test_proximity_equals_brute_force(spark, make, slop):
    docs, _ = corpus(8, n=500)
    items = [(1, "w1 w2 w3"), (2, "w4 w5 w4 w6"), (3, "w7 É 9"), (4, "w1 nowhere")]
    got = phrase_index.contaminated(make(docs), benchmark(spark, items), 4, slop).collect()
    exact = {(d, i) for d, _, _, names in brute_force(docs, items, 4) for i in names}
    near = {(d, str(i)) for i, t in items for d in near_by_hand(docs, split(t), slop)}
    assert {(r["doc_id"], i) for r in got for i in r["items"]} == exact
    assert {(r["doc_id"], i) for r in got for i in r["near_items"]} == near - exact
    assert near - exact


def test_edges(spark, edges, empty, make):
    items = [(1, "the same text with a few words"), (2, None), (3, "one"), (4, "日本語 x"), (5, "w0q0 w1q1")]
    got = found(phrase_index.contaminated(edges, benchmark(spark, items)))
    texts = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert got == brute_force(texts, items, 10)
    assert len(got) == len(texts)
    assert found(phrase_index.contaminated(empty, benchmark(spark, items))) == []
    none = found(phrase_index.contaminated(edges, benchmark(spark, [])))
    assert len(none) == len(texts) and not any(r[2] for r in none)


def test_phrases_longer_than_the_gap_are_refused(spark, edges):
    with pytest.raises(ValueError):
        phrase_index.contaminated(edges, benchmark(spark, [(1, "a")]), 65)
    with pytest.raises(ValueError):
        phrase_index.search(phrase_index.build_index(edges), phrase_index.windows_of(benchmark(spark, [(1, "a")]), 3), slop=-1)

import random
from itertools import combinations

import numpy as np
from llm_fixtures import edges, empty, make, rows  # noqa: F401
from quarterline.llm import near_dedup, substring_dedup
from quarterline.llm.components import components


def shingles(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    return {tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def brute(data, near):
    ids = [i for i, _ in data if i is not None]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t, near.shingle)) for i, t in data if i is not None]
    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= near.percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def family(seed, n=40, length=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(8)):
            text[rng.randrange(length)] = f"x{rng.randrange(9999)}"
        out.append(" ".join(text))
    return out


def check(docs, data, near):
    want = brute(data, near)
    for r in near_dedup.near_duplicates(docs, near).collect():
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_near_against_all_pairs(make, edges, empty):
    data = [(10 * k + j, t) for j, seed in enumerate((1, 2, 3)) for k, t in enumerate(family(seed))]
    for near in (near_dedup.Near(), near_dedup.Near(shingle=3, percent=85)):
        check(make(data), data, near)
        check(edges, [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()], near)
    out = {(r.doc_id, r.n_shingles) for r in near_dedup.near_duplicates(edges).collect()}
    assert {(1, 0), (3, 0), (4, 1)} <= out
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.without_near_copies(edges).columns == edges.columns


def test_large_groups_meet_in_blocks(make, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", 5)
    data = list(enumerate(family(9, n=60)))
    check(make(data), data, near_dedup.Near())


def test_bit_counts_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    b = np.unique(np.concatenate([a[:3600], rng.integers(0, 2**63, 400, dtype=np.uint64)]))
    bits = near_dedup.pack_bits(near_dedup.minima([np.unique(a), b], 1024)).view(np.uint64)
    agree = 1 - near_dedup.unlike(bits[0], bits[1]) / 1024
    assert abs((agree - 1 / 16) / (1 - 1 / 16) - 3600 / 4400) < 0.05


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7), (200, 100)], "a long, b long")
    assert rows(components(links)) == sorted([(i, 0) for i in range(31)] + [(i, 100) for i in (100, 101, 102, 200)], key=str)
    assert components(links.limit(0)).count() == 0


def test_passage_is_found_wherever_it_stands(make):
    rng = random.Random(7)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    passage = text(60)
    data = [(i, f"{text(40 + 3 * i)} {passage} {text(30)}") for i in range(5)] + [(10 + i, text(150)) for i in range(5)]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(make(data)).collect()}
    assert all(out[i].repeated_bytes > 0 for i in range(5)) and all(out[10 + i].repeated_bytes == 0 for i in range(5))
    assert out[0].removed_bytes == 0 and all(out[i].first_ids == [0] for i in range(1, 5))
    for i, t in data[1:5]:
        left = substring_dedup.cut_spans(t.encode(), [(s["from"], s["to"]) for s in out[i].removed])
        assert len(left) == len(t.encode()) - out[i].removed_bytes and t.startswith(left.decode()[:100])
        assert all(t.encode()[s["from"] : s["to"]] in f" {passage} ".encode() for s in out[i].removed)


def test_chunks_cover_the_text(edges):
    rng = np.random.default_rng(8)
    for n in (0, 1, 15, 17, 500, 5000):
        data = rng.integers(97, 102, n).astype(np.uint8)
        ends = substring_dedup.chunk_ends(substring_dedup.cut_places(data).tolist() if n else [], n)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == n and (sizes <= substring_dedup.LONGEST).all() and (sizes[:-1] >= substring_dedup.SHORTEST).all()


def test_substring_edges(edges, empty):
    out = substring_dedup.repeated_passages(edges).collect()
    assert len(out) == edges.count()
    by = {r.doc_id: r for r in out}
    assert by[1].n_chunks == by[2].n_chunks == 0 and by[9].removed_bytes == 0 and by[10].first_ids == [9]
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_an_id_with_several_texts_ties_their_copies(make):
    one, two = family(21, n=1)[0], family(22, n=1)[0]
    data = [(3, one), (7, one), (7, two), (5, two), (9, two), (11, family(23, n=1)[0])]
    check(make(data), data, near_dedup.Near())
    kept = near_dedup.without_near_copies(make(data)).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [3, 11]


def test_a_chance_chunk_does_not_cut_a_passage(make):
    rng = random.Random(31)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    passage = text(80)
    pieces = passage.split()
    # Document 0 holds six words of the passage, enough for a chunk, but not the passage.
    data = [(0, f"{text(40)} {' '.join(pieces[30:42])} {text(40)}"), *((i, f"{text(30)} {passage} {text(30)}") for i in (5, 6, 7))]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(make(data)).collect()}
    assert out[0].repeated_bytes == out[0].removed_bytes == out[5].removed_bytes == 0 and out[5].repeated_bytes > 0.8 * len(passage)
    # 7 may share a chunk before the passage with 6 alone; all that 5 holds is gone from both.
    assert out[6].first_ids == [5] and min(out[7].first_ids) == 5 and all(out[i].removed_bytes >= out[5].repeated_bytes for i in (6, 7))


def test_chunks_of_different_documents_are_no_passage(make):
    rng = random.Random(32)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    whole = text(96).split()
    # Every stretch of 16 words of document 50 stands in another document, which holds no 25 words of it.
    data = [(50, " ".join(whole)), *((i, f"{text(20)} {' '.join(whole[8 * i : 8 * i + 16])} {text(20)}") for i in range(11))]
    out = substring_dedup.repeated_passages(make(data)).collect()
    assert {(r.repeated_bytes, r.removed_bytes) for r in out} == {(0, 0)}


def test_spans_cover_every_run_of_enough_words():
    rng = np.random.default_rng(33)
    for _ in range(50):
        words = rng.integers(0, 9, 40)
        found = substring_dedup.spans(words, 25).tolist()
        for a in range(40):
            for b in range(a + 1, 41):
                inside = {c for f, t in found if a <= f and t <= b for c in range(f, t)}
                assert inside == (set(range(a, b)) if words[a:b].sum() >= 25 else set())

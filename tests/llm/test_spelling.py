import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import edges, empty, make  # noqa: F401
from quarterline.llm import queries, spelling


def counts_of(docs, every=97):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and check % every == 0:
                k = check % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    counts.pop("", None)
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x.encode()), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def result(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("symbols", [1, 2, 8, 200])
def test_variants_equal_brute_force_at_any_alphabet(spark, symbols):
    chance = random.Random(symbols)
    words = {}
    for _ in range(700):
        words["".join(chance.choices("abcßé", k=chance.randrange(1, 8)))] = chance.randrange(3, 400)
    table = spark.createDataFrame([(w, n, 1) for w, n in words.items()], "word string, n long, code int")
    assert result(spelling.variants(table, symbols=symbols)) == brute_force(words)


def test_forms_lead_on_to_a_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc", "bbbcc", "bbccc"]
    words = {w: 3 * 2**i for i, w in enumerate(chain)} | {"zzzzz": 3, "zzzzy": 5, "yzzzy": 10, "xzzzy": 10}
    got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_force(words)
    assert got["aaaaa"][1] == "bbccc" and got["zzzzz"][0] is None and got["zzzzy"][0] == "xzzzy"


def test_whole_table_equals_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    words = {w: n for w, n in counts_of(docs).items() if len(w) >= 5 and n >= 3}
    got = result(queries.QUERIES["op13_spelling_variants"](spark, small))
    assert got.keys() == words.keys() and {w: v[2] for w, v in got.items()} == words
    assert got == brute_force(words)


def test_word_counts_with_and_without_slips(spark, edges, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in edges.collect()]
    monkeypatch.setattr(spelling, "HELD", 5)
    for every in (None, 1, 2, 97):
        got = {r["word"]: r["n"] for r in spelling.word_counts(edges, every).collect()}
        assert got == counts_of(docs, every)
    assert counts_of(docs, None)["ñ"] == 1


def test_runs_end_at_other_code_points():
    text = "StraßeŒuvre ÀÉ×÷ÿ 日本abc\U0001f600d ſKK éf"
    runs = [r.decode("latin-1") for r in spelling.letter_runs(text)]
    assert runs == ["".join(c.lower() if "A" <= c <= "Z" else c for c in r) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]


def test_no_words_and_no_rows(spark, empty, make):
    assert result(spelling.spelling_variants(empty)) == {}
    assert result(spelling.spelling_variants(make([(1, "ab cd"), (2, None)]))) == {}
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_neighbourhood_codes_are_those_of_the_neighbours():
    def code(symbols):
        return int(spelling.neighbourhood(np.array([symbols], np.uint64), 3)[0][0])

    for word in ([0], [1, 1], [0, 1, 2], [2, 2, 0, 1, 1]):
        _, _, codes = spelling.neighbourhood(np.array([word], np.uint64), 3)
        shorter = {tuple(word[:i] + word[i + 1 :]) for i in range(len(word))}
        raised = {tuple(word[:i] + [s] + word[i + 1 :]) for i in range(len(word)) for s in range(word[i] + 1, 3)}
        assert sorted(map(int, codes)) == sorted(code(list(w)) if w else 0 for w in shorter | raised)

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import edges, empty, make  # noqa: F401
from quarterline.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, source string, part string, n long"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "s", "p", 1) for r in rows], LABELS)


def fails_of(docs):
    """Brute force: the set of failed filters of each (doc_id, text, source)."""
    for doc, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = set()
        if len(words) < 200:
            found.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            found.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            found.add("C")
        if re.search(r"[#$%&*|]", text):
            found.add("D")
        if doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs):
            found.add("E")
        yield doc, source or "", frozenset(found)


def brute_force(docs, told, filters="ABCDE"):
    good = {d for d, q, _ in told if q == 1 and d is not None}
    toxic = {d for d, _, t in told if t == 1 and d is not None}
    rows = list(fails_of(docs))
    result = {}
    for part in {p for _, p, _ in rows}:
        mine = [(d, f) for d, p, f in rows if p == part]
        shapley = Counter()
        for order in itertools.permutations(filters):
            there = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in there if letter in f]
                there = [x for x in there if x not in gone or letter not in x[1]]
                fails = sum(letter in f for _, f in mine)
                only = sum(f == {letter} for _, f in mine)
                result[part, "".join(order), step] = [len(there), len(gone), fails - len(gone), only, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                shapley[letter] += len(gone)
        for (p, order, step), values in result.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in result.items()}


def audited(spark, df, told):
    rows = filter_audit.audit(filter_audit.document_failures(df, labels(spark, told)), "ABCDE", "part", ["good", "toxic"]).collect()
    return {tuple(r)[:3]: tuple(r)[3:] for r in rows}


def test_all_orders_equal_brute_force(spark):
    varied = " ".join(f"w{i}" for i in range(300))
    kinds = ["short", "SHOUT " * 250, varied, varied.upper(), varied + " $", "a b " * 150, "é" * 10, None, "", " \t", "x%"]
    docs = [(i, kinds[i * 7 % len(kinds)] if i % 3 else f"{varied} {i % 4}", ["a", "b", None, ""][i % 4]) for i in range(60)]
    docs += [(None, "short", "a"), (None, None, None), (3, docs[3][1], "b"), (4, "another text of a repeated id", "a")]
    told = [(i, i % 2, i % 5 == 0) for i in range(40)] + [(2, 1, 1), (2, None, None), (None, 1, 1), (999, 1, 1)]
    told = [(d, q, None if t is None else int(t)) for d, q, t in told]
    df = spark.createDataFrame([(d, t, s, "x", 1, "y") for d, t, s in docs], "doc_id long, text string, source string, part string, E int, good string")
    got = audited(spark, df, told)
    want = brute_force(docs, told)
    assert got == want
    assert len(got) == 3 * 120 * 5


def test_edges_have_a_row_per_order_and_step(spark, edges, empty):
    assert len(audited(spark, edges, [])) == 2 * 600
    assert audited(spark, empty, [(1, 1, 1)]) == {}


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = b"one two  three\tfour\n" * 50
    whole = filter_audit.text_failures(text)
    words = text.split()
    for block in (1, 7, 64, 10_000):
        monkeypatch.setattr(filter_audit, "BLOCK", block)
        assert [w for b in filter_audit.word_blocks(text) for w in b] == words
        assert filter_audit.text_failures(text) == whole


def test_removal_steps_are_the_first_failed_filter_of_an_order():
    orders = list(itertools.permutations(range(4)))
    step, position = filter_audit.removal_steps(orders, 4)
    for p, order in enumerate(orders):
        assert [position[f, p] for f in order] == [1, 2, 3, 4]
        for failed in range(16):
            assert step[failed, p] == next((i for i, f in enumerate(order, 1) if failed >> f & 1), 5)
    assert step.dtype == np.int64


def test_own_filters_orders_and_weights(spark):
    flags = spark.createDataFrame([("p", True, None, 3), ("p", True, True, 5), (None, False, False, 7), ("p", False, True, None)], "of string, x boolean, y boolean, words long")
    got = {tuple(r) for r in filter_audit.audit(flags, "xy", "of", ["words"], orders=["yx"]).collect()}
    assert got == {("p", "yx", 1, 1, 2, 0, 1, 5, 2), ("p", "yx", 2, 0, 1, 1, 1, 3, 1), ("", "yx", 1, 1, 0, 0, 0, 0, 0), ("", "yx", 2, 1, 0, 0, 0, 0, 0)}
    with pytest.raises(ValueError):
        filter_audit.audit(flags, "xy", "of", orders=["xx"])
    with pytest.raises(ValueError):
        filter_audit.audit(flags, "abcdefgh", "of")

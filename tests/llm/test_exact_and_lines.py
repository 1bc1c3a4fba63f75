import hashlib
import re
from collections import Counter, defaultdict

from llm_fixtures import edges, empty, make, rows  # noqa: F401
from quarterline.llm import exact_dedup, line_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def bare(text):
    return BLANK.sub("", text or "")


def test_exact_against_groups(edges):
    data = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in data:
        groups[bare(t)].append((-len(t or ""), i is None, i if i is not None else 0))
    out = exact_dedup.exact_dedup(edges).collect()
    assert len(out) == len(data)
    want = {hashlib.sha256(k.encode()).hexdigest(): (min(v), len(v)) for k, v in groups.items()}
    for r in out:
        (_, nameless, best), size = want[r.text_sha256]
        assert r.group_size == size and r.keep_id == (None if nameless else best)
    kept = Counter(r.text_sha256 for r in out if r.kept)
    assert kept == Counter(dict.fromkeys(want, 1))
    # The row with more blanks is the longer one.
    assert {r.keep_id for r in out if r.group_size == 5} == {8}


def test_rows_that_stay_keep_their_columns(edges, empty):
    left = exact_dedup.without_copies(edges)
    assert left.columns == edges.columns
    assert len({bare(r.text) for r in left.collect()}) == left.count()
    assert exact_dedup.without_copies(empty).count() == exact_dedup.exact_dedup(empty).count() == 0


def test_runs_merge_in_any_shape(edges):
    prints = exact_dedup.fingerprints(edges.repartition(7))
    a, b = (rows(exact_dedup.merge_runs(prints, 3, runs, fan)) for runs, fan in ((1, 2), (64, 2)))
    assert a == b


def drop(data, least=20, documents=3):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in data:
        for x in (t or "").split("\n"):
            held[key(x)].add(-1 if i is None else i)
    out = []
    for i, t in data:
        lines = (t or "").split("\n")
        lost = lambda x: len(key(x)) >= least and len(held[key(x)]) >= documents and max(held[key(x)]) != (-1 if i is None else i)  # noqa: E731, B023
        kept = [x for x in lines if not lost(x)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(make, edges, empty):
    line = "a line that very many documents hold"
    data = [(i, f"head {i}\n  {line.upper() if i % 2 else line}\t\nown {i}\n{line}") for i in range(6)]
    data += [(None, line), (None, line), (20, "étée " * 4), (21, "étée " * 4), (22, "étée " * 4), (23, "short\nshort"), (24, "short"), (25, None), (26, "")]
    assert rows(line_dedup.drop_lines(make(data))) == drop(data)
    data = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    assert rows(line_dedup.drop_lines(edges)) == drop(data)
    assert line_dedup.drop_lines(empty).count() == 0

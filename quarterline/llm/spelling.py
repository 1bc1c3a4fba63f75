"""Spelling variants: words one edit apart, found by their letters' few symbols, and the frequent form that each leads to.

Letters are hashed to a few symbols, so a word becomes a reduced word of the same length. Words one edit apart have reduced words that are
equal or one edit apart. Every reduced word generates its neighbourhood of one edit, which is joined with the reduced words of the
vocabulary; what meets is verified on the original strings. Of two reduced words only one need generate the other: the longer deletes a
symbol, and of equal length the one with the smaller symbol replaces it by the greater; so insertions come from the other side.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import spread, stored

SYMBOLS = 8
#: Words that a task counts before it hands them on.
HELD = 400_000
#: A-Z to a-z, other letters of Latin-1 from C0 on to themselves, all else to spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs [A-Za-z\\u00C0-\\u00FF]+ in Latin-1, A-Z lower-cased; a code point that Latin-1 lacks ends a run."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def slipped(run: bytes, start: int, every: int) -> bytes:
    """The run, or the run without a letter where the checksum of its document and itself says so."""
    check = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if check % every:
        return run
    k = check % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(docs: DataFrame, every: int | None = 97) -> DataFrame:
    """word, n over all rows of `docs` (doc_id, text); with `every`, runs whose crc32 of `<doc_id>:<run>` it divides lose a letter.

    A null text has no words, a null doc_id is written as empty text; a run that loses its only letter is no word. Rows that repeat count
    again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted():
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                runs = Counter(letter_runs(text))
                if every is None:
                    held.update(runs)
                else:
                    start = crc32(b":" if doc is None else b"%d:" % doc)
                    for word, n in runs.items():
                        held[slipped(word, start, every)] += n
                if len(held) >= HELD:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    counts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return counts.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def symbol_table(symbols: int) -> np.ndarray:
    """The symbol, from 0, of every letter of Latin-1."""
    return (spread(np.arange(1, 257, dtype=np.uint64)) % np.uint64(symbols)).astype(np.uint64)


def neighbourhood(reduced: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of reduced words of one length (rows): own code; and (row, code) of each word one deletion or raised symbol away.

    A code is the polynomial of a word's symbols at a fixed base, modulo 2^64; words of all lengths share it.
    """
    n, length = reduced.shape
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, _BASE)]), dtype=np.uint64)
        digits = reduced + np.uint64(1)
        here = digits * powers[:length]
        own = here.sum(1, dtype=np.uint64)
        before = np.cumsum(here, 1, dtype=np.uint64) - here
        # What follows a deleted symbol moves down by one place.
        moved = digits[:, 1:] * powers[: length - 1]
        after = np.concatenate([np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1], np.zeros((n, 1), np.uint64)], 1)
        shorter = before + after
        # Deleting any symbol of a run of equal ones gives the same word.
        new = np.concatenate([np.ones((n, 1), bool), reduced[:, 1:] != reduced[:, :-1]], 1)
        rows, codes = [np.nonzero(new)[0]], [shorter[new]]
        for symbol in range(1, symbols):
            lower = reduced < np.uint64(symbol)
            raised = own[:, None] + (np.uint64(symbol) - reduced) * powers[:length]
            rows.append(np.nonzero(lower)[0])
            codes.append(raised[lower])
    return own, np.concatenate(rows), np.concatenate(codes)


def reduced_keys(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, code, own: the code of each word's reduced form (own), and those of its reduced neighbourhood."""
    table = symbol_table(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelt = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            lengths = np.array([len(w) for w in spelt])
            for length in np.unique(lengths):
                chosen = np.flatnonzero(lengths == length)
                letters = np.frombuffer(b"".join(spelt[i] for i in chosen), np.uint8).reshape(-1, length)
                own, rows, codes = neighbourhood(table[letters], symbols)
                index = np.concatenate([chosen, chosen[rows]])
                mine = np.arange(len(index)) < len(chosen)
                taken = batch.take(pa.array(index))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("word"), taken.column("n"), pa.array(np.concatenate([own, codes]).view(np.int64)), pa.array(mine)],
                    ["word", "n", "code", "own"],
                )

    return words.select("word", "n").mapInArrow(run, "word string, n long, code long, own boolean")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """a, n_a, b, n_b: every pair of distinct words one inserted, deleted or replaced code point apart, once. Words are of Latin-1."""
    keys = stored(reduced_keys(words, symbols), "reduced")
    holders = keys.where("own").select("code", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = keys.select("code", "own", F.col("word").alias("a"), F.col("n").alias("n_a")).join(holders, "code")
    # Words of one reduced form meet from both sides, all others from one.
    return met.where((~F.col("own") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def roots(links: DataFrame) -> DataFrame:
    """word, root: where following (word, form) ends, for words that have a form. Forms must not lead in circles.

    Every round doubles the steps that a word has gone; words that have arrived are not joined again.
    """
    gone = stored(links.select("word", F.col("form").alias("at"), F.lit(True).alias("open")), "gone")
    while not gone.where("open").isEmpty():
        onward = gone.select(F.col("word").alias("at"), F.col("at").alias("beyond"))
        stepped = gone.where("open").join(onward, "at", "left").select("word", F.coalesce("beyond", "at").alias("at"), F.col("beyond").isNotNull().alias("open"))
        gone = stored(stepped.unionAll(gone.where("NOT open")), "gone")
    return gone.select("word", F.col("at").alias("root"))


def variants(words: DataFrame, symbols: int = SYMBOLS, ratio: int = 2) -> DataFrame:
    """One row per word of `words` (word, n; distinct, of Latin-1): word, form, root, n, n_near, form_n.

    Near words differ by exactly one inserted, deleted or replaced code point. form: the near word of largest n (ties: the smallest in
    code-point order) if its n is at least `ratio` times the word's, else null; root: where forms lead, the word itself if it has none.
    """
    if ratio < 2:
        raise ValueError("with a ratio under 2 forms might lead back")
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_pairs(words, symbols), "pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(pairs.select("b", "a", "n_a"))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rated = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")
    )
    rated = stored(rated.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "rated")
    found = roots(rated.where("form IS NOT NULL"))
    return rated.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, letters: int = 5, least: int = 3, every: int | None = 97) -> DataFrame:
    """`variants` of the words of at least `letters` code points that `docs` hold at least `least` times."""
    return variants(word_counts(docs, every).where((F.length("word") >= letters) & (F.col("n") >= least)))

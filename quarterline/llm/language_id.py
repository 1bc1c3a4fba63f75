"""Language identification by error-correcting output codes.

Each learned language has a codeword, a row of a Hadamard matrix, so that any two differ in about half of the bits. For every bit a
linear classifier over hashed byte n-grams tells the languages with a 1 from those with a 0. A text's margins are decoded to the
codeword with the smallest weighted logistic loss; where the second best comes close the text is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import id_text_remainder, raw

#: Hashed features of the 2- and 3-grams.
FEATURES = 1 << 13
#: Grams of a text that are counted at a time.
BLOCK = 1 << 20
#: n-grams whose evidence counts in full; a longer text's mean margin is weighed as that of so many.
FULL = 48
AMBIGUOUS = 0.75
_LETTER = regex.compile(r"\p{L}")


def _letters() -> bytes:
    """A-Z to a-z; ASCII that isn't a letter to a blank; other bytes as they are."""
    return bytes(b if b >= 0x80 or chr(b).islower() else (b + 32 if chr(b).isupper() else 32) for b in range(256))


_TABLE = _letters()


def feature_counts(text: bytes) -> np.ndarray:
    """Counts of the features of the 2- and 3-grams of bytes, blanks at both ends; BLOCK grams in memory at a time."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_TABLE).split()) + b" ", np.uint8)
    total = np.zeros(FEATURES, np.int64)
    if len(data) < 3:
        return total
    for at in range(0, len(data) - 1, BLOCK):
        part = data[at : at + BLOCK + 2].astype(np.uint32)
        two = part[:-1] * np.uint32(257) + part[1:]
        three = two[:-1] * np.uint32(257) + part[2:]
        total += np.bincount(_bucket(two[:BLOCK] + np.uint32(1 << 28)), minlength=FEATURES)
        total += np.bincount(_bucket(three), minlength=FEATURES)
    return total


def _bucket(gram: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((gram * np.uint32(2654435769)) >> np.uint32(32 - 13)).astype(np.int64)


def language_counts(training: DataFrame) -> DataFrame:
    """lang, feature, n over all training texts, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), raw(batch, "text"), strict=True):
                if lang not in totals:
                    totals[lang] = np.zeros(FEATURES, np.int64)
                totals[lang] += feature_counts(text)
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            # A language whose texts hold no letters is still learned.
            found = found if len(found) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found), pa.array(total[found])], ["lang", "feature", "n"])

    return training.select("lang", "text").mapInArrow(run, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Codes:
    languages: list[str]
    #: +1 or -1 per language and bit.
    words: np.ndarray
    #: Weight of each feature for each bit, (FEATURES, bits), and of each bit in the loss.
    weights: np.ndarray
    trust: np.ndarray


def codewords(n: int) -> np.ndarray:
    """Rows of a Hadamard matrix without the columns that say nothing about n languages."""
    size = max(8, 1 << (n - 1).bit_length())
    i, j = np.arange(n)[:, None], np.arange(size)[None, :]
    words = 1 - 2 * (np.bitwise_count((i & j).astype(np.uint64)).astype(int) % 2)
    words = words[:, (words != words[:1]).any(0)]
    return np.unique(words, axis=1)


def learn(counts: DataFrame, smooth: float = 0.5) -> Codes:
    """Bit classifiers from language counts: FEATURES numbers per language are all that comes to the driver."""
    seen = counts.toPandas()
    languages = sorted(seen["lang"].unique())
    table = np.zeros((len(languages), FEATURES))
    table[np.searchsorted(languages, seen["lang"].to_numpy(str)) if len(seen) else [], seen["feature"].to_numpy(int)] = seen["n"].to_numpy(float)
    # Every language weighs the same, however many texts it has.
    shares = (table + smooth) / (table + smooth).sum(1, keepdims=True) if len(languages) else table
    words = codewords(len(languages)) if languages else np.zeros((0, 0), int)
    weights, trust = np.zeros((FEATURES, words.shape[1])), np.ones(words.shape[1])
    for b in range(words.shape[1]):
        yes, no = shares[words[:, b] > 0].mean(0), shares[words[:, b] < 0].mean(0)
        weights[:, b] = np.log(yes) - np.log(no)
        # A bit whose two sides differ more is trusted more: half the symmetric divergence of the sides.
        trust[b] = 0.5 * ((yes - no) * weights[:, b]).sum()
    return Codes(languages, words, weights, trust / trust.mean() if len(trust) else trust)


def decode(counts: np.ndarray, model: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its share of the likelihood, and whether it is ambiguous, for rows of feature counts."""
    n = counts.sum(1)
    if len(model.languages) == 1:
        return np.zeros(len(n), int), np.ones(len(n)), np.zeros(len(n), bool)
    margins = counts @ model.weights / np.maximum(n, 1)[:, None] * np.minimum(n, FULL)[:, None]
    loss = np.einsum("tlb,b->tl", np.logaddexp(0, -margins[:, None, :] * model.words[None]), model.trust)
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    best = loss.argmin(1)
    top = share[np.arange(len(n)), best]
    return best, top, top < AMBIGUOUS


def identify(docs: DataFrame, model: Codes) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row, from its text alone.

    `und`, score 0 and ambiguous where the text is null or has no letter, or no language was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                texts = raw(batch, "text")
                known = [i for i, t in enumerate(texts) if _LETTER.search(t.decode(errors="replace"))] if model.languages else []
                names, scores, unsure = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if known:
                    counts = np.stack([feature_counts(texts[i]) for i in known]).astype(np.float64)
                    best, share, close = decode(counts, model)
                    scores[known], unsure[known] = share, close
                    for i, b in zip(known, best, strict=True):
                        names[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names), pa.array(scores), pa.array(unsure)], ["doc_id", "lang_pred", "score", "ambiguous"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def language_of(docs: DataFrame, folds: int = 5) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, ambiguous; learned from the text and lang of the other folds.

    Rows with null text or lang teach nothing. A null doc_id counts as empty text in the fold. Extra columns are ignored.
    """
    fold = id_text_remainder("doc_id", folds)
    model = learn(language_counts(docs.where(fold != 0).where("text is not null and lang is not null")))
    return identify(docs, model).select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "ambiguous")

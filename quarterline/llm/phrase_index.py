"""A distributed positional inverted index, and search of phrases in it.

Documents are dealt into segments of about a million words. A segment's rows are its postings, one row per term with the sorted places of
the term, and one row per document with the span of places that it takes; documents are apart by a gap that no phrase can cross. A search
takes the postings of the test terms, counts them, and starts each phrase from its rarest term: that list, moved by the term's offset, gives
the places where the phrase may start, one row per (segment, phrase). The lists of the other terms, moved by their offsets, are intersected
with them from the rarer to the more frequent, segment by segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import by_groups, raw, stored

#: Words of a segment; a longer text is a segment by itself.
SEGMENT = 1 << 20
#: Places between two documents: a phrase and twice its slop must be no longer.
GAP = 64
#: A-Z to a-z; other ASCII but digits and a-z to spaces; all bytes of other code points are parts of words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

POSTINGS = "segment long, term long, places array<int>, doc_id long, n_words int"


def index_words(text: bytes) -> list[bytes]:
    """Runs outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] once A-Z are lower-cased."""
    return text.translate(_FOLD).split()


def term_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def build_index(docs: DataFrame, tokens: Callable[[bytes], list[bytes]] = index_words, segment_words: int = SEGMENT) -> DataFrame:
    """The index of all words of all rows of `docs` (doc_id, text), stored in the shared folder.

    Rows with a term: its places in the segment, rising. Rows without one: a document, its first place (places[0]) and its n_words; there is
    one for each row of `docs`, also for null and empty texts, null ids and repeated rows. Terms are 64-bit hashes of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        ids, counts, words = [], [], []
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch, "text"), strict=True):
                found = tokens(text)
                if words and len(words) + len(found) > segment_words:
                    yield _segment(made, ids, counts, words)
                    made += 1
                    ids, counts, words = [], [], []
                ids.append(doc)
                counts.append(len(found))
                words += found
        if ids:
            yield _segment(made, ids, counts, words)

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, POSTINGS), "postings")


def _segment(made: int, ids: list, counts: list[int], words: list[bytes]) -> pa.RecordBatch:
    number = (TaskContext.get().partitionId() << 32) + made
    sizes = np.array(counts, np.int64)
    firsts = GAP + np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]])
    # Places of all words: their number in the segment, moved by the gaps before them.
    places = np.arange(len(words)) + np.repeat(firsts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    numbers: dict[bytes, int] = {}
    numbered = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
    order = np.argsort(numbered, kind="stable")
    ends = np.cumsum(np.bincount(numbered, minlength=len(numbers))) if words else np.zeros(0, np.int64)
    lists = np.concatenate([places[order], firsts]).astype(np.int32)
    offsets = np.concatenate([[0], ends, len(words) + np.arange(1, len(ids) + 1)]).astype(np.int32)
    terms = pa.array([term_of(w) for w in numbers] + [None] * len(ids), pa.int64())
    rows, blank = len(terms), [None] * len(numbers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, number, np.int64)), terms, pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists)),
            pa.array(blank + ids, pa.int64()), pa.array(blank + counts, pa.int32()),
        ],
        ["segment", "term", "places", "doc_id", "n_words"],
    )


def windows_of(items: DataFrame, length: int, tokens: Callable[[bytes], list[bytes]] = index_words) -> DataFrame:
    """item_id, window (64-bit hash of its terms), terms: all runs of `length` words of each item; an item of fewer words, but not none, is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), raw(batch, "text"), strict=True):
                terms = np.array([term_of(w) for w in tokens(text)], np.int64)
                if not len(terms):
                    continue
                held = np.lib.stride_tricks.sliding_window_view(terms, min(length, len(terms)))
                names = [xxhash.xxh3_64_intdigest(w.tobytes()) - (1 << 63) for w in held]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * held.shape[1]), pa.array(held.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(held), pa.string()), pa.array(names, pa.int64()), lists], ["item_id", "window", "terms"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(run, "item_id string, window long, terms array<long>")


def search(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """One row per document of the index: segment, first (its first place), doc_id, n_words, n_hit, exact, near.

    `windows` has (window, terms); repeated windows are harmless. exact: the distinct windows whose words stand in the document one after the
    other; n_hit: its words inside any occurrence of one. near: the other windows that have an occurrence of their rarest term from whose
    place every word is at most `slop` places away from where it should be (the first of equally rare terms, by offset).
    """
    if slop < 0:
        raise ValueError(f"slop of {slop}")
    distinct = stored(windows.groupBy("window").agg(F.first("terms").alias("terms")), "windows")
    terms = stored(distinct.select(F.explode("terms").alias("term")).distinct(), "terms")
    needed = stored(index.where("term IS NOT NULL").join(terms, "term", "left_semi").select("segment", "term", "places"), "needed")
    counts = needed.groupBy("term").agg(F.sum(F.size("places")).alias("n"))
    # A window's terms from the rarest to the most frequent; windows with a term that no document has are gone.
    placed = distinct.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term")).join(counts, "term")
    ranked = placed.groupBy("window", "size").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("ranked"))
    ranked = ranked.where(F.size("ranked") == F.col("size"))
    seeds = ranked.select(
        "window", F.col("ranked")[0]["term"].alias("term"), F.col("ranked")[0]["offset"].alias("offset"), F.col("ranked.term").alias("terms"), F.col("ranked.offset").alias("offsets")
    )
    starts = needed.join(stored(seeds, "seeds"), "term").select(
        "segment", F.lit(2).alias("kind"), F.col("window").alias("key"), F.expr("transform(places, p -> p - offset)").alias("places"), "terms", "offsets", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("n_words")
    )
    lists = needed.selectExpr("segment", "1 AS kind", "term AS key", "places", "CAST(NULL AS array<long>) AS terms", "CAST(NULL AS array<int>) AS offsets", "CAST(NULL AS long) AS doc_id", "CAST(NULL AS int) AS n_words")
    spans = index.where("term IS NULL").selectExpr("segment", "0 AS kind", "CAST(places[0] AS long) AS key", "CAST(NULL AS array<int>) AS places", "CAST(NULL AS array<long>) AS terms", "CAST(NULL AS array<int>) AS offsets", "doc_id", "n_words")
    rows = spans.unionByName(lists).unionByName(starts)
    # A segment's rows are bounded by its words and by the windows that start in it.
    return by_groups(rows, ["segment"], lambda group: _intersect(group, slop), "segment long, first long, doc_id long, n_words long, n_hit long, exact array<long>, near array<long>")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a list column."""
    whole = column.combine_chunks()
    return np.diff(whole.offsets.to_numpy()), whole.flatten().to_numpy()


def _intersect(group: pa.Table, slop: int) -> pa.Table:
    kind = group.column("kind").to_numpy()
    spans, lists, starts = (group.filter(pa.array(kind == k)) for k in range(3))
    order = np.argsort(spans.column("key").to_numpy(), kind="stable")
    spans = spans.take(pa.array(order))
    firsts, sizes = spans.column("key").to_numpy(), spans.column("n_words").to_numpy().astype(np.int64)
    n_hit = np.zeros(len(firsts), np.int64)
    exact = near = set()
    if starts.num_rows:
        lengths, terms = _lists(starts.column("terms"))
        if lengths.max() + 2 * slop > GAP:
            raise ValueError(f"a phrase of {lengths.max()} words with a slop of {slop} is longer than the gap of {GAP}")
        _, offsets = _lists(starts.column("offsets"))
        base = np.cumsum(lengths) - lengths
        counts, places = _lists(starts.column("places"))
        begun = np.repeat(np.arange(starts.num_rows), counts), places.astype(np.int64)
        close = _survivors(lists, begun, lengths, terms, offsets, slop)
        whole = _survivors(lists, close, lengths, terms, offsets, 0) if slop else close
        cover = np.zeros(int(firsts[-1] + sizes[-1]) + 2, np.int64)
        np.add.at(cover, whole[1], 1)
        np.add.at(cover, whole[1] + lengths[whole[0]], -1)
        hits = np.concatenate([[0], np.cumsum(np.cumsum(cover) > 0)])
        n_hit = hits[firsts + sizes] - hits[firsts]
        names, seeds = starts.column("key").to_numpy(), offsets[base]

        def pairs(window, start):
            # The seed is inside the document; the place where a phrase should start may lie before it by the slop.
            doc = np.searchsorted(firsts, start + seeds[window], side="right") - 1
            return set(zip(doc.tolist(), names[window].tolist(), strict=True))

        exact = pairs(*whole)
        near = pairs(*close) - exact
    columns = [spans.column("segment"), pa.array(firsts), spans.column("doc_id"), pa.array(sizes), pa.array(n_hit)]
    for found in (exact, near):
        held = np.array(sorted(found), np.int64).reshape(-1, 2)
        ends = np.searchsorted(held[:, 0], np.arange(len(firsts) + 1))
        columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(held[:, 1].copy())))
    return pa.table(columns, names=["segment", "first", "doc_id", "n_words", "n_hit", "exact", "near"])


def _survivors(lists: pa.Table, begun: tuple[np.ndarray, np.ndarray], lengths: np.ndarray, terms: np.ndarray, offsets: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """The (window, start) whose further terms, rarest first, are all at most `slop` places from start + offset."""
    names, inverse = np.unique(lists.column("key").to_numpy(), return_inverse=True)
    counts, places = _lists(lists.column("places"))
    # (term, place) as one number: a term is at a place if its number is among them.
    held = np.sort((np.repeat(inverse, counts).astype(np.int64) << 32) | places)
    ranks = np.searchsorted(names, terms)
    known = names[np.minimum(ranks, len(names) - 1)] == terms
    ranks = np.where(known, ranks, len(names)).astype(np.int64) << 32
    base = np.cumsum(lengths) - lengths
    window, start = begun
    for k in range(1, int(lengths.max())):
        more = lengths[window] > k
        at = base[window] + np.where(more, k, 0)
        wanted = ranks[at] + start + offsets[at]
        around = held[np.minimum(np.searchsorted(held, wanted - slop), len(held) - 1)]
        stays = ~more | (around >= wanted - slop) & (around <= wanted + slop)
        window, start = window[stays], start[stays]
    return window, start


def contaminated(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 0) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, items (the item_ids as text, sorted, of windows that occur), near_items.

    `items` has (item_id, text). Words are runs of letters, digits and code points beyond ASCII, A-Z lower-cased. A null text has no words.
    Rows that share an item_id are one item; the windows of an item without an id make hits but name no item.
    """
    if not 1 <= length <= GAP - 2 * slop:
        raise ValueError(f"a length of {length} with a slop of {slop} is none or beyond the gap of {GAP}")
    windows = stored(windows_of(items, length), "item_windows")
    found = stored(search(build_index(docs), windows, slop), "found")
    named = windows.where("item_id IS NOT NULL").select("window", "item_id").distinct()
    result = found
    for column, name in (("exact", "items"), ("near", "near_items")):
        hits = found.where(F.size(column) > 0).select("segment", "first", F.explode(column).alias("window")).join(named, "window")
        lists = hits.groupBy("segment", "first").agg(F.array_sort(F.collect_set("item_id")).alias(name))
        result = result.join(lists, ["segment", "first"], "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return result.select("doc_id", "n_words", "n_hit", "items", "near_items")

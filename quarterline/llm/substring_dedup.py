"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: it depends on the last WINDOW bytes only, so a text inserted before a passage does not move
the cuts within it. A cut is where four bits of the hash are zero, at least SHORTEST bytes after the last one; after LONGEST bytes a cut
is made anyway. Chunks that several documents hold are found by digest; within runs of them every shortest stretch of neighbouring chunks
that spans at least `least_words` words is a key of its own, and only stretches that another document holds whole are repeated passages.
A document loses the stretches that a smaller doc_id holds whole, and keeps the others at their first place. So a passage stays in the
smallest doc_id that holds it, but for parts of `least_words` words or more that a still smaller one holds. What repeats within a single
document only is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import raw, spread, stored

WINDOW, SHORTEST, LONGEST = 16, 16, 128
#: Bytes hashed at a time.
BLOCK = 1 << 20
_GEAR = (spread(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which the gear hash of the last WINDOW bytes allows a cut."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        # The hash of 2w bytes is that of the later w plus that of the earlier w, shifted by w.
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return np.flatnonzero((h >> np.uint32(20)) & np.uint32(15) == 0) + 1


def chunk_ends(candidates: list[int], size: int) -> list[int]:
    ends, last = [], 0
    for c in candidates:
        while c - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if c - last >= SHORTEST and c < size:
            ends.append(c)
            last = c
    while size - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def chunk(docs: DataFrame) -> DataFrame:
    """A row per input row: row (unique), doc_id, n_bytes and arrays over its chunks: digest, start, size, words begun."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            digests, starts, sizes, begun, offsets, lengths = [], [], [], [], [0], []
            for texts in _blocks(raw(batch, "text")):
                data = np.frombuffer(b"".join(texts), np.uint8)
                places = cut_places(data) if len(data) else np.zeros(0, np.int64)
                blank = _BLANK[data]
                word = ~blank
                word[1:] &= blank[:-1]
                edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                word[edges[:-1][np.diff(edges) > 0]] = ~blank[edges[:-1][np.diff(edges) > 0]]
                split = np.searchsorted(places, edges, side="right")
                first, all_ends = len(starts), []
                for i, text in enumerate(texts):
                    at, last = int(edges[i]), 0
                    for e in chunk_ends((places[split[i] : split[i + 1]] - at).tolist(), len(text)):
                        digests.append(xxhash.xxh3_64_intdigest(text[last:e]) - (1 << 63))
                        starts.append(last)
                        sizes.append(e - last)
                        all_ends.append(at + last)
                        last = e
                    offsets.append(len(digests))
                    lengths.append(len(text))
                if len(starts) > first:
                    begun.append(np.add.reduceat(word, all_ends, dtype=np.int16))
            n = len(lengths)
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in (
                (digests, pa.int64()), (starts, pa.int32()), (sizes, pa.int16()),
                (np.concatenate(begun) if begun else np.zeros(0, np.int16), pa.int16()),
            )]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists],
                ["row", "doc_id", "n_bytes", "digest", "start", "size", "words"],
            )
            row += n

    kind = "row long, doc_id long, n_bytes long, digest array<long>, start array<int>, size array<short>, words array<short>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def repeated_passages(docs: DataFrame, least_words: int = 25) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_chunks, repeated_bytes, removed_bytes, first_ids, removed (spans of bytes, from and to).

    repeated_bytes counts passages that other documents hold too, the first one included; `removed` lists those that are not the
    first and first_ids the smallest documents that hold them. Null or empty text has no chunks. Rows that share a doc_id count as one document, in which
    each row keeps its own first place; rows without a doc_id come after all others. Extra columns are ignored.
    """
    chunks = stored(chunk(docs), "chunks")
    owner = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("owner")
    held = chunks.select(owner, F.explode("digest").alias("digest"))
    repeated = held.groupBy("digest").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first <> last").select("digest")
    # Stored, so that the join deals out both of its sides anew and a chunk that very many documents hold can be split.
    repeated = stored(repeated, "repeated")
    place = F.struct("c.start", "c.size", "c.words", "c.digest").alias("place")
    places = chunks.select("row", owner, F.explode(F.arrays_zip("digest", "start", "size", "words")).alias("c")).select("c.digest", "row", "owner", place)
    found = places.join(repeated, "digest").groupBy("row", "owner").agg(F.sort_array(F.collect_list("place")).alias("found"))
    # The same again with stretches: a chance meeting of one chunk links nothing.
    long = stored(_stretches(found, least_words), "stretches")
    shared = long.groupBy("key").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first <> last").drop("last")
    linked = long.join(stored(shared, "shared"), "key").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("from", "to", "again", "first"))).alias("found"))
    narrow = chunks.select("row", "doc_id", "n_bytes", F.size("digest").cast("long").alias("n_chunks"))
    return _removals(narrow.join(linked, "row", "left"))


def spans(words: np.ndarray, least_words: int) -> np.ndarray:
    """Chunk numbers (first, end) of the shortest stretches of at least `least_words` words from each chunk on, and up to each chunk.

    Both are needed: together they cover every run of chunks of that many words, whatever stands before and after it.
    """
    before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    every = np.arange(len(before))
    on = np.stack([every, np.searchsorted(before, before + least_words, "left")], 1)
    back = np.stack([np.searchsorted(before, before - least_words, "right") - 1, every], 1)
    return np.unique(np.concatenate([on[on[:, 1] < len(before)], back[back[:, 0] >= 0]]), axis=0)


def _stretches(found: DataFrame, least_words: int) -> DataFrame:
    """row, owner, key, from, to, again (the row holds the stretch before) of the stretches of chunks that other documents hold too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            places = batch.column("found")
            offsets, values = places.offsets.to_numpy(), places.values
            start, size, words, digest = (values.field(k).to_numpy() for k in ("start", "size", "words", "digest"))
            end = start + size
            rows, keys, froms, tos, again = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                seen = set()
                cuts = a + 1 + np.flatnonzero(start[a + 1 : b] != end[a : b - 1])
                for x, y in zip([a, *cuts], [*cuts, b], strict=True):
                    if words[x:y].sum(dtype=np.int64) < least_words:
                        continue
                    data = digest[x:y].tobytes()
                    for f, t in spans(words[x:y], least_words).tolist():
                        key = xxhash.xxh3_64_intdigest(data[8 * f : 8 * t]) - (1 << 63)
                        rows.append(i)
                        keys.append(key)
                        froms.append(start[x + f])
                        tos.append(end[x + t - 1])
                        again.append(key in seen)
                        seen.add(key)
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(of), batch.column("owner").take(of), pa.array(keys, pa.int64()), pa.array(froms, pa.int32()), pa.array(tos, pa.int32()), pa.array(again, pa.bool_())],
                ["row", "owner", "key", "from", "to", "again"],
            )

    return found.mapInArrow(run, "row long, owner long, key long, `from` int, `to` int, again boolean")


def _removals(rows: DataFrame) -> DataFrame:
    kind = "doc_id long, n_bytes long, n_chunks long, repeated_bytes long, removed_bytes long, first_ids array<long>, removed array<struct<from:int,to:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            offsets, values = found.offsets.to_numpy(), found.values
            starts, ends, agains, firsts = (values.field(k).to_numpy(zero_copy_only=False) for k in ("from", "to", "again", "first"))
            owner = batch.column("doc_id").fill_null((1 << 63) - 1).to_numpy()
            repeated, removed, ids, spans_of = [], [], [], []
            for a, b, mine in zip(offsets[:-1], offsets[1:], owner, strict=True):
                edges = np.unique(np.concatenate([starts[a:b], ends[a:b]])).astype(np.int64)
                x, y, keeps = np.searchsorted(edges, starts[a:b]), np.searchsorted(edges, ends[a:b]), firsts[a:b] == mine
                covers = lambda some: np.cumsum(np.bincount(x[some], minlength=len(edges)) - np.bincount(y[some], minlength=len(edges)))[:-1] > 0  # noqa: E731, B023
                n, covered = np.diff(edges), covers(np.ones(b - a, bool))
                # A repetition within the keeper is cut only where it doesn't overlap a first place.
                gone = covers(~keeps) | (covered & ~covers(keeps & ~agains[a:b]))
                lost = np.concatenate([[0], np.cumsum(gone)])
                cause = ~keeps | agains[a:b]
                repeated.append(int(n[covered].sum()))
                removed.append(int(n[gone].sum()))
                ids.append(np.unique(firsts[a:b][cause & (lost[y] > lost[x])]).tolist() if b > a else [])
                cut = []
                for at in np.flatnonzero(gone).tolist():
                    if cut and cut[-1]["to"] == edges[at]:
                        cut[-1]["to"] = int(edges[at + 1])
                    else:
                        cut.append({"from": int(edges[at]), "to": int(edges[at + 1])})
                spans_of.append(cut)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_bytes", "n_chunks")), pa.array(repeated, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(ids, pa.list_(pa.int64())), pa.array(spans_of, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))],
                ["doc_id", "n_bytes", "n_chunks", "repeated_bytes", "removed_bytes", "first_ids", "removed"],
            )

    return rows.mapInArrow(run, kind)


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans; a cut within a character loses the rest of that character."""
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:a])
        last = b
    return b"".join([*out, text[last:]]).decode(errors="ignore").encode()

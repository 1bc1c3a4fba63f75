"""Vector bin packing of tokenised examples into training sequences.

An example is a vector: tokens, one segment, loss-bearing tokens. A sequence is a bin with a limit in each. The bin-centric dot-product
heuristic opens a bin and adds the fitting example whose vector has the largest product with the room left, each dimension weighted by
its total demand, until none fits. Equal vectors are one class with a count, so the work per placement does not grow with the examples.

A document is first cut into whole sequences and a tail of under one sequence; only tails are packed, in shards of bounded size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import MEMO, by_groups, raw, stored

LENGTH = 2048
#: Tails that one task packs at a time.
SHARD = 16_384
#: Ids of sequences: the upper bits name the task or shard, the lower ones count.
COUNT_BITS = 40
FIRST_SHARD = 1 << 22

#: Fixed by the tokenizer file: its split of a text and its end-of-text marks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARK = b"<|"


class WordIds(dict):
    """Lower-cased word between ASCII blanks -> its ids as little-endian 32-bit numbers; two generations of bounded size."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.split = regex.compile(SPLIT)
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, word: bytes) -> bytes:
        text = word.decode()
        if not (word.isascii() and text.isprintable()):
            # Normal forms, control characters and bytes beyond ASCII are left to the tokenizer's own steps.
            return np.array(self.whole(text), "<u4").tobytes()
        return b"".join(map(self.piece, (text,) if text.isalpha() else self.split.findall(text)))

    def piece(self, text: str) -> bytes:
        ids = self.pieces.get(text)
        if ids is None:
            ids = np.array([t.id for t in self.tokenize(text)], "<u4").tobytes()
            if len(self.pieces) >= MEMO // 3:
                self.pieces.clear()
            self.pieces[text] = ids
        return ids

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def document(self, text: bytes) -> bytes:
        """Ids of a text. Blanks part tokens, so its words can be encoded one by one; marks are case-sensitive, so texts with one are not."""
        if MARK in text:
            return np.array(self.whole(text.decode()), "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file, kept from task to task."""
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def cut(docs: DataFrame, path: str, end: int = 1, length: int = LENGTH) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, number (unique), whole (fills a sequence)."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, close = word_ids(path), np.array([end], "<u4").tobytes()
        number = TaskContext.get().partitionId() << COUNT_BITS
        for batch in batches:
            owner, start, size, crc, total = [], [], [], [], []
            for i, text in enumerate(raw(batch, "text")):
                ids = memoryview(table.document(text) + close)
                n = len(ids) // 4
                for a in range(0, n, length):
                    b = min(a + length, n)
                    owner.append(i)
                    start.append(a)
                    size.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                    total.append(n)
            sizes = pa.array(size, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()), sizes, pa.array(crc, pa.int64()),
                 pa.array(total, pa.int64()), pa.array(np.arange(number, number + len(size))), pc.equal(sizes, length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "number", "whole"],
            )
            number += len(size)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, number long, whole boolean")


def pack_vectors(vectors: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and rank in the bin of each row of `vectors`; a row beyond a limit gets a bin of its own."""
    bins, ranks = np.full(len(vectors), -1, np.int64), np.zeros(len(vectors), np.int64)
    classes, which, counts = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    order = np.argsort(which.ravel(), kind="stable")
    nexts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    demand = vectors.sum(0) / np.maximum(limits, 1)
    weighted = classes * (demand / np.maximum(limits, 1) ** 2)
    used = -1
    for k in np.flatnonzero((classes > limits).any(1)):
        mine = order[nexts[k] : nexts[k] + counts[k]]
        bins[mine] = np.arange(used + 1, used + 1 + len(mine))
        used += len(mine)
        counts[k] = 0
    alive = np.flatnonzero(counts)
    while len(alive):
        used += 1
        room, rank = limits.astype(np.float64).copy(), 0
        fits = alive
        while True:
            fits = fits[(classes[fits] <= room).all(1) & (counts[fits] > 0)]
            if not len(fits):
                break
            k = fits[np.argmax(weighted[fits] @ room)]
            item = order[nexts[k]]
            bins[item], ranks[item] = used, rank
            nexts[k] += 1
            counts[k] -= 1
            rank += 1
            room = room - classes[k]
        alive = alive[counts[alive] > 0]
    return bins, ranks


def pack(items: DataFrame, length: int = LENGTH, segments: int = 256, loss: int | None = None) -> DataFrame:
    """Place items (number, tokens, loss_tokens): adds sequence_id and offset; a sequence holds at most the three limits.

    An item beyond a limit gets a sequence of its own. Items are dealt into shards of bounded size by a hash of their unique number.
    """
    shards = max(1, -(-items.count() // SHARD))
    limits = np.array([length, segments, loss or length], np.int64)
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)))

    def place(rows: pa.Table) -> pa.Table:
        tokens = rows.column("tokens").to_numpy()
        vectors = np.stack([tokens, np.ones_like(tokens), rows.column("loss_tokens").to_numpy()], 1)
        bins, ranks = pack_vectors(vectors, limits)
        order = np.lexsort((ranks, bins))
        before = np.cumsum(tokens[order]) - tokens[order]
        first = np.concatenate([[True], np.diff(bins[order]) != 0])
        offsets = np.empty_like(tokens)
        offsets[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        shard = int(rows.column("shard")[0].as_py())
        rows = rows.drop_columns(["shard"])
        return rows.append_column("sequence_id", pa.array(((FIRST_SHARD + shard) << COUNT_BITS) + bins)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return by_groups(dealt, ["shard"], place, f"{fields}, sequence_id long, offset long", order=("number",))


def pack_documents(docs: DataFrame, path: str, end: int = 1, length: int = LENGTH, segments: int = 256) -> DataFrame:
    """Pieces of documents in sequences of at most `length` tokens.

    A document is its ids and then `end`; null text is empty text, so one token. Every row gets pieces of its own, also where a doc_id
    repeats or is null. Every id of a document bears loss. Extra columns are ignored; an empty table gives no pieces.
    """
    pieces = stored(cut(docs, path, end, length), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = pieces.where("whole").select(*columns, F.col("number").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    tails = pieces.where("not whole").select(*columns, "number", F.col("length").alias("tokens"), F.col("length").alias("loss_tokens"))
    return whole.unionByName(pack(tails, length, segments).select(*columns, "sequence_id", "offset"))

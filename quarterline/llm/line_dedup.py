"""Line deduplication: hash normalised lines with their positions, count the documents of each hash, drop frequent lines by position and put
the rest of each text together again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import raw, stored


def line_key(line: bytes, least: int) -> tuple[int, int] | None:
    """Two 64-bit halves of the key's hash; None for a key of under `least` code points."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode(errors="replace")) < least:
        return None
    value = xxhash.xxh3_128_intdigest(key)
    return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and two 64-bit hashes of the text: rows that share all of them lose the same lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})


def line_positions(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, h1, h2, high, low, positions: a row per distinct key of a text, with the positions of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, high, low, positions = [], [], [], []
            for row, text in enumerate(raw(batch, "text")):
                found: dict[tuple[int, int], list[int]] = {}
                for position, line in enumerate(text.split(b"\n")):
                    if (key := line_key(line, least)) is not None:
                        found.setdefault(key, []).append(position)
                rows += [row] * len(found)
                high += [k[0] for k in found]
                low += [k[1] for k in found]
                positions += found.values()
            index = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(index) for c in ("doc_id", "h1", "h2")), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(positions, pa.list_(pa.int32()))],
                ["doc_id", "h1", "h2", "high", "low", "positions"],
            )

    return _marked(docs).mapInArrow(run, "doc_id long, h1 long, h2 long, high long, low long, positions array<int>")


def lines_to_drop(docs: DataFrame, least: int, documents: int) -> DataFrame:
    """doc_id, h1, h2, drop: the positions of the lines that a text loses, no more than it has lines."""
    lines = stored(line_positions(docs, least), "lines")
    # max() passes over null ids, so a nameless document is never the one that keeps the line unless no other holds it.
    holders = lines.select("high", "low", "doc_id").distinct().groupBy("high", "low")
    frequent = holders.agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= documents).drop("n")
    # Stored, so that the join deals out both of its sides anew and a line that very many documents hold can be split.
    lost = lines.join(stored(frequent, "frequent"), ["high", "low"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    # Rows that repeat an id and a text count once.
    once = lost.groupBy("doc_id", "h1", "h2", "high", "low").agg(F.first("positions").alias("positions"))
    return stored(once.groupBy("doc_id", "h1", "h2").agg(F.flatten(F.collect_list("positions")).alias("drop")), "drops")


def drop_lines(docs: DataFrame, least: int = 20, documents: int = 3) -> DataFrame:
    """One row per input row: doc_id, text without the frequent lines, n_lines, n_dropped.

    Keys of at least `least` code points found in at least `documents` documents lose all their lines except in the largest doc_id that
    holds them; the other lines are put together again in the order of their positions. Null or empty text is one empty line. Rows that
    share a doc_id count as one document and lose the same keys; all rows without a doc_id count as one document that comes before all
    others. Extra columns are ignored.
    """
    rows = _marked(docs)
    drops = lines_to_drop(docs, least, documents).select(F.col("doc_id").alias("of"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "drop")
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drop = batch.column("drop")
            offsets, positions = drop.offsets.to_pylist(), drop.values.to_pylist()
            texts, total, gone = [], [], []
            for text, a, b in zip(raw(batch, "text"), offsets[:-1], offsets[1:], strict=True):
                if a == b:
                    texts.append(text)
                    total.append(text.count(b"\n") + 1)
                    gone.append(0)
                    continue
                lines, lost = text.split(b"\n"), set(positions[a:b])
                texts.append(b"\n".join([line for position, line in enumerate(lines) if position not in lost]))
                total.append(len(lines))
                gone.append(len(lost))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )

    return joined.select("doc_id", "text", "drop").mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")

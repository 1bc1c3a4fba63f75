"""Near duplicates by b-bit MinHash, with every link confirmed on full sets.

1. A document becomes the set of its word shingles, a digest of the set, band keys over MinHash minima, and the low bits of the minima.
2. Documents with equal sets form a class; only the class's smallest id goes on, so exact copies never pair up.
3. Within a bucket (a band key held by several classes) packed low bits are compared by bit counts, corrected for chance agreement;
   the estimated links are reduced to a spanning forest before they leave the task.
4. Classes joined by estimated links form a cluster. Its full sets are compared exactly; again only a spanning forest leaves the task.
   The components of the confirmed links are the result.

Large buckets and clusters are compared in pairs of blocks, each pair its own task, so all of a group meets without being in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import WordHashes, by_groups, raw, spread, stored, words
from quarterline.llm.components import components

#: Low bits kept of each minimum.
BITS = 4
#: Members of a bucket's block, and members and set elements of a cluster's block.
BUCKET_BLOCK, CLUSTER_BLOCK, CLUSTER_ELEMENTS = 4096, 2048, 2_000_000
_STEPS = spread(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


@dataclass(frozen=True)
class Near:
    """Texts are linked where 100 * intersection >= percent * union of their sets of `shingle` words.

    With 32 bands of 4 rows a link at similarity 0.8 is missed with a chance of 5e-8, one at 0.85 with 1e-10.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    @property
    def slots(self) -> int:
        return self.bands * self.rows

    @property
    def cut(self) -> float:
        """Estimates down to six standard deviations under the limit go on to the exact comparison."""
        s = self.percent / 100
        chance = 1 / (1 << BITS)
        agree = s + (1 - s) * chance
        return s - 6 * (agree * (1 - agree) / self.slots) ** 0.5 / (1 - chance)

    @property
    def most_unlike(self) -> int:
        """Slots in which an estimated link may differ: similarity = (agreement - chance) / (1 - chance)."""
        chance = 1 / (1 << BITS)
        return int(self.slots * (1 - (self.cut * (1 - chance) + chance)))


_HASHES = WordHashes()


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; with fewer words the whole sequence is one; empty without words."""
    tokens = words(text)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    if not len(h):
        return h
    k = min(size, len(h))
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        s = np.full(n, k, np.uint64)
        for i in range(k):
            s += h[i : i + n] * _STEPS[i % len(_STEPS)]
    return np.unique(spread(s))


def minima(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """32-bit MinHash minima, (documents, slots), of sets that aren't empty."""
    out = np.empty((len(sets), slots), np.uint32)
    odd = spread(np.arange(1, slots + 1, dtype=np.uint64)) | np.uint64(1)
    a = 0
    while a < len(sets):
        b, size = a, 0
        while b < len(sets) and (b == a or size + len(sets[b]) <= 60_000):
            size += len(sets[b])
            b += 1
        h = np.concatenate(sets[a:b])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[a : b - 1]], dtype=np.int64)])
        v = np.empty_like(h)
        for j in range(slots):
            np.multiply(h, odd[j], out=v)
            out[a:b, j] = np.minimum.reduceat(v, starts) >> np.uint64(32)
        a = b
    return out


def band_keys(mins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        parts = mins.reshape(len(mins), bands, rows).astype(np.uint64)
        key = np.broadcast_to(spread(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
        for r in range(rows):
            key = spread(key + parts[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def pack_bits(mins: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, two slots to a byte."""
    low = (mins & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return low[:, 0::2] | (low[:, 1::2] << np.uint8(4))


def unlike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Number of slots that differ between packed signatures (as 64-bit words): each differing slot is folded into one bit and counted."""
    x = one ^ many
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(-1)


def fingerprints(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys, packed bits; the last three are null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                sets = [shingle_set(t, near.shingle) for t in raw(batch, "text")]
                full = [i for i, s in enumerate(sets) if len(s)]
                mins = minima([sets[i] for i in full], near.slots)
                keys, bits = band_keys(mins, near.bands, near.rows), pack_bits(mins)
                digest, bands, packed = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                for j, i in enumerate(full):
                    digest[i], bands[i], packed[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), keys[j], bits[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "bands", "bits"],
                )

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, bits binary")


def forest(n: int, alike: Callable[[int, np.ndarray], np.ndarray], first: int = 0) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph in which `alike(i, others)` marks the neighbours of i among `others`.

    Breadth first: every node asks once, and only among those not reached yet, so a group that one member holds together costs one
    comparison with all and then few.
    """
    waiting, links = np.arange(n), []
    queue = [first]
    waiting = waiting[waiting != first]
    while len(waiting):
        if not queue:
            queue.append(int(waiting[0]))
            waiting = waiting[1:]
            continue
        i = queue.pop(0)
        hit = alike(i, waiting)
        if hit.any():
            reached = waiting[hit].tolist()
            links += [(i, j) for j in reached]
            queue += reached
            waiting = waiting[~hit]
    return links


def _block_pairs(rows: DataFrame, member: str, blocks: Column) -> DataFrame:
    """A row for each pair of blocks that a member takes part in; a group within one block has the one pair (0, 0)."""
    blocks = blocks.cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("__other")
    dealt = rows.select("*", F.pmod(F.xxhash64(member), blocks).cast("int").alias("__mine"), other)
    pair = F.least("__mine", "__other").cast("long") * (1 << 31) + F.greatest("__mine", "__other")
    return dealt.withColumn("pair", pair).drop("__mine", "__other")


def estimated_links(classes: DataFrame, near: Near) -> DataFrame:
    """a, b: forests of the links that band buckets and bit counts suggest."""
    keys = stored(classes.select("id", F.explode("bands").alias("bucket")), "buckets")
    # Stored, so that the join deals out both of its sides anew and a large bucket can be split.
    shared = stored(keys.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    rows = keys.join(shared, "bucket").join(classes.select("id", "bits"), "id")

    def links(group: pa.Table) -> pa.Table | None:
        ids = group.column("id").to_numpy()
        bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)
        found = forest(len(ids), lambda i, others: unlike(bits[i], bits[others]) <= near.most_unlike)
        return pa.table({"a": ids[[a for a, _ in found]], "b": ids[[b for _, b in found]]}) if found else None

    return by_groups(_block_pairs(rows, "id", F.ceil(F.col("members") / BUCKET_BLOCK)), ["bucket", "pair"], links, "a long, b long").distinct()


def _sets(docs: DataFrame, members: DataFrame, near: Near) -> DataFrame:
    """members with the full set of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, near.shingle).tobytes() for t in raw(batch, "text")]
            # Where rows share an id, the text of the class is the one with its digest.
            same = [xxhash.xxh3_128_digest(s) == d for s, d in zip(found, batch.column("digest").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("cluster"), pa.array([len(s) // 8 for s in found], pa.int64()), pa.array(found, pa.binary())],
                ["id", "cluster", "n", "set"],
            )
            yield out.filter(pa.array(same, pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(members.select("id", "cluster", "digest"), "id")
    return rows.mapInArrow(run, "id long, cluster long, n long, set binary")


def confirmed_links(sets: DataFrame, near: Near) -> DataFrame:
    """a, b: forests of the links that hold on the full sets, cluster by cluster."""
    sizes = sets.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.ceil(F.col("members") / CLUSTER_BLOCK), F.ceil(F.col("elements") / CLUSTER_ELEMENTS))
    rows = sets.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")

    def links(group: pa.Table) -> pa.Table | None:
        ids, n = group.column("id").to_numpy(), group.column("n").to_numpy()
        flat = np.frombuffer(b"".join(group.column("set").to_pylist()), np.uint64)
        starts = np.concatenate([[0], np.cumsum(n)])
        # Small numbers for the elements: an element held once can't add to an intersection.
        _, flat, held = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(ids)), n)
        useful = held[flat] > 1
        shared = [flat[starts[i] : starts[i + 1]][useful[starts[i] : starts[i + 1]]] for i in range(len(ids))]
        pool, pool_owner = flat[useful], owner[useful]
        mark = np.zeros(len(held), bool)
        alive = np.ones(len(ids), bool)

        def alike(i: int, others: np.ndarray) -> np.ndarray:
            nonlocal pool, pool_owner
            if len(others) < 0.7 * alive.sum():
                # Members reached already are asked about no more.
                alive[:] = False
                alive[others] = True
                keep = alive[pool_owner]
                pool, pool_owner = pool[keep], pool_owner[keep]
            mark[shared[i]] = True
            both = np.bincount(pool_owner[mark[pool]], minlength=len(ids))[others]
            mark[shared[i]] = False
            return 100 * both >= near.percent * (n[i] + n[others] - both)

        # The member whose elements the others hold most often, for its size, likely links to most of them.
        centre = int(np.argmax(np.add.reduceat(held[flat], starts[:-1]) / n)) if len(ids) > 2 else 0
        found = forest(len(ids), alike, centre)
        return pa.table({"a": ids[[a for a, _ in found]], "b": ids[[b for _, b in found]]}) if found else None

    return by_groups(_block_pairs(rows, "id", F.col("blocks")), ["cluster", "pair"], links, "a long, b long")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable, itself included), kept.

    Null or empty texts and texts without words are linked with nothing. Rows that share a doc_id are one node: their texts' links all
    count for it. A row without a doc_id links with nothing, has a null component and is kept. Extra columns are ignored.
    """
    prints = stored(fingerprints(docs, near), "prints")
    named = prints.where("doc_id is not null and digest is not null")
    smallest = stored(named.groupBy("digest").agg(F.min("doc_id").alias("id")), "smallest")
    of_class = named.select("digest", "doc_id", "bands", "bits").join(smallest, "digest").where("doc_id = id")
    classes = stored(of_class.select("digest", "id", "bands", "bits").dropDuplicates(["digest"]), "classes")
    suggested = stored(estimated_links(classes, near), "suggested")
    clusters = components(suggested).withColumnRenamed("component", "cluster")
    members = classes.select("id", "digest").join(clusters, "id")
    sets = stored(_sets(docs, members, near), "sets")
    # Links between ids; an id that is given with several sets also ties their classes together.
    sets_of = F.xxhash64("digest")
    several = named.groupBy("doc_id").agg(F.min(sets_of).alias("least"), F.max(sets_of).alias("most")).where("least <> most")
    copies = named.join(smallest, "digest").where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    shared_ids = copies.join(several.select(F.col("doc_id").alias("a")), "a", "left_semi")
    found = components(confirmed_links(sets, near).unionByName(shared_ids))
    of_row = prints.select("doc_id", "n_shingles", "digest").join(smallest, "digest", "left").withColumn("id", F.coalesce("id", "doc_id"))
    component = F.coalesce("component", "id")
    return (
        of_row.join(found.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_copies(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The rows of `docs` whose doc_id is its component's; columns as they were; a row without a doc_id stays."""
    gone = near_duplicates(docs, near).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

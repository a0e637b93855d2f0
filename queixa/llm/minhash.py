"""Near-duplicate groups by min-max hashing.

Every permutation of the shingle space gives two signature values, its minimum and its
maximum over the document's shingles, so a signature of k values takes k/2 hash evaluations.
Bands of r values are bucket keys. Bands are numerous enough to miss a pair at the threshold
with a chance of MISSED; every link is then confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queixa.llm.graph import components
from queixa.llm.words import SPACED, as_lists, as_long, hashed, mixed, windows
from queixa.session import write_and_read_back

# Values in a band, and the accepted chance that no band of a pair at the threshold agrees.
BAND, MISSED = 7, 1e-6
SEED = 20250101
# How many times longer the bands are that tell apart what shares a bucket without being linked.
LONGER = 2
# Sets in a block that is compared with another.
BLOCK = 128


def bands_needed(similarity: float, band: int = BAND, missed: float = MISSED) -> int:
    return max(1, math.ceil(math.log(missed) / math.log(1 - similarity ** band))) if similarity < 1 else 1


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of `texts`, a few at a time: their shingles' hashes with repeats, and the row bounds."""
    for part in hashed(texts, SPACED, fold=True):
        n_words = np.diff(part.bounds)
        count = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(count)])
        full = windows(part.hashes, size)
        out = np.empty(bounds[-1], dtype=np.uint64)
        long_rows = np.flatnonzero(n_words >= size)
        rows = np.repeat(long_rows, count[long_rows])
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(count[long_rows]) - count[long_rows], count[long_rows])
        out[bounds[rows] + inside] = full[part.bounds[rows] + inside]
        for i in np.flatnonzero((n_words > 0) & (n_words < size)):
            words = part.hashes[part.bounds[i]:part.bounds[i + 1]]
            out[bounds[i]] = windows(words, len(words))[0] ^ np.uint64(len(words))
        yield out, bounds


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _buckets(shingles: np.ndarray, bounds: np.ndarray, bands: int, band: int) -> np.ndarray:
    """Bucket keys (rows, bands) of the rows that have shingles."""
    half = -(-bands * band // 2)
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 63, half, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 1 << 63, half, dtype=np.uint64)
    names = mixed(np.arange(1, bands + 1, dtype=np.uint64) + np.uint64(band << 32))
    starts = bounds[:-1][np.diff(bounds) > 0]
    values = np.zeros((len(starts), 2 * half), dtype=np.uint64)
    for i in range(half if len(starts) else 0):
        x = (shingles ^ masks[i]) * factors[i]
        values[:, 2 * i] = np.minimum.reduceat(x, starts)
        values[:, 2 * i + 1] = np.maximum.reduceat(x, starts)
    powers = np.cumprod(np.full(band, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)
    cut = mixed(values[:, :bands * band]).reshape(len(starts), bands, band)
    return mixed((cut * powers).sum(axis=2, dtype=np.uint64) ^ names)


def _signatures(batches: Iterator[pa.RecordBatch], size: int, bands: int, band: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, n_shingles, node, buckets): the node is a fingerprint of the whole set."""
    for batch in batches:
        at = 0
        for shingles, bounds in shingle_sets(batch.column(1), size):
            n = len(bounds) - 1
            filled = np.flatnonzero(np.diff(bounds))
            buckets = _buckets(shingles, bounds, bands, band)
            sizes = np.zeros(n, dtype=np.int64)
            nodes: list[bytes | None] = [None] * n
            for i in filled.tolist():
                own = np.unique(shingles[bounds[i]:bounds[i + 1]])
                sizes[i], nodes[i] = len(own), _set_key(own)
            per_row = np.zeros(n + 1, dtype=np.int64)
            per_row[filled + 1] = bands
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[at:at + n], batch.column(2)[at:at + n], pa.array(sizes), pa.array(nodes, pa.binary()),
                 as_lists(buckets.ravel(), np.cumsum(per_row))],
                names=["doc_id", "text_key", "n_shingles", "node", "buckets"])
            at += n


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shingles, bounds in shingle_sets(batch.column(0), size):
            own = [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_key(x) if len(x) else None for x in own], pa.binary()),
                 as_lists(np.concatenate(own) if len(own) else np.empty(0, np.uint64), ends)], names=["node", "shingles"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select("a", "b"))


def _similar_sizes(n_a: str, n_b: str, percent: int):
    """Sets of too different sizes can't reach the threshold."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _set_signatures(batches: Iterator[pa.RecordBatch], bands: int, band: int) -> Iterator[pa.RecordBatch]:
    """(node, buckets) of stored sets."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            some = batch.column(1)[i:i + 64]
            bounds = np.concatenate([[0], np.cumsum(np.diff(some.offsets.to_numpy()))])
            flat = some.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            found = _buckets(flat, bounds, bands, band)
            ends = np.arange(0, found.size + 1, bands)
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:i + 64], as_lists(found.ravel(), ends)], names=["node", "buckets"])


def _shared(members: DataFrame) -> DataFrame:
    """The members (node, n, bucket) of buckets that hold several, with the bucket's central member.

    Central is who shares its buckets with most others: in a family of copies that differ
    from one text, that text, to which all of them are closer than to each other."""
    size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    kept = write_and_read_back(members.join(size, "bucket"), "buckets")
    score = kept.groupBy("node").agg(F.sum("m").alias("score"))
    central = kept.join(score, "node").groupBy("bucket").agg(F.max_by("node", F.struct("score", "node")).alias("central"))
    return write_and_read_back(kept.drop("m").join(central, "bucket"), "central")


def _open(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members, with their components, of buckets that hold several components."""
    named = members.join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
    still = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return named.join(still.select("bucket"), "bucket")


def _compare(key: tuple, rows: pa.Table, percent: int) -> pa.Table:
    """Links between two blocks of sets (or within one) that join different components."""
    rows = rows.combine_chunks()
    low, high = key[1].as_py(), key[2].as_py()
    block = rows.column("block").to_numpy()
    nodes, roots = rows.column("node").to_pylist(), rows.column("root").to_pylist()
    lists = rows.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    known, flat = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    flat, bounds = flat.ravel(), np.concatenate([[0], np.cumsum(sizes)])
    found: list[tuple[bytes, bytes]] = []
    marked = np.zeros(len(known), dtype=np.int64)
    for i in np.flatnonzero(block == low).tolist():
        own = flat[bounds[i]:bounds[i + 1]]
        marked[own] = 1
        both = np.add.reduceat(marked[flat], bounds[:-1])
        marked[own] = 0
        near = (100 * both >= percent * (sizes[i] + sizes - both)) & (block == high)
        found += [(nodes[i], nodes[j]) for j in np.flatnonzero(near).tolist() if roots[i] != roots[j]]
    return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([x for _, x in found], pa.binary())})


def _blockwise(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of documents that open buckets hold together.

    Documents tied by open buckets form a cluster; its members are dealt to blocks, and each pair of blocks
    is one small group. Sets are sent once per block of their cluster, pairs of documents aren't rows."""
    ties = components(open_.where("node <> central").select(F.col("node").alias("a"), F.col("central").alias("b")))
    members = open_.select("node", "root").distinct().join(
        ties.withColumnRenamed("root", "cluster"), "node")
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root")

    def compare(key, rows):
        return _compare(key, rows, percent)
    return sent.join(sets, "node").groupBy("cluster", "low", "high").applyInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, band: int = BAND) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least `percent` / 100.

    `docs` needs `doc_id` and `text`; other columns are ignored. Words are runs without
    whitespace, A-Z lowered; a set holds the distinct runs of `shingle` words, or the whole
    sequence if it is shorter. One row per document: doc_id, n_shingles, component_id (the
    smallest doc_id reachable over links), kept, text_key (xxhash64 of the text). Null texts and
    texts without words have empty sets and no links. A null doc_id counts after all others.
    Repeated rows stay, each with the same result. Equal sets are one node, so copies cost a row
    each and never pairs.

    In each bucket the central member is tested against all others, and linked members become
    components. What is still open, buckets with several components, is dealt anew to buckets
    of bands LONGER times as long, which few unlinked pairs share; there the same is done. Documents
    that are still open together are then compared with each other in blocks of BLOCK sets, which emit
    links only. So a family of thousands of near copies costs stars, not all its pairs, and no link
    that a bucket reveals is lost.
    """
    bands = bands_needed(percent / 100, band=band)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = write_and_read_back(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
            partial(_signatures, size=shingle, bands=bands, band=band),
            f"doc_id {kind}, text_key long, n_shingles long, node binary, buckets array<long>"), "signatures")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"))
    members = _shared(nodes.select("node", "n", F.explode("buckets").alias("bucket")))

    wanted = members.select("node").distinct()
    texts = nodes.join(wanted, "node", "left_semi").select("doc_id").distinct()
    sets = write_and_read_back(
        docs.select("doc_id", "text").join(texts, docs["doc_id"].eqNullSafe(texts["doc_id"]), "left_semi").select("text")
        .mapInArrow(partial(_sets, size=shingle), "node binary, shingles array<long>")
        .join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")

    def tested(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (a, n_a, b, n_b)."""
        pairs = pairs.where(_similar_sizes("n_a", "n_b", percent)).select("a", "b").distinct()
        return write_and_read_back(_confirmed(pairs, sets, percent), "links")

    def stars(rows_: DataFrame) -> DataFrame:
        centre = rows_.where("node = central").select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a"))
        other = rows_.where("node <> central").select("bucket", F.col("node").alias("b"), F.col("n").alias("n_b"))
        return other.join(centre, "bucket")

    links = tested(stars(members))
    label = components(links)
    open_nodes = _open(members, label).select("node", "n").distinct()
    long_bands = bands_needed(percent / 100, band=LONGER * band)
    again = sets.join(open_nodes.select("node"), "node", "left_semi").mapInArrow(
        partial(_set_signatures, bands=long_bands, band=LONGER * band), "node binary, buckets array<long>")
    members = _shared(again.join(open_nodes, "node").select("node", "n", F.explode("buckets").alias("bucket")))
    links = links.union(tested(stars(members)))
    label = components(links)
    left = write_and_read_back(_open(members, label), "open")
    found = write_and_read_back(_blockwise(left, sets, percent), "links")
    if not found.isEmpty():
        label = components(links.union(found))

    owner = nodes.join(label, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    smallest = owner.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    owner = owner.join(smallest, "root").select("node", "component_id")
    placed = rows.select("doc_id", "text_key", "n_shingles", "node").join(owner, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """All columns of the documents that stay: of each group that with the smallest doc_id.

    Of rows that repeat a kept doc_id and text one stays."""
    kept = near_duplicates(docs, shingle, percent).where("kept").select(
        F.col("doc_id").alias("kept doc_id"), F.col("text_key").alias("kept text")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("kept doc_id")) & (F.xxhash64(docs["text"]) == F.col("kept text"))
    return docs.join(kept, same).dropDuplicates(["kept doc_id", "kept text"]).drop("kept doc_id", "kept text")

"""Approximate nearest neighbours with a forest of hash prefixes.

Every tree hashes a vector to a long bit string (signs of projections onto random orthogonal
directions) and keeps the vectors sorted by it. A query descends each tree to its longest matching
prefix and then ascends in all trees at once until the vectors below its places are enough; these
are a contiguous piece of each sorted array and are scored exactly.

The forest is built shard by shard where the vectors are read, so they are neither shuffled nor
stored once per tree. Queries are sent in blocks of bounded size, one search after another.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queixa.session import shared_folder

TREES, BITS = 64, 32
# Places that a query looks at over all trees, as a share of the shard: this sets the recall.
# Nearest neighbours of random directions are barely nearer than others, so it is high.
SHARE = 0.6
# Vectors in one shard, and bytes of the queries that are sent at once.
ROWS, BLOCK_BYTES = 20_000, 16 * 1024**2
# What the fast product may be off by.
SLACK = 1e-5
SEED = 5


def directions(size: int, trees: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(trees * bits) directions, orthogonal in blocks of `size`: their signs say more than independent ones."""
    rng = np.random.default_rng(seed)
    need, blocks = trees * bits, []
    while sum(len(b) for b in blocks) < need:
        blocks.append(np.linalg.qr(rng.standard_normal((size, size)))[0].T)
    return np.concatenate(blocks)[:need].astype(np.float32)


def hashes(unit: np.ndarray, axes: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(trees, rows) bit strings, the first bit highest."""
    found = np.empty((trees, len(unit)), dtype=np.int64)
    worth = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for t in range(trees):
        found[t] = (unit @ axes[t * bits:(t + 1) * bits].T >= 0) @ worth
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=-1) / (np.sqrt((x * x).sum(axis=-1)) * np.sqrt((y * y).sum(axis=-1)))


class Shard:
    """A forest over some vectors. Equal vectors are one, with their `most` smallest ids, so a mass of
    copies doesn't fill a node."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray, trees: int, bits: int, most: int):
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order] + 0.0)
        _, first, which = np.unique(x.view(f"V{x.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        by = np.argsort(which, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(which))])
        self.ids = [np.unique(ids[by[a:b]])[:most] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        self.x, self.bits = x[first], bits
        self.unit = _unit(self.x)
        found = hashes(self.unit, axes, trees, bits)
        self.order = np.argsort(found, axis=1, kind="stable")
        self.sorted = np.take_along_axis(found, self.order, axis=1)

    def _deepest(self, values: np.ndarray) -> np.ndarray:
        """Descent: each query's longest prefix that some vector shares, over all trees."""
        longest = np.zeros(values.shape[1], dtype=np.int64)
        for sorted_, mine in zip(self.sorted, values, strict=True):
            at = np.searchsorted(sorted_, mine)
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(sorted_) - 1)):
                differ = np.frexp((sorted_[near] ^ mine).astype(np.float64))[1]
                longest = np.maximum(longest, self.bits - differ)
        return longest

    def _spans(self, values: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query: where the vectors that share `depth` bits begin and end."""
        drop = self.bits - depth
        low = values >> drop << drop
        high = low + (np.int64(1) << drop)
        return (np.array([np.searchsorted(s, v) for s, v in zip(self.sorted, low, strict=True)]),
                np.array([np.searchsorted(s, v) for s, v in zip(self.sorted, high, strict=True)]))

    def places(self, values: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Spans after the ascent: all trees stand at one depth, the largest with enough vectors below.

        Vectors below grow with every step up, so the depth is found by halving."""
        deep = self._deepest(values)
        up = np.zeros_like(deep)
        while (up < deep).any():
            middle = (up + deep + 1) // 2
            begin, end = self._spans(values, middle)
            enough = (end - begin).sum(axis=0) >= share * len(self.x)
            up, deep = np.where(enough, middle, up), np.where(enough, deep, middle - 1)
        return self._spans(values, up)

    def nearest(self, q: np.ndarray, unit: np.ndarray, own: int, begin: np.ndarray, end: np.ndarray, k: int) -> list[tuple]:
        """The k best (-score, id) below the places of one query."""
        below = np.zeros(len(self.x), dtype=bool)
        for order, a, b in zip(self.order, begin.tolist(), end.tolist(), strict=True):
            below[order[a:b]] = True
        rows = np.flatnonzero(below)
        near = self.unit[rows] @ unit
        want = k + 1
        while True:
            least = -2.0 if len(rows) <= want else np.partition(near, len(rows) - want)[len(rows) - want] - SLACK
            take = rows[near >= least]
            best: dict[int, float] = {}
            for row, score in zip(take.tolist(), cosine(self.x[take], q).tolist(), strict=True):
                for i in self.ids[row].tolist():
                    if i != own:
                        best[i] = max(best.get(i, -2.0), score)
            # ids that repeat with other vectors take up places: then look at more
            if len(best) >= k or len(take) == len(rows):
                return sorted((-score, i) for i, score in best.items())[:k]
            want *= 2


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield _arrays(held)
                held, n = [], 0
    if held:
        yield _arrays(held)


def _arrays(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(held)
    return table.column(0).to_numpy(), _matrix(table.column(1))


def _search(batches: Iterator[pa.RecordBatch], asked, k: int, trees: int, bits: int, share: float, rows: int) -> Iterator[pa.RecordBatch]:
    """Each query's k best among the task's vectors."""
    query_ids, q = asked.value
    best: list[list[tuple]] = [[] for _ in query_ids]
    axes = values = None
    unit = _unit(q)
    for ids, x in _shards(batches, rows):
        if axes is None:
            axes = directions(x.shape[1], trees, bits)
            values = hashes(unit, axes, trees, bits)
        shard = Shard(ids, x, axes, trees, bits, k + 1)
        begin, end = shard.places(values, share)
        for i, own in enumerate(query_ids.tolist()):
            known = dict[int, float]()
            for score, j in best[i] + shard.nearest(q[i], unit[i], own, begin[:, i], end[:, i], k):
                known[j] = min(known.get(j, 2.0), score)
            best[i] = sorted((score, j) for j, score in known.items())[:k]
    counts = np.array([len(x) for x in best], dtype=np.int64)
    flat = [x for mine in best for x in mine]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(query_ids, counts), pa.int64()), pa.array([j for _, j in flat], pa.int64()),
         pa.array([-score for score, _ in flat], pa.float64())], names=["query_id", "vec_id", "score"])


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, bits: int = BITS,
            share: float = SHARE, rows: int = ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest vectors found for each query: query_id, rank (from 1), vec_id, score (cosine).

    `embeddings` needs vec_id (a whole number) and embedding; `queries` needs vec_id and
    embedding, rows of the same kind; other columns are ignored. All vectors should have one
    length; those of another than the commonest (of two, the longer), null or zero ones, and those with null or
    non-finite parts take no part, nor do rows without id. A query's own id is no candidate. Ties go to the
    smaller vec_id. An id with several vectors counts once, with its best score; asked with several, its
    smallest vector (part by part) is the query. Queries with fewer than k candidates get fewer rows.
    """
    spark = embeddings.sparkSession

    def usable(rows_: DataFrame) -> DataFrame:
        x = F.col("embedding")
        fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
        return rows_.select(F.col("vec_id").cast("long").alias("vec_id"), x).where("vec_id is not null").where(fine)

    every = usable(embeddings)
    size = every.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = size.n if size else 1
    every = every.where(F.size("embedding") == size)
    asked = usable(queries).where(F.size("embedding") == size).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    parts = max(1, -(-asked.count() // max(1, block_bytes // (8 * size))))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path = os.path.join(shared_folder(spark), f"nearest-{uuid.uuid4().hex}")
    for i in range(parts):
        block = asked.where(part == i).toArrow()
        sent = spark.sparkContext.broadcast((block.column(0).to_numpy(), _matrix(block.column(1))))
        found = every.mapInArrow(
            partial(_search, asked=sent, k=k, trees=trees, bits=bits, share=share, rows=rows),
            "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema("query_id long, rank int, vec_id long, score double").parquet(path)

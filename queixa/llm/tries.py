"""Conversations as a trie of their turns, built in double arrays per prefix shard.

Distinct turn sequences, dealt to shards by range, so that a shard holds neighbouring prefixes and a
hot first turn is split among shards. In a shard the turns are numbered densely, BASE and CHECK
are packed level by level, and walking every sequence through them gives the nodes and their
sums. Only nodes on a shard's first or last sequence can also lie in a neighbour: these upper
nodes come out as parts and are merged over all shards. A part counts what its shard owns (a
node belongs to the first shard that has it), so the parts of a node simply add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queixa.llm.chunks import offsets
from queixa.session import write_and_read_back

# Conversations of one family (conv_id // 20) may start with up to three turns of its first one.
FAMILY, MOST_SHARED = 20, 4
# Turns of distinct sequences in a shard.
SHARD_TURNS = 1 << 19
# A set of siblings of up to so many is fitted into gaps, a larger one goes behind the last cell.
FITTED = 64
# Text handed on at once to the task that digests the ids of a long list.
BLOCK_BYTES = 1 << 20
KEY = 16

NODES = pa.schema([
    ("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("ended", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])


class DoubleArray:
    """A trie over dense codes: the child of cell s by code c is cell BASE[s] + c, if CHECK there is s; cell 0 is the root."""

    def __init__(self) -> None:
        self.base, self.check = np.zeros(1, dtype=np.int64), np.full(1, -1, dtype=np.int64)
        self.free = np.zeros(1, dtype=bool)
        self.low, self.end = 1, 1  # the first free cell, and the one behind the last used

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])
            self.free = np.concatenate([self.free, np.ones(more, dtype=bool)])

    def _take(self, cells: np.ndarray, parents: np.ndarray) -> None:
        self.check[cells] = parents
        self.free[cells] = False
        self.end = max(self.end, int(cells.max()) + 1)
        while self.low < self.end and not self.free[self.low]:
            ahead = self.free[self.low:self.low + 4096]
            self.low += int(ahead.argmax()) if ahead.any() else len(ahead)

    def _fit(self, steps: np.ndarray) -> int:
        """The first cell from which all of `steps` ahead are free."""
        if len(steps) > FITTED:
            self._reach(self.end + int(steps[-1]) + 1)
            return self.end
        at = self.low
        while True:
            self._reach(at + 4096 + int(steps[-1]) + 1)
            cells = at + np.flatnonzero(self.free[at:at + 4096])
            good = self.free[cells[:, None] + steps].all(axis=1)
            if good.any():
                return int(cells[good.argmax()])
            at += 4096

    def add(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Cells of new children, given sorted by parent; a parent's children come all at once."""
        cells = np.empty(len(parents), dtype=np.int64)
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(starts, len(parents)))
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            own = codes[start:start + size]
            least = int(own.min())
            self.base[parents[start]] = first = self._fit(np.sort(own) - least) - least
            cells[start:start + size] = first + own
            self._take(cells[start:start + size], parents[start:start + size])
        single = starts[sizes == 1]
        if len(single):
            self._reach(self.end + len(single))
            found = self.low + np.flatnonzero(self.free[self.low:self.end + len(single)])[:len(single)]
            cells[single] = found
            self.base[parents[single]] = found - codes[single]
            self._take(found, parents[single])
        return cells

    def step(self, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        found = self.base[cells] + codes
        if not (self.check[found] == cells).all():
            raise AssertionError("a sequence left the trie")
        return found


def _pack(turns: np.ndarray, bounds: np.ndarray, n_turns: int) -> tuple[DoubleArray, np.ndarray]:
    """The double array of sequences (turns[bounds[i]:bounds[i + 1]]) and the codes of their turns.

    Turns are numbered as the levels first show them, so siblings have codes close together."""
    trie, codes, known = DoubleArray(), np.full(n_turns, -1, dtype=np.int64), 0
    sizes, cells = np.diff(bounds), np.zeros(len(bounds) - 1, dtype=np.int64)
    live, depth = np.flatnonzero(sizes > 0), 0
    while len(live):
        both, back = np.unique(cells[live] * n_turns + turns[bounds[live] + depth], return_inverse=True)
        parents, own = np.divmod(both, n_turns)
        new, first = np.unique(own[codes[own] < 0], return_index=True)
        codes[new[np.argsort(first)]] = known + np.arange(len(new))
        known += len(new)
        cells[live] = trie.add(parents, codes[own])[back]
        depth += 1
        live = live[sizes[live] > depth]
    return trie, codes


def _lists(column: pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """Fixed-size keys of a column of lists, joined, and each row's bounds among them (a null list is empty)."""
    lists = [x or [] for x in column.to_pylist()]
    return b"".join(k for x in lists for k in x), offsets(np.array([len(x) for x in lists], dtype=np.int64))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def shard_nodes(sequences: pa.Table, beside: pa.Table) -> pa.Table:
    """The nodes of one shard; `beside` has its first and last sequence and those next to them in other shards."""
    keys, bounds = _lists(sequences["keys"])
    edges = [_lists(beside[n]) for n in ("first", "last", "before", "after")]
    every, turns = np.unique(np.frombuffer(keys + b"".join(e[0] for e in edges), dtype=f"S{KEY}"), return_inverse=True)
    turns = turns.reshape(-1)
    at = offsets(np.array([int(bounds[-1]), *(int(e[1][-1]) for e in edges)]))
    first, last, before, after = (turns[at[i]:at[i + 1]] for i in range(1, 5))
    turns = turns[:at[1]]
    trie, codes = _pack(turns, bounds, max(1, len(every)))

    cells = len(trie.check)
    n_convs, depth, words = (np.zeros(cells, dtype=np.int64) for _ in range(3))
    conv_id = np.full(cells, np.iinfo(np.int64).max)
    ended = np.full(cells, -1, dtype=np.int64)
    count, least = sequences["n"].to_numpy(), sequences["conv_id"].to_numpy()
    n_words = np.array([w for x in sequences["words"].to_pylist() for w in x], dtype=np.int64)
    sizes, now, live, level = np.diff(bounds), np.zeros(len(count), dtype=np.int64), np.arange(len(count)), 0
    while len(live):
        np.add.at(n_convs, now[live], count[live])
        np.minimum.at(conv_id, now[live], least[live])
        depth[now[live]] = level
        stops = sizes[live] == level
        ended[now[live[stops]]] = live[stops]
        live = live[~stops]
        place = bounds[live] + level
        now[live] = trie.step(now[live], codes[turns[place]])
        words[now[live]] = n_words[place]
        level += 1

    def along(path: np.ndarray, other: np.ndarray, known: bool) -> list[int]:
        """Cells on `path` that the neighbour has too: the root and as far as both sequences agree."""
        found = [0] if known else []
        for code in codes[path[:_common(path, other)]].tolist() if known else []:
            found.append(int(trie.step(np.array([found[-1]]), np.array([code]))[0]))
        return found
    has_before, has_after = (beside[n][0].as_py() is not None for n in ("before", "after"))
    earlier, later = along(first, before, has_before), along(last, after, has_after)
    owned, shared = np.ones(cells, dtype=bool), np.zeros(cells, dtype=bool)
    owned[earlier] = False
    shared[earlier], shared[later] = True, True

    used = np.flatnonzero(n_convs > 0)
    used = used[np.argsort(depth[used], kind="stable")]
    parent = np.maximum(trie.check, 0)
    n_children, n_leaves = np.zeros(cells, dtype=np.int64), np.zeros(cells, dtype=np.int64)
    has_child = np.zeros(cells, dtype=bool)
    has_child[parent[used[1:]]] = True
    np.add.at(n_children, parent[used[1:]], owned[used[1:]])
    n_leaves[used] = ~has_child[used]
    n_leaves[later] = 0  # it goes on in the next shard; deeper leaves are added below
    saved = (n_convs - owned) * words
    cuts = np.flatnonzero(np.diff(depth[used])) + 1
    for level in reversed(np.split(used, cuts)[1:]):
        np.add.at(n_leaves, parent[level], n_leaves[level])
        np.add.at(saved, parent[level], saved[level])

    # names of shared nodes: a digest of the turns down to them
    name: dict[int, bytes] = {}
    for path, steps in ((first, earlier), (last, later)):
        digest = hashlib.blake2b(b"", digest_size=KEY).digest()
        for i, cell in enumerate(steps):
            if i:
                digest = hashlib.blake2b(digest + bytes(every[path[i - 1]]).ljust(KEY, b"\0"), digest_size=KEY).digest()
            name[cell] = digest
    below = used[used != 0]
    parent_of = np.full(cells, -1, dtype=np.int64)
    parent_of[below] = trie.check[below]
    above_shared = (parent_of[used] >= 0) & shared[parent_of[used]]
    end_keys = sequences["path_key"].to_pylist()
    shard = sequences["shard"][0].as_py()
    return pa.table({
        "shard": pa.array(np.full(len(used), shard), pa.int32()),
        "key": pa.array([name.get(c) for c in used.tolist()] if name else [None] * len(used), pa.binary()),
        "parent_key": pa.array([name[p] if s else None for p, s in zip(parent_of[used].tolist(), above_shared.tolist(), strict=True)], pa.binary()),
        "ended": pa.array([end_keys[i] if i >= 0 else None for i in ended[used].tolist()], pa.binary()),
        "conv_id": conv_id[used], "depth": depth[used],
        "parent_conv_id": pa.array(conv_id[np.maximum(parent_of[used], 0)], pa.int64(), mask=(parent_of[used] < 0) | above_shared),
        "n_convs": n_convs[used], "n_children": n_children[used], "n_leaves": n_leaves[used], "saved_tokens": saved[used]}).cast(NODES)


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path_key, conv_id): the ids of one path, joined by commas, in blocks."""
    schema = pa.schema([("path_key", pa.binary()), ("conv_id", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        keys, ids = batch["path_key"].to_pylist(), batch["conv_id"].to_pylist()
        starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
        step = BLOCK_BYTES // 20
        cuts = [(k, min(k + step, y)) for x, y in zip(starts, starts[1:], strict=False) for k in range(x, y, step)]
        yield pa.RecordBatch.from_arrays([
            pa.array([keys[x] for x, _ in cuts], pa.binary()), pa.array([ids[x] for x, _ in cuts], pa.int64()),
            pa.array([",".join(map(str, ids[x:y])).encode() for x, y in cuts], pa.binary())], schema=schema)


def _digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks: one digest per path, fed block by block."""
    schema = pa.schema([("path_key", pa.binary()), ("ends_sha256", pa.string())])
    key, digest = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch["path_key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if k == key:
                digest.update(b"," + ids)
            else:
                done += [(key, digest.hexdigest())] if digest else []
                key, digest = k, hashlib.sha256(ids)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], schema.field(i).type) for i in (0, 1)], schema=schema)
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((key, digest.hexdigest()), schema, strict=True)], schema=schema)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, words): turns as digests of role and text, after the first turns of the family's first conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"), digest.alias("key"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("said")).where("conv_id is not null")
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("said", 1, MOST_SHARED - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    path = F.concat(F.slice(F.coalesce("head", F.slice("said", 1, 0)), F.lit(1), taken),
                    F.slice("said", taken + 1, F.greatest(F.size("said") - taken, F.lit(0))))
    joined = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left")
    return joined.select("conv_id", path.alias("path")).select("conv_id", F.col("path.key").alias("keys"), F.col("path.words").alias("words"))


def _bytes_of(keys: Column) -> Column:
    return F.array_join(F.transform(keys, lambda k: F.hex(k)), "")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Per node of the trie: smallest conversation, depth, the parent's, members, children, leaves, saved tokens, digest of ends.

    `conversations` needs conv_id, turn, role and text; other columns are not read. Turns are ordered by number, null
    first, those of one number by a digest of role and text; repeated rows are turns of their own. Null role or text is
    empty. Rows without conv_id belong to no conversation and are left out. An empty table has no nodes, not even a root.
    A conversation's turns (16 bytes each) are held by one task, whatever their texts' lengths.
    """
    paths = write_and_read_back(rebuilt(conversations).withColumn(
        "path_key", F.unhex(F.substring(F.sha2(_bytes_of(F.col("keys")), 256), 1, 2 * KEY))), "conversations")
    # a conversation that stands there many times is one sequence
    sequences = paths.groupBy("path_key", "keys", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    turns = paths.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    dealt = sequences.repartitionByRange(max(1, -(-turns // shard_turns)), "keys").withColumn("shard", F.spark_partition_id())
    shards = write_and_read_back(dealt, "trie-shards")
    # one row per shard: its first and last sequence, and what stands next to them
    edges = shards.groupBy("shard").agg(F.min("keys").alias("first"), F.max("keys").alias("last"))
    order = Window.orderBy("shard")
    beside = edges.select(F.col("shard").alias("own"), "first", "last", F.lag("last").over(order).alias("before"),
                          F.lead("first").over(order).alias("after"))
    from pyspark.sql.pandas.types import from_arrow_schema
    made = shards.groupBy("shard").cogroup(beside.groupBy("own")).applyInArrow(shard_nodes, from_arrow_schema(NODES))
    nodes = write_and_read_back(made, "trie-nodes")

    result = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended")
    parts, inner = nodes.where("key is not null"), nodes.where("key is null")
    merged = write_and_read_back(parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("ended").alias("ended"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))), "trie-upper")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    upper = merged.join(above, "parent_key", "left").withColumn("parent_conv_id", F.col("parent"))
    # a shard asks once for each upper node it has, so the children of a hot one are not joined on it alone
    here = parts.select("shard", F.col("key").alias("parent_key")).join(above, "parent_key")
    under = inner.where("parent_key is not null").join(here, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("parent"))
    found = inner.where("parent_key is null").select(*result).union(under.select(*result)).union(upper.select(*result))

    sorted_ids = paths.select("path_key", "conv_id").repartitionByRange("path_key", "conv_id").sortWithinPartitions("path_key", "conv_id")
    blocks = sorted_ids.mapInArrow(_join_ids, "path_key binary, conv_id long, ids binary")
    ends = blocks.repartition("path_key").sortWithinPartitions("path_key", "conv_id").mapInArrow(_digest_blocks, "path_key binary, ends_sha256 string")
    stops = found.where("ended is not null").join(ends.withColumnRenamed("path_key", "ended"), "ended").drop("ended")
    others = found.where("ended is null").drop("ended").withColumn("ends_sha256", F.sha2(F.lit(""), 256))
    return stops.unionByName(others)

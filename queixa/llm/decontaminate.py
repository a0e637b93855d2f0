"""Benchmark decontamination with suffix arrays over the training words.

Each task cuts its documents into shards, sorts the suffixes of a shard's word sequence, and
finds every suffix of every benchmark item by binary search. The benchmark is sent to the tasks
in blocks of about BLOCK_WORDS words. Each block is a job of its own that stores what it found,
so one block is held at a time, however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queixa.llm.columns import others, set_aside, without_results
from queixa.llm.words import LETTERS, as_lists, hashed
from queixa.session import write_and_read_back

# Words in one shard's suffix array, unless a single document has more.
SHARD_WORDS = 1 << 19
# Benchmark words in one broadcast block: up to about 64 bytes each, their windows included.
BLOCK_WORDS = 1 << 20

_SPAN = T.StructType().add("start", "long").add("end", "long")
RESULT = (T.StructType().add("n_words", "long").add("hit_spans", T.ArrayType(_SPAN)).add("items", T.ArrayType(T.StringType()))
          .add("longest_match", "long").add("match_start", "long").add("match_item", "string"))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `words` (ranks from 0) sorted by the first `depth` words at least.

    Prefix multiplying: ranks of two or three neighbours are packed into one integer, so
    each sort doubles or triples the sorted depth.
    """
    rank, reach = words.astype(np.int64), 1
    bits = max(1, int(max(len(words), rank.max(initial=0)) + 1).bit_length())
    parts = 3 if 3 * bits <= 63 else 2
    while reach < depth:
        key = rank.copy()
        for i in range(1, parts):
            key <<= bits
            if i * reach < len(rank):
                key[:len(rank) - i * reach] |= rank[i * reach:] + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        reach *= parts
    return np.argsort(rank, kind="stable")


def _first(words: np.ndarray, order: np.ndarray, wanted: np.ndarray, lengths: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all `wanted` rows at once: the first suffix that is not smaller, or is larger."""
    low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(order))
    columns = np.arange(wanted.shape[1])
    unused = columns[None, :] >= lengths[:, None]
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        seen, want = words[order[middle][:, None] + columns], wanted[open_]
        differs = (seen != want) & ~unused[open_]
        at = differs.argmax(axis=1)
        rows = np.arange(len(open_))
        some = differs[rows, at]
        smaller = np.where(some, seen[rows, at] < want[rows, at], after)
        low[open_] = np.where(smaller, middle + 1, low[open_])
        high[open_] = np.where(smaller, high[open_], middle)


class Block:
    """A bounded part of the benchmark: its distinct words, its distinct windows as places among
    those words, and where each window stands in which item text."""

    def __init__(self, rows: list[tuple[list[str], np.ndarray]], window: int):
        self.names = [names for names, _ in rows]
        sizes = np.array([len(words) for _, words in rows], dtype=np.int64)
        words = np.concatenate([np.empty(0, dtype=np.uint64), *(words for _, words in rows)])
        self.known, ranks = np.unique(words, return_inverse=True)
        text = np.append(ranks.ravel().astype(np.int32), np.full(window, -1, dtype=np.int32))
        lengths = np.minimum(sizes, window)
        count = sizes - lengths + 1
        item = np.repeat(np.arange(len(rows), dtype=np.int32), count)
        starts = np.cumsum(sizes) - sizes
        place = (np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
        table = text[(starts[item] + place)[:, None] + np.arange(window)]
        table[np.arange(window) >= lengths[item][:, None]] = -1
        rows_as_bytes = np.ascontiguousarray(table).view(np.dtype((np.void, table.shape[1] * 4))).ravel()
        _, first, inverse = np.unique(rows_as_bytes, return_index=True, return_inverse=True)
        inverse = inverse.ravel()
        self.windows, self.lengths = table[first], lengths[item[first]].astype(np.int64)
        # owners of window w: suffixes order[starts[w]:starts[w + 1]]
        order = np.argsort(inverse, kind="stable")
        self.starts = np.searchsorted(inverse[order], np.arange(len(first) + 1))
        self.item, self.place = item[order], place[order]

    def items_of(self, w: int) -> np.ndarray:
        return self.item[self.starts[w]:self.starts[w + 1]]


def _places(found: np.ndarray, bounds: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the shard's text (document i's words start at bounds[i] + i) and their windows."""
    known, ranks = np.unique(found, return_inverse=True)
    width = block.windows.shape[1]
    # a gap of rank 0 between documents; shard words are even, absent words odd
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    words = np.zeros(len(found) + len(bounds) - 1 + width, dtype=np.int64)
    words[np.arange(len(found)) + rows] = ranks.ravel() + 1
    # the block's words among the shard's; a window is looked for if all of its words are there
    place_of = np.searchsorted(known, block.known)
    there = np.append(known[np.minimum(place_of, len(known) - 1)] == block.known, True)
    whole = np.flatnonzero(there[block.windows].all(axis=1))
    if not len(whole):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), words
    order = suffix_array(words[:len(words) - width], width)
    wanted, lengths = np.append(place_of, 0)[block.windows[whole]] + 1, block.lengths[whole]
    low = _first(words, order, wanted, lengths, False)
    high = _first(words, order, wanted, lengths, True)
    count = high - low
    which = np.repeat(whole, count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return order[np.repeat(low, count) + inside], which, words


def _longest(place: np.ndarray, which: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal matches: (start in the shard, item, words). Windows that follow each other in
    the text and in an item are one match."""
    count = block.starts[which + 1] - block.starts[which]
    p = np.repeat(place, count)
    owner = np.repeat(block.starts[which], count) + np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)
    item, shift = block.item[owner], p - block.place[owner]
    length = np.repeat(block.lengths[which], count)
    order = np.lexsort((p, shift, item))
    item, shift, p, length = item[order], shift[order], p[order], length[order]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], item[first], p[last] + length[last] - p[first]


def _search(batches: Iterator[pa.RecordBatch], block, window: int, kept: list[str], text: str, first: bool) -> Iterator[pa.RecordBatch]:
    block = block.value
    for batch in batches:
        texts = batch.column(batch.schema.names.index(text))
        out: dict[str, list] = {"n_words": [], "hit_spans": [], "items": [], "longest_match": [], "match_start": [], "match_item": []}
        for shard in hashed(texts, LETTERS, fold=True, words=SHARD_WORDS):
            n = shard.last - shard.first
            sizes = np.diff(shard.bounds)
            spans: list[list] = [[] for _ in range(n)]
            items: list[list[str]] = [[] for _ in range(n)]
            best: list[tuple] = [(0, None, None)] * n
            if len(shard.hashes) and len(block.windows):
                place, which, _ = _places(shard.hashes, shard.bounds, block)
                if len(place):
                    begins = shard.bounds[:-1] + np.arange(n)
                    order = np.argsort(place, kind="stable")
                    place, which = place[order], which[order]
                    row = np.searchsorted(begins, place, side="right") - 1
                    _fill_spans(spans, row, place - begins[row], block.lengths[which])
                    names: dict[bytes, list[str]] = {}
                    edge = np.flatnonzero(np.diff(row, prepend=-1))
                    for a, b in zip(edge, np.append(edge[1:], len(row)), strict=True):
                        mine = np.unique(which[a:b])
                        key = mine.tobytes()
                        if key not in names:
                            texts_hit = np.unique(np.concatenate([block.items_of(w) for w in mine]))
                            names[key] = sorted({x for t in texts_hit for x in block.names[t]})
                        items[row[a]] = names[key]
                    start, item, length = _longest(place, which, block)
                    row = np.searchsorted(begins, start, side="right") - 1
                    for i in np.lexsort((item, start, -length, row)):
                        if not best[row[i]][0]:
                            best[row[i]] = (int(length[i]), int(start[i] - begins[row[i]]), min(block.names[item[i]]))
            out["n_words"] += sizes.tolist()
            out["hit_spans"] += spans
            out["items"] += items
            for k, name in enumerate(("longest_match", "match_start", "match_item")):
                out[name] += [x[k] for x in best]
        if not first:
            out = _merged(out, batch)
        arrays = [batch.column(batch.schema.names.index(c)) for c in kept] + [
            pa.array(out["n_words"], pa.int64()),
            pa.array(out["hit_spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.array(out["items"], pa.list_(pa.string())), pa.array(out["longest_match"], pa.int64()),
            pa.array(out["match_start"], pa.int64()), pa.array(out["match_item"], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *out])


def _fill_spans(spans: list[list], row: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Unions of hit windows per row; `row` and `start` are sorted."""
    for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
        mine = spans[r]
        if mine and s <= mine[-1]["end"]:
            mine[-1]["end"] = max(mine[-1]["end"], s + n)
        else:
            mine.append({"start": s, "end": s + n})


def _merged(out: dict[str, list], batch: pa.RecordBatch) -> dict[str, list]:
    """This block's findings together with those of the blocks before."""
    old = {name: batch.column(batch.schema.names.index(name)).to_pylist() for name in out}
    for i in range(len(out["n_words"])):
        both = sorted([*old["hit_spans"][i], *out["hit_spans"][i]], key=lambda x: x["start"])
        joined: list[list] = [[]]
        _fill_spans(joined, np.zeros(len(both), dtype=int), np.array([x["start"] for x in both], dtype=int),
                    np.array([x["end"] - x["start"] for x in both], dtype=int))
        out["hit_spans"][i] = joined[0]
        out["items"][i] = sorted({*old["items"][i], *out["items"][i]})
        if not out["longest_match"][i] or old["longest_match"][i] and (
                (-old["longest_match"][i], old["match_start"][i], old["match_item"][i])
                < (-out["longest_match"][i], out["match_start"][i], out["match_item"][i])):
            for name in ("longest_match", "match_start", "match_item"):
                out[name][i] = old[name][i]
    return out


def _hash_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in hashed(batch.column(1), LETTERS, fold=True):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[part.first:part.last], as_lists(part.hashes, part.bounds)], names=["item_id", "words"])


def _blocks(benchmark: DataFrame, window: int, most: int) -> Iterator[Block]:
    """The benchmark's distinct texts in blocks of about `most` words, one at a time on the driver."""
    words = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
             .mapInArrow(_hash_items, "item_id string, words array<long>").where(F.size("words") > 0))
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = -(-total // most) if total else 0
    part = F.pmod(F.xxhash64("words"), F.lit(max(1, parts)))
    for i in range(parts):
        rows = words.where(part == i).groupBy("words").agg(F.collect_set("item_id").alias("names")).collect()
        yield Block([(sorted(r.names), np.array(r.words, dtype=np.int64).view(np.uint64))
                     for r in sorted(rows, key=lambda r: sorted(r.names))], window)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document with what it shares verbatim with the benchmark.

    `docs` needs `text`, `benchmark` needs `item_id` and `text`. Words are runs of ASCII letters,
    digits and non-ASCII characters, A-Z lowered. A window is `window` consecutive words of an
    item; an item of fewer words is one window. Returned are all columns of `docs` (its own
    columns named as a result are replaced) and: n_words; hit_spans, the unions of all window
    occurrences as word ranges; items, the sorted ids of items with an occurring window;
    longest_match, match_start, match_item, the longest verbatim match in words (0 and null if
    none; ties: first place, then smallest item). Null or empty texts have no words; items without words match
    nothing; a null item id is named `null`; repeated rows are judged alike; an empty benchmark
    hits nothing.
    """
    spark = docs.sparkSession
    own = others(docs.columns, RESULT.names)
    (found, plain, back), first = set_aside(docs, own), True
    search = partial(_search, window=window, kept=plain, text=plain[[c.casefold() for c in own].index("text")])
    schema = T.StructType([*found.schema.fields, *RESULT.fields])
    for block in _blocks(benchmark, window, block_words):
        sent = spark.sparkContext.broadcast(block)
        found = found if first else write_and_read_back(found, "leaks")
        found = found.mapInArrow(partial(search, block=sent, first=first), schema)
        first = False
    if first:
        sent = spark.sparkContext.broadcast(Block([], window))
        found = found.mapInArrow(partial(search, block=sent, first=True), schema)
    return back(found)


def hit_words(spans: str = "hit_spans"):
    """Number of hit words: the spans don't overlap."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any word inside an occurrence of a benchmark window, with all their columns.

    Null and empty texts have no words and stay; repeated rows stay or go alike; an empty table gives an empty one.
    """
    return without_results(docs, RESULT.names, lambda rows: find_leaks(rows, benchmark, window).where(F.size("hit_spans") == 0))


def digest(names: str = "items"):
    return F.sha2(F.concat_ws(",", names), 256)


__all__ = ["find_leaks", "remove_leaks", "hit_words", "digest", "suffix_array"]

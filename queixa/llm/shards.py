"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents with the same link value are neighbours through one hub, so a group of any size costs
a row per document and no pairs. In each round hubs look up where most of their documents lie
and the others ask to move there; requests are granted up to a quota per pair of shards, so that
no shard's linked documents outgrow it. Groups still cut after the last round are packed whole into
the room that is left, by counts of groups per size; if that doesn't hold them, all groups are packed
anew. Documents without links fill the shards up evenly.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.llm.ranks import order_value, ranked
from queixa.session import write_and_read_back

ROUNDS = 6


def grants(wanted: dict[tuple[int, int], int], load: list[int], capacity: int) -> dict[tuple[int, int], int]:
    """Moves granted per (from, to): as many as come back, and what else the shard has room for."""
    out = {pair: min(n, wanted.get(pair[::-1], 0)) for pair, n in wanted.items()}
    for (source, to), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        room = max(0, min(n - out[source, to], capacity - load[to]))
        out[source, to] += room
        load[to] += room
        load[source] -= room
    return {pair: n for pair, n in out.items() if n}


def _lookup(values: dict, key: Column, default: int = 0) -> Column:
    """A small table of constants (shards or pairs of shards)."""
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), key), F.lit(default)) if entries else F.lit(default)


def propagate(linked: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """`linked` (link, order, shard, ...) after label propagation: same rows, new shards."""
    for _ in range(rounds):
        votes = linked.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
        hubs = votes.groupBy("link").agg(F.max(F.struct("n", (-F.col("shard")).alias("at"))).alias("most"))
        asked = linked.join(hubs.select("link", (-F.col("most.at")).cast("int").alias("to")), "link")
        asked = write_and_read_back(asked, "asked")
        wanted = {(r.shard, r.to): r["count"] for r in asked.where("shard <> to").groupBy("shard", "to").count().collect()}
        load = [0] * shards
        for r in asked.groupBy("shard").count().collect():
            load[r.shard] = r["count"]
        granted = grants(wanted, load, capacity)
        if not granted:
            return linked
        pair = F.col("shard") * shards + F.col("to")
        quota = _lookup({a * shards + b: n for (a, b), n in granted.items()}, pair)
        moving = ranked(asked.where("shard <> to"), ["shard", "to"], "order")
        moving = moving.withColumn("shard", F.when(F.col("rank") < quota, F.col("to")).otherwise(F.col("shard"))).drop("rank")
        linked = write_and_read_back(moving.unionByName(asked.where("shard = to")).drop("to"), "linked")
    return linked


def packed(counts: dict[int, int], room: list[int], most: int) -> tuple[list[tuple], list[tuple], int]:
    """Places of `counts[n]` groups of n rows in shards with `room`, large groups first.

    Whole groups: (n, first, last, shard), for the groups first to last - 1 of that size. Cut ones: (n, group,
    first, last, shard), for rows. A group of more than `most` rows fills the emptiest shards and its remains are
    packed like a group; one that finds no room is cut at the end. The number of those comes last: under
    len(room), as no shard has room for the smallest of them.
    """
    room, whole, cut, late = list(room), [], [], []
    queue = [(-n, 0, c, None) for n, c in counts.items() if c]  # size, rows placed before, groups, of which group
    heapq.heapify(queue)
    while queue:
        n, done, c, of = heapq.heappop(queue)
        n = -n
        if of is None and n > most:
            for g in range(c):
                heapq.heappush(queue, (-n, 0, 1, (n, g)))
            continue
        if of and n > max(room):
            s = max(range(len(room)), key=lambda x: (room[x], -x))
            cut.append((*of, done, done + room[s], s))
            heapq.heappush(queue, (-(n - room[s]), done + room[s], 1, of))
            room[s] = 0
            continue
        g = 0
        for s in sorted(range(len(room)), key=lambda x: (room[x], x)):
            if (take := min(c - g, room[s] // n)) > 0:
                if of:
                    cut.append((*of, done, done + n, s))
                else:
                    whole.append((n, g, g + take, s))
                room[s] -= take * n
                g += take
        late += [(n, x) for x in range(g, c)]
    for n, g in late:
        done = 0
        while done < n:
            s = max(range(len(room)), key=lambda x: (room[x], -x))
            take = min(room[s], n - done)
            cut.append((n, g, done, done + take, s))
            room[s] -= take
            done += take
    return whole, cut, len(late)


def settle(linked: DataFrame, quota: list[int]) -> DataFrame:
    """`linked` (link, order, shard, ...) without cut groups, as far as whole groups fit into shards of `quota` rows."""
    spark, most = linked.sparkSession, max(quota)
    groups = linked.groupBy("link").agg(
        F.count(F.lit(1)).alias("members"), F.min("shard").alias("at"), (F.min("shard") < F.max("shard")).alias("lies cut"))
    groups = write_and_read_back(groups.withColumn("group order", order_value("link")), "groups")
    by_size = [tuple(r) for r in groups.groupBy("members", "at", "lies cut").agg(F.count(F.lit(1))).collect()]
    room = list(quota)
    for n, at, lies_cut, c in by_size:
        room[at] -= 0 if lies_cut else n * c

    def sizes(chosen):
        out: dict[int, int] = {}
        for n, _, _, c in filter(chosen, by_size):
            out[n] = out.get(n, 0) + c
        return out
    moving = groups.where("`lies cut`")
    plan = packed(sizes(lambda x: x[2]), room, most) if min(room) >= 0 else None
    if plan is None or plan[2]:
        anew = packed(sizes(lambda x: True), quota, most)
        if plan is None or anew[2] < plan[2]:
            plan, moving = anew, groups
    whole, cut, _ = plan
    if not whole and not cut:
        return linked
    numbered = ranked(moving.select("link", "members", "group order"), ["members"], "group order", ["link"], name="group")
    spans = spark.createDataFrame(whole, "members long, first long, last long, to int")
    inside = (F.col("group") >= F.col("first")) & (F.col("group") < F.col("last"))
    targets = numbered.join(spans, "members").where(inside).select("link", "to")
    pieces = spark.createDataFrame(cut, "members long, group long, first long, last long, to int")
    split = numbered.join(pieces, ["members", "group"]).select("link", "first", "last", "to")
    targets = write_and_read_back(targets.select("link", F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), "to")
                                  .union(split), "targets")
    one = targets.where("first is null").select("link", "to")
    few = write_and_read_back(targets.where("first is not null"), "pieces")
    # few groups are cut, so their keys are few
    torn = F.broadcast(few.select("link").distinct())
    rest = linked.join(torn, "link", "left_anti").join(one, "link", "left")
    rest = rest.withColumn("shard", F.coalesce("to", "shard")).drop("to")
    within = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    dealt = ranked(linked.join(torn, "link", "left_semi"), ["link"], "order").join(F.broadcast(few), "link").where(within)
    dealt = dealt.withColumn("shard", F.col("to")).drop("to", "first", "last", "rank")
    return write_and_read_back(rest.unionByName(dealt), "settled")


def shard_rows(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS, seed: int = 11) -> DataFrame:
    """Every document's shard and its slot there, shards' row counts at most one apart.

    `docs` needs `doc_id` and `text`; other columns are ignored. Documents of equal text are
    linked (null texts aren't). One row per document: doc_id, size (UTF-8 bytes of the text plus
    1; null: 1), text_crc32 (of null: 0), linked, shard, slot (gapless from 0), text_key (xxhash64
    of the text). Groups stay together unless they are larger than a shard or fill the shards so that
    no room for a whole one is left: under `shards` of those. Repeated rows and
    null ids are rows like others; an empty table gives no rows.
    """
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.unhex(F.md5("text")).alias("link"), F.xxhash64("text").alias("text_key"))
    rows = rows.withColumn("order", order_value("doc_id", "text_key", seed=seed))
    rows = write_and_read_back(rows.withColumn("shard", (F.col("order") % shards).cast("int")), "rows")
    total = rows.count()
    groups = rows.where("link is not null").groupBy("link").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    marked = write_and_read_back(
        rows.join(groups.select(F.col("link").alias("group"), "members"), F.col("link") == F.col("group"), "left")
        .drop("members"), "marked")
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    linked = propagate(marked.where("group is not null").drop("group"), shards, -(-total // shards), rounds)
    linked = settle(linked, list(quota.values()))
    single = marked.where("group is null").drop("group")
    # documents without links rank last, so they are the ones that move to even the counts
    free = F.shiftright("order", 1)
    every = linked.withColumn("linked", F.lit(True)).unionByName(single.withColumn("linked", F.lit(False)))
    every = ranked(every.withColumn("place", F.when(F.col("linked"), free).otherwise(free + F.lit(1 << 62))),
                   ["shard"], "place")
    every = write_and_read_back(every.drop("place", "order"), "ranked")
    load = {r.shard: r["count"] for r in every.groupBy("shard").count().collect()}
    first, rest = {}, 0
    spans, room = [], 0
    for s in range(shards):
        first[s] = rest
        rest += max(0, load.get(s, 0) - quota[s])
        missing = max(0, quota[s] - load.get(s, 0))
        spans.append((room, room + missing, s))
        room += missing
    # the n-th row that is too many goes to the n-th free slot
    over = F.col("rank") >= _lookup(quota, F.col("shard"))
    turn = _lookup(first, F.col("shard")) + F.col("rank") - _lookup(quota, F.col("shard"))
    shard, slot = F.col("shard"), F.col("rank")
    for low, high, s in spans:
        if low < high:
            here = over & (turn >= low) & (turn < high)
            shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, turn - low + load.get(s, 0)).otherwise(slot)
    return every.select("doc_id", "size", "text_crc32", "linked", shard.cast("int").alias("shard"),
                        slot.cast("long").alias("slot"), "text_key")

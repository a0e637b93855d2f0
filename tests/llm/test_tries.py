"""The conversation trie against brute force, over one and over many shards."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from queixa.llm import tries

COLUMNS = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"


def brute(rows):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    paths = {}
    for conv, said in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        paths[conv] = tuple(own.get(conv - conv % 20, [])[:h] + said[h:])
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved = {n: (len(c) - 1) * len((n[-1][1] if n else "").encode().split()) for n, c in members.items()}
    out = []
    for node, convs in members.items():
        below, todo = [], [node]
        while todo:
            below.append(todo.pop())
            todo += children.get(below[-1], [])
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
                    sum(b not in children for b in below), sum(saved[b] for b in below), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def table(spark, rows):
    """With extra columns named like results."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, Key string, depth int")


def made(rng, n, hot):
    rows = []
    for conv in range(n):
        if conv % 20 == 0 and rng.random() < 0.3:
            continue  # a family without its first conversation
        for turn in range(rng.randrange(1, 7)):
            text = "hello  there\tyou" if turn < hot and rng.random() < 0.5 else f"t{rng.randrange(6)} w{rng.randrange(3)}"
            rows.append((conv, turn if rng.random() < 0.95 else 50 + turn, rng.choice(["user", "assistant"]), text))
    return rows


def same(got, expected):
    assert sorted(map(repr, (tuple(r[c] for c in COLUMNS) for r in got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("shard_turns", [7, 60, tries.SHARD_TURNS])
def test_trie(spark, shard_turns):
    rows = made(random.Random(4), 400, 3)
    same(tries.prefix_trie(table(spark, rows), shard_turns).collect(), brute(rows))


def test_one_conversation_many_times(spark, monkeypatch):
    monkeypatch.setattr(tries, "BLOCK_BYTES", 100)
    rows = [(c, t, "user", f"same {t}") for c in range(900) for t in range(4)] + made(random.Random(5), 100, 0)
    rows = [(c + 1000 * (i >= 3600), *rest) for i, (c, *rest) in enumerate(rows)]
    same(tries.prefix_trie(table(spark, rows), 30).collect(), brute(rows))


def test_odd_rows(spark):
    rows = [(0, None, None, "first by null"), (0, 1, "user", None), (0, 2, None, None), (1, 1, "a", "bc"), (1, 2, "ab", "c"), (2, 5, "a", ""),
            (None, 1, "user", "without conversation"), (41, 1, "user", "no family"), (42, 1, "", "long " * 50_000), (42, 2, "user", "x"), (-3, 1, "user", "below zero")]
    got = {(r.conv_id, r.depth): r for r in tries.prefix_trie(table(spark, rows), 3).collect() if r.conv_id >= 0 or r.depth == 0}
    assert got[(-3, 0)].n_convs == 6 and got[(-3, 0)].parent_conv_id is None
    rows = [r for r in rows if r[0] != -3]
    same(tries.prefix_trie(table(spark, rows), 3).collect(), brute(rows))
    repeated = [(7, 1, "user", "again")] * 5
    same(tries.prefix_trie(table(spark, repeated), 3).collect(), brute(repeated))


def test_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2) for t in range(3000)] + [(2, 3000, "user", "one more"), (3, 0, "user", "other")]
    same(tries.prefix_trie(table(spark, rows), 2000).collect(), brute_deep(rows))


def brute_deep(rows):
    """As brute(), for few conversations of many turns: nodes by level instead of by prefix."""
    own = {}
    for conv, _, role, text in rows:
        own.setdefault(conv, []).append((role, text))
    paths = {c: own.get(c - c % 20, [])[:zlib.crc32(str(c).encode()) % 4] + own[c][zlib.crc32(str(c).encode()) % 4:] for c in own}
    levels = [{(): sorted(paths)}]
    while levels[-1]:
        below = {}
        for node, convs in levels[-1].items():
            for c in convs:
                if len(paths[c]) >= len(levels):
                    below.setdefault((min(convs), paths[c][len(levels) - 1]), []).append(c)
        levels.append(below)
    out, sums = [], {}
    for d in range(len(levels) - 1, -1, -1):
        now = {}
        for node, convs in levels[d].items():
            kids = [k for k in (levels[d + 1] if d + 1 < len(levels) else {}) if k[0] == min(convs) and any(c in convs for c in levels[d + 1][k])]
            leaves = sum(sums[k][0] for k in kids) if kids else 1
            saved = sum(sums[k][1] for k in kids) + ((len(convs) - 1) * len(node[1][1].split()) if node else 0)
            now[node] = (leaves, saved)
            ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == d)
            above = min(c for n, cs in levels[d - 1].items() if min(convs) in cs for c in cs) if d else None
            out.append((min(convs), d, above, len(convs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        sums = now
    return out


def test_empty_table(spark):
    assert tries.prefix_trie(table(spark, [])).collect() == []


def test_double_array_packs_and_finds():
    rng = np.random.default_rng(1)
    paths = sorted({tuple(rng.integers(0, 40, rng.integers(0, 6))) for _ in range(3000)} | {(x,) for x in range(200, 400)})
    bounds = np.cumsum([0, *(len(p) for p in paths)])
    turns = np.array([x for p in paths for x in p], dtype=np.int64)
    trie, codes = tries._pack(turns, bounds, 400)
    nodes = {p[:k] for p in paths for k in range(len(p) + 1)}
    seen = {}
    for node in nodes:
        cell = np.zeros(1, dtype=np.int64)
        for x in node:
            cell = trie.step(cell, codes[np.array([x])])
        assert seen.setdefault(int(cell[0]), node) == node
    assert len(seen) == len(nodes) and trie.end < 1.5 * len(nodes)

"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length. A source's whole copies come first; most of the
remaining budget is shared out by length, in proportion; what is left is fitted by a bounded
knapsack over lengths. Which documents of a length are taken follows a seeded hash.
"""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queixa.llm.ranks import order_value, ranked
from queixa.session import write_and_read_back

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Words left to the knapsack, as long as no single document is longer.
KNAPSACK_WORDS = 1 << 15
SEED = 7


def knapsack(budget: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length (at most its count) add up closest to `budget`; of two, the lower sum.

    Reachable sums are bits of one integer; a length's count is split into powers of two, and
    the search stops as soon as the budget itself is reached.
    """
    counts = {length: n for length, n in sorted(counts.items()) if length > 0 and n > 0}
    if budget <= 0 or not counts:
        return {}
    limit = budget + min(counts)
    mask = (1 << (limit + 1)) - 1
    steps, reach = [], 1
    for length, n in counts.items():
        part = 1
        while n and not reach >> budget & 1 and length <= limit:
            part = min(part, n)
            grown = (reach | reach << (length * part)) & mask if length * part <= limit else reach
            if grown != reach:
                steps.append((length, part, reach))
                reach = grown
            n -= part
            part *= 2
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> budget
    over = budget + (above & -above).bit_length() - 1 if above else None
    at = below if over is None or budget - below <= over - budget else over
    taken: dict[int, int] = {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + part
            at -= length * part
    return taken


def fit(lengths: pd.DataFrame, most_copies: int, spare: int) -> pd.DataFrame:
    """One source: the copies that all documents get, and how many of each length get one more."""
    total = int((lengths["size"] * lengths["n"]).sum())
    target = float(lengths["target"].iloc[0])
    copies = min(most_copies, int(target // total)) if total else 0
    counts = {int(s): int(n) for s, n in zip(lengths["size"], lengths["n"], strict=True) if s > 0}
    left = round(target) - copies * total if copies < most_copies else 0
    extra = dict.fromkeys(counts, 0)
    if left > 0:
        budget = left
        for size in counts:
            extra[size] = counts[size] * budget // total
            left -= extra[size] * size
        for size in sorted(counts, reverse=True):
            more = min(counts[size] - extra[size], max(0, left - spare // 2) // size)
            extra[size] += more
            left -= more * size
        for size, n in knapsack(left, {s: counts[s] - extra[s] for s in counts}).items():
            extra[size] += n
    return pd.DataFrame({"source_no": lengths["source_no"], "size": lengths["size"], "copies": copies,
                         "extra": [extra.get(int(s), 0) for s in lengths["size"]]})


def source_targets(sources: DataFrame, weights: tuple[int, ...], most_copies: int) -> DataFrame:
    """(source_no, source, source_size, target): the total shared by weight, at most `most_copies`
    times a source's size each, the excess reshared among the others until none is above."""
    spark = sources.sparkSession
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    # positions without gathering the sources in one task
    numbered = spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[1], x[0][0], x[0][1])), "source_no long, source string, source_size long")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    numbered = write_and_read_back(numbered.withColumn("weight", weight), "sources")
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    rate = 0.0
    while True:
        full = F.col("weight") * rate > most_copies * F.col("source_size")
        row = numbered.agg(
            F.coalesce(F.sum(F.when(full, most_copies * F.col("source_size"))), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weights")).first()
        now = (total - row.fixed) / row.weights if row.weights else rate
        if now <= rate:
            break
        rate = now
    target = F.least(F.col("weight") * rate, (most_copies * F.col("source_size")).cast("double"))
    return numbered.select("source_no", "source", "source_size", target.alias("target"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES,
            seed: int = SEED, spare: int = KNAPSACK_WORDS) -> DataFrame:
    """How often the mix takes each document.

    `docs` needs `doc_id`, `source` and `text`; other columns are ignored. One row per document:
    doc_id, source, size (words without whitespace; null text: 0), source_size, target (words
    its source should give), copies, taken (size times copies), text_key (xxhash64 of the text).
    Sources are ordered by code point, null last, and weigh `weights`, repeating. Every source's
    words come as near its target as document lengths allow. A source without words gets target
    0. The choice depends on doc_id, text and `seed` only, so reruns agree; of rows equal in doc_id,
    source and text some may be taken more often than others. Empty tables give no rows.
    """
    rows = write_and_read_back(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_key")), "sizes")
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_copies)
    sources = write_and_read_back(sources, "targets")
    named = sources.withColumnRenamed("source", "named")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    rows = rows.withColumn("order", order_value("doc_id", "text_key", seed=seed))
    lengths = rows.groupBy("source_no", "size", "target").agg(F.count(F.lit(1)).alias("n"))
    plan = write_and_read_back(lengths.groupBy("source_no").applyInPandas(
        partial(fit, most_copies=most_copies, spare=spare), "source_no long, size long, copies long, extra long"), "plan")
    placed = ranked(rows, ["source_no", "size"], "order", ["doc_id", "text_key"])
    copies = F.col("copies") + (F.col("rank") < F.col("extra")).cast("long")
    return placed.join(plan, ["source_no", "size"]).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"), "text_key")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: all columns of `docs`, each document as often as the mix takes it.

    Rows equal in doc_id, source and text are one document here, taken as often as all of them."""
    taken = mixture(docs, **options).groupBy("doc_id", "source", "text_key").agg(F.sum("copies").alias("n copies")).where(
        F.col("n copies") > 0).withColumnsRenamed({"doc_id": "mix doc_id", "source": "mix source", "text_key": "mix text"})
    same = (docs["doc_id"].eqNullSafe(F.col("mix doc_id")) & docs["source"].cast("string").eqNullSafe(F.col("mix source"))
            & (F.xxhash64(docs["text"]) == F.col("mix text")))
    joined = docs.join(taken, same).dropDuplicates(["mix doc_id", "mix source", "mix text"])
    many = joined.withColumn("copy no", F.explode(F.sequence(F.lit(1), F.col("n copies").cast("int"))))
    return many.select([F.col(f"`{c}`") for c in docs.columns])

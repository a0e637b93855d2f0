"""A quality classifier with hierarchical empirical Bayes.

Evidence of a document: word forms typical of rejected texts, words repeated in place, and
the words most telling of a rejected document. Weights are fitted on a bounded sample of the
labels. All documents' evidence is then summed by host and by path; a path's rate is shrunk towards
its host's and a host's towards the whole corpus's, the more the fewer documents it has and the
less such sites differ, and the posterior joins evidence and path rate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queixa.llm.columns import others, quoted, without_results
from queixa.llm.words import LETTERS, SPACED, _buffers, hashed
from queixa.session import write_and_read_back

# Labelled rows used for fitting, chosen by a hash of their id.
LABELLED = 40_000
# Forms and words are features by so many leading bits of their names: none is dropped, a few share a place.
FEATURE_BITS = 19
# A feature's rate is shrunk by this many documents at the overall rate.
PRIOR = 5.0
# Rejected from this posterior on. Half of the labels of sf0.1 judged by the other half: see the README.
THRESHOLD = 0.25
FORM, WORD = 0, 1
RESULT = ("evidence", "host_rate", "path_rate", "posterior", "rejected")

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x30:0x3A] = ord("9")
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")


def forms(texts: pa.Array) -> pa.Array:
    """The texts as word forms: letters, capitals and digits by class, repeats as one."""
    offsets, data = _buffers(texts)
    if not len(texts) or offsets[-1] == offsets[0]:
        return pa.array([""] * len(texts), pa.large_string())
    seen = _CLASS[data[offsets[0]:offsets[-1]]]
    keep = np.ones(len(seen), dtype=bool)
    keep[1:] = seen[1:] != seen[:-1]
    starts = offsets - offsets[0]
    keep[starts[(starts < len(seen))]] = True
    count = np.concatenate([[0], np.cumsum(keep)])
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(count[starts].astype(np.int64).tobytes()), pa.py_buffer(seen[keep].tobytes()))


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows first..last with their form hashes, word hashes (each with row bounds) and repeats in place."""
    at = 0
    while at < len(texts):
        some = texts.slice(at, 64)
        form, word, plain = (list(hashed(x, c, fold)) for x, c, fold in (
            (forms(some), SPACED, False), (some, LETTERS, True), (some, SPACED, False)))
        joined = [(np.concatenate([p.hashes for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.bounds) for p in parts]))]))
                  for parts in (form, word, plain)]
        again = np.zeros(len(joined[2][0]), dtype=np.int64)
        again[1:] = joined[2][0][1:] == joined[2][0][:-1]
        first = joined[2][1][:-1]
        again[first[first < len(again)]] = 0
        yield at, at + len(some), *joined[0], *joined[1], np.diff(np.concatenate([[0], np.cumsum(again)])[joined[2][1]])
        at += len(some)


def _place(names: np.ndarray) -> np.ndarray:
    return names >> np.uint64(64 - FEATURE_BITS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, and rejected ones, that hold each form or word: partial sums of a batch."""
    for batch in batches:
        bad = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        seen: list[list[np.ndarray]] = [[], []]
        for first, last, form, form_at, word, word_at, _ in _tokens(batch.column(0)):
            for kind, values, bounds in ((FORM, form, form_at), (WORD, word, word_at)):
                for i in range(last - first):
                    own = np.unique(_place(values[bounds[i]:bounds[i + 1]]))
                    seen[kind].append(np.column_stack([own, np.full(len(own), bad[first + i], dtype=np.uint64)]))
        for kind in (FORM, WORD):
            both = np.concatenate(seen[kind]) if seen[kind] else np.empty((0, 2), np.uint64)
            value, at, n = np.unique(both[:, 0], return_inverse=True, return_counts=True)
            of_bad = np.bincount(at.ravel(), weights=both[:, 1].astype(float), minlength=len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(value), kind, dtype=np.int32)), pa.array(value.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(of_bad)],
                names=["kind", "feature", "n", "bad"])


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _row_evidence(texts: pa.Array, model: dict) -> np.ndarray:
    """Per text: mean and strongest log odds of its forms, share of repeats, and of its words the two strongest."""
    out = np.zeros((len(texts), 5))
    for first, last, form, form_at, word, word_at, again in _tokens(texts):
        for values, bounds, kind in ((form, form_at, FORM), (word, word_at, WORD)):
            mine = model["odds"][kind][_place(values)]
            for i in range(last - first):
                a, b = bounds[i], bounds[i + 1]
                if a == b:
                    continue
                row, here = out[first + i], mine[a:b]
                if kind == FORM:
                    row[0], row[1], row[2] = here.mean(), here.max(), again[i] / (b - a)
                else:
                    row[3] = here.max()
                    other = here[values[a:b] != values[a:b][here.argmax()]]
                    row[4] = max(0.0, other.max(initial=0.0))
    return out


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _features(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _row_evidence(batch.column(0), model.value)
        yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(c) for c in x.T]], names=["bad", "a", "b", "c", "d", "e"])


def _scores(batches: Iterator[pa.RecordBatch], model, kept: list[str], text: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = model.value
        texts = batch.column(batch.schema.names.index(text))
        odds = np.zeros(len(texts))
        if own["weights"] is not None:
            x = _row_evidence(texts, own)
            odds = np.clip(own["weights"][0] + x @ own["weights"][1:], -20, 20)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(batch.schema.names.index(c)) for c in kept], pa.array(odds)], names=[*kept, name])


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> dict:
    """The classifier's weights from at most `labelled` labels; None as weights if a class is missing.

    A document is to be rejected if its quality is 0 or it is toxic. Half of the sample (by
    hash) gives the features' odds, the other half the weights, so that the weights know how the
    features do on documents they were not counted on.
    """
    spark = docs.sparkSession
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.coalesce("quality", "toxic").isNotNull(), 0)
    # the sample is bounded by `labelled`, so it can go to every task
    sample = (labels.select("doc_id", bad.alias("bad")).where("doc_id is not null and bad is not null")
              .groupBy("doc_id").agg(F.max("bad").alias("bad"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
              .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))))
    rows = write_and_read_back(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "labelled")
    counting, fitting = rows.where("half = 0").select("text", "bad"), rows.where("half = 1").select("text", "bad")
    total = counting.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    model: dict = {"weights": None, "odds": np.zeros((2, 1 << FEATURE_BITS), dtype=np.float32)}
    if not 0 < total[1] < total[0]:
        return model
    rate = total[1] / total[0]
    counted = counting.mapInArrow(_count, "kind int, feature long, n long, bad long").groupBy("kind", "feature").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    shrunk = (F.col("bad") + PRIOR * rate) / (F.col("n") + PRIOR)
    odds = F.log(shrunk / (1 - shrunk)) - float(_logit(rate))
    # at most one row per place
    found = counted.select("kind", "feature", odds.alias("odds")).toArrow()
    model["odds"][found["kind"].to_numpy(), found["feature"].to_numpy()] = found["odds"].to_numpy()
    sent = spark.sparkContext.broadcast(model)
    seen = np.array([list(r) for r in fitting.mapInArrow(
        partial(_features, model=sent), "bad int, a double, b double, c double, d double, e double").collect()], dtype=float).reshape(-1, 6)
    if 0 < seen[:, 0].sum() < len(seen):
        model["weights"] = _fit(seen[:, 1:], seen[:, 0])
    return model


def _strength(groups: DataFrame) -> Column:
    """How many documents the prior of such groups is worth: by moments, from how far their rates lie
    apart beyond what their sizes explain. Groups that don't differ are shrunk fully, in effect."""
    mean = F.sum("bad") / F.sum("n")
    spread = F.sum(F.col("bad") * F.col("bad") / F.col("n")) / F.sum("n") - mean * mean
    noise = mean * (1 - mean) * F.count(F.lit(1)) / F.sum("n")
    return F.least(F.lit(1e6), F.greatest(F.lit(1.0), mean * (1 - mean) / F.greatest(spread - noise, F.lit(1e-9)) - 1))


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
          threshold: float = THRESHOLD, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """`columns` of `docs` (all if not given; its own columns named as a result are replaced), and: evidence (log odds
    of being rejected by the text alone, beyond the corpus's odds), host_rate, path_rate, posterior, rejected.

    `docs` needs `doc_id`, `text`, and the columns `host` and `path`, where a path is told apart
    within its host; null is a host or path of its own. `labels` needs `doc_id`, `quality` and
    `toxic`; labels without id or without both values are ignored, several of one id count as
    rejected if one is. Null or empty texts get the evidence of a text without features. Without labels
    of both kinds every evidence is 0 and nothing is rejected. Repeated rows are judged alike.
    """
    spark = docs.sparkSession
    model = train(docs, labels, **options)
    own = others(docs.columns if columns is None else columns, RESULT)
    sent = spark.sparkContext.broadcast(model)

    def scored(rows: DataFrame, columns: list[str]) -> DataFrame:
        fields = [rows.schema[c] for c in columns]
        return rows.mapInArrow(partial(_scores, model=sent, kept=columns, text=text, name="evidence"),
                               T.StructType([*fields, T.StructField("evidence", T.DoubleType())]))

    site = [quoted(host).cast("string").alias("site host"), quoted(path).cast("string").alias("site path")]
    # evidence once; both the rates and the verdicts start from what is stored
    aside = [f"own {i}" for i in range(len(own))]
    text = next((a for a, c in zip(aside, own, strict=True) if c.casefold() == "text"), None)
    rows = docs.select(*[quoted(c).alias(a) for a, c in zip(aside, own, strict=True)], *site,
                       *([] if text else [F.col("text").alias("judged text")]))
    text = text or "judged text"
    narrow = write_and_read_back(scored(rows, [*aside, "site host", "site path"]), "evidence")
    chance = 1 / (1 + F.exp(-F.col("evidence")))
    paths = narrow.groupBy("site host", "site path").agg(F.count(F.lit(1)).alias("n"), F.sum(chance).alias("bad"))
    paths = write_and_read_back(paths, "paths")
    hosts = paths.groupBy("site host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), _strength(hosts).alias("k")).first()
    rate = whole.bad / whole.n if whole.n else 0.5
    k_host = whole.k or 1.0
    k_path = paths.agg(_strength(paths).alias("k")).first().k or 1.0
    rated = hosts.select("site host", ((F.col("bad") + k_host * rate) / (F.col("n") + k_host)).alias("host_rate")
                         ).withColumnRenamed("site host", "of host")
    sites = paths.join(rated, F.col("site host").eqNullSafe(F.col("of host"))).select(
        "site host", "site path", "host_rate",
        ((F.col("bad") + k_path * F.col("host_rate")) / (F.col("n") + k_path)).alias("path_rate"))

    def logit(p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(p / (1 - p))

    sites = sites.select(F.col("site host").alias("of host"), F.col("site path").alias("of path"), "host_rate", "path_rate")
    judged = narrow.join(sites, F.col("site host").eqNullSafe(F.col("of host")) & F.col("site path").eqNullSafe(F.col("of path")), "left")
    odds = F.col("evidence") + logit(F.col("path_rate")) - logit(F.lit(float(rate)))
    posterior = 1 / (1 + F.exp(-odds))
    trained = model["weights"] is not None
    return judged.select(*[F.col(a).alias(c) for a, c in zip(aside, own, strict=True)], "evidence", "host_rate", "path_rate", posterior.alias("posterior"),
                         (F.lit(trained) & (posterior > threshold)).alias("rejected"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that aren't rejected, with all their columns.

    Null and empty texts are judged by their sites alone; without labels of both kinds all rows stay."""
    return without_results(docs, RESULT, lambda rows: judge(rows, labels, **options).where(~F.col("rejected")))

"""Removal of long verbatim repeats by recompression.

A text's words are rewritten in rounds: runs of one symbol become one symbol, then symbols
are split by a hash bit into left and right ones and every left-right neighbour pair becomes one
symbol. Names are 64-bit fingerprints of what they stand for, so every task of every job gives
equal strings equal names without a table of names. Each symbol remembers the words its making
depended on. A repeated stretch that holds all of those carries the same symbol in every copy,
so a window whose symbols are not all shared by two documents repeats nowhere. The windows that
remain are verified by 95-bit hashes of all their words; windows too poor in symbols are
verified without being asked, so no repeat is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.llm.words import SPACED, as_lists, as_long, hashed, mixed, windows
from queixa.session import write_and_read_back

ROUNDS = 4
# One symbol in so many is asked for, chosen by its name: fewer symbols to exchange, while nearly
# every window still holds one. Windows that hold none are verified anyway.
ASKED = 3
NO_ID = (1 << 63) - 1
_RUN, _PAIR = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xA24BAED4963EE407)


def symbols(hashes: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """The symbols of several texts after some rounds: (name, text, from, to), where words `from` to
    `to` are those that the symbol's making depended on; beyond the text's ends if it saw an end."""
    name, text = hashes, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    low = np.arange(len(hashes))
    high = low + 1
    for turn in range(rounds):
        if not len(name):
            break
        # runs: a symbol ends where its neighbours differ, so it depends on both
        inner = text[1:] == text[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~(inner & (name[1:] == name[:-1]))]))
        count = np.diff(np.append(first, len(name)))
        last = first + count - 1
        low, high = _seen(low, high, text, first, last, np.ones(len(first), bool), np.ones(len(first), bool))
        name, text = name[first], text[first]
        name = np.where(count > 1, mixed(name * _RUN + count.astype(np.uint64)), name)
        # pairs: an unpaired symbol depends on the neighbour it might have been paired with
        left = mixed(name + np.uint64(((turn + 1) * 0xA24BAED4963EE407) % (1 << 64))) >> np.uint64(63) == 0
        paired = np.zeros(len(name), dtype=bool)
        paired[:-1] = left[:-1] & ~left[1:] & (text[1:] == text[:-1])
        first = np.flatnonzero(~np.concatenate([[False], paired[:-1]]))
        last = first + paired[first]
        alone = ~paired[first]
        low, high = _seen(low, high, text, first, last, alone & ~left[first], alone & left[first])
        joined = mixed(name[first] * _PAIR + mixed(name[last] + np.uint64(turn)))
        name, text = np.where(alone, name[first], joined), text[first]
    return name, text, low, high


def _seen(low: np.ndarray, high: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray,
          before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that the symbols first..last, and the neighbours looked at, depended on."""
    n = len(text)
    new_low, new_high = np.minimum(low[first], low[last]), np.maximum(high[first], high[last])
    prior, later = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    has_prior = (first > 0) & (text[prior] == text[first])
    has_later = (last < n - 1) & (text[later] == text[last])
    new_low = np.where(before, np.where(has_prior, np.minimum(new_low, low[prior]), -1), new_low)
    new_high = np.where(before & has_prior, np.maximum(new_high, high[prior]), new_high)
    new_high = np.where(after, np.where(has_later, np.maximum(new_high, high[later]), np.int64(1) << 60), new_high)
    new_low = np.where(after & has_later, np.minimum(new_low, low[later]), new_low)
    return new_low, new_high


def _anchors(hashes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Symbols to ask for whose making lies inside some window of their text: (name, text, first window, last window)."""
    name, text, low, high = symbols(hashes, bounds)
    start = np.maximum(high - window, bounds[text])
    stop = np.minimum(low, bounds[text + 1] - window)
    use = (low >= bounds[text]) & (high <= bounds[text + 1]) & (start <= stop) & (name % np.uint64(ASKED) == 0)
    return name[use], text[use], start[use], stop[use]


def _covered(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the ranges start..stop (both included)."""
    steps = np.bincount(start, minlength=n + 1)[:n + 1] - np.bincount(stop + 1, minlength=n + 1)[:n + 1]
    return np.cumsum(steps)[:n] > 0


def _places(bounds: np.ndarray, window: int, n: int) -> np.ndarray:
    """Where whole windows start."""
    sizes = np.diff(bounds)
    full = sizes >= window
    return _covered(n, bounds[:-1][full], bounds[1:][full] - window) if full.any() else np.zeros(n, dtype=bool)


def _parse(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Per row: its id columns, n_words, a hash of its words, its distinct symbols, and whether a window has none."""
    for batch in batches:
        for part in hashed(batch.column(2), SPACED):
            n = part.last - part.first
            name, text, start, stop = _anchors(part.hashes, part.bounds, window)
            bare = _places(part.bounds, window, len(part.hashes)) & ~_covered(len(part.hashes), start, stop)
            held = np.concatenate([[0], np.cumsum(bare)])
            at = np.searchsorted(text, np.arange(n + 1))
            own = [np.unique(name[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            texts = batch.column(2)[part.first:part.last].to_pylist()
            whole = [hashlib.sha256(b" ".join((x or "").encode().split())).hexdigest() for x in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0)[part.first:part.last], batch.column(1)[part.first:part.last],
                pa.array(np.diff(part.bounds)), pa.array(whole),
                as_lists(np.concatenate(own) if own else np.empty(0, np.uint64), np.concatenate([[0], np.cumsum([len(x) for x in own])])),
                pa.array(held[part.bounds[1:]] > held[part.bounds[:-1]])],
                names=["doc_id", "key", "n_words", "whole_sha256", "symbols", "bare"])


def _candidates(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows whose symbols all occur in an earlier (`later`: in a later) document."""
    for batch in batches:
        ids, tags, texts, before, after = (batch.column(i) for i in range(5))
        for part in hashed(texts, SPACED):
            n = len(part.hashes)
            name, text, start, stop = _anchors(part.hashes, part.bounds, window)
            place = _places(part.bounds, window, n)
            may = {}
            for side, lists in (("removable", before), ("source", after)):
                rows = lists[part.first:part.last]
                sizes = np.diff(rows.offsets.to_numpy())
                shared = rows.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                owner = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64)
                known = np.isin(mixed(name ^ mixed(text.astype(np.uint64))), mixed(shared ^ mixed(owner)))
                may[side] = place & ~_covered(n, start[~known], stop[~known])
            at = np.flatnonzero(may["removable"] | may["source"])
            if not len(at):
                continue
            high = windows(part.hashes, window)[at]
            row = np.searchsorted(part.bounds, at, side="right") - 1
            # a window that a text repeats itself (a run of one word) is asked once; _cut finds the others
            at, high, row = (x[np.unique(high ^ mixed(row.astype(np.uint64)), return_index=True)[1]] for x in (at, high, row))
            low = windows(mixed(part.hashes ^ _RUN), window)[at] >> np.uint64(33)
            take = pa.array(row + part.first)
            yield pa.RecordBatch.from_arrays([
                ids.take(take), tags.take(take), as_long(high), pa.array(low.astype(np.int32)),
                pa.array((at - part.bounds[row]).astype(np.int32)), pa.array(may["removable"][at]), pa.array(may["source"][at])],
                names=["first_id", "tag", "high", "low", "place", "removable", "source"])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts, places = batch.column(0), batch.column(1), batch.column(2)
        out: dict[str, list] = {"key": keys.to_pylist(), "removed_spans": [], "kept_text": []}
        for text, mine in zip(texts, places, strict=True):
            words, spans, kept, at = (text.as_py() or "").encode().split(), [], [], 0
            found = [windows(part.hashes, window) for part in hashed(pa.array([text.as_py()], pa.string()), SPACED)][0]
            for p in np.flatnonzero(np.isin(found, found[mine.as_py()])).tolist():
                if spans and p <= spans[-1]["end"]:
                    spans[-1]["end"] = p + window
                else:
                    spans.append({"start": p, "end": p + window})
            for span in spans:
                kept += words[at:span["start"]]
                at = span["end"]
            out["removed_spans"].append(spans)
            out["kept_text"].append(b" ".join(kept + words[at:]).decode())
        yield pa.RecordBatch.from_arrays([
            pa.array(out["key"], pa.binary()),
            pa.array(out["removed_spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.array(out["kept_text"], pa.string())], names=list(out))


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """What each document repeats of documents with a smaller doc_id, in runs of `window` words or more.

    `docs` needs `doc_id` (a whole number) and `text`; other columns are ignored. Words are runs
    without whitespace. One row per document: doc_id, n_words, n_removed (words in a window whose
    word sequence also starts in a document with a smaller doc_id, judged on the input),
    removed_spans (as word ranges), kept_text (the other words joined by one space; null if all
    stay), kept_sha256 (of the kept words), text_key (md5 of the text). Null texts have no words. A
    null doc_id counts after all others. Rows with the same doc_id don't remove each other's words.
    Exact copies are one text from the start, so a group of copies costs a row each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    keyed = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), "text")
    parsed = write_and_read_back(keyed.mapInArrow(
        partial(_parse, window=window),
        f"doc_id {kind}, key binary, n_words long, whole_sha256 string, symbols array<long>, bare boolean"), "parsed")
    # of equal texts only the first is looked at; the others are removed whole
    firsts = parsed.where(F.col("n_words") >= window).groupBy("key").agg(F.min(order).alias("first_id"))
    texts = parsed.join(firsts, "key").where(order == F.col("first_id")).dropDuplicates(["key"])
    # a short tag beside the id tells texts of one repeated doc_id apart
    tag = F.xxhash64("key").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    texts = write_and_read_back(texts.select("key", "first_id", tag.alias("tag"), "symbols", "bare"), "texts")
    held = texts.select("first_id", "tag", F.explode("symbols").alias("symbol"))
    spread = (held.groupBy("symbol").agg(F.min("first_id").alias("low"), F.max("first_id").alias("high"))
              .where("low < high"))
    shared = held.join(spread, "symbol").groupBy("first_id", "tag").agg(
        F.collect_list(F.when(F.col("low") < F.col("first_id"), F.col("symbol"))).alias("before"),
        F.collect_list(F.when(F.col("high") > F.col("first_id"), F.col("symbol"))).alias("after"))
    none = F.array().cast("array<long>")
    wanted = texts.join(shared, ["first_id", "tag"], "left").where("bare or before is not null").select(
        "key", "first_id", "tag", F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after"))
    wanted = write_and_read_back(wanted, "wanted")
    # the texts, dealt out once: both passes over them read the same shuffle
    dealt = keyed.select(order.alias("order"), tag.alias("text_tag"), "text")

    def looked_at(rows: DataFrame) -> DataFrame:
        return dealt.join(rows, (dealt["order"] == rows["first_id"]) & (dealt["text_tag"] == rows["tag"]))

    found = looked_at(wanted.drop("key")).select("first_id", "tag", "text", "before", "after").mapInArrow(
        partial(_candidates, window=window),
        "first_id long, tag int, high long, low int, place int, removable boolean, source boolean")
    sources = found.where("source").groupBy("high", "low").agg(F.min("first_id").alias("origin"))
    places = (found.where("removable").join(sources, ["high", "low"]).where("origin < first_id")
              .groupBy("first_id", "tag").agg(F.collect_list("place").alias("places")))
    places = places.join(wanted.select("key", "first_id", "tag"), ["first_id", "tag"])
    cut = looked_at(places).select("key", "text", "places").mapInArrow(
        partial(_cut, window=window),
        "key binary, removed_spans array<struct<start:long,end:long>>, kept_text string").dropDuplicates(["key"])

    rows = parsed.select("doc_id", "key", "n_words", "whole_sha256").join(firsts, "key", "left").join(cut, "key", "left")
    copy = order > F.col("first_id")
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    spans = F.when(copy, whole).otherwise(F.coalesce("removed_spans", nothing))
    kept = F.when(copy, F.lit("")).otherwise(F.col("kept_text"))
    return rows.select(
        "doc_id", "n_words", _size(spans).alias("n_removed"), spans.alias("removed_spans"), kept.alias("kept_text"),
        F.coalesce(F.sha2(kept, 256), F.col("whole_sha256")).alias("kept_sha256"), F.lower(F.hex("key")).alias("text_key"))


def _size(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """All rows and columns of `docs`, texts without what they repeat; unchanged texts stay as they are.

    Texts that lose words come back as the kept words joined by one space; null texts stay null."""
    found = repeated_spans(docs, window).where("n_removed > 0").select(
        F.col("doc_id").alias("found doc_id"), F.col("text_key").alias("found key"), F.col("kept_text").alias("found text")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("found doc_id")) & (F.md5(docs["text"]) == F.col("found key"))
    text = F.coalesce(F.col("found text"), docs["text"]).alias("text")
    return docs.join(found, same, "left").select([text if c == "text" else docs[f"`{c}`"] for c in docs.columns])

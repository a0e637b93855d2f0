"""Removal of repeated runs of lines with a suffix array over line ids, by distributed prefix doubling.

Every line has an id; a rank names the next k lines from a place on, in the order of their ids. A round
joins a place's rank with the rank k places on, sorts the distinct pairs and numbers them: ranks for
2k lines. Places of equal rank are an interval of the suffix array in which neighbours share at
least that many lines, so the intervals at the wanted length hold every repeated run. With a least
count of words, lengths differ from place to place: a run of n lines is named by two ranks of the
largest power of two up to n, at its start and at its end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queixa.session import write_and_read_back

NO_ID = (1 << 63) - 1


def _ranked(places: DataFrame) -> DataFrame:
    """Places (id, tag, place, a, b) with a rank that sorts like (a, b); pairs that stand once drop out."""
    pairs = places.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # ids given after a range sort grow with the order; they are stored before they are used twice
    ranks = write_and_read_back(pairs.orderBy("a", "b").withColumn("rank", F.monotonically_increasing_id()), "ranks")
    return write_and_read_back(places.join(ranks, ["a", "b"]).select("id", "tag", "place", "rank"), "places")


def _shifted(places: DataFrame, by: int) -> DataFrame:
    """Ranks at a place and `by` places on; places without both drop out."""
    on = places.select("id", "tag", (F.col("place") - by).alias("place"), F.col("rank").alias("b"))
    return places.withColumnRenamed("rank", "a").join(on, ["id", "tag", "place"])


def _shortest(rows: DataFrame, words: int) -> DataFrame:
    """Per line (id, tag, place, words) the shortest runs of `words` words that start or end there: id, tag, place, n.

    Every line of a longer run lies in one of these inside of it, and equal runs are the shortest in every text.
    """
    text = Window.partitionBy("id", "tag")
    rows = rows.withColumn("upto", F.sum("words").over(text.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("before", F.col("upto") - F.col("words")).withColumn("total", F.sum("words").over(text))
    one = F.lit(1)
    rows = rows.withColumn("on", F.count(one).over(text.orderBy("before").rangeBetween(0, words - 1)).cast("int"))
    rows = rows.withColumn("back", F.count(one).over(text.orderBy("upto").rangeBetween(1 - words, 0)).cast("int"))
    starts = rows.where(F.col("total") - F.col("before") >= words).select("id", "tag", "place", F.col("on").alias("n"))
    ends = rows.where(F.col("upto") >= words).select(
        "id", "tag", (F.col("place") - F.col("back") + 1).alias("place"), F.col("back").alias("n"))
    return starts.union(ends).distinct()


def _wordy_runs(ranked: DataFrame, runs: DataFrame) -> DataFrame:
    """`runs` (id, tag, place, n) that may stand twice, named by n, a and b; `ranked` has the ranks of single lines."""
    found, reach = [], 1
    longest = runs.agg(F.max("n")).first()[0] or 0
    while reach <= longest and not ranked.isEmpty():
        own = runs.where(F.col("n").between(reach, 2 * reach - 1)).withColumn("end", F.col("place") + F.col("n") - reach)
        own = own.join(ranked.withColumnRenamed("rank", "a"), ["id", "tag", "place"])
        last = ranked.select("id", "tag", F.col("place").alias("end"), F.col("rank").alias("b"))
        found.append(own.join(last, ["id", "tag", "end"]).select("id", "tag", "place", "n", "a", "b"))
        if 2 * reach <= longest:
            ranked = _ranked(_shifted(ranked, reach))
        reach *= 2
    return reduce(DataFrame.union, found) if found else runs.select("*", F.lit(0).alias("a"), F.lit(0).alias("b")).limit(0)


def _standing_earlier(runs: DataFrame, name: list[str]) -> DataFrame:
    """`runs` (id, tag, place, `name`) whose name also stands in a smaller id, or further up in the same text."""
    own = runs.groupBy(*name, "id", "tag").agg(F.min("place").alias("first_place"))
    origin = runs.groupBy(*name).agg(F.min("id").alias("origin"))
    return runs.join(own, [*name, "id", "tag"]).join(origin, name).where("origin < id or first_place < place")


def repeated_lines(docs: DataFrame, lines: int = 3, words: int | None = None) -> DataFrame:
    """Runs of at least `lines` lines, or of at least `words` words, that stand earlier, per document.

    `docs` needs `doc_id` (a whole number) and `text`; other columns are ignored. Lines end at line
    feeds; blank ones (only whitespace) aren't counted and never removed. A line is removed if it
    lies in a run of `lines` consecutive counted lines that also starts in a document with a smaller
    doc_id, or further up in the same text; runs are judged on the input. With `words` it is removed as
    well if it lies in such a run of any number of lines with at least `words` words in all (1: every line
    that stands earlier goes), or if the whole text stands earlier. One row per document: doc_id,
    n_lines, n_removed, removed (line numbers from 0, blank ones counted), kept_text, text_key (md5
    of the text). Null texts have no lines and stay null. A null doc_id counts after all others; rows
    of the same doc_id don't remove each other's lines. Exact copies are one text from the start.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    counted = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
                       lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))
    keyed = docs.select("doc_id", order.alias("id"), F.unhex(F.md5("text")).alias("key"), "text").withColumn("counted", counted)
    least = 1 if words else lines
    firsts = keyed.select("id", "key", F.size("counted").alias("n")).where(F.col("n") >= least).groupBy("key").agg(
        F.min("id").alias("first_id"))
    firsts = write_and_read_back(firsts, "firsts")
    tag = F.xxhash64("key").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    n_words = F.regexp_count("x.line", F.lit(r"[^\x20\x09-\x0D]+")) if words and words > 1 else F.lit(1)
    every = keyed.where(F.size("counted") >= least).select("id", "key", F.posexplode("counted").alias("place", "x")).select(
        "id", "key", "place", F.xxhash64("x.line").alias("a"), F.xxhash64(F.lit(1), F.col("x.line")).alias("b"),
        n_words.alias("words"))
    first = firsts.withColumnRenamed("key", "first key")
    rows = every.join(first, (F.col("id") == F.col("first_id")) & (F.col("key") == F.col("first key")), "left_semi")
    places = rows.groupBy("id", "key", "place").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("words").alias("words")).select(
        "id", tag.alias("tag"), "place", "a", "b", "words")
    single = ranked = _ranked(places)
    found = []
    if words == 1:
        found.append(_standing_earlier(single, ["rank"]).select("id", "tag", "place", F.lit(1).alias("n")))
    elif words:
        runs = write_and_read_back(_shortest(places, words), "runs")
        found.append(_standing_earlier(_wordy_runs(single, runs), ["n", "a", "b"]).select("id", "tag", "place", "n"))
    if words != 1:  # else every line of a longer run is gone by itself
        reach = 1
        while reach < lines:
            step = min(reach, lines - reach)
            ranked, reach = _ranked(_shifted(ranked, step)), reach + step
        found.append(_standing_earlier(ranked, ["rank"]).select("id", "tag", "place", F.lit(lines).alias("n")))
    gone = reduce(DataFrame.union, found).groupBy("id", "tag").agg(
        F.flatten(F.collect_list(F.sequence(F.col("place"), F.col("place") + F.col("n") - 1))).alias("gone")).select(
        F.col("id").alias("gone id"), F.col("tag").alias("gone tag"), F.array_distinct("gone").alias("gone"))
    # what is known of a text is brought together first, so that the texts are joined once
    known = firsts.join(gone, (F.col("first_id") == F.col("gone id")) & (tag == F.col("gone tag")), "left")
    known = write_and_read_back(known.select("key", "first_id", "gone"), "gone")

    all_rows = keyed.join(known, "key", "left")
    copy = F.col("id") > F.col("first_id")
    removed = F.when(copy, F.col("counted")["at"]).when(
        F.col("gone").isNotNull(), F.transform(F.filter("counted", lambda x, i: F.array_contains("gone", i)), lambda x: x["at"])
    ).otherwise(F.array().cast("array<int>"))
    lines_of = F.split("text", "\n", -1)
    kept = F.when(F.size("removed") == 0, F.col("text")).otherwise(
        F.array_join(F.filter(lines_of, lambda x, i: ~F.array_contains("removed", i)), "\n"))
    return all_rows.withColumn("removed", removed).select(
        "doc_id", F.greatest(F.size("counted"), F.lit(0)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), "removed", kept.alias("kept_text"),
        F.lower(F.hex("key")).alias("text_key"))

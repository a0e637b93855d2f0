"""Dirty delimited files: Latin-1, `;`, every cell a string."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queixa.fixed_values import COLUMN_NAMES
from queixa.sources.account import DropAccount

BYTE_ORDER_MARK = "\ufeff"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (any file system Spark can reach) can be read."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """Physical lines (`value`) with their file, the offset of the split they were read in, and a place
    that grows line by line inside a split."""
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        # The text source hands over the bytes of a line as they are.
        value = F.decode(value.cast("binary"), encoding)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"))


def _without_quoted(text: Column, sep: str) -> Column:
    """The text with whole quoted cells taken out. A quote opens a cell only at the cell's start; elsewhere it is a character."""
    cell = f'(^|{re.escape(sep)})"[^"]*+(?:""[^"]*+)*+"'
    return F.when(text.contains('"'), F.regexp_replace(text, cell, "$1_")).otherwise(text)


def _opens(text: Column, sep: str) -> Column:
    """Whether a quoted cell that begins on this line is still open at its end."""
    return text.contains('"') & _without_quoted(text, sep).rlike(f'(^|{re.escape(sep)})"')


def _stays_open(text: Column, sep: str) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one, this or a later one."""
    closing = '^[^"]*+(?:""[^"]*+)*+"'
    return ~text.rlike(closing) | _opens(F.regexp_replace(text, closing, "_"), sep)


def _ends_open(started: Column, fixed: Column, flips: Column) -> Column:
    """A line or split either fixes how it ends (`fixed`, then `flips` since) or flips how it started."""
    odd = flips % 2 == 1
    return F.coalesce(fixed, started) != odd


def _records(lines: DataFrame, sep: str, most_bytes: int) -> DataFrame:
    """Lines put together where a quoted cell goes on over line breaks (read as one `\\n` each).

    What a line does to an open cell does not depend on what stands before it: it fixes how it
    ends, keeps it, or flips it. So each split is summed up by itself, the few sums of a file
    are chained, and each split's lines learn how they start. Only lines of records that
    go over a break are grouped; all others stay where they are.
    """
    opens, stays = F.col("opens"), F.col("stays")
    read = lines.withColumns({"opens": _opens(F.col("value"), sep), "stays": F.col("value").contains('"')}).withColumn(
        "stays", F.when(stays, _stays_open(F.col("value"), sep)).otherwise(True))
    inside = W.partitionBy("file", "split").orderBy("place")
    flips = F.sum((opens & ~stays).cast("long")).over(inside)
    known = read.withColumn("flips", flips).withColumn(
        "last_fix", F.last(F.when(opens == stays, F.struct(opens.alias("open"), "flips")), ignorenulls=True).over(inside))
    since = F.col("flips") - F.coalesce("last_fix.flips", F.lit(0))
    known = known.select("value", "file", "split", "place", F.col("last_fix.open").alias("fixed"), since.alias("since"))

    # one row per split: how it ends, as a function of how it starts
    chain = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    ends = known.groupBy("file", "split").agg(F.max_by(F.struct("fixed", "since"), "place").alias("end")).withColumn(
        "before", F.coalesce(F.sum("end.since").over(chain), F.lit(0)))
    last_fix = F.last(F.when(F.col("end.fixed").isNotNull(), F.struct("end.fixed", "before")), ignorenulls=True).over(chain)
    starts = ends.withColumn("last_fix", last_fix).select(
        "file", "split", _ends_open(F.lit(False), F.col("last_fix.fixed"), F.col("before") - F.coalesce("last_fix.before", F.lit(0))).alias("starts_open"))
    state = known.join(starts, ["file", "split"]).withColumn(
        "open_after", _ends_open(F.col("starts_open"), F.col("fixed"), F.col("since")))
    state = state.withColumn("open_before", F.coalesce(F.lag("open_after").over(inside), F.col("starts_open")))
    whole = state.where(~F.col("open_before") & ~F.col("open_after")).select("value", "file")

    # a record is named by the place of its first line, which may lie in an earlier split
    begun = state.withColumn("first", F.last(F.when(~F.col("open_before"), F.col("place")), ignorenulls=True).over(inside))
    lasts = begun.groupBy("file", "split").agg(F.max_by("first", "place").alias("last"))
    carried = lasts.select("file", "split", F.last("last", ignorenulls=True).over(chain).alias("carried"))
    pieces = begun.where(F.col("open_before") | F.col("open_after")).join(carried, ["file", "split"]).select(
        "file", F.coalesce("first", "carried").alias("record"), "split", "place", "value", "open_after")
    # a cell that is never closed would take in the rest of its file
    sizes = pieces.groupBy("file", "record").agg(
        F.sum(F.length("value") + 1).alias("size"), F.max_by("open_after", F.struct("split", "place")).alias("unclosed"))
    sound = sizes.select("file", "record", F.when(
        F.col("unclosed") | (F.col("size") > most_bytes), F.raise_error(
            F.concat(F.lit("a quoted cell is not closed in "), F.col("file"))).cast("boolean")).otherwise(True).alias("sound"))
    joined = pieces.join(sound, ["file", "record"]).where("sound").groupBy(
        "file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "place", "value"))).alias("lines"))
    return whole.union(joined.select(F.array_join("lines.value", "\n"), "file"))


@dataclass(frozen=True)
class _Header:
    """A header line, the files that begin with it, and whether a cell in one of them goes over a line break."""
    line: str
    files: list[str]
    broken: bool

    def names(self, sep: str) -> list[str]:
        return [name.strip().strip('"').strip() for name in self.line.strip(BYTE_ORDER_MARK).split(sep)]


def _headers(lines: DataFrame, sep: str, multi_line: bool) -> list[_Header]:
    """The distinct headers of a path's files, in one pass that shuffles a row per file and task."""
    first = F.min_by(F.when(F.col("split") == 0, F.col("value")), F.when(F.col("split") == 0, F.col("place")))
    opened = F.max(_opens(F.col("value"), sep)) if multi_line else F.lit(False)
    found = lines.groupBy("file").agg(first.alias("header"), opened.alias("broken")).where("header is not null")
    by_line: dict[str, list] = {}
    for row in sorted(found.collect(), key=lambda r: r.file):
        by_line.setdefault(row.header, []).append(row)
    return [_Header(line, [r.file for r in rows], any(r.broken for r in rows)) for line, rows in by_line.items()]


def _parsed(records: DataFrame, header: _Header, sep: str, account: DropAccount | None) -> DataFrame:
    """Cells of the records under one header; records with more fields than it are skipped, shorter ones padded."""
    names = header.names(sep)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    record = F.col("value")
    unquoted = _without_quoted(record, sep)
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))
    blank, is_header, too_long = F.trim(record) == "", record == F.lit(header.line), separators >= len(names)
    if account is not None:
        records = account.watch(records, {"linha vazia": blank, "linha longa": ~blank & ~is_header & too_long})
    kept = records.where(~blank & ~is_header & ~too_long)
    options = {"sep": sep, "quote": '"', "escape": '"'}
    return kept.select(F.from_csv(record, schema.toDDL(), options).alias("row")).select("row.*")


# A record longer than this holds a cell that was never closed.
MOST_RECORD_BYTES = 64 << 20


def read_raw_csv(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1", multi_line: bool = True,
    most_record_bytes: int = MOST_RECORD_BYTES, account: DropAccount | None = None,
) -> DataFrame:
    """One delimited file, or a folder of them, each with a header line; all columns strings.

    Lines with more fields than the header are skipped; shorter ones are kept and
    padded with NULL. Spark's malformed-line mode would drop both, so the fields
    of a line are counted first (separators inside quotes do not count). Header
    names are trimmed. Files of a folder may differ in their headers: each is read under its own,
    and columns are matched by name.

    A first pass reads the headers and looks for quoted cells that go over line breaks. Only
    if there are some are lines put together (`multi_line=False` never does); files
    are split among tasks either way, and no record is cut where a split ends. A cell that is
    never closed is an error once its record passes `most_record_bytes`, or ends its file. An `account`
    counts what is skipped.
    """
    lines = _lines(spark, path, encoding)
    headers = _headers(lines, sep, multi_line)
    if not headers:
        raise ValueError(f"no header line in {path}")
    frames = []
    for header in headers:
        own = lines if len(headers) == 1 else _lines(spark, [unquote(f) for f in header.files], encoding)
        records = _records(own, sep, most_record_bytes) if header.broken else own
        frames.append(_parsed(records, header, sep, account))
    return union_all(frames)


def canonical_columns(df: DataFrame, names: Mapping[str, str] = COLUMN_NAMES) -> DataFrame:
    """Trim the header names and rename those the map knows; others stay, absent ones are ignored."""
    return df.toDF(*[c.strip() for c in df.columns]).withColumnsRenamed(dict(names))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_many(spark: SparkSession, paths: Sequence[str], account: DropAccount | None = None) -> list[DataFrame]:
    """One frame per path that exists; missing files are skipped, none at all is an error."""
    frames = [read_raw_csv(spark, path, account=account) for path in paths if path_exists(spark, path)]
    if not frames:
        raise FileNotFoundError(f"none of these exist: {', '.join(paths)}")
    return frames

"""WARC archives of page captures, and one index over them by external merge.

Spark's text writer makes the archives: a row is a record, and the blank lines that end a record
are the line separator. Each archive is read back into a run of captures sorted by URL key and
timestamp. Runs are cut into blocks at common range bounds; a merge task gets its range's blocks
in the order of their first capture and merges them with a loser tree, opening a block only when
the merge reaches it. So it holds the blocks that overlap, not its range.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.session import shared_folder, write_and_read_back

# Payloads from this size on are stored once.
SHARED_FROM = 100
# Records in an archive, and their bytes on average; captures in a block of a run, captures in a merged range.
ARCHIVE_RECORDS, ARCHIVE_BYTES, BLOCK, RANGE = 5_000, 64 << 20, 512, 50_000
# Bytes inflated at once when an archive is read.
PIECE = 1 << 20
END = "\r\n\r\n"
ENTRY = pa.struct([("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()),
                   ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())])
ENTRY_SQL = ("struct<url_key:string,timestamp:string,page_id:bigint,url:string,archive:string,offset:bigint,length:bigint,"
             "record_type:string,payload_digest:string,payload_bytes:bigint,refers_to:bigint>")


def decide(pages: DataFrame) -> DataFrame:
    """Pages with payload, payload_digest, payload_bytes, record_type and refers_to.

    Of equal payloads of at least SHARED_FROM bytes the smallest page_id is the response and the
    others revisit it; rows that repeat that page_id are responses too, and without any page_id all are."""
    payload = pages.withColumn("payload", F.coalesce("html", F.lit(""))).withColumn(
        "payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    shared = payload.where(F.col("payload_bytes") >= SHARED_FROM).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_page is not null").drop("n")
    marked = payload.join(shared, "payload_digest", "left")
    revisit = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return marked.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first_page"))).drop("first_page")


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; control characters and blanks are percent-encoded."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7f]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, records: int | None = None) -> None:
    """One WARC/1.1 record per page, in compressed archives under `path`.

    An archive has at most `records` records; if that isn't given, ARCHIVE_RECORDS, or as many average pages as make
    ARCHIVE_BYTES. `pages` needs page_id, url, timestamp (14 digits or null) and html."""
    if records is None:
        average = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 1
        records = max(1, min(ARCHIVE_RECORDS, int(ARCHIVE_BYTES / max(1, average))))
    rows = decide(pages)
    response = F.col("record_type") == "response"
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    body = F.concat(http, F.when(response, F.col("payload")).otherwise(""))
    stamp = F.regexp_replace("timestamp", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    refers = F.when(~response, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(">"))),
        _header("WARC-Date", F.coalesce(stamp, F.lit("1970-01-01T00:00:00Z"))), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(~response, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", refers), F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(body)), F.lit("\r\n"), body)
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", records).text(path)


def url_key(url: str | None) -> str:
    """The key captures are sorted by: host labels reversed, then path and query; no scheme, port or fragment."""
    found = re.match(r"(?:[a-zA-Z][\w+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url or "", re.DOTALL)
    host = found[1].lower().removeprefix("www.")
    return f"{','.join(reversed(host.split('.')))}){found[2] or '/'}"


class Inflated:
    """A compressed archive, read forward piece by piece: `held` is what is inflated and not yet dropped."""

    def __init__(self, data) -> None:
        self.data, self.at, self.held, self.inflate = memoryview(data), 0, bytearray(), zlib.decompressobj(wbits=31)

    def more(self) -> bool:
        if self.at >= len(self.data):
            return False
        if self.inflate.eof:  # a file may hold several members
            self.inflate = zlib.decompressobj(wbits=31)
        piece = self.data[self.at:self.at + PIECE]
        self.held += self.inflate.decompress(piece, PIECE)
        self.at += len(piece) - len(self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail)
        return True

    def reach(self, n: int) -> None:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")

    def find(self, mark: bytes) -> int:
        """Where the mark stands; -1 at the archive's end."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                return -1
        return found


def parse(data, archive: str) -> Iterator[dict]:
    """The records of one compressed archive, one at a time. A response's digest and size are those of the payload
    read; a revisit has no payload of its own and gives those its headers state."""
    read, at = Inflated(data), 0
    while (stop := read.find(b"\r\n\r\n")) >= 0:
        head = dict(x.split(": ", 1) for x in read.held[:stop].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        end = stop + 4 + size + 4
        read.reach(end)
        http, payload = bytes(read.held[stop + 4:stop + 4 + size]).split(b"\r\n\r\n", 1)
        del read.held[:end]
        number = head["WARC-Record-ID"][len("<urn:page:"):-1]
        digest, n = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(http.rsplit(b": ", 1)[1])
        if head["WARC-Type"] == "response":
            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != n:
                raise ValueError(f"damaged record at {at} of {archive}")
        yield {"url_key": url_key(head.get("WARC-Target-URI")), "timestamp": re.sub(r"\D", "", head["WARC-Date"]),
               "page_id": None if number == "none" else int(number), "url": head.get("WARC-Target-URI"), "archive": archive,
               "offset": at, "length": end, "record_type": head["WARC-Type"], "payload_digest": digest, "payload_bytes": n,
               "refers_to": int(head["WARC-Refers-To"][len("<urn:page:"):-1]) if "WARC-Refers-To" in head else None}
        at += end
    if bytes(read.held).strip():
        raise ValueError(f"{archive} ends inside a record")


def sort_key(entry: dict) -> tuple:
    page = entry["page_id"]
    return entry["url_key"], entry["timestamp"], page is None, page or 0, entry["archive"], entry["offset"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive's captures as a sorted run."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            run = sorted(parse(content.as_buffer() if content.is_valid else b"", os.path.basename(path.as_py())), key=sort_key)
            for at in range(0, len(run), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([run[at:at + BLOCK]], pa.list_(ENTRY))], names=["run"])


def _blocks(batches: Iterator[pa.RecordBatch], bounds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of runs, cut at the ranges' bounds: (range, first key, entries)."""
    for batch in batches:
        for run in batch.column(0).to_pylist():
            cuts: dict[int, list] = {}
            for entry in run:
                cuts.setdefault(bisect_right(bounds, sort_key(entry)[:4]), []).append(entry)
            for part, entries in cuts.items():
                first = json.dumps(sort_key(entries[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([entries[0]["url_key"]]), pa.array([entries[0]["timestamp"]]),
                     pa.array([first]), pa.array([entries], pa.list_(ENTRY))], names=["part", "url_key", "timestamp", "first", "entries"])


class LoserTree:
    """Merges sorted lists: inner nodes hold the loser of their subtree's match, so the next smallest head
    takes one comparison per level. Lists can be added while merging."""

    def __init__(self) -> None:
        self.lists: list[list[dict]] = []
        self.at: list[int] = []
        self.heads: list[tuple | None] = []
        self.losers: list[int] = []
        self.winner = -1

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def add(self, entries: list[dict]) -> None:
        spent = [i for i, head in enumerate(self.heads) if head is None]
        if spent:
            self.lists[spent[0]], self.at[spent[0]], self.heads[spent[0]] = entries, 0, sort_key(entries[0])
        else:
            size = max(1, 2 * len(self.lists))
            self.lists += [entries] + [[] for _ in range(size - len(self.lists) - 1)]
            self.at += [0] * (size - len(self.at))
            self.heads += [sort_key(entries[0])] + [None] * (size - len(self.heads) - 1)
        self._play()

    def _play(self) -> None:
        n = len(self.lists)
        self.losers, won = [0] * n, [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.losers[node] = (a, b) if self._less(a, b) else (b, a)
        self.winner = won[1] if n > 1 else 0

    def head(self) -> tuple | None:
        return self.heads[self.winner] if self.heads else None

    def pop(self) -> dict:
        i = self.winner
        entry = self.lists[i][self.at[i]]
        self.at[i] += 1
        self.heads[i] = sort_key(self.lists[i][self.at[i]]) if self.at[i] < len(self.lists[i]) else None
        node = (i + len(self.lists)) // 2
        while node:
            if not self._less(i, self.losers[node]):
                i, self.losers[node] = self.losers[node], i
            node //= 2
        self.winner = i
        return entry


def merge(blocks: Iterator[tuple[tuple, list[dict]]]) -> Iterator[dict]:
    """All captures in order; `blocks` come in the order of their first keys."""
    tree = LoserTree()
    for first, entries in blocks:
        while tree.head() is not None and tree.head() < first:
            yield tree.pop()
        tree.add(entries)
    while tree.head() is not None:
        yield tree.pop()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's ranges, one after another, each merged; `part` orders them."""

    def blocks() -> Iterator[tuple[int, tuple, list[dict]]]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.column(0)[i].as_py(), tuple(json.loads(batch.column(3)[i].as_py())), batch.column(4)[i].as_py()

    def out(entries: list[dict], part: int) -> pa.RecordBatch:
        table = pa.array(entries, ENTRY)
        return pa.RecordBatch.from_arrays([pa.array([part] * len(entries), pa.int32()), table], names=["part", "capture"])

    def ranges() -> Iterator[tuple[int, Iterator]]:
        held = next(source, None)
        while held is not None:
            part = held[0]

            def own(part=part):
                nonlocal held
                while held is not None and held[0] == part:
                    yield held[1], held[2]
                    held = next(source, None)
            yield part, own()

    source = blocks()
    for part, own in ranges():
        entries = []
        for entry in merge(own):
            entries.append(entry)
            if len(entries) == 4096:
                yield out(entries, part)
                entries = []
        if entries:
            yield out(entries, part)


def index(spark, path: str, captures_per_range: int = RANGE) -> DataFrame:
    """All captures of the archives under `path`, read back and checked: their entries, and `part`.

    Parts are consecutive ranges of (url_key, timestamp, page_id), and each comes sorted, so part by
    part it is one history. A URL captured very often spreads over several parts."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").schema(kind).option("pathGlobFilter", "*.gz").load(path)
    runs = write_and_read_back(files.select("path", "content").mapInArrow(_runs, f"run array<{ENTRY_SQL}>"), "runs")
    entries = runs.select(F.explode("run").alias("x")).select("x.*")
    total = entries.count()
    ranges = max(1, -(-total // captures_per_range))
    # bounds only balance the ranges, so a bounded sample by hash does
    sample = entries.select("url_key", "timestamp", "page_id").orderBy(
        F.xxhash64("page_id", "url_key", "timestamp")).limit(min(100_000, 64 * ranges)).collect()
    keys = sorted((r.url_key, r.timestamp, r.page_id is None, r.page_id or 0) for r in sample)
    bounds = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    blocks = runs.mapInArrow(
        partial(_blocks, bounds=bounds),
        f"part int, url_key string, timestamp string, first string, entries array<{ENTRY_SQL}>")
    dealt = blocks.repartition(ranges, "part").sortWithinPartitions("part", "url_key", "timestamp", "first")
    merged = dealt.mapInArrow(_merged, f"part int, capture {ENTRY_SQL}")
    return merged.select("part", "capture.*")


def archive_and_index(pages: DataFrame, records: int | None = None) -> DataFrame:
    """Archives `pages` in the shared folder and returns the merged index (see `index`).

    `pages` needs page_id (a whole number), url, html, and may have timestamp (14 digits); without
    one, captures are a second apart by page_id. Other columns are ignored. A null html is an empty
    payload, a null url has no target header and the smallest key, a null page_id stays null; repeated
    rows are records of their own; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    if "timestamp" not in pages.columns:
        second = F.timestamp_seconds(F.lit(1_577_836_800) + F.coalesce(F.pmod("page_id", F.lit(10**8)), F.lit(0)))
        pages = pages.withColumn("timestamp", F.date_format(second, "yyyyMMddHHmmss"))
    path = os.path.join(shared_folder(spark), f"warc-{uuid.uuid4().hex}")
    write_archives(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "timestamp", "html"), path, records)
    return index(spark, path)

"""Tokens of two tokenizers aligned by bytes, and how many documents hold each linked pair.

A is a byte-level BPE (JSON), B a piece model with byte fallback. Both are encoded whole; where
tokens of both end, a group ends. Two tokens are linked where their bytes overlap: the stretches
between neighbouring token ends of either side are the links, one each.

A pair of ids with the same bytes is found in an array over A's ids, and its documents are
counted in vectors of A's length. All other pairs are counted by a shuffle of (pair, documents)
per chunk, and a chunk gets its own pairs' counts back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queixa.llm.chunks import CHUNK_BYTES, Numbering, chunk_writer, offsets, spread, sums
from queixa.session import write_and_read_back

# Neither tokenizer has a token across such a space: A cuts words there, and no piece of B goes on
# over a space (checked when it is loaded). A text's tokens are those of the stretches between.
CUT = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")
# Stretches that begin and end at such a cut, of letters whose class is the same in every version of
# Unicode: joined by spaces they have the tokens that they have alone.
PLAIN = re.compile("[A-Za-z](?:[\\t\\n\\r -~À-ÖØ-öø-ɏ]*[!-~])?")
# How byte-level BPE cuts a text into words (fixed by the tokenizer's format).
WORDS_OF_A = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bytes handed to the tokenizers in one call.
CALL_BYTES = 1 << 17

CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())),
    *((name, pa.list_(pa.int64())) for name in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.list_(pa.string())),
    ("same_ids", pa.list_(pa.int32())), ("same_documents", pa.list_(pa.int32())),  # counts of A ids linked to their own bytes
    ("pairs", pa.list_(pa.int64())), ("pair_documents", pa.list_(pa.int32())),  # counts of all other pairs
    # per document: how many ids and pairs, then which and how often
    ("same_sizes", pa.binary()), ("same_places", pa.binary()), ("same_times", pa.binary()),
    ("pair_sizes", pa.binary()), ("pair_places", pa.binary()), ("pair_times", pa.binary())])
DOCUMENTS = pa.schema([
    ("doc_id", pa.int64()), *((name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    ("groups_sha256", pa.string())])
PER_CHUNK = ("same_sizes", "same_places", "same_times", "pair_sizes", "pair_places", "pair_times")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where it prints, the others as 256, 257, ..."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their ids, and for each A id the B id of the same bytes (or -1)."""

    def __init__(self, byte_json: bytes, piece_model: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(byte_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = _byte_of_letter()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for text, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(letters.__getitem__, text)) if letters.keys() >= set(text) else text.encode()
        self.fast = self._ranked(json.loads(byte_json))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces that go on over a space cannot be cut there")
        single = [self.b.is_byte(i) for i in range(len(pieces))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if one else p.replace("▁", " ").encode()
                        for p, one in zip(pieces, single, strict=True)]
        by_bytes = {b: i for i, (b, one) in enumerate(zip(self.bytes_b, single, strict=True)) if one}
        by_bytes |= {b: i for i, (b, one) in enumerate(zip(self.bytes_b, single, strict=True)) if not one}
        self.same = np.array([by_bytes.get(b, -1) for b in self.bytes_a], dtype=np.int64)
        self.length_a, self.length_b = (np.array([len(x) for x in own], dtype=np.int64) for own in (self.bytes_a, self.bytes_b))
        self.text_a = [f"{i}{end}" for end in ",|" for i in range(len(self.bytes_a))]
        self.text_b = [f"{i}{end}" for end in ",;" for i in range(len(self.bytes_b))]

    def _ranked(self, file: dict):
        """A's merges by rank, for plain text: the same ids several times faster. None where its ids are not in the order of its merges."""
        import tiktoken

        model, cut = file["model"], file.get("pre_tokenizer") or {}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
        made = [model["vocab"].get(m, -1) for m in merged]
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not file.get("normalizer")
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not usual or not plain or not made or made != list(range(256, 256 + len(made))) or len(model["vocab"]) != 256 + len(made):
            return None
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values()}
        return tiktoken.Encoding("plain", pat_str=WORDS_OF_A, mergeable_ranks=ranks, special_tokens={})

    def joined(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens of plain stretches, one after the other."""
        text = " ".join(texts)
        a = self.fast.encode_ordinary(" " + text) if self.fast else self.a.encode(" " + text, add_special_tokens=False).ids
        lines = [" ".join(texts[i:i + 100]) for i in range(0, len(texts), 100)]
        return a, list(chain.from_iterable(self.b.encode(lines, num_threads=1)))

    def each(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [x.ids for x in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _loaded(byte_json: bytes, piece_model: bytes) -> Pair:
    return Pair(byte_json, piece_model)


class _Aligned:
    """Stretches of text with their counts (A, B, groups, links), their groups as text and their links, one after the other."""

    def __init__(self, pair: Pair, texts: list[str]) -> None:
        plain = np.array([PLAIN.fullmatch(t) is not None for t in texts], dtype=bool)
        self.order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        self.counts, self.groups, self.links = [], [], []
        self.whole = np.ones(len(texts), dtype=bool)
        self._calls(pair, [texts[i] for i in np.flatnonzero(plain).tolist()], self._plain)
        self._calls(pair, [texts[i] for i in np.flatnonzero(~plain).tolist()], self._odd)
        # back to the order of the texts
        counts, groups = np.concatenate([np.empty((0, 4), dtype=np.int64), *self.counts]), self.groups
        self.links = np.concatenate([np.empty(0, dtype=np.int64), *self.links])
        place = np.argsort(self.order)
        self.whole, self.counts, self.groups = self.whole[place], counts[place], [groups[i] for i in place.tolist()]
        self.first_link = offsets(counts[:, 3])[:-1][place]

    def _calls(self, pair: Pair, texts: list[str], call) -> None:
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CALL_BYTES):
                size += len(texts[end])
                end += 1
            call(pair, texts[at:end])
            at = end

    def _plain(self, pair: Pair, texts: list[str]) -> None:
        a, b = pair.joined(texts)
        whole = (" " + " ".join(texts)).encode()
        if b"".join(map(pair.bytes_a.__getitem__, a)) != whole or b"".join(map(pair.bytes_b.__getitem__, b)) != whole:
            self._odd(pair, texts)
        else:
            self._align(pair, np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), np.array([1 + len(t.encode()) for t in texts]))

    def _odd(self, pair: Pair, texts: list[str]) -> None:
        found_a, found_b = pair.each(texts)
        wanted = [b" " + t.encode() for t in texts]
        whole = [b"".join(map(pair.bytes_a.__getitem__, a)) == w == b"".join(map(pair.bytes_b.__getitem__, b))
                 for a, b, w in zip(found_a, found_b, wanted, strict=True)]
        a, b = ([i for x, ok in zip(found, whole, strict=True) if ok for i in x] for found in (found_a, found_b))
        at = len(self.groups)
        self.whole[at:at + len(texts)] = whole
        lengths = np.array([len(w) if ok else 0 for w, ok in zip(wanted, whole, strict=True)])
        self._align(pair, np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), lengths)

    def _align(self, pair: Pair, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> None:
        """Tokens of stretches that stand one after the other, `lengths` bytes each."""
        ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
        last_a, last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        ends = np.sort(np.concatenate([ends_a, ends_b[~last_b]]), kind="stable")
        shared = ends_a[last_a]
        self.links.append(a[np.searchsorted(ends_a, ends)] * len(pair.bytes_b) + b[np.searchsorted(ends_b, ends)])
        edges = offsets(lengths)
        cuts = [np.searchsorted(x, edges, side="right") for x in (ends_a, ends_b, shared, ends)]
        self.counts.append(np.stack([np.diff(x) for x in cuts], axis=1))
        # a token's place among A and B tokens, group by group, and its text with what follows it
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        through_a, through_b = np.bincount(group_a, minlength=len(shared)).cumsum(), np.bincount(group_b, minlength=len(shared)).cumsum()
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], through_b])[group_a]] = a + last_a * len(pair.bytes_a)
        order[np.arange(len(b)) + through_a[group_b]] = -1 - (b + last_b * len(pair.bytes_b))
        said = [pair.text_a[i] if i >= 0 else pair.text_b[-1 - i] for i in order.tolist()]
        bounds = (cuts[0] + cuts[1]).tolist()
        self.groups += ["".join(said[x:y])[:-1] for x, y in zip(bounds, bounds[1:], strict=False)]


def _pack(table: pa.Table, pair: Pair) -> dict:
    """One chunk: its documents' counts, and the ids and pairs they hold, each once per document."""
    numbers, of_document, sizes = Numbering(), [], []
    for text in table["text"].to_pylist():
        found = list(map(numbers.__getitem__, CUT.split(text))) if text else []
        of_document.append(np.array(found, dtype=np.int64))
        sizes.append(len(found))
    known = _Aligned(pair, list(numbers))
    bounds, stretches = offsets(np.array(sizes, dtype=np.int64)), np.concatenate([np.empty(0, dtype=np.int64), *of_document])
    broken = sums((~known.whole[stretches]).astype(np.int64), bounds) > 0
    digests = []
    for i, own in enumerate(of_document):
        good = len(own) and not broken[i]
        digests.append(hashlib.sha256(";".join([known.groups[k] for k in own.tolist()]).encode()).hexdigest() if good else "")
        if broken[i]:
            of_document[i] = own[:0]
    sizes = np.array([len(x) for x in of_document], dtype=np.int64)
    bounds, stretches = offsets(sizes), np.concatenate([np.empty(0, dtype=np.int64), *of_document])
    counts = [sums(known.counts[stretches, k], bounds) for k in range(4)]
    # a stretch once per document, then its links, then a pair once per document
    documents = np.repeat(np.arange(len(sizes)), sizes)
    both, times = np.unique(documents * max(1, len(numbers)) + stretches, return_counts=True)
    documents, stretches = np.divmod(both, max(1, len(numbers)))
    n_links = known.counts[:, 3]
    at = spread(known.first_link[stretches], n_links[stretches])
    width = len(pair.bytes_a) * len(pair.bytes_b)
    held, place = np.unique(np.repeat(documents, n_links[stretches]) * width + known.links[at], return_inverse=True)
    times = np.bincount(place, weights=np.repeat(times, n_links[stretches]), minlength=len(held)).astype(np.int64)
    documents, pairs = np.divmod(held, width)
    a, b = np.divmod(pairs, len(pair.bytes_b))
    same = pair.same[a] == b
    per_id = np.bincount(a[same], minlength=len(pair.bytes_a))
    ids = np.flatnonzero(per_id)
    other, place, n_other = np.unique(pairs[~same], return_inverse=True, return_counts=True)

    def raw(x: np.ndarray) -> bytes:
        return x.astype(np.int32).tobytes()
    return {
        "doc_id": table["doc_id"].combine_chunks(), **{n: c for n, c in zip(("n_a", "n_b", "n_groups", "n_links"), counts, strict=True)},
        "groups_sha256": digests, "same_ids": ids, "same_documents": per_id[ids], "pairs": other, "pair_documents": n_other,
        "same_sizes": raw(np.bincount(documents[same], minlength=len(sizes))), "same_places": raw(a[same]), "same_times": raw(times[same]),
        "pair_sizes": raw(np.bincount(documents[~same], minlength=len(sizes))), "pair_places": raw(place), "pair_times": raw(times[~same])}


def _settle(chunks: pa.Table, answers: pa.Table, same_counts: np.ndarray, same_best: np.ndarray) -> Iterator[pa.Table]:
    """The documents of one chunk, given the counts of its pairs in the order of its own list."""
    for row in chunks.to_batches():
        order = np.argsort(answers["place"].to_numpy())
        counts, best = (answers[n].to_numpy(zero_copy_only=False)[order] for n in ("documents", "best"))
        part = {n: np.frombuffer(row[n][0].as_py(), dtype=np.int32).astype(np.int64) for n in PER_CHUNK}
        count_sum, n_best = 0, 0
        for kind, count, is_best in (("same", same_counts, same_best), ("pair", counts, best)):
            bounds, places, times = offsets(part[f"{kind}_sizes"]), part[f"{kind}_places"], part[f"{kind}_times"]
            count_sum = count_sum + sums(times * count[places], bounds)
            n_best = n_best + sums(times * is_best[places], bounds)
        columns = {n: row[n][0].values for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        columns |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        yield pa.Table.from_arrays([columns[f.name] for f in DOCUMENTS], schema=DOCUMENTS)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def align(docs: DataFrame, byte_json: str, piece_model: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: tokens of A and B, groups, links, links to an A id's most frequent partner, and the links' counts.

    `docs` needs doc_id and text; other columns are neither read nor returned, so none can clash. Null
    and empty texts, and texts that a tokenizer does not give back byte for byte, have zeros and ''.
    Rows with equal ids count as documents of their own; a null id stays null. An empty table gives
    an empty result. The tokenizer files are read by the driver and sent to the tasks.

    The vectors by A id and B's ids are as long as the vocabularies, whatever the corpus; pairs are shuffled.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((_read(byte_json), _read(piece_model)))
    pair = _loaded(*files.value)
    n_a, n_b = len(pair.bytes_a), len(pair.bytes_b)

    def pack(table: pa.Table) -> dict:
        return _pack(table, _loaded(*files.value))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = write_and_read_back(rows.mapInArrow(chunk_writer(pack, CHUNKS, chunk_bytes), _spark_schema(CHUNKS)), "aligned-chunks")

    own = stored.select(F.explode(F.arrays_zip("same_ids", "same_documents")).alias("x")).groupBy("x.same_ids").agg(F.sum("x.same_documents").alias("n"))
    asked = stored.select("chunk", F.posexplode(F.arrays_zip("pairs", "pair_documents")).alias("place", "x")).select(
        "chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_documents").alias("n"))
    counted = write_and_read_back(asked.groupBy("pair").agg(F.sum("n").alias("documents")), "pair-counts")
    # one row per A id on the driver: at most the vocabulary
    same_counts, most = np.zeros(n_a, dtype=np.int64), np.zeros(n_a, dtype=np.int64)
    for a, n in own.collect():
        same_counts[a] = n
    a_id = F.floor(F.col("pair") / n_b) if n_a * n_b < 2**53 else F.expr(f"pair div {n_b}")
    for a, n in counted.groupBy(a_id.cast("int").alias("a")).agg(F.max("documents")).collect():
        most[a] = n
    vectors = spark.sparkContext.broadcast((same_counts, np.maximum(most, same_counts)))
    best = spark.createDataFrame([(int(i), int(vectors.value[1][i])) for i in np.flatnonzero(most)], "a int, most long")
    marked = counted.join(F.broadcast(best), a_id.cast("int") == best["a"]).select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    answers = asked.select("chunk", "place", "pair").join(marked, "pair").select(F.col("chunk").alias("asked_by"), "place", "documents", "best")

    def settle(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        counts, highest = vectors.value
        found = list(_settle(chunks, answers, counts, (counts == highest) & (counts > 0)))
        return pa.concat_tables(found) if found else DOCUMENTS.empty_table()
    wanted = stored.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *PER_CHUNK)
    return wanted.groupBy("chunk").cogroup(answers.groupBy("asked_by")).applyInArrow(settle, _spark_schema(DOCUMENTS))


def _spark_schema(schema: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema
    return from_arrow_schema(schema)

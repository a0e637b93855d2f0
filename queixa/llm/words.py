"""Words of UTF-8 texts as arrays: one 64-bit name per word.

A word is a maximal run of bytes of one class. Both classes below treat every byte of a
non-ASCII character as part of a word, so working on bytes equals working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z
LETTERS = np.ones(256, dtype=bool)
LETTERS[:0x80] = False
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

# Bytes worked on at once: the arrays of a piece stay in the processor's cache.
PIECE = 1 << 18

def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Names(dict):
    """Names of long words: digests, so that no two share one by their letters. Forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_NAMES:
            self.clear()
        self[word] = name = int.from_bytes(blake2b(word, digest_size=8, key=b"words").digest(), "little")
        return name


MOST_NAMES = 1 << 17
_NAMES = _Names()
# A word of up to eight bytes is named by those bytes themselves, spread by a bijection: no two share a name.
SHORT = 8
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], dtype=np.uint64)
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 0x20


def _hashes(data: np.ndarray, cuts: np.ndarray, word: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words of `data`, and how many words start before each of `cuts` (where rows begin)."""
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.zeros(len(cuts), dtype=np.int64)
    inside = word[data]
    edges = cuts[(cuts > 0) & (cuts < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    lengths = ends - starts
    padded = np.concatenate([_FOLDED[data] if fold else data, np.zeros(SHORT, dtype=np.uint8)])
    short = lengths <= SHORT
    zeros = np.flatnonzero(padded[:-SHORT] == 0)
    if len(zeros):  # a zero byte in a word would look like its end
        short &= np.searchsorted(zeros, starts) == np.searchsorted(zeros, ends)
    found = np.lib.stride_tricks.sliding_window_view(padded, SHORT)[starts].view(np.uint64).ravel()
    found = mixed((found & _LOW_BYTES[np.minimum(lengths, SHORT)]) ^ _LEFT)
    long = np.flatnonzero(~short)
    if len(long):
        text = padded.tobytes()
        own = [text[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        found[long] = np.fromiter(map(_NAMES.__getitem__, own), dtype=np.uint64, count=len(own))
    return found, np.searchsorted(starts, cuts)


@dataclass
class Words:
    """Rows `first` to `last` (excluded) of a batch; row i's words are hashes[bounds[i]:bounds[i + 1]]."""
    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)


def _long_row(data: np.ndarray, word: np.ndarray, fold: bool) -> np.ndarray:
    """Word hashes of one long text, piece by piece; pieces end where no word does."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):
            stop = np.flatnonzero(~word[data[max(at, end - PIECE):end]])
            if len(stop):
                end = max(at, end - PIECE) + int(stop[-1]) + 1
                break
            end = min(len(data), end + PIECE)
        parts.append(_hashes(data[at:end], np.array([0, end - at]), word, fold)[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def hashed(texts: pa.Array, word: np.ndarray, fold: bool = False, words: int = 0) -> Iterator[Words]:
    """Consecutive rows of `texts` with the hashes of all their words; nulls have none.

    Each item holds rows of about PIECE bytes, or of at least `words` words, or one longer row.
    """
    if not len(texts):
        return
    offsets, data = _buffers(texts)
    held: list[Words] = []
    at = 0
    while at < len(texts):
        last = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
        last = min(last, len(texts))
        piece = data[offsets[at]:offsets[last]]
        if len(piece) > PIECE:
            found = _long_row(piece, word, fold)
            item = Words(at, last, found, np.array([0, len(found)]))
        else:
            item = Words(at, last, *_hashes(piece, offsets[at:last + 1] - offsets[at], word, fold))
        held.append(item)
        at = last
        if sum(len(x.hashes) for x in held) >= words or at == len(texts):
            yield _joined(held)
            held = []


def _joined(held: list[Words]) -> Words:
    if len(held) == 1:
        return held[0]
    bounds, base = [np.zeros(1, dtype=np.int64)], 0
    for x in held:
        bounds.append(x.bounds[1:] + base)
        base += len(x.hashes)
    return Words(held[0].first, held[-1].last, np.concatenate([x.hashes for x in held]), np.concatenate(bounds))


def _both(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of one stretch followed by another. Mixed at each step: no sum of powers, whose terms could cancel out."""
    return mixed(mixed(left + _LEFT) + right * _RIGHT)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words: stretches of 1, 2, 4, ... words, put together."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    found, done, stretch, size = None, 0, hashes, 1
    while size <= n:
        if n & size:
            own = stretch[done:done + count]
            found, done = (own if found is None else _both(found, own)), done + size
        size *= 2
        if size <= n:
            stretch = _both(stretch[:len(stretch) - size // 2], stretch[size // 2:])
    return mixed(found)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def as_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One list of longs per row."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), as_long(values))

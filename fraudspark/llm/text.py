"""Vectorised text helpers for Arrow batches: flat bytes, word spans, 64-bit hashes.

All functions work on whole texts; batches are cut into blocks of whole documents of
about ``BLOCK_BYTES`` (and at most ``BLOCK_TEXTS`` documents), so memory follows the block (or the longest document), not the batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2_000_000
BLOCK_TEXTS = 2_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


@dataclass
class Block:
    """Documents first .. first+n of a batch; data[starts[i]:starts[i + 1]] is a text, null texts are empty."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    valid: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole documents of a string column."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    valid = np.asarray(texts.is_valid())
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        to = min(to, at + BLOCK_TEXTS, n)
        yield Block(at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], valid[at:to])
        at = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case, all others as they are."""
    return _LOWER[data]


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and document of each run of true flags that stays within a document."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = starts[(starts > 0) & (starts < n)]
    before[edges] = False
    after[edges - 1] = False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def space_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of each document."""
    return spans(~((data == 32) | ((data >= 9) & (data <= 13))), starts)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.full(1 << max(n, 1 << 16).bit_length(), base, np.uint64)
        table[0] = 1
        table = _powers[name] = np.multiply.accumulate(table, out=table)
    return table[:n]


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, from one running polynomial sum."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    sums = total[1:]  # one array of 64-bit numbers beside the powers, for a block is most of a worker's memory
    np.add(data, np.uint64(1), out=sums, dtype=np.uint64)
    sums *= _power_table("up", _BASE, n)
    np.cumsum(sums, out=sums)
    value = (total[end] - total[begin]) * _power_table("down", _BASE_INVERSE, n + 1)[begin]
    return mix(mix(value) + (end - begin).astype(np.uint64))


def shingles(words: np.ndarray, docs: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words as (hash, document) sorted by document and hash.

    A document with fewer words, but not none, has its whole sequence as its only shingle.
    """
    counts = np.bincount(docs, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(counts)))
    take = np.maximum(counts - size + 1, 0)
    long_docs = np.repeat(np.arange(n_docs), take)
    at = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + first[long_docs]
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value = mix(value * _BASE + words[at + k]) if k else words[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    more = np.zeros(len(short), np.uint64)
    for i, d in enumerate(short):
        x = np.uint64(counts[d])
        for w in words[first[d] : first[d + 1]]:
            x = mix(np.array([x]) * _BASE + w)[0]
        more[i] = x
    value = np.concatenate((value, more))
    owner = np.concatenate((long_docs, short))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[keep], owner[keep]


def gather_places(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + length[i] - 1, one span after the other."""
    stop = np.cumsum(length)
    return np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - length - begin, length)


def gather(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The items of those spans."""
    return data[gather_places(begin, length)]


def text_crc32(value: int | str) -> int:
    """CRC-32 of a value written as text, the split rule of all learned operators."""
    return zlib.crc32(str(value).encode())

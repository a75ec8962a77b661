"""Byte-level BPE ids of whole texts with the vocabulary of a tokenizers file.

The pre-tokenizer never joins what stands on the two sides of a lone space or line feed
between two characters that are not white space (a space goes to the word behind it), so a
text is cut there and every distinct chunk of a block is encoded only once.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from fraudspark.llm.text import Block, gather, gather_places, hash_spans

# The word pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def exact(path: str):
    """Exact encoder for texts with special tokens; large, so only tasks that meet such a text load it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def load(path: str):
    """Encoder, special tokens, and the byte length of each id."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = [t["content"].encode() for t in described["added_tokens"]]
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    letters = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in described["model"]["vocab"].items()
        if token.encode() not in special
    }
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, special, sizes


def _cuts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a chunk begins: each document, each lone space, each lone line feed and what follows it;
    and which bytes are surely not white space."""
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 31))
    # characters that may be wide white space: lead bytes C2, E1, E2, E3 and all bytes behind them
    odd = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
    wide = odd.copy()
    wide[1:] |= odd[:-1]
    wide[2:] |= odd[:-2]
    solid = ~(space | wide)
    lone = np.zeros(n, bool)
    if n > 2:
        lone[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & solid[:-2] & solid[2:]
    edges = starts[(starts > 0) & (starts < n)]
    lone[edges] = False
    lone[edges - 1] = False
    cut = lone.copy()
    cut[1:] |= lone[:-1] & (data[:-1] == 10)
    cut[starts[:-1][starts[:-1] < n]] = True
    return np.flatnonzero(cut), solid


def encode_block(block: Block, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents in a row, and where each document's ids start (n + 1 numbers)."""
    fast, special, sizes = load(path)
    data, n = block.data, len(block.data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(block) + 1, np.int64)
    begin, solid = _cuts(data, block.starts)
    end = np.append(begin[1:], n)
    _, first, chunk = np.unique(hash_spans(data, begin, end), return_index=True, return_inverse=True)
    length = end[first] - begin[first]
    # distinct chunks one after the other: each is "space + solid ..." up to a solid byte, or gets a
    # line feed, a token of its own between solid bytes, in front; the rest is encoded alone
    head, tail = begin[first], end[first] - 1
    led = (data[head] == 32) & (length > 1)
    plain = solid[tail] & solid[np.minimum(head + led, n - 1)]
    pieces: list[np.ndarray] = []
    counts = np.zeros(len(first), np.int64)
    marked = np.zeros(len(first), bool)
    if any(mark in data.tobytes() for mark in special):
        for i in range(len(first)):
            text = data[begin[first[i]] : end[first[i]]].tobytes()
            marked[i] = any(mark in text for mark in special)
    easy = np.flatnonzero(plain & ~marked)
    if len(easy):
        bare = ~led[easy]
        filled = length[easy] + bare
        joined = np.full(filled.sum(), 10, np.uint8)
        joined[gather_places(np.cumsum(filled) - length[easy], length[easy])] = gather(data, head[easy], length[easy])
        got = np.array(fast.encode_ordinary(joined.tobytes().decode()), np.int64)
        last = np.searchsorted(np.cumsum(sizes[got]), np.cumsum(filled)) + 1
        before = np.concatenate(([0], last[:-1]))
        counts[easy] = last - before - bare
        kept = np.ones(len(got), bool)
        kept[before[bare]] = False
        pieces.append(got[kept])
    rest = np.flatnonzero(~plain | marked)
    for i in rest:
        text = data[begin[first[i]] : end[first[i]]].tobytes().decode()
        ids = exact(path).encode(text, add_special_tokens=False).ids if marked[i] else fast.encode_ordinary(text)
        counts[i] = len(ids)
        pieces.append(np.array(ids, np.int64))
    table = np.concatenate(pieces)
    order = np.concatenate((easy, rest))
    place = np.empty(len(first), np.int64)
    place[order] = np.cumsum(counts[order]) - counts[order]
    ids = gather(table, place[chunk], counts[chunk])
    reach = np.concatenate(([0], np.cumsum(counts[chunk])))
    return ids, reach[np.searchsorted(begin, block.starts)]

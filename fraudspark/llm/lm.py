"""LM scoring: a word trigram model of all n-grams, dealt by context into Elias-Fano levels.

Counts are exact over all training documents and nothing is cut: every word, bigram and trigram that
was seen is in the model, which therefore grows with the corpus. No process holds it whole. The n-grams
of each document (START START w1 ... wn END, so each token ends one trigram) are summed per document
and sent once, packed, to the bucket of their middle word's hash; buckets hold about ``BUCKET_TOKENS``
tokens. So a bucket also has all bigrams that begin with its words. Trigrams of a word with more than
``HOT_TOKENS`` tokens are dealt to several buckets by their context, and the counts of its bigrams, which
then are spread, are made before and sent along. A bucket's task sums the training counts of its contexts,
builds the level set of its trigrams and looks up its own queries in it, which wait in an unlinked file
meanwhile. What it does not hold (trigrams of held-out texts) takes the back-off weight of the context
and the bigram; only if that was not seen either, the back-off weight of its first word and the last word
alone are joined, as far as rare words take part.

Levels: for each context its successors. Pointers and the successors' numbers (made monotone by adding
the last number of the context before) are Elias-Fano sequences: low bits packed, high bits in unary.
Log probabilities of trigrams are quantised to 8 bits a bucket. Probabilities are discounted relative
frequencies; back-off weights give each context a total of 1; words never seen in training are <unk>.
``Trie`` is the same model in one process with 8 bits for every level.

Logs are summed in billionths, so no order of rows changes a score. Texts are named by a 64-bit hash in
between; equal texts get equal scores.

The base score needs the exact count of every token: words with a share of at least ``word_share`` (at
most 1 / word_share of them) are broadcast with their counts, all other tokens are joined by shuffle.

Defined results: a null or empty text is the end token alone; repeated rows count and are scored each;
with nothing to learn from, all counts are 0; other columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.text import Block, blocks, hash_spans, lower_ascii, mix, space_words
from fraudspark.llm.toxicity import held_out
from fraudspark.session import materialize

WORD_SHARE = 1e-6
BUCKET_TOKENS = 1 << 20
HOT_TOKENS = 1 << 22  # training tokens behind one word that may meet in one task
MERGE_ROWS = 1 << 21
QUERY_ROWS = 1 << 18  # trigrams of a bucket that are looked up at once
SORT_ROWS = 1 << 14
UNIT = 1e9
DISCOUNT = 0.75
HELD_OUT = (7, 2)
ID_BITS = 20
UNK, END, START, FIRST_WORD = 0, 1, 2, 3


# --- Elias-Fano sequences -------------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of n numbers below a bound: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        self.zeros = np.arange(len(high) + 1) * 64 - self.ones

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
        rest = values & np.uint64((1 << low_bits) - 1)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(low, word, rest << shift)
        over = (shift > 0) & (shift + np.uint64(low_bits) > 64)
        np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((n + (top >> low_bits)) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        return EliasFano(n, low_bits, low, high)

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        got = self.low[word] >> shift
        more = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (got | more) & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit (from 0)."""
        word = np.searchsorted(before, k, "right") - 1
        word = np.minimum(word, len(words) - 1)
        bits, rest = words[word].copy(), (k - before[word]).astype(np.int64)
        place = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            inside = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = rest >= inside
            rest -= inside * skip
            place += width * skip
            bits >>= skip.astype(np.uint64) * np.uint64(width)
        return place

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(self.high, self.ones, i) - i).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | self._low_of(i)).astype(np.int64)

    def find(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Index of each value within [first, last), or -1: the values with the same high bits are halved."""
        out = np.full(len(value), -1, np.int64)
        live = np.flatnonzero((value >= 0) & (first < last))
        if not len(live) or not self.n:
            return out
        high = value[live] >> self.low_bits
        reachable = high < self.zeros[-1] - 1
        live, high = live[reachable], high[reachable]
        none = ~self.high
        begin = np.where(high > 0, self._select(none, self.zeros, np.maximum(high - 1, 0)) - high + 1, 0)
        end = self._select(none, self.zeros, high) - high
        at = np.maximum(begin, first[live])
        end = np.minimum(end, last[live])
        wanted = (value[live] & ((1 << self.low_bits) - 1)).astype(np.uint64)
        while True:
            # the first steps go through all, the last ones through those in long runs only
            inside = at < end
            live, at, end, wanted = live[inside], at[inside], end[inside], wanted[inside]
            if not len(live):
                return out
            middle = (at + end) >> 1
            low = self._low_of(middle)
            out[live[low == wanted]] = middle[low == wanted]
            going = low != wanted
            live, at, end, wanted, middle, less = live[going], at[going], end[going], wanted[going], middle[going], (low < wanted)[going]
            at, end = np.where(less, middle + 1, at), np.where(less, end, middle)


# --- the model ------------------------------------------------------------------------------------


def _quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes of an even grid, and the book with the mean of the values of each code."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(256)
    low, high = values.min(), values.max()
    codes = np.clip((values - low) / max(high - low, 1e-12) * 255 + 0.5, 0, 255).astype(np.int64)
    book = np.bincount(codes, values, 256) / np.maximum(np.bincount(codes, minlength=256), 1)
    return codes.astype(np.uint8), book


class Level:
    """Successors of all contexts of one length."""

    def __init__(self, pointers: EliasFano, numbers: EliasFano, prob: np.ndarray, prob_book: np.ndarray, back: np.ndarray, back_book: np.ndarray):
        self.pointers, self.numbers = pointers, numbers
        self.prob, self.prob_book, self.back, self.back_book = prob, prob_book, back, back_book

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end of the successors of each context (-1: none) and the number added to them."""
        known = context >= 0
        safe = np.where(known, context, 0)
        first = self.pointers.access(safe)
        last = np.where(known, self.pointers.access(safe + 1), first)
        base = np.zeros(len(context), np.int64)
        later = first > 0
        if later.any():
            base[later] = self.numbers.access(first[later] - 1)
        return first, last, base

    def find(self, context: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Place of the successor with this number (from 1) below each context, or -1."""
        if not self.numbers.n or not len(context):
            return np.full(len(context), -1, np.int64)
        distinct, of = np.unique(context, return_inverse=True)
        first, last, base = (x[of] for x in self.ranges(distinct))
        return self.numbers.find(np.where(number > 0, base + number, -1), first, last)


def _level(context: np.ndarray, number: np.ndarray, n_contexts: int, logs: np.ndarray, back: np.ndarray) -> Level:
    """context and number (from 1) sorted; number is monotone within a context."""
    counts = np.bincount(context, minlength=n_contexts)
    pointers = np.concatenate(([0], np.cumsum(counts)))
    last = np.zeros(n_contexts, np.int64)
    full = counts > 0
    last[full] = number[pointers[1:][full] - 1]
    base = np.cumsum(last) - last
    return Level(EliasFano.encode(pointers), EliasFano.encode(number + base[context]), *_quantise(logs), *_quantise(back))


class Trie:
    """Words, bigrams and trigrams with quantised log10 probabilities and back-off weights."""

    def __init__(self, words: np.ndarray, one: tuple, two: Level, three: Level, log_share: float):
        self.words, self.one, self.two, self.three, self.log_share = words, one, two, three, log_share

    @staticmethod
    def build(words, word_counts, unk, ends, bigrams, bigram_counts, trigrams, trigram_counts, other_words: int) -> Trie:
        """words sorted by hash; bigrams and trigrams sorted as packed ids."""
        count = np.concatenate(([unk, ends, 0], word_counts)).astype(float)
        smooth = count + 0.5
        smooth[UNK] += (word_counts == 1).sum()  # as many new words are to come as came once
        p1 = smooth / (smooth.sum() - smooth[START])
        a, b = bigrams >> ID_BITS, bigrams & ((1 << ID_BITS) - 1)
        context = count.copy()
        context[START] = ends
        context[END] = 0
        p2 = (bigram_counts - DISCOUNT) / np.maximum(context[a], 1)
        n = len(count)
        left = np.maximum(1 - np.bincount(a, p2, n), 1e-9)
        rest = np.maximum(1 - np.bincount(a, p1[b], n), 1e-9)
        back1 = np.minimum(left / rest, 1e3)
        pair, c = trigrams >> ID_BITS, trigrams & ((1 << ID_BITS) - 1)
        at_ab = np.searchsorted(bigrams, pair)
        bc = ((pair & ((1 << ID_BITS) - 1)) << ID_BITS) | c
        at_bc = np.searchsorted(bigrams, bc)
        m = len(bigrams)
        p3 = (trigram_counts - DISCOUNT) / bigram_counts[at_ab] if len(trigrams) else np.zeros(0)
        left = np.maximum(1 - np.bincount(at_ab, p3, m), 1e-9)
        rest = np.maximum(1 - np.bincount(at_ab, p2[at_bc] if len(trigrams) else None, m), 1e-9)
        back2 = np.minimum(left / rest, 1e3)
        first_of = np.concatenate(([0], np.cumsum(np.bincount(a, minlength=n))))
        rank = at_bc - first_of[bc >> ID_BITS] + 1
        one = (*_quantise(np.log10(p1)), *_quantise(np.log10(back1)))
        two = _level(a, b + 1, n, np.log10(p2), np.log10(back2))
        three = _level(at_ab, rank, max(m, 1), np.log10(p3), np.zeros(len(p3)))
        return Trie(words, one, two, three, -float(np.log10(other_words + 1)))

    # one file: each array as its type, length and bytes

    def _arrays(self) -> list[np.ndarray]:
        found = [self.words, *self.one]
        for level in (self.two, self.three):
            for e in (level.pointers, level.numbers):
                found += [np.array([e.n, e.low_bits], np.int64), e.low, e.high]
            found += [level.prob, level.prob_book, level.back, level.back_book]
        return [*found, np.array([self.log_share])]

    def dump(self) -> bytes:
        parts = []
        for x in self._arrays():
            kind = {"u1": 0, "u8": 1, "i8": 2, "f8": 3}[x.dtype.str[1:]]
            body = x.tobytes()
            parts += [np.array([kind, len(x)], np.int64).tobytes(), body, b"\0" * (-len(body) % 8)]
        return b"".join(parts)

    @staticmethod
    def load(blob: bytes) -> Trie:
        """Map the levels from a file of the task's own that has no name any more."""
        handle, path = tempfile.mkstemp(suffix=".trie")
        try:
            with os.fdopen(handle, "wb") as file:
                file.write(blob)
            mapped = np.memmap(path, np.uint8, "r")
        finally:
            os.unlink(path)
        arrays, at = [], 0
        while at < len(mapped):
            kind, n = np.frombuffer(mapped[at : at + 16], np.int64)
            dtype = np.dtype(("u1", "u8", "i8", "f8")[kind])
            size = int(n) * dtype.itemsize
            arrays.append(np.frombuffer(mapped[at + 16 : at + 16 + size], dtype))
            at += 16 + size + -size % 8
        it = iter(arrays)
        words, one = next(it), tuple(next(it) for _ in range(4))
        levels = []
        for _ in range(2):
            coded = []
            for _ in range(2):
                n, low_bits = next(it).tolist()
                coded.append(EliasFano(n, low_bits, next(it), next(it)))
            levels.append(Level(*coded, *(next(it) for _ in range(4))))
        return Trie(words, one, levels[0], levels[1], float(next(it)[0]))

    def log_probs(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log10 probability of each token; ids holds START ... END sequences; that of START is 0."""
        code1, book1, back_code1, back_book1 = self.one
        last = np.full(len(ids), START)
        last[1:] = ids[:-1]
        place = np.full(len(ids), -1, np.int64)  # of the bigram that ends here
        inner = ids != START
        key = (last[inner] << ID_BITS) | ids[inner]
        distinct, of = np.unique(key, return_inverse=True)
        place[inner] = self.two.find(distinct >> ID_BITS, (distinct & ((1 << ID_BITS) - 1)) + 1)[of]
        before = np.full(len(ids), -1, np.int64)  # of the bigram that is the context
        before[1:] = place[:-1]
        first_of = self.two.pointers.access(np.minimum(last, self.two.pointers.n - 2))
        rank = np.where(place >= 0, place - first_of + 1, 0)
        third = np.full(len(ids), -1, np.int64)
        ask = np.flatnonzero(inner & (before >= 0) & (rank > 0))
        third[ask] = self.three.find(before[ask], rank[ask])
        out = np.where(
            place >= 0,
            self.two.prob_book[self.two.prob[np.maximum(place, 0)]] if self.two.numbers.n else 0.0,
            back_book1[back_code1[last]] + book1[code1[ids]],
        )
        if self.two.numbers.n:
            out = out + np.where(before >= 0, self.two.back_book[self.two.back[np.maximum(before, 0)]], 0.0)
        if self.three.numbers.n:
            out = np.where(third >= 0, self.three.prob_book[self.three.prob[np.maximum(third, 0)]], out)
        out = out + np.where(ids == UNK, self.log_share, 0.0)
        return np.where(inner, out, 0.0)


# --- passes over the documents ----------------------------------------------------------------------


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (as a signed number) and its document."""
    data = lower_ascii(block.data)
    begin, end, doc = space_words(data, block.starts)
    return hash_spans(data, begin, end).view(np.int64), doc


def _ids(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.full(len(hashes), UNK)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at + FIRST_WORD, UNK)


def _sequences(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """START, the words and END of each document in a row, and where each begins."""
    counts = np.bincount(doc, minlength=n_docs)
    begins = np.cumsum(counts + 2) - counts - 2
    out = np.empty(len(ids) + 2 * n_docs, np.int64)
    out[begins] = START
    out[begins + counts + 1] = END
    out[np.arange(len(ids)) + 2 * doc + 1] = ids
    return out, begins


def _count(rows: DataFrame, keys_of) -> DataFrame:
    """Sum the counts of the keys that ``keys_of(block)`` finds; a batch sends each key once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [keys_of(block) for block in blocks(batch.column(0))]
            if found:
                key, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _fetch(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts sorted by key; callers bound the rows by a share of all tokens."""
    table = df.toArrow()
    key, n = (table.column(i).to_numpy().astype(np.int64) for i in range(2))
    order = np.argsort(key)
    return key[order], n[order]


def _distinct_rows(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the rows (first column first), and the places in it where a new row begins."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for x in columns:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    return order, np.flatnonzero(new)


def _joined(*columns: np.ndarray) -> list[np.ndarray]:
    """The same order of rows in fewer columns: numbers from 0 that fit into 63 bits together become one."""
    out, free = [], 0
    for x in columns:
        bits = int(x.max()).bit_length() if len(x) else 0
        if out and bits <= free:
            out[-1] = (out[-1] << bits) | x
            free -= bits
        else:
            out.append(x)
            free = 63 - bits
    return out


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = mix(a.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
    return mix(mixed).view(np.int64)


class Vocabulary:
    """Frequent words, START and END, sorted by hash, with their counts; all other words are joined."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, ends: int, mass: float):
        keys = np.concatenate((words, [END, START])).astype(np.int64)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], np.concatenate((counts, [ends, ends])).astype(np.int64)[order]
        self.p1 = (self.counts + 0.5) / mass
        self.parts = 1 + self.counts // HOT_TOKENS  # tasks that share the trigrams with this middle word

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return _place(self.keys, hashes)

    def of(self, facts: np.ndarray, hashes: np.ndarray, other: float) -> np.ndarray:
        at = self.place(hashes)
        return np.where(at >= 0, facts[at], other)


def _place(sorted_keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each number stands, or -1."""
    if not len(sorted_keys):
        return np.full(len(asked), -1, np.int64)
    if len(asked) > SORT_ROWS:
        # in order, so that the search goes through memory once
        order = np.argsort(asked)
        at = np.empty(len(asked), np.int64)
        at[order] = np.searchsorted(sorted_keys, asked[order])
    else:
        at = np.searchsorted(sorted_keys, asked)
    at = np.minimum(at, len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == asked, at, -1)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, all first bytes first: the higher ones compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _compressed(kind: int, head: list[int], hashes: list[np.ndarray], numbers: list[np.ndarray]) -> bytes:
    raw = b"".join([np.array([kind, *head]).tobytes(), *(x.astype(np.int64).tobytes() for x in hashes), *map(_planes, numbers)])
    return np.array([len(raw)]).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _expanded(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int(np.frombuffer(packed, np.int64, 1)[0]), "zstd", asbytes=True)


def _numbers(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64), at + 4 * n


GRAMS, PAIRS = 0, 1


def _packed_grams(block: Block, trains: np.ndarray, n_buckets: int, known: Vocabulary) -> Iterator[tuple[int, bytes]]:
    """(bucket, its trigrams): texts, whether they train, and each text's distinct trigrams with their times."""
    hashes, doc = _words(block)
    n = len(block)
    ids, begins = _sequences(hashes, doc, n)
    owner = np.repeat(np.arange(n), np.diff(np.append(begins, len(ids))))
    ends = np.ones(len(ids), bool)
    ends[begins] = False
    at = np.flatnonzero(ends)
    first = at == begins[owner[at]] + 1
    # words of the block by their rank, which packs into few columns
    distinct, local = np.unique(np.append(ids, START), return_inverse=True)
    where, start = known.place(distinct), local[-1]
    a, b, c, owner = np.where(first, start, local[at - 1 - ~first]), local[at - 1], local[at], owner[at]
    parts = np.where(where >= 0, known.parts[where], 1)[b]
    part = np.zeros(len(b), np.uint64)
    hot = np.flatnonzero(parts > 1)
    part[hot] = _pair_key(distinct[a[hot]], distinct[b[hot]]).view(np.uint64) % parts[hot].astype(np.uint64)
    bucket = _bucket_of(distinct, np.uint64(0), n_buckets)[b]
    bucket[hot] = _bucket_of(distinct[b[hot]], part[hot], n_buckets)
    order, new = _distinct_rows(*_joined(bucket, b, a, owner, c))
    times = np.diff(np.append(new, len(order)))
    order = order[new]
    texts = hash_spans(block.data, block.starts[:-1], block.starts[1:]).view(np.int64)
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for i, j in zip(edges, np.append(edges[1:], len(order)), strict=True):
        rows = order[i:j]
        own, of = np.unique(owner[rows], return_inverse=True)
        words, number = np.unique(np.concatenate((a[rows], b[rows], c[rows])), return_inverse=True)
        # frequent words go by their steps in the vocabulary, the others by hash
        found, words = where[words], distinct[words]
        frequent = found >= 0
        rank = np.empty(len(words), np.int64)
        rank[frequent], rank[~frequent] = np.arange(frequent.sum()), frequent.sum() + np.arange((~frequent).sum())
        steps = np.diff(found[frequent], prepend=0)
        number = rank[number]
        head = [len(own), len(rows), len(steps), len(words) - len(steps)]
        yield int(bucket[rows[0]]), _compressed(GRAMS, head, [texts[own], words[~frequent]], [steps, trains[own], of, times[i:j], *np.split(number, 3)])


def _bucket_of(b: np.ndarray, part: np.ndarray, n_buckets: int) -> np.ndarray:
    """Trigrams are dealt by their middle word, those of a hot one to several buckets by their context."""
    return ((mix(b.view(np.uint64)) % np.uint64(n_buckets) + part) % np.uint64(n_buckets)).astype(np.int64)


def _unpacked(raw: bytes, known: Vocabulary) -> tuple[np.ndarray, ...]:
    """texts, trains, of, times, context, b, c."""
    n_texts, n, n_known, n_rare = np.frombuffer(raw, np.int64, 4, 8).tolist()
    texts, rare = np.split(np.frombuffer(raw, np.int64, n_texts + n_rare, 40), [n_texts])
    at, columns = 40 + 8 * (n_texts + n_rare), []
    for size in (n_known, n_texts, n, n, n, n, n):
        numbers, at = _numbers(raw, at, size)
        columns.append(numbers)
    steps, trains, of, times, a, b, c = columns
    words = np.concatenate((known.keys[np.cumsum(steps)], rare))
    a, b, c = words[a], words[b], words[c]
    return texts, trains, of, times, _pair_key(a, b), b, c


def _fixed(p: np.ndarray) -> np.ndarray:
    """Shares in fixed point, whose sums do not depend on the order."""
    return np.floor(p * 1e15 + 0.5).astype(np.int64)


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, of, values)
    return out


def _back_off(left: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.maximum(left, 1e-9) / np.maximum(1 - seen, 1e-9), 1e3)


class Bucket:
    """The trigrams of some middle words: counts first, then a level set that answers the queries of the same file."""

    def __init__(self, known: Vocabulary):
        self.known, self.file, self.parts, self.pairs, self.waiting = known, tempfile.TemporaryFile(), [], [], 0

    def add(self, packed: bytes) -> None:
        raw = _expanded(packed)
        if np.frombuffer(raw, np.int64, 1)[0] == PAIRS:
            self.pairs.append(np.frombuffer(raw, np.int64, offset=8).reshape(3, -1))
            return
        self.file.write(np.array([len(packed)]).tobytes() + packed)
        _, trains, of, times, context, b, c = _unpacked(raw, self.known)
        own = trains[of] > 0
        self.parts.append((context[own], b[own], c[own], times[own]))
        self.waiting += int(own.sum())
        if self.waiting > MERGE_ROWS:
            self._merge()

    def _merge(self) -> None:
        context, b, c, times = (np.concatenate([x[i] for x in self.parts]) for i in range(4))
        order, new = _distinct_rows(context, c)
        summed = np.add.reduceat(times[order], new) if len(order) else times
        order = order[new]
        # rows that are distinct already wait no more, so merging takes turns with doubled input
        self.parts, self.waiting = [(context[order], b[order], c[order], summed)], -len(order)

    def _bigrams(self, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(b, c, n) sorted: those of hot middle words were counted before, of all others every trigram is here."""
        here = self.known.of(self.known.parts, b, 1) == 1
        b, c, n = (np.concatenate([x[here], *(pair[i] for pair in self.pairs)]) for i, x in enumerate((b, c, n)))
        order, new = _distinct_rows(b, c)
        n = np.add.reduceat(n[order], new) if len(order) else n
        return b[order[new]], c[order[new]], n

    def _queries(self) -> Iterator[tuple[np.ndarray, ...]]:
        """texts, owner, times, context, b, c of the file, parcels of many senders at once, ordered by context."""
        self.file.seek(0)
        taken, rows, n_texts = [], 0, 0
        while True:
            head = self.file.read(8)
            if taken and (not head or rows > QUERY_ROWS):
                columns = [np.concatenate(x) for x in zip(*taken, strict=True)]
                order = np.argsort(columns[3])
                yield columns[0], *(x[order] for x in columns[1:])
                taken, rows, n_texts = [], 0, 0
            if not head:
                return
            raw = _expanded(self.file.read(int(np.frombuffer(head, np.int64)[0])))
            texts, _, owner, *columns = _unpacked(raw, self.known)
            taken.append((texts, owner + n_texts, *columns))
            rows, n_texts = rows + len(owner), n_texts + len(texts)

    def answers(self) -> Iterator[dict[str, np.ndarray]]:
        """Sums of found n-grams per text; what must back off to words, the facts of its first words and their rare successors."""
        self.parts = self.parts or [(np.zeros(0, np.int64),) * 4]
        self._merge()
        context, b, c, n = self.parts[0]
        contexts, of = np.unique(context, return_inverse=True)
        words, number = np.unique(c, return_inverse=True)
        total = np.bincount(of, n, len(contexts))
        level = _level(of, number + 1, max(len(contexts), 1), np.log10((n - DISCOUNT) / total[of]), np.zeros(len(n)))
        left = DISCOUNT * np.bincount(of, minlength=len(contexts)) / np.maximum(total, 1)
        units = np.rint(level.prob_book * UNIT).astype(np.int64)

        # the bigrams as ranges of their first words, and the back-off weights of the contexts
        b2, c2, n2 = self._bigrams(b, c, n)
        firsts, begin, of2 = np.unique(b2, return_index=True, return_inverse=True)
        m = _sums(of2, n2, len(firsts))
        p2 = (n2 - DISCOUNT) / m[of2] if len(n2) else np.zeros(0)
        key2 = _pair_key(b2, c2)
        sorted2 = np.argsort(key2)
        key2 = key2[sorted2]
        bigram = lambda x, y: (lambda at: np.where(at >= 0, sorted2[at], -1) if len(sorted2) else at)(_place(key2, _pair_key(x, y)))
        seen = _sums(of, _fixed(p2[bigram(b, c)]), len(contexts)) / 1e15
        back2 = _back_off(left, seen)
        asked_firsts = np.zeros(len(firsts), bool)

        for texts, owner, times, asked, middle, last in self._queries():
            ctx = _place(contexts, asked)
            at = level.find(ctx, _place(words, last) + 1)
            hit = at >= 0
            sums = _sums(owner[hit], units[level.prob[at[hit]]] * times[hit], len(texts))
            miss = np.flatnonzero(~hit)
            weight = np.where(ctx[miss] >= 0, back2[ctx[miss]], 1.0) if len(contexts) else np.ones(len(miss))
            pair = bigram(middle[miss], last[miss])
            two = pair >= 0
            logs = np.log10(p2[pair[two]]) + np.log10(weight[two])
            sums += _sums(owner[miss[two]], np.rint(logs * UNIT).astype(np.int64) * times[miss[two]], len(texts))
            yield {"kind": np.zeros(len(texts), np.int64), "text": texts, "units": sums}
            miss, weight = miss[~two], weight[~two]
            if len(miss):
                first = _place(firsts, middle[miss])
                asked_firsts[first[first >= 0]] = True
                p1 = self.known.of(self.known.p1, last[miss], -1.0)
                yield {"kind": np.ones(len(miss), np.int64), "text": texts[owner[miss]], "units": times[miss], "b": middle[miss], "c": last[miss], "back2": weight, "p1": p1}
        self.file.close()
        if asked_firsts.any():
            p1 = self.known.of(self.known.p1, c2, -1.0)
            part = _sums(of2, np.where(p1 >= 0, _fixed(np.maximum(p1, 0)), 0), len(firsts))
            k = np.bincount(of2, minlength=len(firsts))
            f = np.flatnonzero(asked_firsts)
            yield {"kind": np.full(len(f), 2), "b": firsts[f], "text": k[f], "c": m[f], "units": part[f]}
            rare = asked_firsts[of2] & (p1 < 0)
            yield {"kind": np.full(int(rare.sum()), 3), "b": b2[rare], "c": c2[rare]}


_ANSWER = {"kind": pa.int64(), "text": pa.int64(), "units": pa.int64(), "b": pa.int64(), "c": pa.int64(), "back2": pa.float64(), "p1": pa.float64()}


def _answer_batches(found: Iterator[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for x in found:
        n = len(x["kind"])
        for i in range(0, n, MERGE_ROWS):
            arrays = [pa.array(x[k][i : i + MERGE_ROWS], t) if k in x else pa.nulls(min(n - i, MERGE_ROWS), t) for k, t in _ANSWER.items()]
            yield pa.RecordBatch.from_arrays(arrays, list(_ANSWER))


def _hot_pairs(training: DataFrame, n_buckets: int, shared_words) -> DataFrame:
    """(bucket, packed): the counts of all bigrams with a hot first word, for each bucket that has trigrams of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_words.value
        for batch in batches:
            for block in blocks(batch.column(0)):
                hashes, doc = _words(block)
                ids, begins = _sequences(hashes, doc, len(block))
                at = np.delete(np.arange(len(ids)), begins)
                at = at[known.of(known.parts, ids[at - 1], 1) > 1]
                b, c = ids[at - 1], ids[at]
                order, new = _distinct_rows(b, c)
                n = np.diff(np.append(new, len(order)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (b[order[new]], c[order[new]], n)], ["b", "c", "n"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_words.value
        for batch in batches:
            b, c, n = (batch.column(i).to_numpy() for i in range(3))
            found = []
            for word in np.unique(b):
                own = b == word
                one, parts = np.array([word]), int(known.of(known.parts, np.array([word]), 1)[0])
                packed = _compressed(PAIRS, [], [b[own], c[own], n[own]], [])
                found += [(x, packed) for x in {int(_bucket_of(one, np.array([k], np.uint64), n_buckets)[0]) for k in range(parts)}]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], ["bucket", "packed"])

    counted = training.mapInArrow(count, "b long, c long, n long").groupBy("b", "c").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(send, "bucket long, packed binary")


def _trigram_answers(docs: DataFrame, training: DataFrame, n_buckets: int, shared_words) -> DataFrame:
    """Answers of all buckets; one shuffle of packed trigrams."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_words.value
        for batch in batches:
            trains = np.asarray(batch.column(1))
            for block in blocks(batch.column(0)):
                found = list(_packed_grams(block, trains[block.first : block.first + len(block)], n_buckets, known))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], ["bucket", "packed"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now:
                    if state is not None:
                        yield from _answer_batches(state.answers())
                    now, state = bucket, Bucket(shared_words.value)
                state.add(packed.as_buffer().to_pybytes())
        if state is not None:
            yield from _answer_batches(state.answers())

    rows = docs.select("text", (~held_out(F.col("doc_id"), *HELD_OUT)).alias("trains"))
    sent = rows.mapInArrow(send, "bucket long, packed binary")
    if (shared_words.value.parts > 1).any():
        sent = sent.unionByName(_hot_pairs(training, n_buckets, shared_words))
    sent = sent.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    schema = "kind long, text long, units long, b long, c long, back2 double, p1 double"
    return materialize(sent.mapInArrow(answer, schema), "trigram_answers")


def _score_units(docs: DataFrame, training: DataFrame, counts: DataFrame, frequent: tuple, ends: int, total: int, distinct: int) -> DataFrame:
    """(text, units): the log probability of each text in billionths, summed over its copies."""
    # words: as many new ones are to come as came once
    once = counts.where("n = 1").count()
    mass = total + 0.5 * (distinct - (ends > 0)) + 0.5 + 0.5 + once
    unseen = (once + 0.5) / mass
    shared_words = docs.sparkSession.sparkContext.broadcast(Vocabulary(*frequent, ends, mass))
    found = _trigram_answers(docs, training, max(1, -(-(total + 1) // BUCKET_TOKENS)), shared_words)

    # back-off weights of first words: the task has summed their frequent successors
    words = counts.select(F.col("key").alias("c"), ((F.col("n") + 0.5) / mass).alias("word"))
    facts = found.where("kind = 2").select("b", F.col("text").alias("k"), F.col("c").alias("m"), F.col("units").alias("part")).distinct()
    rare = found.where("kind = 3").select("b", "c").distinct().join(words, "c").groupBy("b").agg(F.sum(F.round(F.col("word") * 1e15).cast("long")).alias("more"))
    taken = (F.col("part") + F.coalesce("more", F.lit(0))) / 1e15
    back1 = F.least(F.greatest(DISCOUNT * F.col("k") / F.col("m"), F.lit(1e-9)) / F.greatest(1 - taken, F.lit(1e-9)), F.lit(1e3))
    weights = materialize(facts.join(rare, "b", "left").select("b", back1.alias("back1")), "word_weights")

    missing = found.where("kind = 1").select("text", F.col("units").alias("times"), "b", "c", "back2", "p1")
    others = missing.where("p1 < 0").join(words, "c", "left").withColumn("p1", F.coalesce("word", F.lit(unseen)))
    missing = missing.where("p1 >= 0").drop("c").unionByName(others.drop("c", "word"))
    log = F.log10(F.coalesce("back1", F.lit(1.0)) * F.col("p1")) + F.log10("back2")
    backed = missing.join(weights, "b", "left").select("text", (F.round(log * UNIT).cast("long") * F.col("times")).alias("units"))
    return found.where("kind = 0").select("text", "units").unionByName(backed).groupBy("text").agg(F.sum("units").alias("units"))


def lm_score(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    word_share: float = WORD_SHARE,
    gram_share: float | None = None,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``word_share`` says which words' counts are broadcast instead of joined and changes no result;
    ``gram_share`` was the share below which n-grams were cut and is not used any more.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    training = docs.where(~held_out(F.col("doc_id"), *HELD_OUT)).select("text")

    counts = materialize(_count(training, lambda block: _words(block)[0]), "word_counts")
    ends = training.count()
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = seen.n + ends, seen.v + (ends > 0)
    least = max(1, int(np.ceil(word_share * total)))
    words, word_counts = _fetch(counts.where(F.col("n") >= least))  # at most 1 / word_share rows
    shared_words = spark.sparkContext.broadcast((words, word_counts))
    units = _score_units(docs, training, counts, (words, word_counts), ends, total, distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, frequent_counts = shared_words.value
        in_words = np.log10(frequent_counts + 1.0)
        for batch in batches:
            for block in blocks(batch.column(1)):
                hashes, doc = _words(block)
                n, ids = len(block), _ids(hashes, frequent)
                known = ids >= FIRST_WORD
                logs = np.zeros(len(ids))
                logs[known] = in_words[ids[known] - FIRST_WORD]
                order = np.lexsort((hashes[~known], doc[~known]))
                rare, owner = hashes[~known][order], doc[~known][order]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(rare)))
                reach = np.searchsorted(owner[first], np.arange(n + 1)).astype(np.int32)
                columns = {
                    "doc_id": batch.column(0).slice(block.first, n),
                    "n_tokens": pa.array(np.bincount(doc, minlength=n) + 1),
                    "n_in": pa.array(np.bincount(doc[known], minlength=n).astype(np.int64)),
                    "logs": pa.array(np.bincount(doc, logs, n)),
                    "text": pa.array(hash_spans(block.data, block.starts[:-1], block.starts[1:]).view(np.int64)),
                    "rare": pa.ListArray.from_arrays(pa.array(reach), pa.array(rare[first])),
                    "times": pa.ListArray.from_arrays(pa.array(reach), pa.array(times.astype(np.int64))),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, n_in long, logs double, text long, rare array<long>, times array<long>"
    scored = docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialize(scored, "scored_texts")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("key"), "r.times")
    more = (
        rare.join(counts.where(F.col("n") < least), "key")
        .groupBy("row")
        .agg(F.sum("times").alias("n_more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs_more"))
    )
    # each copy of a text has sent the same sum
    scores = scored.groupBy("text").agg(F.count("*").alias("copies")).join(units, "text")
    scores = scores.select("text", (F.col("units") / F.col("copies") / UNIT).alias("score"))
    end_log = float(np.log10(ends + 1.0))
    norm = float(np.log10(total + distinct + 1.0))
    return scored.drop("rare", "times").join(more, "row", "left").join(scores, "text").select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_in") + F.coalesce("n_more", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("logs_more", F.lit(0.0)) + end_log - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )

"""Spelling variants: generated edits probe Bloom filters, what passes meets the exact vocabulary.

Words are counted from all texts (one count a word and block leaves a task, Spark sums them). The
vocabulary is cut by length; each length has a blocked Bloom filter (a word touches one block of 512
bits). Filters are broadcast in rounds of at most ``filter_bytes``; a length beyond that is cut by
hash, so the share of false positives is the same at every size. Each word of a round's reach sends
its deletions and its replacements by a later letter (insertions and the other half are the same pairs
seen from the other word); edits are made as hashes in numpy, and only those that pass become strings
and are joined with the vocabulary, which removes false positives.

Roots are found by doubling: each round a word takes the form of its form. Along forms n at least
doubles, so chains are short and have no cycles.

Defined results: a null text has no words; a null id counts as an empty id text; repeated rows count
as often as they stand there; a word may be of any length; an empty vocabulary gives no rows. The
result has one row a word, other columns of the table are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.text import Block, blocks, gather, hash_spans, lower_ascii, mix, spans
from fraudspark.session import materialize

MIN_CHARS = 5
MIN_COUNT = 3
DELETE_EVERY = 97
FILTER_BYTES = 64 << 20  # broadcast at once
BITS_A_WORD = 16
BLOCK_BITS = 512
PROBES = 6
LAST_LENGTH = 64  # longer words share a filter
EDITS_AT_ONCE = 1 << 21
WORDS_A_TASK = 50_000

_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _x = np.uint32(_i)
    for _ in range(8):
        _x = (_x >> np.uint32(1)) ^ (np.uint32(0xEDB88320) if _x & np.uint32(1) else np.uint32(0))
    _CRC[_i] = _x
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = mix(np.arange(256, dtype=np.uint64) + np.uint64(977))


def crc32_spans(data: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, carried on from the CRC-32 of what stands before it."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    x = state[order] ^ np.uint32(0xFFFFFFFF)
    far = int(np.searchsorted(-size, -256, "left"))  # spans of over 256 bytes, one by one
    for i in range(far):
        x[i] = np.uint32(zlib.crc32(data[begin[i] : begin[i] + size[i]].tobytes(), int(state[order[i]]))) ^ np.uint32(0xFFFFFFFF)
    for j in range(int(size[far]) if far < len(size) else 0):
        to = int(np.searchsorted(-size, -j, "left"))  # those longer than j
        at = slice(far, to)
        x[at] = _CRC[(x[at] ^ data[begin[at] + j]) & np.uint32(0xFF)] ^ (x[at] >> np.uint32(8))
    found = np.empty_like(x)
    found[order] = x ^ np.uint32(0xFFFFFFFF)
    return found


def count_words(block: Block, ids: list, min_chars: int, every: int) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of a block, after the deletions, with their counts."""
    data, starts = lower_ascii(block.data), block.starts
    lead = data == 0xC3  # of U+00C0 to U+00FF
    inside = ((data >= 97) & (data <= 122)) | lead
    inside[1:] |= lead[:-1]
    begin, end, doc = spans(inside, starts)
    leads = np.concatenate(([0], np.cumsum(lead)))
    chars = (end - begin) - (leads[end] - leads[begin])
    keep = chars >= min_chars
    begin, end, doc, chars = begin[keep], end[keep], doc[keep], chars[keep]
    if not len(begin):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    word = hash_spans(data, begin, end)
    _, first, count = np.unique(mix(word + _LETTER[0]) ^ mix(doc.astype(np.uint64)), return_index=True, return_counts=True)
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc32_spans(data, begin[first], end[first] - begin[first], before[doc[first]])
    cut = crc % np.uint32(every) == 0
    changed: dict[str, int] = {}
    for i, h, n in zip(first[cut], crc[cut].tolist(), count[cut].tolist(), strict=True):
        if chars[i] > min_chars:
            run = data[begin[i] : end[i]].tobytes().decode()
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            changed[run] = changed.get(run, 0) + n
    first, count = first[~cut], count[~cut]
    _, one, of = np.unique(word[first], return_index=True, return_inverse=True)
    total = np.bincount(of, weights=count, minlength=len(one)).astype(np.int64)
    at = first[one]
    size = end[at] - begin[at]
    flat = gather(data, begin[at], size)
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes()))
    words = pa.concat_arrays([words, pa.array(list(changed), pa.string())])
    return words, np.concatenate((total, np.fromiter(changed.values(), np.int64, len(changed))))


def vocabulary(docs: DataFrame, id_column: str, text_column: str, min_chars: int, min_count: int, every: int) -> DataFrame:
    """Columns word, n: all words of at least ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                words, n = count_words(block, ids[block.first : block.first + len(block)], min_chars, every)
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_column).cast("string"), F.col(text_column).cast("string"))
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and letters (as Latin-1 codes) of the words of each length."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        codes = np.frombuffer("".join([words[i] for i in rows]).encode("latin-1"), np.uint8)
        yield rows, codes.reshape(len(rows), size)


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_sums(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the letters, 0 first; the last column names the word."""
    sums = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(_LETTER[codes] * powers(codes.shape[1]), axis=1, out=sums[:, 1:])
    return sums


def places(key: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a key and the scrambled bits from which its probes in the block come."""
    key = mix(key)
    return (key >> np.uint64(20)) % np.uint64(n_blocks), mix(key + _STEP)


def probe_bits(bits: np.ndarray, i: int) -> np.ndarray:
    return (bits >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1)


def passes(filters: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Numbers of the keys that may be in the filter; later probes look at what is left only."""
    block, bits = places(key, len(filters) * 64 // BLOCK_BITS)
    base = block * np.uint64(BLOCK_BITS // 64)
    left = np.arange(len(key))
    for i in range(PROBES):
        bit = probe_bits(bits[left], i)
        left = left[(filters[base[left] + (bit >> np.uint64(6))] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    return left


def shard_of(length: int) -> int:
    return min(length, LAST_LENGTH)


def slice_of(key: np.ndarray, slices: int) -> np.ndarray:
    return mix(key ^ _STEP) % np.uint64(slices)


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Deletions and replacements by later letters of words of one length: kind, row, place, letter and key of each."""
    n, size = codes.shape
    per_place = n * (len(alphabet) + 1)
    wide = max(1, EDITS_AT_ONCE // per_place) if per_place else 1
    sums, power = word_sums(codes), powers(size)
    whole = sums[:, -1:]
    for p in range(0, size, wide):
        q = min(size, p + wide)
        if size > 1:
            key = sums[:, p:q] + (whole - sums[:, p + 1 : q + 1]) * _STEP_BACK
            last = np.ones((n, q - p), bool)  # of equal letters in a row only the last is deleted
            inner = min(q, size - 1)
            last[:, : inner - p] = codes[:, p:inner] != codes[:, p + 1 : inner + 1]
            row, at = np.nonzero(last)
            yield "delete", row, at + p, np.zeros(len(row), np.uint8), key[row, at]
        row, at, letter = np.nonzero(alphabet[None, None, :] > codes[:, p:q, None])
        letter = alphabet[letter]
        key = whole[row, 0] + (_LETTER[letter] - _LETTER[codes[row, at + p]]) * power[at + p]
        yield "replace", row, at + p, letter, key


def _rounds(counts: dict[int, int], limit: int) -> list[dict[int, tuple[int, int, int]]]:
    """Filters of each round: length -> (slice, slices, blocks), together at most ``limit`` bytes."""
    out: list[dict[int, tuple[int, int, int]]] = []
    room = 0
    for length, n in sorted(counts.items()):
        slices = max(1, -(-n * BITS_A_WORD // (limit * 8)))
        size = -(-n * BITS_A_WORD // (slices * BLOCK_BITS)) + 1
        for part in range(slices):
            if not out or length in out[-1] or room < size:
                out.append({})
                room = limit * 8 // BLOCK_BITS + 1
            out[-1][length] = (part, slices, size)
            room -= size
    return out


def _filters(vocab: DataFrame, plan: dict[int, tuple[int, int, int]]) -> dict[int, np.ndarray]:
    """The filters of a round; tasks set bits, Spark joins them, at most the round's bytes come to the driver."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in by_length(batch.column(0).to_pylist()):
                shard = shard_of(codes.shape[1])
                if shard not in plan:
                    continue
                part, slices, size = plan[shard]
                key = word_sums(codes)[:, -1]
                block, bits = places(key[slice_of(key, slices) == part], size)
                cell = [block * np.uint64(8) + (probe_bits(bits, i) >> np.uint64(6)) for i in range(PROBES)]
                one = [np.uint64(1) << (probe_bits(bits, i) & np.uint64(63)) for i in range(PROBES)]
                cell, one = np.concatenate(cell).astype(np.int64), np.concatenate(one).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), shard, np.int32)), pa.array(cell), pa.array(one)], ["shard", "cell", "bits"])

    made = vocab.select("word").mapInArrow(fill, "shard int, cell long, bits long")
    found = made.groupBy("shard", "cell").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = {shard: np.zeros(size * BLOCK_BITS // 64, np.uint64) for shard, (_, _, size) in plan.items()}
    for shard, rows in found.groupby("shard"):
        out[shard][rows["cell"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _edited(codes: np.ndarray, kind: str, place: int, letter: int) -> str:
    word = codes.tobytes().decode("latin-1")
    return word[:place] + ("" if kind == "delete" else chr(letter)) + word[place + 1 :]


def near_pairs(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Columns word, n, other, other_n: both directions of all pairs of words one edit apart."""
    spark = vocab.sparkSession
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    alphabet = np.array(sorted(ord(r.c) for r in letters.collect() if r.c), np.uint8)  # at most 90
    size = F.least(F.length("word"), F.lit(LAST_LENGTH))
    counts = {r.size: r["count"] for r in vocab.groupBy(size.alias("size")).count().collect()}
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // WORDS_A_TASK)
    words, found = vocab.repartition(tasks, "word"), None  # a word makes about a thousand edits
    for plan in _rounds(counts, filter_bytes):
        shared = spark.sparkContext.broadcast((plan, _filters(vocab, plan)))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            plan, filters = shared.value
            for batch in batches:
                n = batch.column(1).to_numpy()
                for rows, codes in by_length(batch.column(0).to_pylist()):
                    step = max(1, EDITS_AT_ONCE // (codes.shape[1] * (len(alphabet) + 1)))
                    for at in range(0, len(rows), step):
                        some = codes[at : at + step]
                        for kind, row, place, letter, key in edits(some, alphabet):
                            shard = shard_of(codes.shape[1] - (kind == "delete"))
                            if shard not in plan:
                                continue
                            part, slices, _ = plan[shard]
                            if slices > 1:
                                mine = slice_of(key, slices) == part
                                row, place, letter, key = row[mine], place[mine], letter[mine], key[mine]
                            hit = passes(filters[shard], key)
                            made = [_edited(some[r], kind, p, c) for r, p, c in zip(row[hit], place[hit].tolist(), letter[hit].tolist(), strict=True)]
                            here = rows[at + row[hit]]
                            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(here)), pa.array(n[here]), pa.array(made, pa.string())], ["word", "n", "other"])

        hits = words.mapInArrow(probe, "word string, n long, other string")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return vocab.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    pairs = found.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    there = F.struct("word", "n", "other", "other_n")
    back = F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.select(F.explode(F.array(there, back)).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """Columns word, root of the words that have a form."""
    links = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    links = materialize(links, "variant_forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved"))
        links = materialize(links, "variant_roots")
        if not links.where("moved").head(1):
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    delete_every: int = DELETE_EVERY,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    vocab = materialize(vocabulary(docs, id_column, text_column, min_chars, min_count, delete_every), "vocabulary")
    # of equal n the smallest word: the least of (-n, word)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = near_pairs(vocab, filter_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocab.join(near, "word", "left")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    forms = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    forms = materialize(forms, "variants")
    return forms.join(_roots(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))

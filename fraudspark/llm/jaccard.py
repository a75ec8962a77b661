"""N-gram Jaccard join by prefix trees.

Every text becomes its set of word shingles in one global order: shingles that are not frequent
first, then the frequent ones by rising count. Two sets that link share a shingle among their first
n - ceil(t n) + 1, so these are exchanged. Shared passages are frequent and stand last, where only
texts that hardly have anything else are compared on them.

Texts with equal sets are one set. A bucket (the sets with a shingle in that prefix) never sends all
its pairs: first every set is compared with one pivot, the set of its buckets that has least in
front of the shared shingle. Linked sets then belong to one component, and only sets outside of their
bucket's main component are compared with the sets of other components. Pairs without enough shared
shingles in their prefixes are dropped before whole sets are fetched. Comparisons build a trie over
the ordered sets of a probe, walk it once for all of them, share the overlap of common beginnings,
and drop a subtree when the remaining lengths cannot reach the threshold.

Hashes of shingles and sets have 64 bits. The frequent shingles that are broadcast are at most
``FREQUENT`` (any order gives right results; a shorter list only makes larger buckets); buckets
with more than ``CHUNK`` members are dealt over several tasks.

Defined results: a null, empty or blank text has no shingles and is its own component; fewer words
than ``size`` are one shingle; repeated rows are copies; a null id never names a component; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.bitmap import maybe_in
from fraudspark.llm.components import components
from fraudspark.llm.text import Block, blocks, hash_spans, lower_ascii, mix, shingles, space_words
from fraudspark.session import materialize, small_batches

SIZE = 5
PERCENT = 80
FREQUENT = 1 << 20
SEEN_OFTEN = 4  # times in SEEN_ROWS rows of a task
SEEN_ROWS = 10_000
CHUNK = 50_000
AHEAD = 16


def block_shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their documents."""
    data = lower_ascii(block.data)
    begin, end, doc = space_words(data, block.starts)
    return shingles(hash_spans(data, begin, end), doc, len(block), size)


def frequent_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the shingles that stand in several of ``SEEN_ROWS`` texts."""

    def counts(found: list[np.ndarray]) -> pa.RecordBatch:
        value = np.concatenate(found)
        found.clear()
        value.sort()
        # in sorted order one that stands there often is equal to the one so many places before
        again = value[SEEN_OFTEN - 1 :]
        key = np.unique(again[again == value[: len(again)]])
        n = np.searchsorted(value, key, "right") - np.searchsorted(value, key)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = [], 0
        for batch in batches:
            found += [block_shingles(block, size)[0] for block in blocks(batch.column(0))]
            seen += batch.num_rows
            if seen >= SEEN_ROWS:
                yield counts(found)
                seen = 0
        if seen:
            yield counts(found)

    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    with small_batches(texts.sparkSession):
        table = counted.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    key, n = (table.column(i).to_numpy().astype(np.int64) for i in range(2))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], n[order]


def ordered_sets(block: Block, size: int, often: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all documents in the global order, and where each document's begin."""
    value, owner = block_shingles(block, size)
    count = np.zeros(len(value), np.int64)
    keys, counts = often
    if len(keys) and len(value):
        at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
        count = np.where(keys[at] == value, counts[at], 0)
    order = np.lexsort((value, count, owner))
    return value[order], np.searchsorted(owner, np.arange(len(block) + 1))


def set_ids(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)))))
    return mix((total[starts[1:]] - total[starts[:-1]]) ^ np.diff(starts).astype(np.uint64)).view(np.int64)


def _list(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values.view(np.int64)))


def _gather_first(value: np.ndarray, starts: np.ndarray, take: np.ndarray) -> np.ndarray:
    at = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take - starts[:-1], take)
    return value[at]


def _may_link(n, at, m, bt, percent: int):
    """Whether sizes and the places of the first shared shingle leave enough overlap for a link."""
    rest = np.minimum(n - at, m - bt)
    return (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & (rest * (100 + percent) >= percent * (n + m))


def _buckets(percent: int):
    """Rows (key, chunk, at, set, n) of whole partitions to those that may link with another, with their pivot.

    In the order of sizes every row is tested with its next ``AHEAD`` neighbours; rows of larger buckets
    that found no partner there are kept untested.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = list(batches)
        if not sum(b.num_rows for b in read):
            return
        table = pa.Table.from_batches(read)
        key, chunk, at, own, n = (table.column(c).to_numpy() for c in ("key", "chunk", "at", "set", "n"))
        order = np.lexsort((own, n, chunk, key))
        key, chunk, at, own, n = (x[order].astype(np.int64) for x in (key, chunk, at, own, n))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
        size = np.diff(np.append(np.flatnonzero(new), len(key)))[np.cumsum(new) - 1]
        keep = (size > AHEAD + 1) | (chunk > 0)  # the chunks of one key meet again
        for step in range(1, AHEAD + 1):
            same = (key[step:] == key[:-step]) & (chunk[step:] == chunk[:-step])
            good = same & _may_link(n[step:], at[step:], n[:-step], at[:-step], percent)
            keep[step:] |= good
            keep[:-step] |= good
        key, chunk, at, own, n = (x[keep] for x in (key, chunk, at, own, n))
        order = np.lexsort((own, at, chunk, key))
        key, chunk, at, own, n = (x[order] for x in (key, chunk, at, own, n))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
        pivot = np.flatnonzero(new)[np.cumsum(new) - 1]
        small = lambda x: x.astype(np.int32)
        columns = [key, small(chunk), own, small(n), small(at), own[pivot], small(n[pivot]), small(at[pivot])]
        names = ["key", "chunk", "set", "n", "at", "pivot", "pivot_n", "pivot_at"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of n and m shingles that link: 100 x >= percent (n + m - x)."""
    return -(-(percent * (n + m)) // (100 + percent))


def trie_overlaps(probe: list[np.ndarray], member: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether probe i links with member i; all tries of a batch are walked level by level together.

    Rows of the same probe are neighbours; within a probe equal beginnings of members are one path.
    """
    total = len(probe)
    linked = np.zeros(total, bool)
    if not total:
        return linked
    n = np.array([len(x) for x in probe])
    m = np.array([len(x) for x in member])
    need = _needed(n, m, percent)
    # which rows share a probe, and all (probe, shingle) facts in one sorted array
    number, numbers = {}, np.zeros(total, np.int64)
    for i in range(total):
        numbers[i] = number.setdefault(probe[i].tobytes(), len(number))
    once = np.unique(numbers, return_index=True)[1]
    salt = mix(np.arange(1, len(once) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    facts = np.sort(np.concatenate([mix(probe[i] ^ salt[numbers[i]]) for i in once]))
    begin = np.concatenate(([0], np.cumsum(m)))
    flat = np.concatenate(member)
    # a trie: members sorted by probe and content; a row joins the row before for their common beginning
    rows = np.array(sorted(range(total), key=lambda i: (numbers[i], member[i].tobytes())))
    shared = np.zeros(total, np.int64)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if numbers[a] == numbers[b]:
            k = min(m[a], m[b])
            differ = np.flatnonzero(member[a][:k] != member[b][:k])
            shared[b] = differ[0] if len(differ) else k
    place = np.empty(total, np.int64)
    place[rows] = np.arange(total)
    live = np.flatnonzero(np.minimum(n, m) >= need)
    overlap = np.zeros(total, np.int64)
    before = np.zeros(total, np.int64)
    before[rows[1:]] = rows[:-1]
    depth = 0
    live = live[np.argsort(place[live])]
    while len(live):
        # a row whose beginning is shared takes over its neighbour's node if that is still live
        inside = depth < m[live]
        live = live[inside]
        if not len(live):
            break
        fresh = np.ones(len(live), bool)
        if len(live) > 1:
            fresh[1:] = (before[live[1:]] != live[:-1]) | (shared[live[1:]] <= depth)
        asked = mix(flat[begin[live[fresh]] + depth] ^ salt[numbers[live[fresh]]])
        at = np.minimum(np.searchsorted(facts, asked), len(facts) - 1)
        hit = facts[at] == asked
        overlap[live] += hit[np.cumsum(fresh) - 1]
        depth += 1
        overlap_live = overlap[live]
        done = overlap_live >= need[live]
        linked[live[done]] = True
        going = ~done & (overlap_live + (m[live] - depth) >= need[live])
        live = live[going]
    return linked


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; a is the probe, whose rows come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = []
            for name in ("probe", "member"):
                column = batch.column(batch.schema.get_field_index(name))
                arrays.append([np.frombuffer(x.as_buffer(), np.uint64) for x in column])
            good = trie_overlaps(*arrays, percent)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in range(2)], ["a", "b"])

    of = lambda name, column: sets.select(F.col("set").alias(name), F.col("shingles").alias(column))
    rows = pairs.join(of("b", "member"), "b").join(of("a", "probe"), "a").select("a", "b", "probe", "member")
    return rows.mapInArrow(run, "a long, b long")


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    chunk: int = CHUNK,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id that links reach)."""
    spark = docs.sparkSession
    text = F.col(text_column).cast("string")
    often = frequent_shingles(docs.select(text.alias("text")), size)
    shared = spark.sparkContext.broadcast(often)
    keyed = docs.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64(F.lit(1), text).alias("k1"),
        F.xxhash64(F.lit(2), text).alias("k2"),
        text.alias("text"),
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(3)):
                value, starts = ordered_sets(block, size, shared.value)
                n = np.diff(starts)
                take = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                own = [c.slice(block.first, len(block)) for c in batch.columns[:3]]
                first = _list(_gather_first(value, starts, take), take)
                found = [pa.array(n), pa.array(set_ids(value, starts), mask=n == 0), first]
                yield pa.RecordBatch.from_arrays([*own, *found], ["doc_id", "k1", "k2", "n", "set", "first"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    rows = keyed.mapInArrow(describe, f"doc_id {kind}, k1 long, k2 long, n long, set long, first array<long>")
    with small_batches(spark):
        rows = materialize(rows, "shingle_sets")
    full = rows.where(F.col("n") > 0)

    # the members of shared shingles; very frequent ones in chunks
    long_keys = np.flatnonzero(often[1] > chunk)
    parts = {int(np.int64(often[0][i].view(np.int64))): int(-(-often[1][i] // chunk)) for i in long_keys}
    once = full.select("set", F.col("n").cast("int").alias("n"), "first").dropDuplicates(["set"])
    exploded = once.select("set", "n", F.posexplode("first").alias("at", "key"))
    if parts:
        pieces = F.broadcast(spark.createDataFrame(sorted(parts.items()), "key long, pieces int"))  # rows <= all texts / chunk
        exploded = exploded.join(pieces, "key", "left").withColumn(
            "chunk", F.coalesce(F.pmod(F.xxhash64("set"), F.col("pieces")) + 1, F.lit(0)).cast("int")
        )
    else:
        exploded = exploded.withColumn("chunk", F.lit(0))
    dealt = exploded.select("key", "chunk", "at", "set", "n").repartition("key", "chunk")
    schema = "key long, chunk int, set long, n int, at int, pivot long, pivot_n int, pivot_at int"
    members = materialize(dealt.mapInArrow(_buckets(percent), schema), "buckets")
    if parts:  # chunks of one key get the key's pivot
        tops = members.where(F.col("chunk") > 0).select("key", "chunk", "pivot", "pivot_n", "pivot_at").distinct()
        top = tops.groupBy("key").agg(F.min(F.struct("pivot_at", "pivot", "pivot_n")).alias("top"))
        members = members.join(F.broadcast(top), "key", "left")  # one row per chunked key
        for name in ("pivot", "pivot_n", "pivot_at"):
            members = members.withColumn(name, F.coalesce(F.col("top")[name], F.col(name)))
        members = members.drop("top")

    def may_link(n: Column, at: Column, m: Column, bt: Column) -> Column:
        rest = F.least(n - at, m - bt) * (100 + percent)
        return (F.least(n, m) * 100 >= percent * F.greatest(n, m)) & (rest >= percent * (n + m))

    star = (
        members.where((F.col("pivot") != F.col("set")) & may_link(*map(F.col, ("n", "at", "pivot_n", "pivot_at"))))
        .groupBy("set")
        .agg(F.min(F.struct("pivot_at", "pivot")).alias("p"))
        .select(F.col("p.pivot").alias("a"), F.col("set").alias("b"))
    )
    star = _enough_in_front(materialize(star, "star_pairs"), full, percent, "star_fronts")
    sets = _sets(keyed, full, star, size, shared, "star_sets")
    with small_batches(spark):
        links = materialize(_linked(star, sets, percent), "star_links")
    merged = materialize(components(links), "star_components")

    # sets outside of their bucket's main component against the sets of other components
    named = merged.withColumnRenamed("node", "set")
    of_pivot = merged.select(F.col("node").alias("pivot"), F.col("component").alias("main"))
    members = (
        members.join(named, "set", "left").withColumn("component", F.coalesce("component", "set"))
        .join(of_pivot, "pivot", "left").withColumn("main", F.coalesce("main", "pivot"))
        .select("key", "set", "n", "at", "component", "main")
    )
    members = materialize(members, "named_buckets")
    outside = members.where(F.col("component") != F.col("main"))
    open_keys = outside.select("key").distinct()
    x, y = outside.alias("x"), members.join(open_keys, "key", "left_semi").alias("y")
    crossing = (
        x.join(y, F.col("x.key") == F.col("y.key"))
        .where(
            (F.col("x.component") != F.col("y.component"))
            & may_link(*map(F.col, ("x.n", "x.at", "y.n", "y.at")))
        )
        .select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b"))
        .distinct()
    )
    crossing = _enough_in_front(materialize(crossing, "crossing_pairs"), full, percent, "crossing_fronts")
    sets = _sets(keyed, full, crossing, size, shared, "crossing_sets")
    with small_batches(spark):
        more = materialize(_linked(crossing, sets, percent), "more_links")
    final = components(links.unionByName(more))

    least = (
        rows.where(F.col("n") > 0).groupBy("set").agg(F.min("doc_id").alias("least"))
        .join(final.withColumnRenamed("node", "set"), "set", "left")
        .withColumn("component", F.coalesce("component", "set"))
    )
    least = materialize(least, "least_ids")
    named = least.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = least.join(named, "component").select("set", "component_id")
    return rows.join(of_set, "set", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()


def _enough_in_front(pairs: DataFrame, full: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs that share enough shingles in their prefixes.

    A shared shingle stands in both prefixes or behind the prefix that ends first, so at least the
    needed overlap less the larger rest must be shared in front.
    """
    wanted = materialize(_ends(pairs), f"{name}_ids")
    # a semi-join here would be moved before the bitmap and shuffle every prefix; rows too many do no harm
    fronts = maybe_in(full.select("set", "n", "first"), "set", wanted, "set")
    fronts = materialize(fronts.dropDuplicates(["set"]), f"{name}_sets")
    of = lambda end: fronts.select(F.col("set").alias(end), F.col("n").alias(f"n_{end}"), F.col("first").alias(f"first_{end}"))
    rows = pairs.join(of("b"), "b").join(of("a"), "a")
    total = F.col("n_a") + F.col("n_b")
    needed = F.ceil(F.lit(percent) * total / (100 + percent))
    behind = F.greatest(F.col("n_a") - F.size("first_a"), F.col("n_b") - F.size("first_b"))
    shared = F.size(F.array_intersect("first_a", "first_b"))
    return materialize(rows.where(shared >= needed - behind).select("a", "b"), name)


def _sets(keyed: DataFrame, full: DataFrame, pairs: DataFrame, size: int, often, name: str) -> DataFrame:
    """(set, shingles) of the sets in the pairs: one text of each, found by its key, shuffled once.

    A bitmap of the keys spares most other texts the shuffle.
    """
    wanted = materialize(_ends(pairs), f"{name}_ids")
    keys = full.join(wanted, "set", "left_semi").groupBy("set").agg(F.min(F.struct("k1", "k2")).alias("k"))
    keys = materialize(keys.select("set", "k.*"), f"{name}_keys")
    once = maybe_in(keyed, "k1", keys, "k1").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = once.join(keys, ["k1", "k2"]).select("set", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                value, starts = ordered_sets(block, size, often.value)
                packed = [value[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                own = batch.column(0).slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([own, pa.array(packed, pa.binary())], ["set", "shingles"])

    with small_batches(keyed.sparkSession):
        return materialize(texts.mapInArrow(run, "set long, shingles binary"), name)

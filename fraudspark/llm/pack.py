"""Best-fit packing: a grouping genetic algorithm on islands with elite migration.

Tokenizing is one pass over the texts, in small batches and without a shuffle, and leaves one narrow row per piece.
Pieces that fill a sequence alone are done. All others are dealt by hash into cells of a bounded
number of pieces; every cell is evolved by several islands, each a Spark group of its own. A
chromosome is a list of bins. Crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold a duplicate, and best-fits the displaced pieces. After each
epoch the elite of an island migrates to the next island of its cell. Pieces in poorly filled bins
of all cells meet in new, fewer cells and evolve once more, so the waste of a cell does not add up.

Defined results: a null or empty text is the single id 0; a text longer than ``capacity`` is cut
into full pieces with the rest in the first piece; repeated rows are packed each for itself; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.llm.text import blocks
from fraudspark.llm.tokens import encode_block
from fraudspark.session import materialize, small_batches

CELL_PIECES = 1024  # a cell is one task's work; more pieces make more cells
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
TOKEN_BYTES = 500_000  # of texts encoded together; more save no time
POOR_FILL = 0.95  # bins below this share meet again in the last round

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, path: str, capacity: int, id_column: str, text_column: str, keep_ids: bool) -> DataFrame:
    """Pieces of at most ``capacity`` ids, each document ended by id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for block in blocks(batch.column(1), TOKEN_BYTES):
                ids, starts = encode_block(block, path)
                rows: list[tuple] = []
                parts: list[np.ndarray] = []
                for i in range(len(block)):
                    own = np.append(ids[starts[i] : starts[i + 1]], 0).astype("<u4")
                    first = (len(own) - 1) % capacity + 1  # the first piece may be shorter, all others are full
                    cuts = [0, *range(first, len(own), capacity)]
                    for piece, (at, to) in enumerate(zip(cuts, [*cuts[1:], len(own)], strict=True)):
                        part = own[at:to]
                        rows.append((block.first + i, piece, at, len(part), zlib.crc32(part.tobytes())))
                        if keep_ids:
                            parts.append(part)
                owner, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                columns = [
                    keys.take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    reach = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(reach, np.concatenate(parts).astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(run, schema)


class Bins:
    """One chromosome: bins of piece numbers with their fills."""

    def __init__(self, bins: list[list[int]], fills: list[int], capacity: int):
        self.bins, self.fills, self.capacity = bins, fills, capacity

    def rank(self) -> tuple[int, float]:
        """Fewer bins first, then the more uneven filling, which leaves larger holes."""
        return len(self.bins), -sum(f * f for f in self.fills)

    def best_fit(self, pieces: list[int], sizes: list[int]) -> Bins:
        """Put pieces, largest first, where least room stays."""
        room = sorted((self.capacity - f, b) for b, f in enumerate(self.fills))
        for p in sorted(pieces, key=lambda x: -sizes[x]):
            at = bisect.bisect_left(room, (sizes[p], -1))
            if at < len(room):
                left, b = room.pop(at)
            else:
                left, b = self.capacity, len(self.bins)
                self.bins.append([])
                self.fills.append(0)
            self.bins[b].append(p)
            self.fills[b] += sizes[p]
            bisect.insort(room, (left - sizes[p], b))
        return self


def _without(parent: Bins, drop: set[int]) -> Bins:
    """A copy without the bins of these numbers."""
    keep = [b for b in range(len(parent.bins)) if b not in drop]
    return Bins([list(parent.bins[b]) for b in keep], [parent.fills[b] for b in keep], parent.capacity)


def _cross(one: Bins, other: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """``one`` with some of the best-filled bins of ``other``."""
    order = sorted(range(len(other.bins)), key=lambda b: -other.fills[b])
    good = order[: max(1, len(order) // 2)]
    chosen = rng.sample(good, max(1, len(good) // 3))
    gift = {p for b in chosen for p in other.bins[b]}
    broken = {b for b, bin_ in enumerate(one.bins) if not gift.isdisjoint(bin_)}
    displaced = [p for b in broken for p in one.bins[b] if p not in gift]
    child = _without(one, broken)
    child.bins += [list(other.bins[b]) for b in chosen]
    child.fills += [other.fills[b] for b in chosen]
    return child.best_fit(displaced, sizes)


def _mutate(parent: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Dissolve the worst bins and a few others."""
    order = sorted(range(len(parent.bins)), key=lambda b: parent.fills[b])
    drop = {*order[: 1 + len(order) // 20], *rng.sample(order, min(3, len(order)))}
    loose = [p for b in drop for p in parent.bins[b]]
    rng.shuffle(loose)
    child = _without(parent, drop)
    return child.best_fit(loose, sizes)


def evolve(sizes: list[int], capacity: int, start: list[Bins], generations: int, seed: int) -> Bins:
    """The best chromosome found; ends early at the bound of the total size."""
    rng = random.Random(seed)
    bound = -(-sum(sizes) // capacity)
    people = list(start)
    if not people:
        people.append(Bins([], [], capacity).best_fit(list(range(len(sizes))), sizes))
    best = min(people, key=Bins.rank)
    if len(best.bins) <= bound:
        return best
    while len(people) < POPULATION:
        people.append(_mutate(best, sizes, rng))
    for _ in range(generations):
        one, other = rng.sample(people, 2)
        for child in (_cross(one, other, sizes, rng), _mutate(min(one, other, key=Bins.rank), sizes, rng)):
            worst = max(range(len(people)), key=lambda i: people[i].rank())
            if child.rank() <= people[worst].rank():
                people[worst] = child
        best = min(people, key=Bins.rank)
        if len(best.bins) <= bound:
            break
    return best


def _epoch(capacity: int, generations: int, seed: int, epoch: int):
    """One epoch of one island: rows of its own elite (origin = island) and of immigrants."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["origin", "item"], kind="stable")
        island, cell = int(rows["island"].iloc[0]), int(rows["cell"].iloc[0])
        own = rows[rows["origin"] == rows["origin"].iloc[0]].reset_index(drop=True)
        sizes = own["length"].tolist()
        people = []
        for _, elite in rows.groupby("origin", sort=True):
            if elite["bin"].iloc[0] < 0:
                continue
            bins: dict[int, list[int]] = {}
            for p, b in enumerate(elite["bin"].tolist()):
                bins.setdefault(b, []).append(p)
            fills = [sum(sizes[p] for p in pieces) for pieces in bins.values()]
            people.append(Bins(list(bins.values()), fills, capacity))
        number = zlib.crc32(f"{seed}/{epoch}/{cell}/{island}".encode())
        best = evolve(sizes, capacity, people, generations, number)
        at = np.empty(len(sizes), np.int32)
        fill = np.empty(len(sizes), np.int32)
        for b, pieces in enumerate(best.bins):
            at[pieces] = b
            fill[pieces] = best.fills[b]
        return own.assign(
            bin=at, fill=fill, origin=np.int32(island), n_bins=np.int32(len(best.bins)), square=-float(best.rank()[1])
        )

    return run


def _evolve_cells(items: DataFrame, capacity: int, cell_pieces: int, islands: int, epochs: int, generations: int, seed: int):
    """Assign a bin to every piece of every cell; (cell, bin) names a sequence."""
    cells = max(1, -(-items.count() // cell_pieces))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields]
    schema = ", ".join([*fields, "cell long, island int, origin int, bin int, fill int, n_bins int, square double"])
    state = (
        items.withColumn("cell", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(cells)))
        .withColumn("island", F.explode(F.array([F.lit(i) for i in range(islands)])))
        .withColumn("origin", F.col("island"))
        .withColumns({"bin": F.lit(-1), "fill": F.lit(0), "n_bins": F.lit(0), "square": F.lit(0.0)})
    )
    for epoch in range(epochs):
        state = state.groupBy("cell", "island").applyInPandas(_epoch(capacity, generations, seed, epoch), schema)
        if epoch + 1 < epochs:  # the elite stays and goes to the next island
            next_island = F.pmod(F.col("origin") + 1, F.lit(islands)).cast("int")
            state = state.withColumn("island", F.explode(F.array("origin", next_island)))
    best = state.groupBy("cell").agg(F.min(F.struct("n_bins", -F.col("square"), "island"))["island"].alias("best"))
    chosen = state.join(best, "cell").where(F.col("island") == F.col("best"))
    return chosen.drop("island", "origin", "n_bins", "square", "best")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
    cell_pieces: int = CELL_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    generations: int = GENERATIONS,
    seed: int = 7,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = tokenize(docs, tokenizer_path, capacity, id_column, text_column, keep_ids)
    with small_batches(docs.sparkSession):
        pieces = materialize(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity)
    loose = pieces.where(F.col("length") < capacity).select("item", "length")
    tune = (capacity, cell_pieces, islands, epochs, generations)
    first = materialize(_evolve_cells(loose, *tune, seed), "packed_cells")
    poor = F.col("fill") < POOR_FILL * capacity
    again = _evolve_cells(first.where(poor).select("item", "length"), *tune, seed + 1)
    number = F.shiftleft(F.col("cell"), 20) + F.col("bin")
    placed = (
        full.select("item", (-F.col("item") - 1).alias("sequence_id"))
        .unionByName(first.where(~poor).select("item", (number * 2).alias("sequence_id")))
        .unionByName(again.select("item", (number * 2 + 1).alias("sequence_id")))
    )
    order = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.join(placed, "item")
        .withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0).cast("long")))
        .drop("item")
    )

"""Approximate nearest neighbours by low-dimensional stable projections and a kd-tree.

Largest inner product becomes nearest distance: every vector gets one more coordinate that lifts it
to the length of the longest, queries get 0 there. Vectors are projected by a fixed Gaussian (a
2-stable) matrix to ``dims`` coordinates, in which squared distances are the true ones times a
chi-square variable with ``dims`` degrees of freedom.

The top of the kd-tree is made from a bounded sample of the projections and cuts all vectors into
cells; a cell beyond ``cell_rows`` (also one of equal vectors) is dealt over several blocks by hash.
Each block is a Spark group with a kd-tree of its own in boxes. Every query visits its nearest
cells first; the k-th distance found there goes with the query to the other cells, and only to those
that the stopping test does not exclude. In a block the boxes come by projected distance; their
vectors are verified by exact inner products, until the chi-square test says that a closer vector
would have had, with probability ``sure``, a smaller projected distance than the next box.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; with fewer than k candidates a query gets all of them; equal
scores are ordered by id; repeated ids are vectors of their own, and a query skips all with its id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.session import materialize

DIMS = 8
CELL_ROWS = 4096
BOX_ROWS = 64
SAMPLE_ROWS = 20_000
FIRST_CELLS = 2
SURE = 0.95
QUERY_BLOCK = 512
FIRST_BOXES = 4
RESCORE_ROWS = 1 << 16
ROUNDING = 1e-12


def chi_square_share(x: np.ndarray, dims: int) -> np.ndarray:
    """Share of the chi-square distribution with an even number of degrees of freedom below x."""
    half = np.minimum(np.maximum(x, 0) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_value(share: float, dims: int) -> float:
    """The value below which this share lies."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(np.array([middle]), dims)[0] < share else (low, middle)
    return high


def usable(vector: Column, width: int) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) == width) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


class Cells:
    """The top of the kd-tree: cells as boxes in the projection, cut at medians of a sample."""

    def __init__(self, sample: np.ndarray, rows: int, cell_rows: int):
        dims = sample.shape[1]
        self.cuts: list[tuple[int, float, int, int]] = []  # axis, place, lower child, upper child; axis -1: a cell
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._grow(sample, rows, cell_rows, np.full(dims, -np.inf), np.full(dims, np.inf))
        self.lows, self.highs = np.array(self.low), np.array(self.high)

    def _grow(self, sample, rows, cell_rows, low, high) -> int:
        node = len(self.cuts)
        self.cuts.append((-1, 0.0, len(self.low), 0))
        if rows > cell_rows and len(sample) > 8:
            axis = int(np.argmax(sample.max(axis=0) - sample.min(axis=0)))
            place = float(np.median(sample[:, axis]))
            below = sample[:, axis] < place
            if 0 < below.sum() < len(sample):
                under, over = high.copy(), low.copy()
                under[axis] = over[axis] = place
                share = below.mean()
                a = self._grow(sample[below], rows * share, cell_rows, low, under)
                b = self._grow(sample[~below], rows * (1 - share), cell_rows, over, high)
                self.cuts[node] = (axis, place, a, b)
                return node
        self.low.append(low)
        self.high.append(high)
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        work = [(0, np.arange(len(points)))]
        while work:
            node, who = work.pop()
            axis, place, a, b = self.cuts[node]
            if axis < 0:
                out[who] = a
            elif len(who):
                below = points[who, axis] < place
                work += [(a, who[below]), (b, who[~below])]
        return out

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        out = np.zeros((len(points), len(self.lows)))
        for axis in range(points.shape[1]):
            x = points[:, axis : axis + 1]
            gap = np.maximum(np.maximum(self.lows[:, axis] - x, x - self.highs[:, axis]), 0)
            out += gap * gap
        return out


def _boxes(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of each box of a kd-tree over the points, halved by rank, so ties split too."""
    out, work = [], [np.arange(len(points))]
    while work:
        who = work.pop()
        if len(who) <= size:
            out.append(who)
            continue
        part = points[who]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        order = np.argpartition(part[:, axis], len(who) // 2)
        work += [who[order[: len(who) // 2]], who[order[len(who) // 2 :]]]
    return out


class _Best:
    """The k best so far of each query of a block; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound
        self.row, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.found = np.zeros(queries, np.int64)

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row))
        row = row[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.row, self.id, self.score = row[keep], ids[order][keep], score[order][keep]
        self.found = np.bincount(self.row, minlength=len(self.found))
        full = np.flatnonzero(self.found == self.k)
        last = np.cumsum(self.found)[full] - 1
        self.bound[full] = np.maximum(self.bound[full], self.score[last])


def _search_block(k: int, dims: int, sure: float, longest: float):
    """A cell's block of vectors and its queries to the best k of each query in it.

    Boxes are taken in waves, nearest first and twice as many each time. A wave multiplies each of its
    boxes once with all queries that still ask for it.
    """
    limit = chi_square_value(sure, dims)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object), "scores": pd.Series(dtype=object)})
        p = np.stack(left["p"].to_numpy())
        boxes = _boxes(p, BOX_ROWS)
        order = np.concatenate(boxes)
        x, p, ids = np.stack(left["v"].to_numpy()).astype(float)[order], p[order], left["id"].to_numpy()[order]
        edges = np.concatenate(([0], np.cumsum([len(b) for b in boxes])))
        low, high = np.minimum.reduceat(p, edges[:-1]), np.maximum.reduceat(p, edges[:-1])
        out = []
        for at in range(0, len(right), QUERY_BLOCK):
            part = right.iloc[at : at + QUERY_BLOCK]
            q, qp = np.stack(part["v"].to_numpy()).astype(float), np.stack(part["p"].to_numpy())
            own, given = part["id"].to_numpy(), part["bound"].to_numpy(float)
            best = _Best(len(q), k, given.copy())
            reach = np.zeros((len(q), len(boxes)))
            for axis in range(dims):
                y = qp[:, axis : axis + 1]
                gap = np.maximum(np.maximum(low[:, axis] - y, y - high[:, axis]), 0)
                reach += gap * gap
            near = np.argsort(reach, axis=1)
            norms = (q * q).sum(axis=1)
            step, width = 0, FIRST_BOXES
            while step < len(boxes):
                # the squared distance of the k-th score; a closer vector projects below limit times it
                open_to = np.where(best.bound > -np.inf, np.maximum(norms + longest * longest - 2 * best.bound, 0.0) * limit, np.inf)
                wave = near[:, step : step + width]
                asks, slot = np.nonzero(np.take_along_axis(reach, wave, axis=1) <= open_to[:, None])
                if not len(asks):
                    break
                scores = np.full((len(q), wave.shape[1], BOX_ROWS), -np.inf)
                which = wave[asks, slot]
                by_box = np.argsort(which, kind="stable")
                cuts = np.flatnonzero(np.diff(which[by_box], prepend=-1))
                for i, j in zip(cuts, np.append(cuts[1:], len(by_box)), strict=True):
                    rows, box = by_box[i:j], which[by_box[i]]
                    inside = slice(edges[box], edges[box + 1])
                    found = q[asks[rows]] @ x[inside].T
                    found[own[asks[rows]][:, None] == ids[inside]] = -np.inf
                    scores[asks[rows], slot[rows], : found.shape[1]] = found
                scores = scores.reshape(len(q), -1)
                kth = -np.partition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, min(k, scores.shape[1]) - 1]
                # products of whole boxes may differ in the last bits; what may be among the k is scored anew
                least = np.maximum(kth, best.bound)
                row, place = np.nonzero((scores > -np.inf) & (scores >= (least - ROUNDING * (np.sqrt(norms) * longest))[:, None]))
                who = edges[wave[row, place // BOX_ROWS]] + place % BOX_ROWS
                for begin in range(0, len(row), RESCORE_ROWS):
                    some = slice(begin, begin + RESCORE_ROWS)
                    best.add(row[some], ids[who[some]], (x[who[some]] * q[row[some]]).sum(axis=1))
                step, width = step + width, 2 * width
            # what is below the bound that came with the query cannot be among its k best
            worth = best.score >= given[best.row]
            reach_out = np.cumsum(np.bincount(best.row[worth], minlength=len(q)))[:-1]
            found_ids, found_scores = np.split(best.id[worth], reach_out), np.split(best.score[worth], reach_out)
            out += [r for r in zip(part["query_row"], found_ids, found_scores, strict=True) if len(r[1])]
        return pd.DataFrame(out, columns=["query_row", "ids", "scores"])

    return run


def nearest(
    vectors: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_modulus: int = 20,
    dims: int = DIMS,
    cell_rows: int = CELL_ROWS,
    sure: float = SURE,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 13,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of largest inner product for each row whose id is divisible."""
    raw = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    empty = "query_id long, rank int, vec_id long, score double"
    sizes = raw.where(F.col("v").isNotNull()).groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if sizes is None or sizes.w <= 0:
        return vectors.sparkSession.createDataFrame([], empty)
    width = sizes.w
    raw = raw.where(F.col("id").isNotNull() & usable(F.col("v"), width))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    extent = raw.agg(F.max(square).alias("s"), F.count("*").alias("n")).first()
    if not extent.n:
        return vectors.sparkSession.createDataFrame([], empty)
    longest = math.sqrt(extent.s) * (1 + 1e-12)
    matrix = np.random.default_rng(seed).normal(size=(width + 1, dims))

    def project(v: np.ndarray, query: bool) -> np.ndarray:
        lift = np.zeros(len(v)) if query else np.sqrt(np.maximum(longest**2 - (v * v).sum(axis=1), 0))
        return v @ matrix[:-1] + lift[:, None] * matrix[-1]

    def stacked(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def sample_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = project(stacked(batch), False)
            yield pa.RecordBatch.from_arrays([pa.array(list(points))], ["p"])

    picked = raw.orderBy(F.xxhash64("id", F.lit(seed))).limit(sample_rows) if extent.n > sample_rows else raw
    sample = np.stack(picked.mapInArrow(sample_points, "p array<double>").toPandas()["p"].to_numpy())
    cells = Cells(sample, extent.n, cell_rows)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = project(stacked(batch), False)
            columns = [*batch.columns, pa.array(list(points), pa.list_(pa.float64())), pa.array(cells.of(points))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "p", "cell"])

    placed = raw.mapInArrow(locate, "id long, v array<double>, p array<double>, cell long")
    placed = materialize(placed.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "cells")
    counts = placed.groupBy("cell").count().select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("blocks"))
    counts = F.broadcast(counts)  # a row for each cell of the sampled tree, at most sample_rows / 4
    data = placed.join(counts, "cell").withColumn("block", F.pmod("deal", "blocks").cast("int"))

    limit = chi_square_value(sure, dims)
    asked = placed.where(F.col("id") % query_modulus == 0).select("id", "v")
    asked = materialize(asked.withColumn("query_row", F.monotonically_increasing_id()), "queries")

    def visits(first: bool):
        """Cells to visit: the nearest ones first, then all others that the bound leaves open."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = stacked(batch)
                points = project(q, True)
                away = cells.distances(points)
                near = np.argsort(away, axis=1, kind="stable")
                head = min(FIRST_CELLS, away.shape[1])
                chosen = np.zeros(away.shape, bool)
                np.put_along_axis(chosen, near[:, :head], True, axis=1)
                bound = np.full(len(q), -np.inf)
                if not first:
                    bound = batch.column(3).to_numpy(zero_copy_only=False)
                    bound = np.where(np.isnan(bound), -np.inf, bound)
                    gap = np.maximum((q * q).sum(axis=1) + longest**2 - 2 * bound, 0)
                    chosen = ~chosen & (away <= (gap * limit)[:, None])
                which, cell = np.nonzero(chosen)
                take = pa.array(which)
                columns = [batch.column(i).take(take) for i in range(3)]
                columns += [pa.array(list(points[which]), pa.list_(pa.float64())), pa.array(cell), pa.array(bound[which])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "query_row", "p", "cell", "bound"])

        return run

    schema = "id long, v array<double>, query_row long, p array<double>, cell long, bound double"
    search = _search_block(k, dims, sure, longest)

    def ask(rows: DataFrame, first: bool) -> DataFrame:
        sent = rows.mapInArrow(visits(first), schema).join(counts, "cell")
        sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        both = data.select("id", "v", "p", "cell", "block").groupBy("cell", "block").cogroup(sent.groupBy("cell", "block"))
        return both.applyInPandas(search, "query_row long, ids array<long>, scores array<double>")

    near = materialize(ask(asked, True), "near_cells")
    pairs = lambda df: df.select("query_row", F.explode(F.arrays_zip("scores", "ids")).alias("r"))
    ordered = lambda c: F.transform(c, lambda r: F.struct((-r["scores"]).alias("s"), r["ids"].alias("id")))

    def best(df: DataFrame) -> DataFrame:
        """The k best of each query: at most k from each of its cells' blocks."""
        return df.groupBy("query_row").agg(F.slice(F.array_sort(ordered(F.collect_list("r"))), 1, k).alias("top"))

    so_far = best(pairs(near)).select("query_row", F.when(F.size("top") == k, -F.element_at("top", k)["s"]).alias("bound"))
    rest = asked.join(so_far, "query_row", "left").select("id", "v", "query_row", "bound")
    far = ask(rest, False)
    top = best(pairs(near.unionByName(far)))
    return (
        asked.select("query_row", F.col("id").alias("query_id"))
        .join(top, "query_row")
        .select("query_id", F.posexplode("top").alias("rank", "r"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("r.id").alias("vec_id"), (-F.col("r.s")).alias("score"))
    )

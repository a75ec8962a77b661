"""Exact Kendall tau-b of column pairs.

Columns are few-valued (at most ``FEW`` distinct values) or many-valued, and each kind of pair has its
own plan; none sends a row once per pair:

* two few-valued columns: every task counts its rows into small tables of all such pairs, Spark adds
  the tables up; rows are never shuffled;
* a many-valued column with all few-valued ones: one range partitioning by the many-valued column
  carries the others as packed codes. A partition counts its own discordant pairs; pairs across
  partitions follow from weights per partition and code by window sums. A value that is held by a
  large share of the rows may span partitions; its runs are put together again from their codes;
* two many-valued columns: equal points are merged, then discordant pairs are counted by two range
  partitionings. Blocks cut the points in (x, y) order and buckets cut them in (y, x) order. Two
  points of one block are compared inside that block, two points of one bucket but different blocks
  inside that bucket, all others only through the block-by-bucket table of weights. Its cells are
  weighted points again: a table beyond the bound of a task goes through the same two partitionings.

Both orders break ties by the other column. Points that tie in x never count as discordant wherever
the cut falls, and the same holds for y, so a frequent value is split like any other run of points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudspark.functions.inversions import exact_dot, heavier_before
from fraudspark.functions.parsing import named
from fraudspark.operators.features import model_columns
from fraudspark.session import materialize

# A block, a bucket or a table of cells is compared inside one task and aims at this many points.
POINTS_PER_BLOCK = 1_000_000
FEW = 63  # distinct values: a code of six bits, 0 for none
CODES_IN_LONG = 10

_BIG = "decimal(38,0)"
_HIGH = 1 << 40  # a count too large for 64 bits is carried as high * _HIGH + low
_POINTS_IN_BLOCK = "pair int, block int, bucket int, y double, weight long, passed long"
_CELLS = "pair int, block int, bucket int, weight long, high long, low long"
_TOTALS = "pair int, discordant decimal(38,0)"
_PARTS = ("all", "tied_xy", "tied_x", "tied_y", "discordant")


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles v0, v1, …; NaN is null, booleans are 0 and 1."""
    types = dict(df.dtypes)

    def value(name: str) -> Column:
        number = named(name).cast("int").cast("double") if types[name] == "boolean" else named(name).cast("double")
        return F.when(~F.isnan(number), number)

    return df.select(*[value(c).alias(f"v{i}") for i, c in enumerate(columns)])


def _few_values(rows: DataFrame, few: int) -> dict[int, list[float]]:
    """The sorted values of each column that has at most ``few``; a task sends no more than that a column."""
    names = list(rows.columns)

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {i: np.zeros(0) for i in range(len(names))}
        for batch in batches:
            for i in [i for i, v in seen.items() if len(v) <= few]:
                values = batch[names[i]].to_numpy(np.float64)
                seen[i] = np.unique(np.r_[seen[i], values[~np.isnan(values)]])
        # one value beyond the limit is enough to show that there are too many
        yield pd.DataFrame([(i, v) for i, found in seen.items() for v in found[: few + 1]], columns=["i", "value"])

    found = rows.mapInPandas(distinct, "i int, value double").distinct()
    counts = {r["i"]: r["count"] for r in found.groupBy("i").count().collect()}
    short = [i for i in range(len(names)) if counts.get(i, 0) <= few]
    values: dict[int, list[float]] = {i: [] for i in short}
    for row in found.where(F.col("i").isin(short)).orderBy("i", "value").collect():
        values[row["i"]].append(row["value"])
    return values


def _codes(values: np.ndarray, known: Sequence[float]) -> np.ndarray:
    """1 for the least known value and so on, 0 for none."""
    return np.where(np.isnan(values), 0, np.searchsorted(np.asarray(known, np.float64), values) + 1)


def _count_tables(rows: DataFrame, values: Mapping[int, Sequence[float]], n: int) -> DataFrame:
    """(pair, x, y, weight) of all pairs of few-valued columns, counted where the rows are."""
    pairs = list(combinations(sorted(values), 2))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {p: np.zeros((len(values[p[0]]) + 1) * (len(values[p[1]]) + 1), np.int64) for p in pairs}
        for batch in batches:
            codes = {i: _codes(batch[f"v{i}"].to_numpy(np.float64), values[i]) for i in values}
            for (i, j), table in tables.items():
                table += np.bincount(codes[i] * (len(values[j]) + 1) + codes[j], minlength=len(table))
        for (i, j), table in tables.items():
            seen = np.flatnonzero(table)
            x, y = np.divmod(seen, len(values[j]) + 1)
            keep = (x > 0) & (y > 0)
            yield pd.DataFrame({"pair": np.int32(i * n + j), "x": x[keep].astype(float), "y": y[keep].astype(float), "weight": table[seen[keep]]})

    few = rows.select(*[f"v{i}" for i in values])
    made = few.mapInPandas(count, "pair int, x double, y double, weight long")
    return made.groupBy("pair", "x", "y").agg(F.sum("weight").alias("weight"))


def _table_parts(table: pd.DataFrame) -> pd.DataFrame:
    """The parts of tau of one small table of counts."""
    weight = np.zeros((int(table["x"].max()) + 1, int(table["y"].max()) + 1), dtype=object)
    for x, y, w in zip(table["x"].astype(int), table["y"].astype(int), table["weight"].tolist()):
        weight[x, y] = w
    twice = lambda w: sum(v * (v - 1) for v in w)
    above = weight[:, ::-1].cumsum(axis=1)[:, ::-1].cumsum(axis=0)  # this row and before, this column and after
    discordant = (weight[1:, :-1] * above[:-1, 1:]).sum() if min(weight.shape) > 1 else 0
    found = (twice([weight.sum()]), twice(weight.ravel()), twice(weight.sum(axis=1)), twice(weight.sum(axis=0)), discordant)
    return pd.DataFrame({"pair": table["pair"].iloc[:1]} | {c: [Decimal(int(v))] for c, v in zip(_PARTS, found)})


def _packed(values: Mapping[int, Sequence[float]]) -> list[Column]:
    """All few-valued columns of a row as codes of six bits."""
    code = {i: F.coalesce(F.array_position(F.array(*[F.lit(v) for v in known]), F.col(f"v{i}")), F.lit(0)) for i, known in values.items()}
    order = sorted(values)
    longs = []
    for at in range(0, len(order), CODES_IN_LONG):
        shifted = [F.shiftleft(code[i].cast("long"), 6 * k) for k, i in enumerate(order[at : at + CODES_IN_LONG])]
        packed = shifted[0]
        for one in shifted[1:]:
            packed = packed.bitwiseOR(one)
        longs.append(packed.alias(f"p{at // CODES_IN_LONG}"))
    return longs


def _run_counts(values: Mapping[int, Sequence[float]]) -> Callable:
    """Counts of one range of a many-valued column, sorted by it, with every few-valued column.

    Rows out: kind 0, weight of a code; 1, high and low of discordant, tied_x and tied_xy (code 1, 2, 3)
    inside the range; 2, weight of a code in the first or last run of equal values, which may go on elsewhere.
    """
    order = sorted(values)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if not rows:
            return
        table = pd.concat(rows, ignore_index=True)
        x, weight, part = table["x"].to_numpy(), table["weight"].to_numpy(), int(table["part"].iloc[0])
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        run, runs = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)])), len(starts)
        edge = sorted({0, runs - 1})
        out: list[tuple] = []
        for k, j in enumerate(order):
            code = (table[f"p{k // CODES_IN_LONG}"].to_numpy() >> (6 * (k % CODES_IN_LONG))) & 63
            above, held = np.zeros(runs, np.int64), np.zeros(runs, np.int64)
            discordant = tied_xy = 0
            for c in range(len(values[j]), 0, -1):
                mine = code == c
                if not mine.any():
                    continue
                here = np.zeros(runs, np.int64)
                np.add.at(here, run[mine], weight[mine])
                discordant += exact_dot(here, above)
                above += np.cumsum(here) - here
                held += here
                tied_xy += exact_dot(here[1:-1], here[1:-1] - 1) if runs > 2 else 0
                out.append((j, 0, None, c, int(here.sum()), 0))
                out += [(j, 2, x[starts[e]], c, int(here[e]), 0) for e in edge if here[e]]
            tied_x = exact_dot(held[1:-1], held[1:-1] - 1) if runs > 2 else 0
            out += [(j, 1, None, c, *divmod(v, _HIGH)) for c, v in ((1, discordant), (2, tied_x), (3, tied_xy))]
        found = pd.DataFrame(out, columns=["other", "kind", "x", "code", "weight", "low"])
        yield found.assign(part=part, x=found["x"].astype(float))

    return count


def _many_with_few(rows: DataFrame, i: int, values: Mapping[int, Sequence[float]], n: int, points_per_block: int) -> DataFrame:
    """The parts of tau of a many-valued column with every few-valued one."""
    packed = _packed(values)
    names = [f"p{k}" for k in range(len(packed))]
    merged = rows.where(F.col(f"v{i}").isNotNull()).groupBy(F.col(f"v{i}").alias("x"), *packed).agg(F.count(F.lit(1)).alias("weight"))
    merged = materialize(merged, "runs")
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(spread, -(-merged.count() // points_per_block))
    dealt = merged.repartitionByRange(parts, "x", *names).withColumn("part", F.spark_partition_id()).sortWithinPartitions("x")
    counted = dealt.mapInPandas(_run_counts(values), "other int, kind int, x double, code int, weight long, low long, part int")
    counted = materialize(counted, "run_counts")

    # pairs across parts: weight of lower codes times the weight of higher codes in earlier parts; runs
    # of one value that span parts tie in x, so what they add is taken off again
    cells = counted.where("kind != 1")
    line = Window.partitionBy("other", "kind", "x", "code").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    higher = Window.partitionBy("other", "kind", "x", "part").orderBy(F.desc("code")).rowsBetween(Window.unboundedPreceding, -1)
    # every code of a column needs a cell in every part, so that its earlier weight is known there
    sizes = rows.sparkSession.createDataFrame([(j, len(v)) for j, v in values.items()], "other int, codes int")
    grid = cells.select("other", "kind", "x", "part").distinct().join(F.broadcast(sizes), "other")
    grid = grid.select("other", "kind", "x", "part", F.explode(F.sequence(F.lit(1), F.col("codes"))).alias("code"))
    held = cells.groupBy("other", "kind", "x", "part", "code").agg(F.sum("weight").alias("weight"))
    same = [grid[c].eqNullSafe(held[c]) for c in ("other", "kind", "x", "part", "code")]
    full = grid.join(held, same, "left").select(*[grid[c] for c in grid.columns], F.coalesce(held["weight"], F.lit(0)).alias("weight"))
    before = full.withColumn("before", F.coalesce(F.sum("weight").over(line), F.lit(0)))
    above = before.withColumn("above", F.coalesce(F.sum("before").over(higher), F.lit(0)))
    product = F.col("above").cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")
    signed = F.when(F.col("kind") == 0, product).otherwise(-product)
    across = above.groupBy("other").agg(F.sum(signed).cast(_BIG).alias("discordant"))

    carried = F.col("weight").cast("decimal(20,0)") * F.lit(_HIGH).cast("decimal(18,0)") + F.col("low")
    inside = counted.where("kind = 1").groupBy("other").agg(
        *[F.sum(F.when(F.col("code") == c, carried)).cast(_BIG).alias(name) for c, name in ((1, "discordant"), (2, "tied_x"), (3, "tied_xy"))]
    )
    runs = counted.where("kind = 2").groupBy("other", "x", "code").agg(F.sum("weight").alias("weight"))
    edge_xy = runs.groupBy("other").agg(F.sum(_twice_pairs(F.col("weight"))).cast(_BIG).alias("tied_xy"))
    edge_x = runs.groupBy("other", "x").agg(F.sum("weight").alias("weight")).groupBy("other")
    edge_x = edge_x.agg(F.sum(_twice_pairs(F.col("weight"))).cast(_BIG).alias("tied_x"))
    of_code = counted.where("kind = 0").groupBy("other", "code").agg(F.sum("weight").alias("weight"))
    ties_y = of_code.groupBy("other").agg(
        _twice_pairs(F.sum("weight")).cast(_BIG).alias("all"), F.sum(_twice_pairs(F.col("weight"))).cast(_BIG).alias("tied_y")
    )
    found = None
    for part in (across, inside, edge_xy, edge_x, ties_y):
        part = part.select("other", *[F.col(c) if c in part.columns else F.lit(None).cast(_BIG).alias(c) for c in _PARTS])
        found = part if found is None else found.unionByName(part)
    pair = F.least(F.lit(i), F.col("other")) * n + F.greatest(F.lit(i), F.col("other"))
    # the smaller column number is x of the pair; tau does not change if the two are swapped
    return found.groupBy(pair.cast("int").alias("pair")).agg(*[F.sum(c).cast(_BIG).alias(c) for c in _PARTS])


def _weighted_points(rows: DataFrame, many: Sequence[int], n: int) -> DataFrame:
    """(pair, x, y, weight) for every two many-valued columns, rows with a null in either left out.

    Columns i < j of n make pair i * n + j.
    """
    pairs = [
        F.struct(F.lit(i * n + j).alias("pair"), F.col(f"v{i}").alias("x"), F.col(f"v{j}").alias("y"))
        for i, j in combinations(sorted(many), 2)
    ]
    points = rows.select(F.inline(F.array(*pairs))).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return points.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("weight"))


def _compare_in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One block, sorted by (pair, x, y): per point, the weight it is discordant with."""
    rows = [batch for batch in batches if len(batch)]
    if not rows:
        return
    points = pd.concat(rows, ignore_index=True)
    points["passed"] = heavier_before(
        points["y"].to_numpy(), points["weight"].to_numpy(), points["pair"].to_numpy()
    )
    yield points[["pair", "block", "bucket", "y", "weight", "passed"]]


def _compare_in_bucket(points: pd.DataFrame) -> pd.DataFrame:
    """One bucket: discordance across blocks, summed with the block part into table cells."""
    points = points.iloc[np.lexsort((points["y"], points["block"], points["pair"]))]
    pair, block, weight = (points[c].to_numpy() for c in ("pair", "block", "weight"))
    passed = points["passed"].to_numpy() + heavier_before(points["y"].to_numpy(), weight, pair)
    starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (block[1:] != block[:-1])])
    cells = points.iloc[starts][["pair", "block", "bucket"]].assign(weight=np.add.reduceat(weight, starts))
    ends = np.r_[starts[1:], len(points)]
    parts = [divmod(exact_dot(weight[i:j], passed[i:j]), _HIGH) for i, j in zip(starts, ends)]
    cells["high"], cells["low"] = zip(*parts)
    return cells


def _compare_cells(cells: pd.DataFrame) -> pd.DataFrame:
    """One pair's table: weight of cells in a later block and a lower bucket."""
    cells = cells.iloc[np.lexsort((cells["bucket"], cells["block"]))]
    weight = cells["weight"].to_numpy()
    across = exact_dot(weight, heavier_before(cells["bucket"].to_numpy(), weight))
    return pd.DataFrame({"pair": cells["pair"].iloc[:1], "discordant": [Decimal(across)]})


def _discordant(points: DataFrame, blocks: int, points_per_block: int) -> DataFrame:
    """(pair, discordant): total weight of discordant pairs."""
    in_buckets = points.repartitionByRange(blocks, "pair", "y", "x").withColumn("bucket", F.spark_partition_id())
    in_blocks = in_buckets.repartitionByRange(blocks, "pair", "x", "y").withColumn("block", F.spark_partition_id())
    cells = (
        in_blocks.sortWithinPartitions("pair", "x", "y")
        .mapInPandas(_compare_in_blocks, _POINTS_IN_BLOCK)
        .groupBy("bucket")
        .applyInPandas(_compare_in_bucket, _CELLS)
    )
    cells = materialize(cells, "cells")
    carried = F.col("high").cast("decimal(20,0)") * F.lit(_HIGH).cast("decimal(18,0)") + F.col("low")
    inside = cells.groupBy("pair").agg(F.sum(carried).cast(_BIG).alias("discordant"))
    most, total = cells.groupBy("pair").count().agg(F.max("count"), F.sum("count")).first()
    if (most or 0) <= points_per_block:
        across = cells.repartition(blocks, "pair").groupBy("pair").applyInPandas(_compare_cells, _TOTALS)
    else:
        again = cells.select("pair", F.col("block").cast("double").alias("x"), F.col("bucket").cast("double").alias("y"), "weight")
        across = _discordant(again, _blocks(total, points_per_block), points_per_block)
    return inside.unionByName(across).groupBy("pair").agg(F.sum("discordant").cast(_BIG).alias("discordant"))


def _blocks(points: int, points_per_block: int) -> int:
    """Blocks for so many points; of very many points blocks hold the root, so that the cells stay fewer."""
    return max(1, -(-points // max(points_per_block, int(points**0.5) + 1)))


def _twice_pairs(weight):
    """n * (n - 1), twice the number of pairs among n rows, without overflow."""
    return weight.cast("decimal(19,0)") * (weight - 1).cast("decimal(19,0)")


def _many_with_many(rows: DataFrame, many: Sequence[int], n: int, blocks: int | None, points_per_block: int) -> DataFrame:
    """The parts of tau of every two many-valued columns."""
    points = materialize(_weighted_points(rows, many, n), "points")
    if blocks is None:
        spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = max(spread, _blocks(points.count(), points_per_block))
    totals = points.groupBy("pair").agg(
        F.sum("weight").alias("rows"), F.sum(_twice_pairs(F.col("weight"))).cast(_BIG).alias("tied_xy")
    )
    ties = (
        points.groupingSets([["pair", "x"], ["pair", "y"]], "pair", "x", "y")
        .agg(F.sum("weight").alias("weight"), F.grouping("x").alias("by_y"))
        .groupBy("pair")
        .agg(
            F.sum(F.when(F.col("by_y") == 0, _twice_pairs(F.col("weight")))).cast(_BIG).alias("tied_x"),
            F.sum(F.when(F.col("by_y") == 1, _twice_pairs(F.col("weight")))).cast(_BIG).alias("tied_y"),
        )
    )
    none = F.lit(None).cast(_BIG)
    return (
        totals.select("pair", _twice_pairs(F.col("rows")).cast(_BIG).alias("all"), "tied_xy",
                      none.alias("tied_x"), none.alias("tied_y"), none.alias("discordant"))
        .unionByName(ties, allowMissingColumns=True)
        .unionByName(_discordant(points, blocks, points_per_block), allowMissingColumns=True)
        .groupBy("pair")
        .agg(*[F.max(c).alias(c) for c in _PARTS])
    )


def kendall_matrix(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    blocks: int | None = None,
    full: bool = False,
    few: int = FEW,
    points_per_block: int = POINTS_PER_BLOCK,
) -> DataFrame:
    """(col_a, col_b, tau) for every two numeric columns; ``full`` adds mirrored and diagonal cells.

    tau is null where a column is constant over the rows the pair shares. ``df`` should be a written
    table: it is scanned for the values, the small tables, and once per many-valued column.
    """
    columns = list(columns) if columns is not None else model_columns(df)
    spark, n = df.sparkSession, len(columns)
    rows = _numbers(df, columns)
    values = _few_values(rows, min(few, FEW))  # none at all for a column without any value
    known = {i: v for i, v in values.items() if v}
    many = [i for i in range(n) if i not in values]
    found = spark.createDataFrame([], "pair int, " + ", ".join(f"{c} {_BIG}" for c in _PARTS))
    if len(known) > 1:
        schema = "pair int, " + ", ".join(f"{c} {_BIG}" for c in _PARTS)
        found = found.unionByName(_count_tables(rows, known, n).groupBy("pair").applyInPandas(_table_parts, schema))
    for i in many if known else ():
        found = found.unionByName(_many_with_few(rows, i, known, n, points_per_block))
    if len(many) > 1:
        found = found.unionByName(_many_with_many(rows, many, n, blocks, points_per_block))
    zero = F.lit(0).cast(_BIG)
    parts = found.select("pair", *[F.coalesce(c, zero).alias(c) for c in _PARTS])
    free_x = (F.col("all") - F.col("tied_x")).cast("double")
    free_y = (F.col("all") - F.col("tied_y")).cast("double")
    score = F.col("all") - F.col("tied_x") - F.col("tied_y") + F.col("tied_xy") - 4 * F.col("discordant")
    ratio = score.cast("double") / (F.sqrt(free_x) * F.sqrt(free_y))
    tau = F.when((free_x > 0) & (free_y > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))

    names = spark.createDataFrame(
        [(columns.index(a) * len(columns) + columns.index(b), a, b) for a, b in combinations(columns, 2)],
        "pair int, col_a string, col_b string",
    )
    matrix = names.join(parts.select("pair", tau.alias("tau")), "pair", "left").select("col_a", "col_b", "tau")
    if not full:
        return matrix
    a, b, t = F.col("col_a"), F.col("col_b"), F.col("tau")
    cells = F.array(
        F.struct(a.alias("col_a"), b.alias("col_b"), t.alias("tau")),
        F.struct(b.alias("col_a"), a.alias("col_b"), t.alias("tau")),
    )
    diagonal = spark.createDataFrame([(c, c, 1.0) for c in columns], "col_a string, col_b string, tau double")
    return matrix.select(F.inline(cells)).unionByName(diagonal)


def kendall_tau(df: DataFrame, column_a: str, column_b: str, blocks: int | None = None) -> DataFrame:
    """One row: tau-b of two columns."""
    return kendall_matrix(df, [column_a, column_b], blocks)

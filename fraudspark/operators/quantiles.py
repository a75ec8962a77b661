"""Exact quantiles of numeric columns without a global sort.

Spark's exact ``percentile`` keeps every distinct value of a column in one
buffer. Here each pass is a plain aggregate that narrows, per quantile, an open
interval known to hold the wanted ranks; values leave the executors only when at
most ``collect_rows`` rows are left inside.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from fraudspark.functions.parsing import named


@dataclass
class _Target:
    """Wanted ranks (0-based) of one column, and the interval that still holds some of them."""

    column: str
    probability: float
    position: float
    low: float
    high: float
    margin: float
    found: dict[int, float] = field(default_factory=dict)
    below: int = 0  # rows up to and including the lower end
    inside: int = 0  # rows strictly between the ends

    @property
    def ranks(self) -> list[int]:
        return sorted({math.floor(self.position), math.ceil(self.position)})

    @property
    def missing(self) -> list[int]:
        return [r for r in self.ranks if r not in self.found]

    def value(self) -> float:
        lower, upper = self.found[self.ranks[0]], self.found[self.ranks[-1]]
        return lower + (upper - lower) * (self.position - math.floor(self.position))


def number(column: str) -> Column:
    """The column as a double, NaN as null."""
    value = named(column).cast("double")
    return F.when(~F.isnan(value), value)


def _count_intervals(df: DataFrame, targets: list[_Target]) -> None:
    """One aggregate: rows below, at and between the ends of every interval."""
    counts = []
    for i, t in enumerate(targets):
        v = number(t.column)
        counts += [
            F.count_if(v < t.low).alias(f"lt{i}"),
            F.count_if(v == t.low).alias(f"lo{i}"),
            F.count_if((v > t.low) & (v < t.high)).alias(f"in{i}"),
            F.count_if(v == t.high).alias(f"hi{i}"),
            F.count_if(v > t.high).alias(f"gt{i}"),
        ]
    row = df.agg(*counts).first()
    for i, t in enumerate(targets):
        at_low = row[f"lt{i}"]
        t.below = at_low + row[f"lo{i}"]
        t.inside = row[f"in{i}"]
        above = t.below + t.inside
        for r in t.missing:
            if at_low <= r < t.below:
                t.found[r] = t.low
            elif t.low != t.high and above <= r < above + row[f"hi{i}"]:
                t.found[r] = t.high
        if any(not t.below <= r < above for r in t.missing):
            # the sketch missed by more than its margin: start over with a wider one
            t.low, t.high, t.margin = -math.inf, math.inf, 4 * t.margin
            t.below, t.inside = 0, at_low + row[f"lo{i}"] + row[f"in{i}"] + row[f"hi{i}"] + row[f"gt{i}"]


def _narrow_intervals(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One aggregate of sketches over the open intervals, with the sketch's own error as margin."""
    sketches = []
    for i, t in enumerate(targets):
        v = number(t.column)
        first = (min(t.missing) - t.below) / t.inside - t.margin
        last = (max(t.missing) + 1 - t.below) / t.inside + t.margin
        sketches.append(
            F.percentile_approx(
                F.when((v > t.low) & (v < t.high), v), [max(first, 0.0), min(last, 1.0)], accuracy
            ).alias(f"t{i}")
        )
    row = df.agg(*sketches).first()
    for i, t in enumerate(targets):
        t.low, t.high = row[f"t{i}"]


def _collect_intervals(df: DataFrame, targets: list[_Target]) -> None:
    """Fetch the few values left inside the intervals, grouped, and read the ranks off."""
    cells = []
    for i, t in enumerate(targets):
        v = number(t.column)
        cells.append(F.when((v > t.low) & (v < t.high), F.struct(F.lit(i).alias("target"), v.alias("value"))))
    rows = (
        df.select(F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
        .groupBy("target", "value")
        .count()
        .toPandas()
    )
    for i, group in rows.groupby("target"):
        t = targets[i]
        group = group.sort_values("value")
        upto = t.below + group["count"].cumsum().to_numpy()
        for r in t.missing:
            t.found[r] = float(group["value"].iloc[int((upto <= r).sum())])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = 10_000,
    collect_rows: int = 20_000,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; null for a column with no values."""
    columns = list(columns)
    margin = 2.0 / accuracy
    wanted = sorted({min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)} | {0.0, 1.0})
    aggregates = []
    for i, c in enumerate(columns):
        v = number(c)
        aggregates += [F.count(v).alias(f"n{i}"), F.percentile_approx(v, wanted, accuracy).alias(f"q{i}")]
    row = df.agg(*aggregates).first()

    result: dict[str, list[float | None]] = {}
    targets: dict[tuple[str, float], _Target] = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if n == 0:
            result[c] = [None] * len(probabilities)
            continue
        marks = dict(zip(wanted, row[f"q{i}"]))
        for p in probabilities:
            low, high = (marks[min(max(p + d, 0.0), 1.0)] for d in (-margin, margin))
            if n <= collect_rows:
                low, high = marks[0.0], marks[1.0]
            targets[c, p] = _Target(c, p, (n - 1) * p, low, high, margin)

    open_targets = list(targets.values())
    while open_targets:
        _count_intervals(df, open_targets)
        open_targets = [t for t in open_targets if t.missing]
        small = [t for t in open_targets if t.inside <= collect_rows]
        if small:
            _collect_intervals(df, small)
        open_targets = [t for t in open_targets if t.missing]
        if open_targets:
            _narrow_intervals(df, open_targets, accuracy)
    for c in columns:
        if c not in result:
            result[c] = [targets[c, p].value() for p in probabilities]
    return result

"""Weighted inversion counts of one block of rows."""

from __future__ import annotations

import numpy as np


def dense_ranks(values: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """Ranks from 0, equal values sharing one; with groups, ordered by group first."""
    keys = (values,) if groups is None else (values, groups)
    order = np.lexsort(keys)
    step = np.zeros(len(values), dtype=bool)
    for key in keys:
        key = key[order]
        step[1:] |= key[1:] != key[:-1]
    ranks = np.empty(len(values), dtype=np.int64)
    ranks[order] = np.cumsum(step)
    return ranks


def heavier_before(values: np.ndarray, weights: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """Per row, the weight of earlier rows of its group with a strictly larger value.

    Rows come in ascending order of their group, so a row of an earlier group
    ranks lower and never counts.

    Ranks are compared bit by bit from the top: rows that share the higher bits
    form a group, and inside it a row with bit 0 is passed by the earlier rows
    with bit 1. Each bit is a few whole-array steps.
    """
    n = len(values)
    passed = np.zeros(n, dtype=np.int64)
    if n < 2:
        return passed
    ranks = dense_ranks(values, groups)
    weights = np.asarray(weights, dtype=np.int64)
    order = np.arange(n)
    for bit in range(int(ranks.max()).bit_length() - 1, -1, -1):
        rank = ranks[order]
        ones = ((rank >> bit) & 1).astype(bool)
        group = rank >> (bit + 1)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, n])

        heavy = np.where(ones, weights[order], 0)
        before = np.cumsum(heavy) - heavy
        before -= np.repeat(before[starts], sizes)
        zeros = ~ones
        passed[order[zeros]] += before[zeros]

        # stable split of every group: its zeros first, then its ones
        zeros_before = np.cumsum(zeros) - zeros
        zeros_before -= np.repeat(zeros_before[starts], sizes)
        zeros_in_group = np.repeat(np.add.reduceat(zeros.astype(np.int64), starts), sizes)
        first = np.repeat(starts, sizes)
        offset = np.arange(n) - first
        target = first + np.where(ones, zeros_in_group + offset - zeros_before, zeros_before)
        moved = np.empty_like(order)
        moved[target] = order
        order = moved
    return passed


def exact_dot(left: np.ndarray, right: np.ndarray) -> int:
    """Sum of products as a Python integer, in 64-bit steps when they cannot overflow."""
    if len(left) == 0:
        return 0
    if float(np.abs(left).max()) * float(np.abs(right).max()) * len(left) < 2.0**62:
        return int(np.dot(left.astype(np.int64), right.astype(np.int64)))
    return int(np.dot(left.astype(object), right.astype(object)))

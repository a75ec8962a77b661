"""Isolation trees on arrays: grow one from a sample, walk many rows down all of them.

After Liu, Ting and Zhou, "Isolation Forest" (ICDM 2008). Random choices are digests of seed, tree
and node, and path lengths are summed in whole billionths, so any engine that has MD5 grows the same
trees and adds up the same scores in any order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

EULER_GAMMA = 0.5772156649015329
PATH_UNITS = 1e9  # path lengths are whole multiples of one billionth
DRAW_DIGITS = 13  # hexadecimal digits of a uniform draw: 52 bits

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, left int, right int, size int, depth int"
)


def mean_path(size) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``size`` points."""
    n = np.atleast_1d(np.asarray(size, dtype=np.float64))
    path = np.zeros_like(n)
    path[n == 2] = 1.0
    big = n > 2
    path[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return path


def node_draws(seed: int, tree: int, node: int) -> tuple[float, float]:
    """Two uniform draws from [0, 1) for a node's column and cut."""
    digest = hashlib.md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
    parts = digest[:DRAW_DIGITS], digest[DRAW_DIGITS : 2 * DRAW_DIGITS]
    return int(parts[0], 16) / 16.0**DRAW_DIGITS, int(parts[1], 16) / 16.0**DRAW_DIGITS


def grow_tree(points: np.ndarray, seed: int, tree: int) -> list[tuple]:
    """Nodes (node_id, feature, threshold, left, right, size, depth); a leaf has feature -1.

    A node splits at a uniform cut of a random feature that varies in it. The root is 0, the
    children of node k are 2k+1 and 2k+2.
    """
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[tuple] = []
    waiting = [(0, points, 0)]
    for node, rows, depth in waiting:  # grows while it is walked
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        varying = np.flatnonzero(low < high) if len(rows) > 1 and depth < limit else ()
        if len(varying) == 0:
            nodes.append((node, -1, None, None, None, len(rows), depth))
            continue
        which, where = node_draws(seed, tree, node)
        feature = int(varying[int(which * len(varying))])
        cut = float(low[feature] + (high[feature] - low[feature]) * where)
        if cut <= low[feature]:
            cut = float(high[feature])
        right = rows[:, feature] >= cut
        left_id = 2 * node + 1
        waiting += [(left_id, rows[~right], depth + 1), (left_id + 1, rows[right], depth + 1)]
        nodes.append((node, feature, cut, left_id, left_id + 1, len(rows), depth))
    return nodes


def forest_arrays(nodes, sample_size: int) -> dict:
    """Node arrays of all trees from the node table (a pandas frame), one padded row per tree.

    A plain dict of arrays, which is what Spark's broadcast can carry to any executor.
    """
    trees, row = np.unique(nodes["tree_id"].to_numpy(), return_inverse=True)
    at = (row, nodes["node_id"].to_numpy())
    shape = (len(trees), int(at[1].max()) + 1)
    leaf = nodes["feature"].to_numpy() < 0

    def spread(values, fill, kind):
        array = np.full(shape, fill, dtype=kind)
        array[at] = values
        return array

    # a leaf points to itself under a cut that nothing reaches
    return {
        "feature": spread(np.where(leaf, 0, nodes["feature"]), 0, np.int64),
        "threshold": spread(np.where(leaf, np.inf, nodes["threshold"].astype(float)), np.inf, np.float64),
        "left": spread(np.where(leaf, nodes["node_id"], nodes["left"].astype(float).fillna(0)), 0, np.int64),
        "path": spread(np.where(leaf, np.rint((nodes["depth"] + mean_path(nodes["size"])) * PATH_UNITS), 0), 0, np.int64),
        "depth": int(nodes["depth"].max()),
        "norm": max(float(mean_path(sample_size)[0]), 1e-12),
    }


def forest_scores(forest: dict, rows: np.ndarray, tree_counts: Sequence[int]) -> dict[int, np.ndarray]:
    """Anomaly score in (0, 1) of every row for each count of leading trees, from one walk.

    All rows go down a tree together, one level per step, in arrays that are
    allocated once; clipped takes skip the bounds check, indexes are always valid.
    """
    n = len(rows)
    columns = np.asfortranarray(rows, dtype=np.float64).ravel(order="F")
    row = np.arange(n)
    offsets = forest["feature"] * n
    at, node = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    value, cut, right = np.empty(n), np.empty(n), np.empty(n, dtype=bool)
    path, total = np.empty(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    result = {}
    for t in range(max(tree_counts)):
        offset, threshold, left = offsets[t], forest["threshold"][t], forest["left"][t]
        node.fill(0)
        for _ in range(forest["depth"]):
            offset.take(node, out=at, mode="clip")
            at += row
            columns.take(at, out=value, mode="clip")
            threshold.take(node, out=cut, mode="clip")
            np.greater_equal(value, cut, out=right)
            left.take(node, out=at, mode="clip")
            np.add(at, right, out=node)
        total += forest["path"][t].take(node, out=path, mode="clip")
        if t + 1 in tree_counts:
            result[t + 1] = np.exp2(-total / ((t + 1) * forest["norm"] * PATH_UNITS))
    return result

"""Isolation forest on Spark: pool, trees, scores, threshold, sweep over tree counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudspark.config import PipelineConfig
from fraudspark.functions.parsing import HASH_RANGE, named, row_hash
from fraudspark.functions.trees import NODE_SCHEMA, forest_arrays, forest_scores, grow_tree
from fraudspark.operators.cluster import column_medians, prepare_rows, split_missing
from fraudspark.operators.evaluate import choose_candidate, class_report, confusion_by_candidate
from fraudspark.operators.features import model_columns, one_hot_columns
from fraudspark.operators.quantiles import exact_quantiles
from fraudspark.session import materialize

# Upper bound of what is broadcast, in 8-byte cells: the node arrays.
MAX_NODE_CELLS = 64_000_000


def forest_columns(df: DataFrame, cfg: PipelineConfig) -> list[str]:
    """Numeric columns without id, label and earlier results; one-hot columns only if configured."""
    outside = {cfg.id_column, cfg.label_column, "cluster_labels", "predictions", "df_pred"}
    columns = model_columns(df, outside)
    if cfg.forest_categories:
        return columns
    made = one_hot_columns(df)
    return [c for c in columns if c not in made]


def scaling(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]]:
    """Mean and sample standard deviation of each column, from one aggregate."""
    stats = df.agg(
        *[F.avg(named(c)).alias(f"mean{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(named(c)).alias(f"std{i}") for i, c in enumerate(columns)],
    ).first()
    return [(stats[f"mean{i}"], stats[f"std{i}"]) for i in range(len(columns))]


def scaled(df: DataFrame, columns: Sequence[str], stats: Sequence[tuple[float, float]] | None = None) -> DataFrame:
    """Each column to mean 0 and sample standard deviation 1, constants to 0; by ``stats`` if given."""
    stats = scaling(df, columns) if stats is None else stats
    return df.withColumns(
        {c: (named(c) - mean) / std if std else F.lit(0.0) for c, (mean, std) in zip(columns, stats, strict=True)}
    )


def training_pool(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    fraction: float,
    size: int,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """The ``size`` complete rows of least hash among a fraction, for sweeps over pool sizes.

    The cut-off follows the row count, so the task that ends the top-k sees about twice ``size`` rows.
    """
    columns, keys = list(columns), list(keys)
    wanted = list(dict.fromkeys(keys + columns))
    rows = df.select(*[named(c) for c in wanted]).na.drop(subset=columns)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.least(F.lit(float(fraction)), F.lit(2.0 * size + 1000.0) / F.greatest(total, F.lit(1)))
    return (
        rows.withColumn("sample_key", row_hash([named(c) for c in keys], seed, method))
        .where(F.col("sample_key") < share * F.lit(HASH_RANGE))
        .orderBy("sample_key", *[named(c) for c in wanted])
        .limit(size)
        .select(*[named(c) for c in columns])
    )


def resolve_samples(max_samples: int | str, pool_rows: int) -> int:
    return min(256 if max_samples == "auto" else int(max_samples), pool_rows)


def least_prime(n: int) -> int:
    """The smallest prime that is n or more."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _digits(digest: Column, first: int, size: int) -> Column:
    return F.conv(F.substring(digest, first, size), 16, 10).cast("long")


def _row_text(columns: Sequence[str]) -> Column:
    """The row as text that a digest can be taken of; numbers to two decimals, nulls empty."""
    return F.concat_ws(
        ":", *[F.coalesce(F.expr(f"try_cast({_quoted(c)} AS decimal(38,2))").cast("string"), F.lit("")) for c in columns]
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def numbered_copies(rows: DataFrame, block: int = 1 << 16) -> DataFrame:
    """``rows`` with the number of each among its equals as ``copy``, whatever their order or partitions.

    Equal rows are counted, map-side first, and made again; a group beyond ``block`` is made by many tasks.
    """
    counted = rows.groupBy(*[named(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("copies"))
    blocks = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(block).cast("long"))
    # only blocks of a repeated row move; rows that are few stay where they were counted
    dealt = counted.where(F.col("copies") > block).withColumn("first", F.explode(blocks))
    dealt = dealt.repartition(*[named(c) for c in rows.columns], "first")
    few = counted.where(F.col("copies") <= block).withColumn("first", F.lit(0).cast("long"))
    last = F.least(F.col("copies"), F.col("first") + block) - 1
    made = few.unionByName(dealt).withColumn("copy", F.explode(F.sequence("first", last)))
    return made.drop("copies", "first")


def tree_draws(
    rows: DataFrame, n_trees: int, sample_size: int, total: int, seed: int = 42, keys: Sequence[str] = (), first_tree: int = 0
) -> DataFrame:
    """All rows' draws (tree_id, order and the row): about twice ``sample_size`` candidates for each tree.

    One rule at every size: a row is drawn by a share of the trees, rounded up or down by chance, and
    takes them in steps of its own from a start of its own, modulo a prime. So each tree draws each row
    with the same chance, and any two trees share no more rows than if they were drawn apart. The chances are digits of the
    MD5 of seed and row; without ``keys`` equal rows are told apart by the number of their copy.
    """
    columns = list(rows.columns)
    numbered = rows if keys else numbered_copies(rows)
    names = [F.coalesce(named(k).cast("string"), F.lit("")) for k in (keys or ["copy"])]
    rest = [c for c in columns if c not in set(keys)]
    text = F.concat_ws(":", F.lit(f"{seed}:{first_tree}"), *names, _row_text(rest))
    share = min(1.0, (2.0 * sample_size + 20) / total)
    prime = least_prime(n_trees)
    digest = F.col("__digest")
    drawn = numbered.withColumn("__digest", F.md5(text)).withColumn(
        "__times", F.floor(F.lit(prime * share) + _digits(digest, 1, 13) / F.lit(16.0**13))
    )
    step = 1 + _digits(digest, 22, 8) % (prime - 1)
    taken = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("__times") - 1), lambda i: (_digits(digest, 14, 8) + i * step) % prime
    )
    drawn = drawn.where(F.col("__times") > 0).withColumn("tree_id", F.explode(taken)).where(F.col("tree_id") < n_trees)
    order = _digits(F.md5(F.concat_ws(":", digest, F.col("tree_id").cast("string"))), 1, 13)
    return drawn.withColumns({"order": order, "tree_id": F.col("tree_id") + first_tree}).select(*[named(c) for c in columns], "tree_id", "order")


def grow_forest(
    rows: DataFrame,
    n_trees: int,
    max_samples: int | str = "auto",
    seed: int = 42,
    keys: Sequence[str] = (),
    first_tree: int = 0,
) -> tuple[DataFrame, int]:
    """The forest as a node table, and the rows per tree, from all ``rows``.

    Each tree takes the rows of least hash among its draws and is one small group of its own; nothing
    passes through the driver. ``keys`` name a row; they take part in the draw, but not in the trees.
    Tree *t* splits by digests of (seed, t, node), so the trees are the same however they are spread.
    """
    total = rows.count()
    if total == 0:
        raise ValueError("no complete rows to grow trees from")
    psi = resolve_samples(max_samples, total)
    features = [c for c in rows.columns if c not in set(keys)]

    def grow(draws: pd.DataFrame) -> pd.DataFrame:
        tree = int(draws["tree_id"].iloc[0])
        points = draws[features].to_numpy(dtype=np.float64)
        order = np.lexsort((*points.T, draws["order"].to_numpy()))[:psi]
        nodes = pd.DataFrame(
            grow_tree(points[order], seed, tree),
            columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"],
        )
        nodes.insert(0, "tree_id", tree)
        return nodes.astype({"left": "Int32", "right": "Int32"})

    draws = tree_draws(rows, n_trees, psi, total, seed, keys, first_tree)
    return draws.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA), psi


def score_function(spark, forests: dict[str, tuple[dict, Sequence[int]]]):
    """A vectorised function of the model columns: a struct with a score for each forest's name and tree count.

    ``forests`` maps a name's beginning to node arrays and tree counts; the score of n leading trees of
    forest "p" is named "pn<n>". The arrays are broadcast, bounded by trees times rows a tree.
    """
    shared = spark.sparkContext.broadcast(forests)

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.array([c.to_numpy(dtype=np.float64) for c in batch]).T
            found = {}
            for prefix, (arrays, counts) in shared.value.items():
                found |= {f"{prefix}n{n}": s for n, s in forest_scores(arrays, rows, counts).items()}
            yield pd.DataFrame(found)

    schema = ", ".join(f"`{prefix}n{n}` double" for prefix, (_, counts) in forests.items() for n in sorted(counts))
    return F.pandas_udf(_as_series_iterator(score), schema)


def node_frame(nodes: DataFrame) -> pd.DataFrame:
    """The bounded node table on the driver, as Arrow columns on the way and not as a Python object a cell."""
    return nodes.toArrow().to_pandas()


def check_forest_size(n_trees: int, sample_size: int) -> None:
    if 4 * n_trees * 2 * sample_size > MAX_NODE_CELLS:
        raise ValueError("the forest is too large to broadcast: fewer trees or samples")


def score_rows(
    df: DataFrame, columns: Sequence[str], nodes: DataFrame, sample_size: int, tree_counts: Sequence[int]
) -> DataFrame:
    """Add ``scores``, a struct with one anomaly score ``n<count>`` per tree count.

    Trees are independent, so the first n trees of the forest are a forest of n:
    one walk of the largest gives the scores of all. Rows go through in Arrow
    batches; the node table is bounded by trees times rows per tree.
    """
    counts = sorted(set(tree_counts))
    check_forest_size(max(counts), sample_size)
    wanted = node_frame(nodes.where(F.col("tree_id") < max(counts)))
    score = score_function(df.sparkSession, {"": (forest_arrays(wanted, sample_size), counts)})
    # one argument per column reaches the walk as one Arrow column each
    return df.withColumn("scores", score(*[named(c).cast("double") for c in columns]))


def _as_series_iterator(score):
    """Spark hands a one-column batch over as a bare series; make it a tuple."""

    def adapted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        return score(b if isinstance(b, tuple) else (b,) for b in batches)

    return adapted


def contamination_thresholds(df: DataFrame, scores: dict[str, Column], contamination: float = 0.15) -> dict[str, float]:
    """Per score, the exact quantile above which a row counts as an anomaly; nulls count nowhere."""
    share = 1.0 - contamination
    table = df.select(*[c.alias(name) for name, c in scores.items()])
    found = exact_quantiles(table, list(scores), [share])
    return {name: values[0] for name, values in found.items()}


def add_predictions(df: DataFrame, score: Column, threshold: float) -> DataFrame:
    """``predictions`` -1 for an anomaly, 1 otherwise; ``df_pred`` the same as 1 and 0."""
    anomaly = score > threshold
    return df.withColumns(
        {
            "predictions": F.when(anomaly, F.lit(-1)).otherwise(F.lit(1)),
            "df_pred": F.when(anomaly, F.lit(1)).otherwise(F.lit(0)),
        }
    )


@dataclass(frozen=True)
class Detection:
    """Scored rows, the sweep, the report on the chosen forest, and the forest itself."""

    rows: DataFrame
    quarantined: DataFrame
    sweep: DataFrame
    report: DataFrame
    nodes: DataFrame
    columns: list[str]
    sample_size: int
    best_count: int
    threshold: float
    medians: dict[str, float] | None = None
    scaling: list[tuple[float, float]] | None = None


def sweep_counts(scored: DataFrame, thresholds: dict[str, float], label: str = "is_fraud") -> DataFrame:
    """(n_estimators, tp, fp, fn, tn, precision, recall, f1) of every tree count, from one scan.

    ``no_positives`` marks tables where the label never occurs and the metrics mean nothing.
    """
    guesses = {int(name[1:]): F.col(f"scores.{name}") > t for name, t in thresholds.items()}
    table = confusion_by_candidate(scored, guesses, label)
    return table.withColumn("no_positives", F.col("tp") + F.col("fn") == 0)


def detect(df: DataFrame, cfg: PipelineConfig = PipelineConfig(), columns: Sequence[str] | None = None) -> Detection:
    """The full anomaly step over the feature table.

    Every row is walked down the forest once for the sweep, of which only the label and the scores
    are written to the shared folder. The scored rows are not written here: whoever reads them walks
    the chosen trees, so the only full copy is the one that is asked for.
    """
    columns = list(columns) if columns is not None else forest_columns(df, cfg)
    if not columns:
        raise ValueError("no model columns")
    if cfg.label_column not in df.columns:
        raise ValueError(f"the label column {cfg.label_column} is needed to choose the tree count")
    medians = column_medians(df, columns) if cfg.null_features == "median" else None
    rows = prepare_rows(df, columns, cfg.null_features, medians)
    inputs, stats = columns, None
    if cfg.scale_forest_features:
        inputs = [f"scaled_{i}" for i in range(len(columns))]
        rows = rows.withColumns({s: named(c).cast("double") for s, c in zip(inputs, columns)})
        stats = scaling(rows, inputs)
        rows = scaled(rows, inputs, stats)
    keys = [cfg.id_column] if cfg.id_column in rows.columns else []
    drawn = rows.select(*[named(c) for c in dict.fromkeys([*keys, *inputs])])
    nodes, psi = grow_forest(drawn, max(cfg.tree_counts), cfg.max_samples, cfg.seed, keys)
    nodes = materialize(nodes, "forest")
    judged = score_rows(rows, inputs, nodes, psi, cfg.tree_counts)
    judged = materialize(judged.select(named(cfg.label_column), "scores"), "sweep_scores")

    names = {f"n{n}": F.col(f"scores.n{n}") for n in sorted(set(cfg.tree_counts))}
    thresholds = contamination_thresholds(judged, names, cfg.contamination)
    # a handful of rows, one per tree count
    sweep = sweep_counts(judged, thresholds, cfg.label_column)
    sweep = df.sparkSession.createDataFrame(sweep.collect(), sweep.schema)
    best = choose_candidate(sweep, cfg.metric).first()["n_estimators"]
    limit = thresholds[f"n{best}"]
    report = class_report(add_predictions(judged, names[f"n{best}"], limit), cfg.label_column)
    result = score_rows(rows, inputs, nodes, psi, [best])
    result = add_predictions(result, names[f"n{best}"], limit).withColumn("anomaly_score", names[f"n{best}"])
    return Detection(
        rows=result.drop("scores", *(inputs if cfg.scale_forest_features else ())),
        quarantined=split_missing(df, columns)[1] if cfg.null_features == "quarantine" else df.limit(0),
        sweep=sweep,
        report=report,
        nodes=nodes,
        columns=columns,
        sample_size=psi,
        best_count=best,
        threshold=limit,
        medians=medians,
        scaling=stats,
    )


def ranked_pool(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], size: int, seed: int = 42
) -> DataFrame:
    """The ``size`` complete rows of least digest with their rank from 1: each smaller pool is a part of it.

    The cut-off follows the row count, so the task that ranks sees about twice ``size`` rows.
    """
    columns, keys = list(columns), list(keys)
    wanted = list(dict.fromkeys(keys + columns))
    rows = df.select(*[named(c) for c in wanted]).na.drop(subset=columns)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.least(F.lit(1.0), F.lit(2.0 * size + 1000.0) / F.greatest(total, F.lit(1)))
    keyed = rows.withColumn("sample_key", row_hash([named(c) for c in keys], seed, "md5"))
    first = Window.orderBy("sample_key", *[named(c) for c in wanted])
    near = keyed.where(F.col("sample_key") < share * F.lit(HASH_RANGE))
    return near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size).drop("sample_key")


def sweep_pools(
    df: DataFrame, pool_sizes: Sequence[int], cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """(pool, n_estimators, …): the tree-count sweep of a forest for each training pool size.

    The pools are parts of one ranked pool, their forests one node table with running tree numbers. All
    rows are walked down all forests in one scan, and one aggregate counts every pool and tree count.
    The model columns are written once: drawing the pool on top of the encodings and their null checks makes
    the optimizer derive constraints of each from all others, which takes the driver minutes and its memory.
    """
    columns = forest_columns(df, cfg)
    keys, trees, counts = [cfg.id_column], max(cfg.tree_counts), sorted(set(cfg.tree_counts))
    wanted = dict.fromkeys([*keys, cfg.label_column, *columns])
    rows = materialize(prepare_rows(df, columns, cfg.null_features).select(*[named(c) for c in wanted]), "pool_rows")
    pool = materialize(ranked_pool(rows, columns, keys, max(pool_sizes), cfg.seed), "pool")
    nodes, sizes = None, []
    for i, size in enumerate(pool_sizes):
        part = pool.where(F.col("rank") <= size).drop("rank")
        grown, psi = grow_forest(part, trees, cfg.max_samples, cfg.seed, keys, first_tree=i * trees)
        nodes = grown if nodes is None else nodes.unionByName(grown)
        sizes.append(psi)
        check_forest_size(trees * len(pool_sizes), psi)
    table = node_frame(materialize(nodes, "pool_forests"))
    of = table["tree_id"] // trees
    forests = {}
    for i, psi in enumerate(sizes):
        own = table[of == i].assign(tree_id=lambda t: t["tree_id"] % trees)
        forests[f"p{i}"] = (forest_arrays(own, psi), counts)
    score = score_function(df.sparkSession, forests)
    walk = score(*[named(c).cast("double") for c in columns])

    candidates = [(i, n) for i in range(len(sizes)) for n in counts]
    limits = {
        f"p{i}n{n}": F.when(F.col("rank") <= pool_sizes[i], F.col(f"scores.p{i}n{n}")) for i, n in candidates
    }
    judged = materialize(pool.select("rank", walk.alias("scores")), "pool_scores")
    thresholds = contamination_thresholds(judged, limits, cfg.contamination)
    guesses = {k: F.col(f"scores.p{i}n{n}") > thresholds[f"p{i}n{n}"] for k, (i, n) in enumerate(candidates)}
    label = rows.select(named(cfg.label_column), walk.alias("scores"))
    found = confusion_by_candidate(label, guesses, cfg.label_column, key="candidate")
    at = F.col("candidate") + 1
    size = F.element_at(F.array(*[F.lit(int(pool_sizes[i])) for i, _ in candidates]), at)
    count = F.element_at(F.array(*[F.lit(int(n)) for _, n in candidates]), at)
    rest = [F.col(c) for c in found.columns if c != "candidate"]
    table = found.select(size.alias("pool"), count.alias("n_estimators"), *rest)
    return table.withColumn("no_positives", F.col("tp") + F.col("fn") == 0)

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudspark.functions.trees import forest_arrays, forest_scores, grow_tree, mean_path
from fraudspark.operators import anomaly as a

NODE = ["node_id", "feature", "threshold", "left", "right", "size", "depth"]


def nodes_of(points, trees, seed=0):
    tables = []
    for t in range(trees):
        table = pd.DataFrame(grow_tree(points, seed, t), columns=NODE)
        table.insert(0, "tree_id", t)
        tables.append(table)
    return pd.concat(tables, ignore_index=True)


def walk(nodes, tree, point):
    table = nodes[nodes.tree_id == tree].set_index("node_id")
    node = table.loc[0]
    while node.feature >= 0:
        node = table.loc[node.right if point[int(node.feature)] >= node.threshold else node.left]
    return node.depth + mean_path(node["size"])[0]


def test_mean_path():
    assert mean_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert mean_path(256)[0] == pytest.approx(10.2448, abs=1e-3)


def test_tree_structure():
    points = np.random.default_rng(3).normal(size=(64, 3))
    nodes = nodes_of(points, 4)
    for _, tree in nodes.groupby("tree_id"):
        leaves = tree[tree.feature < 0]
        assert leaves["size"].sum() == 64 and tree["depth"].max() <= 6 and (tree["size"] > 0).all()
        inner = tree[tree.feature >= 0].set_index("node_id")
        sizes = tree.set_index("node_id")["size"]
        for node_id, row in inner.iterrows():
            assert sizes[row.left] + sizes[row.right] == row["size"] and row.right == row.left + 1


def test_scores_match_a_row_by_row_walk():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(50, 3))
    nodes = nodes_of(points, 6)
    rows = rng.normal(size=(20, 3)) * 2
    found = forest_scores(forest_arrays(nodes, 50), rows, [2, 6])
    for count in (2, 6):
        expected = [2 ** (-np.mean([walk(nodes, t, r) for t in range(count)]) / mean_path(50)[0]) for r in rows]
        np.testing.assert_allclose(found[count], expected)


@pytest.mark.parametrize("points", [np.ones((1, 2)), np.ones((9, 2)), np.c_[np.ones(9), np.arange(9.0)]])
def test_degenerate_samples(points):
    nodes = nodes_of(points, 3)
    scores = forest_scores(forest_arrays(nodes, len(points)), points, [3])[3]
    assert np.all((scores > 0) & (scores <= 1))
    assert not (nodes["feature"] == 0).any()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    table = pd.DataFrame(rng.normal(size=(2000, 3)), columns=["x", "y", "z"])
    table["transaction_id"] = np.arange(2000)
    table["is_fraud"] = rng.random(2000) < 0.1
    table.loc[table.is_fraud, "x"] += 4
    return spark.createDataFrame(table)


COLUMNS = ["x", "y", "z"]


def test_pool_trees_and_scores_do_not_depend_on_partitions(rows):
    results = []
    for partitions in (1, 4, 16):
        df = rows.repartition(partitions)
        pool = a.training_pool(df, COLUMNS, ["transaction_id"], 0.5, 300)
        nodes, psi = a.grow_forest(pool, 10)
        assert psi == 256
        scored = a.score_rows(df, COLUMNS, nodes, psi, [5, 10])
        results.append(
            (
                pool.toPandas(),
                nodes.toPandas().sort_values(["tree_id", "node_id"], ignore_index=True),
                scored.select("transaction_id", "scores.*").toPandas().sort_values("transaction_id", ignore_index=True),
            )
        )
    for other in results[1:]:
        for left, right in zip(results[0], other):
            pd.testing.assert_frame_equal(left, right)
    scores = results[0][2][["n5", "n10"]].to_numpy()
    assert ((scores > 0) & (scores < 1)).all()


def test_leading_trees_are_a_smaller_forest(rows):
    pool = a.training_pool(rows, COLUMNS, ["transaction_id"], 1.0, 500)
    small, psi = a.grow_forest(pool, 5)
    large, _ = a.grow_forest(pool, 20)
    score = lambda nodes, n: a.score_rows(rows, COLUMNS, nodes, psi, [n]).agg(F.sum(f"scores.n{n}")).first()[0]
    both = a.score_rows(rows, COLUMNS, large, psi, [5, 20]).agg(F.sum("scores.n5"), F.sum("scores.n20")).first()
    assert both[0] == pytest.approx(score(small, 5)) and both[1] == pytest.approx(score(large, 20))


def test_one_column(rows):
    pool = a.training_pool(rows, ["x"], ["transaction_id"], 1.0, 500)
    nodes, psi = a.grow_forest(pool, 5, max_samples=64)
    assert psi == 64 and a.score_rows(rows, ["x"], nodes, psi, [5]).select("scores.n5").distinct().count() > 10


def test_detect(rows, small_cfg):
    cfg = small_cfg
    found = a.detect(rows, cfg)
    types = dict(found.rows.dtypes)
    assert types["predictions"] == "int" and types["df_pred"] == "int"
    assert found.rows.count() == rows.count()
    assert {r.predictions for r in found.rows.select("predictions").distinct().collect()} <= {-1, 1}
    assert found.rows.where((F.col("predictions") == -1) != (F.col("df_pred") == 1)).count() == 0
    flagged = found.rows.where("predictions = -1").count() / rows.count()
    assert abs(flagged - cfg.contamination) < 0.05
    sweep = {r.n_estimators: r for r in found.sweep.collect()}
    assert set(sweep) == {5, 20} and all(r.tp + r.fp + r.fn + r.tn == rows.count() for r in sweep.values())
    assert sweep[found.best_count].f1 == max(r.f1 for r in sweep.values())
    assert sweep[found.best_count].tp == found.rows.where("predictions = -1 AND is_fraud").count()


def test_scaling_does_not_change_what_is_found(rows, small_cfg):
    plain = a.detect(rows, small_cfg).sweep.orderBy("n_estimators").collect()
    scaled = a.detect(rows, replace(small_cfg, scale_forest_features=True)).sweep.orderBy("n_estimators").collect()
    assert all(abs(p.recall - s.recall) < 0.15 for p, s in zip(plain, scaled))


def test_no_fraud_rows(rows, small_cfg):
    found = a.detect(rows.withColumn("is_fraud", F.lit(False)), small_cfg)
    assert found.best_count == 5
    assert all(r.no_positives and r.f1 == r.recall == r.precision == 0.0 for r in found.sweep.collect())


def test_rows_with_gaps_are_quarantined(rows, small_cfg):
    holed = rows.withColumn("y", F.when(F.col("transaction_id") >= 100, F.col("y")))
    found = a.detect(holed, small_cfg)
    assert found.quarantined.count() == 100 and found.rows.count() == 1900


def test_nothing_to_train_on(rows, small_cfg):
    with pytest.raises(ValueError, match="no complete rows"):
        a.detect(rows.limit(0), small_cfg)


def test_missing_label_is_named(rows, small_cfg):
    with pytest.raises(ValueError, match="is_fraud"):
        a.detect(rows.drop("is_fraud"), small_cfg)


def test_only_model_columns_reach_python(rows):
    pool = a.training_pool(rows, ["x"], ["transaction_id"], 1.0, 300)
    nodes, psi = a.grow_forest(pool, 3)
    plan = a.score_rows(rows, ["x"], nodes, psi, [3])._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "x#" in call.split("[")[1] and "y#" not in call.split("]")[0]


def test_pool_sweep(rows, small_cfg):
    table = a.sweep_pools(rows, [100, 400], small_cfg)
    assert {(r.pool, r.n_estimators) for r in table.collect()} == {(p, n) for p in (100, 400) for n in (5, 20)}


def test_pool_is_drawn_from_written_rows(featured, small_cfg, monkeypatch):
    """No encoding or null check is left below the draw: on top of them its plan does not end on a small driver."""
    plans, draw = [], a.ranked_pool

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise StopIteration

    monkeypatch.setattr(a, "ranked_pool", seen)
    with pytest.raises(StopIteration):
        a.sweep_pools(featured, [100, 400], small_cfg)
    assert "CASE WHEN" not in plans[0] and "Filter" not in plans[0]
    monkeypatch.setattr(a, "ranked_pool", draw)
    found = a.sweep_pools(featured, [100, 400], small_cfg).collect()
    assert len(found) == 4 and len({r.tp + r.fp + r.fn + r.tn for r in found}) == 1


def test_quality_over_seeds(clustering, cfg):
    """Recall gate of the job, and precision well above the base rate, without category columns."""
    base = clustering.rows.agg(F.avg(F.col("is_fraud").cast("int"))).first()[0]
    for seed in (42, 43, 44):
        chosen = replace(cfg, seed=seed, forest_categories=False, tree_counts=(100, 200))
        best = a.choose_candidate(a.detect(clustering.rows, chosen).sweep).first()
        assert best.recall >= 0.35 and best.precision >= 2 * base


def test_equal_rows_are_drawn_apart(spark):
    """A third of all rows are equal and nothing names them: each of their copies has its own draw."""
    df = spark.range(90_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).cast("double").alias("x"))
    results = []
    for partitions in (1, 7):
        drawn = a.tree_draws(df.repartition(partitions), 50, 64, 90_000, seed=7)
        results.append(sorted(map(tuple, drawn.collect())))
        per_tree = drawn.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_if(F.col("x") == 0).alias("equal")).collect()
        assert len(per_tree) == 50 and all(90 < r.n < 210 for r in per_tree)
        assert 0.28 < sum(r.equal for r in per_tree) / sum(r.n for r in per_tree) < 0.39
    assert results[0] == results[1]
    copies = a.numbered_copies(df, block=1000)
    assert copies.count() == 90_000 and copies.distinct().count() == 90_000
    assert copies.where("x = 0").agg(F.max("copy")).first()[0] == 30_000 - 1


def test_no_two_trees_share_more_rows_than_if_drawn_apart(spark):
    df = spark.range(20_000).select("id", F.col("id").cast("double").alias("x"))
    drawn = a.tree_draws(df, 20, 2500, 20_000, keys=["id"]).select("id", "tree_id")
    share = 5020 / 20_000
    pairs = drawn.alias("l").join(drawn.alias("r"), "id").where("l.tree_id < r.tree_id").groupBy("l.tree_id", "r.tree_id").count()
    found = [r["count"] for r in pairs.collect()]
    assert len(found) == 190 and 0.8 < np.mean(found) / (20_000 * share**2) <= 1.02 and max(found) < 1.2 * 20_000 * share**2


def test_draws_come_from_all_rows(spark):
    """Every part of a large table is drawn from, each tree from about twice its rows."""
    df = spark.range(60_000).select("id", (F.col("id") % 100).cast("double").alias("x"))
    for trees, size in ((20, 64), (200, 256)):  # more rows than candidates, and fewer
        drawn = a.tree_draws(df, trees, size, 60_000, keys=["id"])
        per_tree = {r.tree_id: r["count"] for r in drawn.groupBy("tree_id").count().collect()}
        assert set(per_tree) == set(range(trees))
        assert all(size < n < 3 * size for n in per_tree.values())
        assert drawn.where("id >= 50000").count() > 0.1 * drawn.count()
    nodes, psi = a.grow_forest(df, 10, keys=["id"])
    roots = nodes.where("node_id = 0").collect()
    assert psi == 256 and [r["size"] for r in roots] == [256] * 10


def test_small_tables_fill_their_trees(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("x"))
    nodes, psi = a.grow_forest(df, 8, keys=["id"])
    assert psi == 50 and [r["size"] for r in nodes.where("node_id = 0").collect()] == [50] * 8

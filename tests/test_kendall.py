import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from fraudspark.functions.inversions import exact_dot, heavier_before
from fraudspark.operators import kendall
from fraudspark.operators.kendall import kendall_matrix, kendall_tau


def all_pairs(x, y):
    ok = ~(np.isnan(x) | np.isnan(y))
    x, y = x[ok], y[ok]
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    size = np.sqrt((sx * sx).sum()) * np.sqrt((sy * sy).sum())
    return (sx * sy).sum() / size if size > 0 else None


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-3, 3), st.integers(1, 9)), max_size=60))
@settings(max_examples=200, deadline=None)
def test_weighted_inversions(rows):
    rows = sorted(rows, key=lambda r: r[0])
    group, value, weight = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(3))
    expected = [
        sum(int(weight[j]) for j in range(i) if group[j] == group[i] and value[j] > value[i]) for i in range(len(rows))
    ]
    assert heavier_before(value, weight, group).tolist() == expected


def test_exact_dot_beyond_64_bits():
    big = np.array([2**40, 2**41], dtype=np.int64)
    assert exact_dot(big, big) == 2**80 + 2**82


def sample(n):
    rng = np.random.default_rng(n)
    table = pd.DataFrame(
        {
            "few": rng.integers(0, 5, n).astype(float),
            "smooth": rng.normal(size=n),
            "binary": rng.integers(0, 2, n).astype(float),
            "atom": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
            "constant": np.ones(n),
        }
    )
    table.loc[rng.random(n) < 0.1, "smooth"] = np.nan
    return table


@pytest.mark.parametrize("n", [1, 2, 60, 400])
def test_matches_all_pairs_under_any_partitioning(spark, n):
    table = sample(n)
    df = spark.createDataFrame(table)
    for blocks in (1, 7):
        for r in kendall_matrix(df.repartition(blocks), list(table), blocks).collect():
            expected = all_pairs(table[r.col_a].to_numpy(), table[r.col_b].to_numpy())
            if expected is None:
                assert r.tau is None
            else:
                assert r.tau == pytest.approx(expected, abs=1e-12)


def test_perfect_orders_and_booleans(spark):
    df = spark.createDataFrame([(i, -i, i > 5) for i in range(20)], "a int, b int, c boolean")
    tau = {(r.col_a, r.col_b): r.tau for r in kendall_matrix(df, ["a", "b", "c"]).collect()}
    assert tau["a", "b"] == -1.0 and tau["a", "c"] == -tau["b", "c"] > 0.5


def test_all_nulls_gives_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert kendall_tau(df, "a", "b").first().tau is None


def test_full_matrix_of_features(featured):
    columns = ["transaction_amount", "cardholder_age", "is_online", "transaction_hour"]
    cells = {(r.col_a, r.col_b): r.tau for r in kendall_matrix(featured, columns, full=True).collect()}
    assert len(cells) == 16
    assert all(cells[c, c] == 1.0 for c in columns)
    assert all(-1 <= v <= 1 and cells[b, a] == v for (a, b), v in cells.items())


@pytest.mark.parametrize("few", [0, 2, 63])
def test_every_kind_of_pair_gives_the_same(spark, few):
    """Few-valued or not, small blocks that make cells split again, a value that spans several parts."""
    table = sample(300)
    df = spark.createDataFrame(table).repartition(3)
    found = kendall_matrix(df, list(table), few=few, points_per_block=20)
    for r in found.collect():
        expected = all_pairs(table[r.col_a].to_numpy(), table[r.col_b].to_numpy())
        assert r.tau is None if expected is None else r.tau == pytest.approx(expected, abs=1e-12)


def test_rows_are_not_sent_once_a_pair(spark):
    """Few-valued columns are counted where they are, a many-valued one is dealt out once with all others."""
    df = spark.createDataFrame(sample(200))
    rows = kendall._numbers(df, list(df.columns))
    values = kendall._few_values(rows, 63)
    assert sorted(values) == [0, 2, 4] and values[4] == [1.0]
    plan = kendall._count_tables(rows, values, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.index("MapInPandas") < len(plan)

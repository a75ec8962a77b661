import numpy as np
import pandas as pd
import pytest

from fraudspark.operators.profile import describe, null_counts, preview, schema_info
from fraudspark.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.85, 1.0]


@pytest.mark.parametrize("n", [1, 2, 7, 3000])
def test_quantiles_match_numpy_while_narrowing(spark, n):
    rng = np.random.default_rng(n)
    table = pd.DataFrame(
        {
            "smooth": rng.normal(size=n),
            "atom": np.where(rng.random(n) < 0.4, 3.0, rng.normal(3.0, 1.0, n)),
            "ages": rng.integers(18, 80, n).astype(float),
            "same": np.full(n, 5.0),
        }
    )
    df = spark.createDataFrame(table).repartition(5)
    for accuracy, limit in ((20, 3), (10_000, 20_000)):
        found = exact_quantiles(df, list(table), PROBABILITIES, accuracy=accuracy, collect_rows=limit)
        for c in table:
            np.testing.assert_allclose(found[c], np.quantile(table[c], PROBABILITIES), rtol=1e-12, err_msg=c)


def test_nulls_nan_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, 1), (float("nan"), None, 2), (3.0, None, None)], "a double, b double, c int")
    assert exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [2.0], "b": [None], "c": [1.5]}


def test_describe(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (4, None)], "v int, s string")
    found = {r.statistic: r.value for r in describe(df).collect()}
    assert found == {
        "count": 3.0, "mean": 2.33333, "std": 1.52753, "min": 1.0, "25%": 1.5, "50%": 2.0, "75%": 3.0, "max": 4.0,
    }
    assert describe(df.select("s")).count() == 0
    empty = {r.statistic: r.value for r in describe(df.limit(0)).collect()}
    assert empty["count"] == 0.0 and empty["50%"] is None


def test_profiles(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "v int, s string")
    assert [tuple(r) for r in schema_info(df).collect()] == [("v", "int", 2), ("s", "string", 1)]
    assert [tuple(r) for r in null_counts(df).collect()] == [("v", 0), ("s", 1)]
    assert preview(df, 1, ["v"]).collect()[0].v == 1 and preview(df, 1).count() == 1

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fraudspark.operators.profile import schema_info
from fraudspark.plans.model import FraudModel
from fraudspark.plans.run import register_views, run
from fraudspark.sources.sinks import write_table
from fraudspark.sources.tables import read_table


@pytest.fixture(scope="module")
def result(spark, raw, small_cfg, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    write_table(raw, str(folder / "raw"), "csv")
    cfg = replace(small_cfg, input_path=str(folder / "raw"), output_path=str(folder / "out"))
    return run(spark, cfg), folder / "out"


def test_rows_from_file_equal_rows_from_tables(result, cleaned):
    found = result[0].cleaned.withColumn("transaction_id", F.col("transaction_id").cast("long"))
    assert found.exceptAll(cleaned).count() == cleaned.exceptAll(found).count() == 0


def test_written_output(spark, result):
    done, out = result
    scored = read_table(spark, str(out / "scored"))
    assert scored.count() == done.scored.count() > 0
    assert {"cluster_labels", "predictions", "df_pred", "anomaly_score"} <= set(scored.columns)
    assert not any(c.startswith("features_") for c in scored.columns)
    quarantined = read_table(spark, str(out / "quarantined"))
    assert scored.count() == done.cleaned.count()
    assert scored.where("predictions is null").count() == quarantined.count() > 0
    assert scored.where("(predictions is null) != (cluster_labels is null) or (predictions is null) != (anomaly_score is null)").count() == 0


def test_tables(result, small_cfg):
    done = result[0]
    assert {r.dimension for r in done.fraud_counts.select("dimension").distinct().collect()} == set(
        small_cfg.count_dimensions
    )
    assert done.correlation.where("tau is not null and abs(tau) > 1").count() == 0
    assert done.detection.sweep.count() == len(small_cfg.tree_counts)
    assert {p.name for p in (result[1] / "tables").iterdir()} == set(done.tables())


def test_views(spark, result):
    register_views(result[0], "card")
    counts = spark.sql(
        "SELECT (SELECT count(*) FROM card_raw) r, (SELECT count(*) FROM card_clean) c, (SELECT count(*) FROM card_scored) s"
    ).first()
    assert counts.r > counts.c == counts.s > 0


def test_saved_model_scores_the_same_in_another_session(spark, result):
    done, out = result
    model = FraudModel.load(spark.newSession(), str(out / "model"))
    again = model.score(done.raw)
    first = done.scored
    assert set(again.columns) == set(first.columns)
    again = again.select(*first.columns)
    assert first.count() > 0 and first.exceptAll(again).count() == again.exceptAll(first).count() == 0
    one = model.score(done.raw.limit(3))
    assert one.count() <= 3 and "anomaly_score" in one.columns


def test_scoring_reads_cleaned_rows_that_are_written(spark, result):
    done, out = result
    plan = FraudModel.load(spark, str(out / "model")).score(done.raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # the duplicate removal lies behind the written rows


def test_profiles_come_with_the_written_rows(result):
    done = result[0]
    expected = {tuple(r) for r in schema_info(done.cleaned).collect()}
    assert {tuple(r) for r in done.profile_schema.collect()} == expected
    assert done.tables()["silhouette"].first()[0] == done.clustering.silhouette

import pytest

from fraudspark.operators import evaluate as e


def table(spark, pairs):
    return spark.createDataFrame(pairs, "is_fraud boolean, df_pred int")


CASES = {
    "mixed": ([(True, 1)] * 3 + [(False, 1)] * 1 + [(True, 0)] * 2 + [(False, 0)] * 4, (3, 1, 2, 4, 0.75, 0.6, 2 / 3)),
    "perfect": ([(True, 1), (False, 0)], (1, 0, 0, 1, 1.0, 1.0, 1.0)),
    "no fraud": ([(False, 1), (False, 0)], (0, 1, 0, 1, 0.0, 0.0, 0.0)),
    "nothing flagged": ([(True, 0), (False, 0)], (0, 0, 1, 1, 0.0, 0.0, 0.0)),
    "null label": ([(None, 1), (True, 1)], (1, 0, 0, 0, 1.0, 1.0, 1.0)),
}


@pytest.mark.parametrize("case", CASES)
def test_confusion(spark, case):
    pairs, expected = CASES[case]
    assert tuple(e.confusion(table(spark, pairs)).first()) == pytest.approx(expected)


def test_class_report(spark):
    found = {(r["class"], r.metric): r.value for r in e.class_report(table(spark, CASES["mixed"][0])).collect()}
    assert found["0", "precision"] == pytest.approx(4 / 6) and found["0", "support"] == 5
    assert found["1", "recall"] == pytest.approx(0.6) and found["accuracy", "f1"] == pytest.approx(0.7)
    assert found["macro avg", "precision"] == pytest.approx((4 / 6 + 0.75) / 2)
    assert found["weighted avg", "recall"] == pytest.approx(0.7)


def test_label_totals(spark):
    assert tuple(e.label_totals(table(spark, CASES["no fraud"][0])).first()) == (2, 0, True)
    assert tuple(e.label_totals(table(spark, CASES["mixed"][0])).first()) == (10, 5, False)


def test_choice_prefers_the_smaller_count_on_a_tie(spark):
    metrics = spark.createDataFrame([(50, 0.4, 0.1), (100, 0.5, 0.1), (150, 0.5, 0.9)], "n_estimators int, f1 double, recall double")
    assert e.choose_candidate(metrics).first().n_estimators == 100
    assert e.choose_candidate(metrics, "recall").first().n_estimators == 150

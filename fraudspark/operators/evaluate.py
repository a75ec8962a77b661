"""Quality of 0/1 predictions against a boolean or 0/1 label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fraudspark.functions.parsing import named


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    """Aggregates tp, fp, fn, tn; rows with a null on either side count nowhere."""
    return [
        F.count_if(predicted & label).alias("tp"),
        F.count_if(predicted & ~label).alias("fp"),
        F.count_if(~predicted & label).alias("fn"),
        F.count_if(~predicted & ~label).alias("tn"),
    ]


def add_scores(counts: DataFrame) -> DataFrame:
    """precision, recall and f1 from tp, fp and fn; 0.0 where a denominator is zero."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion(df: DataFrame, label: str = "is_fraud", predicted: str = "df_pred") -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall, f1."""
    truth, guess = named(label).cast("boolean"), named(predicted).cast("boolean")
    return add_scores(df.agg(*confusion_counts(truth, guess)))


def confusion_by_candidate(
    df: DataFrame, predictions: Mapping[int, Column], label: str = "is_fraud", key: str = "n_estimators"
) -> DataFrame:
    """The confusion row of every candidate, from one scan of ``df``."""
    truth = named(label).cast("boolean")
    wide = df.agg(
        *[
            count.alias(f"{name}_{candidate}")
            for candidate, guess in predictions.items()
            for name, count in zip(("tp", "fp", "fn", "tn"), confusion_counts(truth, guess))
        ]
    )
    rows = [
        F.struct(
            F.lit(candidate).alias(key),
            *[F.col(f"{name}_{candidate}").alias(name) for name in ("tp", "fp", "fn", "tn")],
        )
        for candidate in predictions
    ]
    return add_scores(wide.select(F.inline(F.array(*rows))))


def label_totals(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: rows, positives, and whether there is no positive at all."""
    positive = F.count_if(named(label).cast("boolean"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), positive.alias("positives"), (positive == 0).alias("no_positives")
    )


def class_report(df: DataFrame, label: str = "is_fraud", predicted: str = "df_pred") -> DataFrame:
    """(class, metric, value): per class, accuracy, macro and weighted averages, from one scan."""
    counts = confusion(df, label, predicted).select("tp", "fp", "fn", "tn")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    classes = {
        "0": {
            "precision": _ratio(tn, tn + fn),
            "recall": _ratio(tn, tn + fp),
            "f1": _ratio(2 * tn, 2 * tn + fn + fp),
            "support": tn + fp,
        },
        "1": {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "support": tp + fn,
        },
    }
    zero, one = classes["0"], classes["1"]
    report = dict(classes)
    report["accuracy"] = {"f1": _ratio(tp + tn, total), "support": total}
    report["macro avg"] = {m: (zero[m] + one[m]) / 2 for m in ("precision", "recall", "f1")} | {"support": total}
    report["weighted avg"] = {
        m: _ratio(zero[m] * zero["support"] + one[m] * one["support"], total) for m in ("precision", "recall", "f1")
    } | {"support": total}
    cells = [
        F.struct(
            F.lit(name).alias("class"), F.lit(metric).alias("metric"), value.cast("double").alias("value")
        )
        for name, metrics in report.items()
        for metric, value in metrics.items()
    ]
    return counts.select(F.inline(F.array(*cells)))


def choose_candidate(
    metrics: DataFrame, metric: str = "f1", keys: Sequence[str] = ("n_estimators",)
) -> DataFrame:
    """One row: the candidate with the best metric; ties go to the smallest keys."""
    return metrics.orderBy(F.desc(metric), *keys).limit(1)

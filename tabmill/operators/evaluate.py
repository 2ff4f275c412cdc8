"""Error metrics of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expressions(y: Column, p: Column) -> dict[str, Column]:
    return {
        "mse": F.avg((y - p) * (y - p)),
        "rmse": F.sqrt(F.avg((y - p) * (y - p))),
        "mae": F.avg(F.abs(y - p)),
    }


METRICS = ("mse", "rmse", "mae")


def known_metrics(metrics) -> list[str]:
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; known: {METRICS}")
    return list(metrics)


def metrics_by_stage(df: DataFrame, label: str, predictions: dict[str, str], metrics=METRICS) -> DataFrame:
    """(model_id, stage, metric, value): every metric of every model on every stage in one aggregate.

    `predictions` maps model ids to prediction columns of the same rows.
    """
    wanted = known_metrics(metrics)
    aggregates, cells = [], []
    for i, (model_id, column) in enumerate(predictions.items()):
        expressions = _expressions(F.col(label), F.col(column))
        for m in wanted:
            aggregates.append(expressions[m].alias(f"{m}_{i}"))
            cells.append(
                F.struct(F.lit(model_id).alias("model_id"), F.lit(m).alias("metric"), F.col(f"{m}_{i}").alias("value"))
            )
    per_stage = df.groupBy("stage").agg(*aggregates)
    return per_stage.select("stage", F.inline(F.array(*cells))).select("model_id", "stage", "metric", "value")


def errors(df: DataFrame, label: str, prediction: Column, metrics=METRICS) -> DataFrame:
    """The metrics over the whole table, one column each."""
    expressions = _expressions(F.col(label), F.col("_p"))
    return df.withColumn("_p", prediction).agg(
        F.count(F.lit(1)).alias("n_rows"), *[expressions[m].alias(m) for m in known_metrics(metrics)]
    )


def mean_baseline(df: DataFrame, label: str) -> float:
    """Train mean of the label: the prediction every model has to beat."""
    return df.where(F.col("stage") == "train").agg(F.avg(label)).first()[0]


def best_model(metrics: DataFrame, primary: str) -> DataFrame:
    """(model_id, value) with the lowest primary metric on the valid rows, first by id on a tie."""
    return (
        metrics.where((F.col("stage") == "valid") & (F.col("metric") == primary))
        .agg(F.min(F.struct("value", "model_id")).alias("best"))
        .select("best.model_id", "best.value")
    )

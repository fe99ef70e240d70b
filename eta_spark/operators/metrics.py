"""Regression metrics and model comparisons."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eta_spark.functions.labels import is_long
from eta_spark.schema import CLEANING_RULE, MAE_TOLERANCE

# Metric names of the reports.
MEASURES = [
    "MAE",
    "RMSE",
    "R2",
    "overall_signed_error",
    "long_delivery_count",
    "long_delivery_MAE",
    "long_delivery_RMSE",
    "long_delivery_signed_error",
]


def regression_measures(actual: Column, predicted: Column) -> list[Column]:
    error = predicted - actual
    total_spread = F.var_pop(actual) * F.count(actual)
    return [
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (1 - F.sum(error * error) / F.nullif(total_spread, F.lit(0.0))).alias("R2"),
    ]


def tail_measures(actual: Column, predicted: Column) -> list[Column]:
    """Overall measures, bias and the same for long deliveries (NULL when there are none)."""
    error = predicted - actual
    long_error = F.when(is_long(actual), error)
    return regression_measures(actual, predicted) + [
        F.avg(error).alias("overall_signed_error"),
        F.count(long_error).alias("long_delivery_count"),
        F.avg(F.abs(long_error)).alias("long_delivery_MAE"),
        F.sqrt(F.avg(long_error * long_error)).alias("long_delivery_RMSE"),
        F.avg(long_error).alias("long_delivery_signed_error"),
    ]


def evaluate(df: DataFrame, actual: Column, predicted: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*tail_measures(actual, predicted))


def evaluate_models(df: DataFrame, actual: Column, predictions: dict, name: str = "model") -> DataFrame:
    """Several prediction columns of one table, measured in one scan; one row per model.

    ``predictions`` maps a row label to a prediction column.
    """
    labels = list(predictions)
    one = df.agg(
        *[
            F.struct(*tail_measures(actual, F.col(f"`{predictions[label]}`"))).alias(f"m{i}")
            for i, label in enumerate(labels)
        ]
    )
    rows = [
        F.struct(F.lit(label).alias(name), *[F.col(f"m{i}.{m}").alias(m) for m in MEASURES])
        for i, label in enumerate(labels)
    ]
    return one.select(F.inline(F.array(*rows)))


def value_in_row(name: str, row: str, column: str) -> Column:
    """Aggregate that reads one cell of a report by its row label."""
    return F.max(F.when(F.col(name) == row, F.col(column)))


def _change_pct(before: Column, after: Column) -> Column:
    return (after - before) / before * 100


def cleaning_effect(metrics: DataFrame, model: str) -> DataFrame:
    """Original against cleaned data for one model."""
    chosen = metrics.filter(F.col("model") == model)
    cells = {
        f"{dataset.lower()}_{m}": value_in_row("dataset", dataset, m)
        for dataset in ("Original", "Cleaned")
        for m in ("MAE", "RMSE", "R2")
    }
    one = chosen.agg(*[c.alias(n) for n, c in cells.items()])
    mae_change = F.col("cleaned_MAE") - F.col("original_MAE")
    return one.select(
        F.lit(model).alias("model"),
        _change_pct(F.col("original_MAE"), F.col("cleaned_MAE")).alias("MAE_change_pct"),
        _change_pct(F.col("original_RMSE"), F.col("cleaned_RMSE")).alias("RMSE_change_pct"),
        (F.col("cleaned_R2") - F.col("original_R2")).alias("R2_change"),
        F.when(mae_change < 0, "improved").when(mae_change > 0, "increased").otherwise("same").alias("test_MAE_result"),
    )


def tail_effect(metrics: DataFrame, baseline: str, tail_aware: str) -> DataFrame:
    """Baseline against tail-weighted model, with the selection verdict."""
    columns = ("MAE", "RMSE", "long_delivery_MAE")
    one = metrics.agg(
        *[value_in_row("model", baseline, c).alias(f"base_{c}") for c in columns],
        *[value_in_row("model", tail_aware, c).alias(f"tail_{c}") for c in columns],
    )
    overall = _change_pct(F.col("base_MAE"), F.col("tail_MAE"))
    tail = _change_pct(F.col("base_long_delivery_MAE"), F.col("tail_long_delivery_MAE"))
    return one.select(
        (F.col("tail_MAE") - F.col("base_MAE")).alias("MAE_change"),
        (-overall).alias("MAE_improvement_pct"),
        (F.col("tail_RMSE") - F.col("base_RMSE")).alias("RMSE_change"),
        (-_change_pct(F.col("base_RMSE"), F.col("tail_RMSE"))).alias("RMSE_improvement_pct"),
        (F.col("tail_long_delivery_MAE") - F.col("base_long_delivery_MAE")).alias("long_MAE_change"),
        (-tail).alias("long_MAE_improvement_pct"),
        F.when((tail < 0) & (overall <= 1.0), "promising")
        .when(tail < 0, "trade-off")
        .otherwise("keep baseline")
        .alias("verdict"),
    )


def with_cleaning_rule(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("geographic_cleaning", F.lit(CLEANING_RULE))


def _baseline_cell(column: str) -> Column:
    """The cell of the weight-1 row. The sweep has one row per weight, so one window holds it all."""
    return F.max(F.when(F.col("long_delivery_weight") == 1.0, F.col(column))).over(Window.partitionBy())


def sweep_deltas(sweep: DataFrame) -> DataFrame:
    """Each weight against weight 1."""
    long_base = _baseline_cell("long_delivery_MAE")
    return sweep.withColumns(
        {
            "MAE_change_vs_baseline": F.col("MAE") - _baseline_cell("MAE"),
            "RMSE_change_vs_baseline": F.col("RMSE") - _baseline_cell("RMSE"),
            "long_MAE_change_vs_baseline": F.col("long_delivery_MAE") - long_base,
            "long_MAE_improvement_pct": (long_base - F.col("long_delivery_MAE")) / long_base * 100,
        }
    )


def acceptable_weights(sweep: DataFrame, tolerance: float = MAE_TOLERANCE) -> DataFrame:
    limited = sweep.withColumn("_limit", _baseline_cell("MAE") * tolerance)
    return limited.filter(F.col("MAE") <= F.col("_limit")).drop("_limit")


def select_weight(sweep: DataFrame, tolerance: float = MAE_TOLERANCE) -> DataFrame:
    """Best tail error among the acceptable weights; the lower weight wins ties, no row if none qualifies."""
    return (
        acceptable_weights(sweep, tolerance)
        .filter(F.col("long_delivery_MAE").isNotNull())
        .orderBy("long_delivery_MAE", "long_delivery_weight")
        .limit(1)
    )

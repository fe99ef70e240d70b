"""Metrics, comparisons and error tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eta_spark.operators import delays, errors, metrics
from eta_spark.schema import FEATURES, TARGET


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(3)
    actual = rng.uniform(10, 55, 400).round()
    predicted = actual + rng.normal(0, 3, 400)
    table = spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "a double, p double")
    row = metrics.evaluate(table, F.col("a"), F.col("p")).first()
    error, tail = predicted - actual, actual >= 45
    assert row.MAE == pytest.approx(np.abs(error).mean())
    assert row.RMSE == pytest.approx(np.sqrt((error**2).mean()))
    assert row.R2 == pytest.approx(1 - (error**2).sum() / ((actual - actual.mean()) ** 2).sum())
    assert row.long_delivery_count == tail.sum()
    assert row.long_delivery_MAE == pytest.approx(np.abs(error[tail]).mean())
    assert row.long_delivery_signed_error == pytest.approx(error[tail].mean())


def test_no_long_orders_leaves_tail_metrics_empty(spark):
    table = spark.createDataFrame([(20.0, 21.0), (30.0, 28.0)], "a double, p double")
    row = metrics.evaluate(table, F.col("a"), F.col("p")).first()
    assert row.long_delivery_count == 0 and row.long_delivery_MAE is None and row.long_delivery_RMSE is None


def test_published_tail_effect(spark):
    rows = [("Baseline", 3.0601943783407357, 3.8534596010706847, 4.703178056450778), ("Tail", 3.0801667599540723, 3.863202597631217, 4.044650987137196)]
    table = spark.createDataFrame(rows, "model string, MAE double, RMSE double, long_delivery_MAE double")
    row = metrics.tail_effect(table, "Baseline", "Tail").first()
    assert row.verdict == "promising"
    assert row.long_MAE_improvement_pct == pytest.approx(14.0, abs=0.01)
    assert row.MAE_improvement_pct == pytest.approx(-0.65, abs=0.01)


@pytest.mark.parametrize(("mae", "tail", "verdict"), [(3.2, 4.0, "trade-off"), (2.9, 5.0, "keep baseline"), (3.0, 4.9, "promising")])
def test_tail_verdicts(spark, mae, tail, verdict):
    table = spark.createDataFrame([("b", 3.0, 4.0, 5.0), ("t", mae, 4.0, tail)], "model string, MAE double, RMSE double, long_delivery_MAE double")
    assert metrics.tail_effect(table, "b", "t").first().verdict == verdict


def test_published_cleaning_effect(spark):
    rows = [("Boosted", 3.140397587736548, 3.9464461666953707, 0.8223680620084504, "Original"), ("Boosted", 3.093140384940548, 3.8930781579732097, 0.8308736851915892, "Cleaned")]
    table = spark.createDataFrame(rows, "model string, MAE double, RMSE double, R2 double, dataset string")
    row = metrics.cleaning_effect(table, "Boosted").first()
    assert row.test_MAE_result == "improved"
    assert (row.MAE_change_pct, row.RMSE_change_pct, row.R2_change) == (
        pytest.approx(-1.50, abs=0.01),
        pytest.approx(-1.35, abs=0.01),
        pytest.approx(0.0085, abs=0.0001),
    )


def test_weight_selection(spark):
    rows = [(1.0, 3.00, 4.0, 5.0), (1.5, 3.01, 4.0, 4.6), (2.0, 3.03, 4.0, 4.2), (3.0, 3.04, 4.0, 3.9)]
    sweep = spark.createDataFrame(rows, "long_delivery_weight double, MAE double, RMSE double, long_delivery_MAE double")
    assert metrics.select_weight(sweep).first().long_delivery_weight == 2.0
    assert metrics.select_weight(sweep, 0.5).isEmpty()
    deltas = {r.long_delivery_weight: r for r in metrics.sweep_deltas(sweep).collect()}
    assert deltas[1.0].MAE_change_vs_baseline == 0
    assert deltas[2.0].long_MAE_improvement_pct == pytest.approx(16.0)


def prediction_rows(spark, ids):
    schema = f"ID string, `{TARGET}` double, predicted double, error double, absolute_error double, is_long_delivery boolean, City string"
    return spark.createDataFrame([(i, 46.0, 40.0, -6.0, 6.0, True, "given") for i in ids], schema)


def feature_rows(spark, ids):
    schema = "ID string, " + ", ".join(f"{c} {'double' if c == 'distance_km' else 'string'}" for c in FEATURES)
    return spark.createDataFrame([(i, *[30.0 if c == "distance_km" else "v" for c in FEATURES]) for i in ids], schema)


def test_left_join_of_features(spark):
    joined = errors.attach_features(prediction_rows(spark, ["a", "b"]), feature_rows(spark, ["a"]))
    rows = {r.ID: r for r in joined.collect()}
    assert rows["a"].City == "given" and rows["a"].City_data == "v"
    assert rows["b"].City_data is None
    keyed = errors.with_report_keys(joined).filter("ID = 'a'").first()
    assert keyed.distance_bucket is None and keyed.delivery_time_bucket == ">45"


def test_duplicate_features_repeat_or_are_refused(spark):
    predictions, features = prediction_rows(spark, ["a"]), feature_rows(spark, ["a", "a"])
    assert errors.attach_features(predictions, features).count() == 2
    with pytest.raises(ValueError, match="not unique"):
        errors.attach_features(predictions, features, require_unique=True)


def test_fused_reports_equal_single_ones(spark, sf_dir):
    from eta_spark.catalog.base import error_table

    table = error_table(spark, sf_dir)
    fused = errors.error_by_keys(table, ["City", "Weatherconditions"])
    for key in ("City", "Weatherconditions"):
        one = {r[key]: r for r in errors.summarize_error(table, key).collect()}
        many = {r.level: r for r in fused.filter(F.col("key") == key).collect()}
        assert one.keys() == many.keys()
        for level, row in one.items():
            assert row.orders == many[level].orders and row.mae == pytest.approx(many[level].mae)


def test_missing_factor_levels_are_kept(orders):
    risk = delays.risk_of_factor(orders, "Weatherconditions").collect()
    assert None in [r.Weatherconditions for r in risk]
    assert sum(r.orders for r in risk) == orders.count()
    rates = [r.long_delivery_rate for r in risk]
    assert rates == sorted(rates, reverse=True)


def test_reports_keep_the_types_of_their_levels(orders):
    """Levels share a grouping as text and come back as numbers, flags and text."""
    from eta_spark.plans.reports import delay_reports
    from eta_spark.schema import DELAY_FACTORS

    reports = delay_reports(orders)
    for factor in DELAY_FACTORS:
        for prefix in ("delay_by", "long_delivery_risk"):
            report = reports[f"{prefix}_{factor.lower()}"]
            assert report.schema[factor].dataType == orders.schema[factor].dataType
            found = {r[0] for r in report.select(factor).collect()}
            assert found == {r[0] for r in orders.select(factor).distinct().collect()}

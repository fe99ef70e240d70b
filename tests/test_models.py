"""Model properties that do not depend on exact digits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eta_spark.functions.labels import target
from eta_spark.operators import models, preparation, splits
from eta_spark.operators.importance import permutation_importance, permuted_errors, shuffled_pairs, with_donor, with_row_key
from eta_spark.operators.quality import clean_geography
from eta_spark.operators.scenarios import BASE_ORDER, SCENARIOS, behaviour_checks, order_checks, run_scenarios, scenario_report
from eta_spark.operators.scoring import predict_eta
from eta_spark.plans import training
from eta_spark.schema import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from eta_spark.sources.deliveries import orders_from_rows
from eta_spark.sources.model_store import load_model, save_model


@pytest.fixture(scope="module")
def sides(orders):
    return splits.split_tables(splits.random_split(clean_geography(orders)))


@pytest.fixture(scope="module")
def linear(sides):
    return models.fit_model(sides[0], models.LINEAR, models.SMOKE)


@pytest.fixture(scope="module")
def boosted(sides):
    return models.fit_model(sides[0], models.BOOSTED, models.SMOKE)


def test_preparation_statistics(sides):
    train, _ = sides
    frame = train.select(*FEATURES).toPandas()
    numbers = {r.feature: r for r in preparation.numeric_statistics(train).collect()}
    for name in NUMERIC_FEATURES:
        values = frame[name].astype(float)
        filled = values.fillna(values.median())
        assert numbers[name]["median"] == pytest.approx(values.median())
        assert numbers[name]["mean"] == pytest.approx(filled.mean())
        assert numbers[name]["scale"] == pytest.approx(filled.std(ddof=0))
    modes = {r.feature: r["mode"] for r in preparation.category_modes(train).collect()}
    for name in CATEGORICAL_FEATURES:
        counts = frame[name].value_counts()
        assert modes[name] == min(counts[counts == counts.max()].index)


def test_mode_tie_takes_the_smallest(spark):
    rows = spark.createDataFrame([(c,) for c in ["b", "a", "b", "a", None, None, None]], "x string")
    table = rows.select(*[F.col("x").alias(c) for c in CATEGORICAL_FEATURES])
    assert {r["mode"] for r in preparation.category_modes(table).collect()} == {"a"}


def test_least_squares_matches_numpy(sides, linear):
    train, _ = sides
    vectors = linear.transform(train).select("features", "prediction", target().alias("y")).toPandas()
    x = np.column_stack([np.ones(len(vectors)), np.stack([v.toArray() for v in vectors.features])])
    solution, *_ = np.linalg.lstsq(x, vectors.y.to_numpy(), rcond=None)
    assert np.abs(x @ solution - vectors.prediction.to_numpy()).max() < 1e-3


def test_unseen_category_is_all_zero(spark, boosted):
    odd = orders_from_rows(spark, [{**BASE_ORDER, "City": "Atlantis", "Weatherconditions": None}])
    row = predict_eta(odd, boosted.transform).first()
    assert row.predicted_eta_min > 0 and row.City == "Atlantis"


def test_boosted_beats_the_mean(sides, boosted):
    train, test = sides
    mean = train.agg(F.avg(target())).first()[0]
    scored = boosted.transform(test).agg(
        F.avg(F.abs(F.col("prediction") - target())).alias("model"), F.avg(F.abs(F.lit(mean) - target())).alias("mean")
    ).first()
    assert scored["model"] < scored["mean"]


def test_reloaded_model_predicts_the_same(sides, boosted, tmp_path):
    _, test = sides
    reloaded = load_model(save_model(boosted, str(tmp_path / "model")))
    first = boosted.transform(test).select("ID", "prediction")
    assert first.exceptAll(reloaded.transform(test).select("ID", "prediction")).isEmpty()


def test_row_count_is_kept_when_scoring(spark, sf_dir, boosted):
    from eta_spark.catalog.base import raw

    orders = raw(spark, sf_dir)
    results = predict_eta(orders, boosted.transform)
    assert results.columns == [*orders.columns, "predicted_eta_min", "predicted_long_delivery", "distance_km"]
    assert results.count() == orders.count()
    assert results.filter("predicted_eta_min is null or predicted_eta_min < 0").isEmpty()


def test_shuffle_uses_every_order_once(sides):
    _, test = sides
    keyed = with_row_key(test).cache()
    pairs = shuffled_pairs(keyed, 2, 42, "_row_key")
    assert pairs.count() == 2 * keyed.count()
    given = keyed.groupBy("distance_km").count()
    for repeat in (1, 2):
        other = pairs.filter(F.col("repeat") == repeat).select("other.distance_km").groupBy("distance_km").count()
        assert given.exceptAll(other).isEmpty() and other.exceptAll(given).isEmpty()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 4097])
def test_donors_are_a_permutation(spark, n):
    numbers = spark.range(n).select(F.col("id").alias("position"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("repeat"))
    rows = with_donor(numbers, n, 42).collect()
    orders = {k: [r.donor for r in sorted(rows) if r.repeat == k] for k in (1, 2, 3)}
    assert all(sorted(o) == list(range(n)) for o in orders.values())
    if n >= 17:
        assert len({tuple(o) for o in orders.values()}) == 3
        # Few orders are their own donors, and neighbours part.
        assert sum(i == o for i, o in enumerate(orders[1])) <= 8
        assert sum(abs(a - b) == 1 for a, b in zip(orders[1], orders[1][1:], strict=False)) <= max(8, n // 50)


def test_copies_do_not_disturb_the_shuffle(sides):
    _, test = sides
    copied = test.unionByName(test.limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(600)))).drop("_copy"))
    keyed = with_row_key(copied)
    assert keyed.count() == copied.count() == keyed.select("_row_key").distinct().count()
    assert shuffled_pairs(keyed, 1, 42, "_row_key").count() == keyed.count()


def test_importance_does_not_depend_on_the_layout(sides):
    _, test = sides

    def score(orders):
        return orders.withColumn("prediction", F.coalesce("distance_km", F.lit(0.0)))

    def errors(table):
        return {(r.repeat, r.feature): r.mae for r in permuted_errors(table, score, repeats=2).collect()}

    first, again = errors(test), errors(test.repartition(5, "distance_km").sortWithinPartitions("distance_km"))
    assert len(first) == 2 * len(FEATURES) + 1
    assert again == pytest.approx(first)


def test_importance_ranks_used_features_first(sides, linear):
    _, test = sides
    rows = permutation_importance(test, linear.transform, "Cleaned", repeats=2).collect()
    assert len(rows) == len(FEATURES)
    assert {"Road_traffic_density", "multiple_deliveries", "distance_km"} & {r.feature for r in rows[:3]}
    assert rows[0].importance > 0.5


def test_scenarios_match_single_orders(spark, boosted):
    base = orders_from_rows(spark, [{"ID": "x", **BASE_ORDER}])
    report = {r.scenario: r for r in scenario_report(run_scenarios(base, boosted.transform)).collect()}
    assert set(report) == {name for name, _, _ in SCENARIOS}
    for name, _, changes in SCENARIOS:
        alone = predict_eta(orders_from_rows(spark, [{**BASE_ORDER, **changes}]), boosted.transform).first()
        assert report[name].predicted_eta_min == alone.predicted_eta_min
        assert report[name].distance_km == pytest.approx(alone.distance_km)
        assert report[name].multiple_deliveries == alone.multiple_deliveries
        change = alone.predicted_eta_min - report["Baseline"].predicted_eta_min
        assert report[name].eta_change_vs_baseline == pytest.approx(change)


def test_checks_flag_unwanted_behaviour(spark):
    base = orders_from_rows(spark, [{"ID": "x", **BASE_ORDER}])

    def backwards(orders):
        return orders.withColumn("prediction", 60 - F.col("distance_km") - 5 * F.col("multiple_deliveries"))

    status = {r.check: r.status for r in order_checks(base, backwards).collect()}
    assert status == {r.check: r.status for r in behaviour_checks(run_scenarios(base, backwards)).collect()}
    assert status == {
        "Low traffic <= baseline": "PASS",
        "Heavy traffic >= low traffic": "PASS",
        "Multiple deliveries >= baseline": "REVIEW",
        "Longer distance >= short distance": "REVIEW",
    }


def test_checks_keep_orders_without_own_id_apart(spark):
    orders = orders_from_rows(spark, [{"ID": i, **BASE_ORDER, "multiple_deliveries": n} for i, n in ((None, 1), (None, 2), ("x", 1), ("x", 3))])
    checks = order_checks(orders, lambda df: df.withColumn("prediction", F.col("distance_km") + F.col("multiple_deliveries")))
    assert checks.count() == 4 * 4
    assert "Exchange" not in checks._jdf.queryExecution().executedPlan().toString()


def test_weight_raises_long_predictions(orders):
    reports = training.tail_aware_experiment(orders, models.SMOKE, weight=5.0).reports
    rows = {r.model: r for r in reports["tail_aware_model_comparison"].collect()}
    assert rows["Tail-Aware"].long_delivery_signed_error > rows["Baseline"].long_delivery_signed_error
    assert reports["tail_aware_predictions"].count() > 0


def test_cleaning_experiment(orders):
    experiment = training.cleaning_experiment(orders, models.SMOKE, repeats=1)
    assert set(experiment.models) == {"eta_model_original", "eta_model_cleaned"}
    rows = experiment.reports["geo_cleaning_model_comparison"].collect()
    assert {(r.dataset, r.model) for r in rows} == {
        (d, m) for d in ("Original", "Cleaned") for m in (models.LINEAR, models.FOREST, models.BOOSTED)
    }
    effect = experiment.reports["geo_cleaning_effect"].first()
    assert effect.test_MAE_result in ("improved", "increased", "same")
    assert experiment.reports["cleaned_permutation_importance"].count() == len(FEATURES)


@pytest.mark.parametrize("validation", [training.temporal_validation, training.group_validation])
def test_validation_reports(orders, validation):
    reports = validation(orders, models.SMOKE).reports
    record = next(r for name, r in reports.items() if name.endswith("_validation")).first()
    predictions = next(r for name, r in reports.items() if name.endswith("_predictions"))
    assert predictions.count() == record.test_rows
    assert record.R2 > 0 and record.MAE < record.RMSE


def test_command_line(spark, sf_dir, tmp_path):
    from eta_spark.__main__ import parse, results_of
    from eta_spark.catalog.base import raw

    raw(spark, sf_dir).write.parquet(str(tmp_path / "orders"))
    common = ["--orders", str(tmp_path / "orders"), "--format", "parquet", "--output", str(tmp_path / "out")]
    delays = results_of(spark, parse(["analyze-delays", *common])).reports
    assert len(delays) == 3 + 16
    assert delays["delay_by_city"].columns == ["City", "count", "mean", "median", "std"]
    audit = results_of(spark, parse(["geo-audit", *common])).reports
    assert audit["geo_audit_summary"].count() == 1


def test_registered_importances_use_five_repeats(monkeypatch):
    import inspect
    from types import SimpleNamespace

    from eta_spark.catalog import modelling

    seen = []

    def caught(function):
        def call(*args, **kwargs):
            bound = inspect.signature(function).bind(*args, **kwargs)
            bound.apply_defaults()
            seen.append(bound.arguments["repeats"])
            raise InterruptedError

        return call

    monkeypatch.setattr(modelling, "_random_sides", lambda *_: (None, None))
    monkeypatch.setattr(modelling, "cleaned", lambda *_: None)
    monkeypatch.setattr(modelling.models, "fit_model", lambda *_: SimpleNamespace(transform=None))
    monkeypatch.setattr(modelling, "permutation_importance", caught(modelling.permutation_importance))
    monkeypatch.setattr(modelling.training, "model_matrix", caught(modelling.training.model_matrix))
    for query in (modelling.model_importance, modelling.experiment_matrix):
        with pytest.raises(InterruptedError):
            query(None, None)
    assert seen == [5, 5]


def test_fits_side_by_side_equal_single_ones(spark, sides):
    train, test = sides
    wanted = {"a": (models.BOOSTED, None), "b": (models.BOOSTED, 3.0), "c": (models.LINEAR, None)}
    tiny = models.Preset(boosted={"maxIter": 2, "maxDepth": 2})
    together = models.predict_many(test, *models.fit_many(train, wanted, tiny, at_once=3)).agg(*[F.sum(c) for c in wanted]).first()
    alone = models.predict_many(test, *models.fit_many(train, wanted, tiny, at_once=1)).agg(*[F.sum(c) for c in wanted]).first()
    assert tuple(together) == pytest.approx(tuple(alone))


def test_the_first_error_cancels_the_others(spark):
    import threading
    import time

    begun = threading.Event()

    def long():
        begun.set()
        slow = F.udf(lambda x: time.sleep(120) or x, "long")
        return spark.range(2).select(slow("id")).collect()

    def wrong():
        begun.wait(30)
        time.sleep(1)
        raise KeyError("wrong")

    started = time.time()
    with pytest.raises(KeyError):
        models.side_by_side(spark, {"long": long, "wrong": wrong}, 2)
    assert time.time() - started < 90

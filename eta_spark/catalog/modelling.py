"""Preparation, fitting and evaluation (F)."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eta_spark.catalog import base as b
from eta_spark.catalog.base import (
    SCORED_COLUMNS,
    cleaned,
    engineered,
    formula,
    formula_sql,
    group_test_scored,
    metrics_sql,
    r,
    random_test,
    register,
)
from eta_spark.functions.labels import is_long, tail_weight, target
from eta_spark.operators import errors, metrics, models, preparation, splits
from eta_spark.operators.importance import permutation_importance
from eta_spark.plans import training
from eta_spark.schema import CATEGORICAL_FEATURES, FEATURES, GROUP_COLUMN, NUMERIC_FEATURES, SWEEP_WEIGHTS, TARGET
from eta_spark.session import new_run_dir
from eta_spark.sources.model_store import load_model, save_model

SMOKE = models.SMOKE


def _random_sides(spark, sf_dir):
    return splits.split_tables(splits.random_split(cleaned(spark, sf_dir)))


def _group_sides(spark, sf_dir):
    return splits.split_tables(splits.group_split(cleaned(spark, sf_dir)))


# --- preparation statistics -----------------------------------------------------------------------

TRAIN_SQL = "(SELECT * FROM rnd WHERE split = 'train')"


@register(
    "f01_median_imputer",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS n_rows, count({c}) AS observed, {r(f'median({c})', 'median')} FROM {TRAIN_SQL}"
        for c in NUMERIC_FEATURES
    ),
)
def median_imputer(spark, sf_dir):
    train, _ = _random_sides(spark, sf_dir)
    statistics = preparation.numeric_statistics(train)
    return statistics.select("feature", F.col("rows").alias("n_rows"), "observed", "median")


def _filled(c: str) -> str:
    return f"coalesce({c}, (SELECT median({c}) FROM {TRAIN_SQL}))"


@register(
    "f02_standard_scaler",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({_filled(c)})', 'mean')}, {r(f'stddev_pop({_filled(c)})', 'scale')} FROM {TRAIN_SQL}"
        for c in NUMERIC_FEATURES
    ),
)
def standard_scaler(spark, sf_dir):
    train, _ = _random_sides(spark, sf_dir)
    return preparation.numeric_statistics(train).select("feature", "mean", "scale")


@register(
    "f03_mode_imputer",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT {c} FROM {TRAIN_SQL} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode"
        for c in CATEGORICAL_FEATURES
    ),
)
def mode_imputer(spark, sf_dir):
    train, _ = _random_sides(spark, sf_dir)
    return preparation.category_modes(train)


@register(
    "f04_one_hot_levels",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n_rows FROM {TRAIN_SQL} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORICAL_FEATURES
    ),
)
def one_hot_levels(spark, sf_dir):
    """Orders per level, read back from the one-hot vectors of the training side."""
    train, _ = _random_sides(spark, sf_dir)
    prepared = preparation.fit_preparation(train)
    indexer = prepared.stages[1]
    encoded = prepared.transform(train)
    cells = []
    for c, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray):
        slots = vector_to_array(f"{c}_onehot")
        # Filled-in gaps also set a slot; only given values are counted.
        cells += [
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(level).alias("level"),
                F.when(F.col(c).isNotNull(), slots[i]).otherwise(0.0).alias("set"),
            )
            for i, level in enumerate(labels)
        ]
    return (
        encoded.select(F.inline(F.array(*cells)))
        .groupBy("feature", "level")
        .agg(F.sum("set").cast("long").alias("n_rows"))
    )


@register(
    "f05_design_vector",
    "SELECT count(*) AS n_rows, 9 + "
    + " + ".join(f"(SELECT count(DISTINCT {c}) FROM {TRAIN_SQL})" for c in CATEGORICAL_FEATURES)
    + " AS vector_size, 0 + count(*) FILTER (WHERE FALSE) AS bad_sums FROM rnd WHERE split = 'test'",
)
def design_vector(spark, sf_dir):
    """Every test order has one vector slot per level and one set slot per category."""
    train, test = _random_sides(spark, sf_dir)
    prepared = preparation.fit_preparation(train)
    vector = vector_to_array(preparation.VECTOR)
    hot = F.aggregate(F.slice(vector, 10, F.size(vector)), F.lit(0.0), lambda total, x: total + x)
    return prepared.transform(test).agg(
        F.count("*").alias("n_rows"),
        F.max(F.size(vector)).alias("vector_size"),
        F.count_if(hot != len(CATEGORICAL_FEATURES)).alias("bad_sums"),
    )


# --- fitted models --------------------------------------------------------------------------------


@register(
    "f06_linear_regression",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n_rows, {r('avg(minutes)', 'mean_actual')}, {r('avg(minutes)', 'mean_predicted')} "
        f"FROM {TRAIN_SQL} WHERE {c} IS NOT NULL AND {c} <> (SELECT {c} FROM {TRAIN_SQL} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) GROUP BY {c}"
        for c in CATEGORICAL_FEATURES
    ),
)
def linear_regression(spark, sf_dir):
    """Least squares leaves no mean residual in any level, which SQL can check without the coefficients."""
    train, _ = _random_sides(spark, sf_dir)
    fitted = models.fit_model(train, models.LINEAR, SMOKE).transform(train)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("level")) for c in CATEGORICAL_FEATURES]
    # The most frequent level also absorbs the filled-in gaps, so it is left out.
    modes = preparation.category_modes(train)
    return (
        fitted.select(F.inline(F.array(*rows)), target().alias("actual"), "prediction")
        .filter(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.count("*").alias("n_rows"), F.avg("actual").alias("mean_actual"), F.avg("prediction").alias("mean_predicted"))
        .join(modes, "feature")
        .filter(F.col("level") != F.col("mode"))
        .drop("mode")
    )


def _quality(spark, sf_dir, name):
    """Does the model beat always answering the training mean?"""
    train, test = _random_sides(spark, sf_dir)
    model = models.fit_model(train, name, SMOKE)
    mean = train.agg(F.avg(target())).scalar()
    scored = model.transform(test)
    return scored.select(target().alias("actual"), "prediction", mean.alias("mean")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.abs("prediction") < 1000).alias("finite_predictions"),
        (F.avg(F.abs(F.col("prediction") - F.col("actual"))) < F.avg(F.abs(F.col("mean") - F.col("actual")))).alias(
            "beats_mean"
        ),
    )


QUALITY_SQL = "SELECT count(*) AS n_rows, count(*) AS finite_predictions, TRUE AS beats_mean FROM rnd WHERE split = 'test'"


@register("f07_random_forest", QUALITY_SQL)
def random_forest(spark, sf_dir):
    return _quality(spark, sf_dir, models.FOREST)


@register("f08_boosted_trees", QUALITY_SQL)
def boosted_trees(spark, sf_dir):
    return _quality(spark, sf_dir, models.BOOSTED)


@register(
    "f09_weighted_fit",
    f"""SELECT is_long AS is_long_delivery, count(*) AS n_rows, {r('sum(CASE WHEN is_long THEN 3e0 ELSE 1e0 END)', 'total_weight')},
 TRUE AS predicted_higher FROM grouped WHERE split = 'train' GROUP BY 1""",
)
def weighted_fit(spark, sf_dir):
    """Weighting long deliveries raises what is predicted for them, and for the others."""
    train, _ = _group_sides(spark, sf_dir)
    wanted = {"plain": (models.BOOSTED, None), "weighted": (models.BOOSTED, 3.0)}
    scored = models.predict_many(train, *models.fit_many(train, wanted, SMOKE))
    return scored.groupBy(is_long(target()).alias("is_long_delivery")).agg(
        F.count("*").alias("n_rows"),
        F.sum(tail_weight(target(), 3.0)).alias("total_weight"),
        (F.avg("weighted") > F.avg("plain")).alias("predicted_higher"),
    )


@register(
    "f10_batch_predict_by_formula",
    f"""SELECT ID, {r('minutes', 'minutes')}, is_long AS is_long_delivery, {r('p', 'predicted')}, {r('p - minutes', 'error')}, {r('abs(p - minutes)', 'absolute_error')}
 FROM (SELECT *, {formula_sql()} AS p FROM rnd WHERE split = 'test')""",
)
def formula_batch_predict(spark, sf_dir):
    """A stored pipeline whose last stage is the formula, loaded and run over the test orders."""
    pipeline = PipelineModel([SQLTransformer(statement=f"SELECT *, {formula_sql()} AS prediction FROM __THIS__")])
    model = load_model(save_model(pipeline, new_run_dir(spark, "f10")))
    scored = model.transform(random_test(spark, sf_dir))
    return errors.prediction_table(scored).select("ID", target().alias("minutes"), "is_long_delivery", "predicted", "error", "absolute_error")


BATCH_SQL = f"SELECT ID, {r('minutes', 'minutes')}, is_long AS is_long_delivery, TRUE AS error_agrees FROM rnd WHERE split = 'test'"


@register("f10_batch_predict_of_model", BATCH_SQL)
@register("f10_batch_predict", BATCH_SQL)
def batch_predict(spark, sf_dir):
    train, test = _random_sides(spark, sf_dir)
    scored = models.fit_model(train, models.LINEAR, SMOKE).transform(test)
    agrees = F.col("error") == F.col("predicted") - target()
    return errors.prediction_table(scored).select(
        "ID", target().alias("minutes"), "is_long_delivery", agrees.alias("error_agrees")
    )


def _exact_metrics(actual: str, predicted: str) -> str:
    e = f"({predicted} - {actual})"
    long = f"FILTER (WHERE {actual} >= 45)"
    return (
        f"avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse, 1 - sum({e} * {e}) / (var_pop({actual}) * count(*)) AS r2, "
        f"avg(abs({e})) {long} AS tail_mae"
    )


# --- evaluation -----------------------------------------------------------------------------------


@register(
    "f11_regression_metrics",
    f"""SELECT {r('avg(abs(p - minutes))', 'MAE')}, {r('sqrt(avg((p - minutes) * (p - minutes)))', 'RMSE')},
 {r('1 - sum((p - minutes) * (p - minutes)) / (var_pop(minutes) * count(*))', 'R2')}
 FROM (SELECT minutes, {formula_sql()} AS p FROM rnd WHERE split = 'test')""",
)
def regression_metrics(spark, sf_dir):
    scored = formula(random_test(spark, sf_dir))
    return scored.agg(*metrics.regression_measures(target(), F.col("prediction")))


@register("f12_tail_metrics", f"SELECT {metrics_sql()} FROM scored")
def tail_metrics(spark, sf_dir):
    return metrics.evaluate(group_test_scored(spark, sf_dir), target(), F.col("prediction"))


def _donor_sql(repeat: int) -> str:
    """The keyed bijection over a rectangle of a rows and b columns, walked until it lands below n."""

    def draw(turn: int, value: str) -> str:
        return f"('0x' || substr(md5('42:{repeat}:{turn}:' || ({value})::VARCHAR), 1, 8))::BIGINT"

    def turned(x: str) -> str:
        row, column = f"(({x}) // b)", f"(({x}) % b)"
        row1 = f"(({row} + {draw(1, column)}) % a)"
        column1 = f"(({column} + {draw(2, row1)}) % b)"
        row2 = f"(({row1} + {draw(3, column1)}) % a)"
        return f"({row2} * b + ({column1} + {draw(4, row2)}) % b)"

    return f"list_reduce(list_prepend({turned('pos')}, range(32)), lambda x, i: CASE WHEN x < n THEN x ELSE {turned('x')} END) AS donor{repeat}"


def _importance_sql(repeats: int) -> str:
    """The permutation check for the three features that the formula reads; each order gets its donor's value."""
    parts = []
    for k in range(1, repeats + 1):
        for feature in FEATURES:
            used = {c: f"b.{c}" for c in ("distance_km", "Road_traffic_density", "multiple_deliveries")}
            if feature in used:
                used[feature] = f"d.{feature}"
            parts.append(
                f"SELECT '{feature}' AS feature, {k} AS k, avg(abs(p - minutes)) - avg(abs(q - minutes)) AS rise FROM ("
                f"SELECT minutes, q, {formula_sql()} AS p FROM (SELECT b.minutes, b.q, "
                + ", ".join(f"{v} AS {c}" for c, v in used.items())
                + f" FROM asked b JOIN asked d ON b.donor{k} = d.pos))"
            )
    return (
        f", placed AS (SELECT *, {formula_sql()} AS q, row_number() OVER (ORDER BY md5('42:0:'||ID), ID) - 1 AS pos FROM rnd WHERE split = 'test'), "
        "side AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM placed), box AS (SELECT n, a, (n + a - 1) // a AS b FROM side), "
        f"asked AS MATERIALIZED (SELECT placed.*, {', '.join(_donor_sql(k) for k in range(1, repeats + 1))} FROM placed, box) "
        f"SELECT feature, {r('avg(rise)', 'importance')}, {r('stddev_pop(rise)', 'importance_std')}, "
        f"'Cleaned' AS dataset FROM ({' UNION ALL '.join(parts)}) GROUP BY feature"
    )


@register("f13_permutation_importance", _importance_sql(5))
def importance(spark, sf_dir):
    return permutation_importance(random_test(spark, sf_dir), formula, "Cleaned", key="ID")


@register("f13_permutation_importance_of_model")
def model_importance(spark, sf_dir):
    train, test = _random_sides(spark, sf_dir)
    model = models.fit_model(train, models.LINEAR, SMOKE)
    return permutation_importance(test, model.transform, "Cleaned")


def _measures(table: str, model: str, dataset: str, lift: float) -> str:
    return f"SELECT '{model}' AS model, '{dataset}' AS dataset, {r('mae', 'MAE')}, {r('rmse', 'RMSE')}, {r('r2', 'R2')} FROM (SELECT {_exact_metrics('minutes', formula_sql(lift))} FROM {table})"


LIFTS = {models.LINEAR: 0.0, models.FOREST: 2.0, models.BOOSTED: 4.0}


@register(
    "f14_experiment_table",
    " UNION ALL ".join(_measures(table, m, dataset, lift) for dataset, table in (("Original", "eng"), ("Cleaned", "clean")) for m, lift in LIFTS.items()),
)
def experiment_table(spark, sf_dir):
    """The table of the experiments, three formulas in place of the models."""

    def measured(orders, dataset):
        columns = {}
        for i, (name, lift) in enumerate(LIFTS.items()):
            orders = formula(orders, lift, f"estimate{i}")
            columns[name] = f"estimate{i}"
        return training.comparison_table(orders, columns, dataset)

    return measured(engineered(spark, sf_dir), "Original").unionByName(measured(cleaned(spark, sf_dir), "Cleaned"))


@register(
    "f14_experiment_matrix",
    "SELECT m AS model, 'Cleaned' AS dataset, TRUE AS in_range FROM (VALUES ('Linear Regression'), ('Random Forest'), ('Boosted Trees')) AS t(m)",
)
def experiment_matrix(spark, sf_dir):
    table = training.model_matrix(cleaned(spark, sf_dir), "Cleaned", SMOKE).reports["model_comparison"]
    return table.select("model", "dataset", ((F.col("R2") > 0) & (F.col("MAE") < F.col("RMSE"))).alias("in_range"))


@register(
    "f15_dataset_comparison",
    f""", o AS (SELECT {_exact_metrics('minutes', formula_sql())} FROM eng),
 c AS (SELECT {_exact_metrics('minutes', formula_sql())} FROM clean)
 SELECT 'Formula' AS model, {r('(c.mae - o.mae) / o.mae * 100', 'MAE_change_pct')}, {r('(c.rmse - o.rmse) / o.rmse * 100', 'RMSE_change_pct')},
 {r('c.r2 - o.r2', 'R2_change')}, CASE WHEN c.mae < o.mae THEN 'improved' WHEN c.mae > o.mae THEN 'increased' ELSE 'same' END AS test_MAE_result
 FROM o, c""",
)
def dataset_comparison(spark, sf_dir):
    def measured(orders, dataset):
        table = metrics.evaluate(formula(orders), target(), F.col("prediction"))
        return table.withColumns({"model": F.lit("Formula"), "dataset": F.lit(dataset)})

    both = measured(engineered(spark, sf_dir), "Original").unionByName(measured(cleaned(spark, sf_dir), "Cleaned"))
    return metrics.cleaning_effect(both, "Formula")


def _record_sql(table: str) -> str:
    sides = []
    for side in ("train", "test"):
        where = f"FROM {table} WHERE split = '{side}'"
        sides += [
            f"(SELECT count(*) {where}) AS {side}_rows",
            f"(SELECT count(DISTINCT Delivery_person_ID) {where}) AS {side}_riders",
            f"(SELECT count(DISTINCT order_day) {where}) AS {side}_days",
            f"(SELECT CAST(min(order_day) AS VARCHAR) {where}) AS {side}_first_day",
            f"(SELECT CAST(max(order_day) AS VARCHAR) {where}) AS {side}_last_day",
        ]
    return f"SELECT {', '.join(sides)}, {metrics_sql('minutes', formula_sql())} FROM {table} WHERE split = 'test'"


def _record(labelled):
    _, test = splits.split_tables(labelled)
    return training.validation_record(labelled, formula(test))


@register("f16_temporal_validation", _record_sql("temporal"))
def temporal_validation(spark, sf_dir):
    return _record(splits.temporal_split(cleaned(spark, sf_dir, SCORED_COLUMNS)))


@register("f17_group_validation", _record_sql("grouped"))
def group_validation(spark, sf_dir):
    return _record(splits.group_split(cleaned(spark, sf_dir, SCORED_COLUMNS)))


@register(
    "f18_tail_aware_effect",
    f""", a AS (SELECT {_exact_metrics('minutes', 'predicted')} FROM scored),
 t AS (SELECT {_exact_metrics('minutes', formula_sql(2.0))} FROM scored)
 SELECT {r('t.mae - a.mae', 'MAE_change')}, {r('(a.mae - t.mae) / a.mae * 100', 'MAE_improvement_pct')},
 {r('t.rmse - a.rmse', 'RMSE_change')}, {r('(a.rmse - t.rmse) / a.rmse * 100', 'RMSE_improvement_pct')},
 {r('t.tail_mae - a.tail_mae', 'long_MAE_change')}, {r('(a.tail_mae - t.tail_mae) / a.tail_mae * 100', 'long_MAE_improvement_pct')},
 CASE WHEN t.tail_mae < a.tail_mae AND (t.mae - a.mae) / a.mae * 100 <= 1 THEN 'promising'
 WHEN t.tail_mae < a.tail_mae THEN 'trade-off' ELSE 'keep baseline' END AS verdict FROM a, t""",
)
def tail_aware_effect(spark, sf_dir):
    both = formula(group_test_scored(spark, sf_dir), 2.0, "tail_prediction")
    table = metrics.evaluate_models(both, target(), {"Baseline": "prediction", "Tail-Aware": "tail_prediction"})
    return metrics.tail_effect(table, "Baseline", "Tail-Aware")


@register(
    "f18_tail_aware_comparison",
    f"""SELECT 'Baseline' AS model, {metrics_sql()}, 'distance<=50km and coordinate differences<=5deg' AS geographic_cleaning FROM scored
 UNION ALL SELECT 'Tail-Aware', {metrics_sql('minutes', formula_sql(2.0))}, 'distance<=50km and coordinate differences<=5deg' FROM scored""",
)
def tail_aware_comparison(spark, sf_dir):
    both = formula(group_test_scored(spark, sf_dir), 2.0, "tail_prediction")
    table = metrics.evaluate_models(both, target(), {"Baseline": "prediction", "Tail-Aware": "tail_prediction"})
    return metrics.with_cleaning_rule(table)


@register(
    "f19_paired_predictions_by_formula",
    f"""SELECT ID, Delivery_person_ID, {r('minutes', 'minutes')}, is_long AS is_long_delivery, {r('p', 'baseline_prediction')}, {r('t', 'tail_aware_prediction')},
 {r('p - minutes', 'baseline_error')}, {r('t - minutes', 'tail_aware_error')}
 FROM (SELECT *, {formula_sql()} AS p, {formula_sql(2.0)} AS t FROM grouped WHERE split = 'test')""",
)
def formula_paired_predictions(spark, sf_dir):
    """The report over two formulas in place of the models."""
    both = formula(group_test_scored(spark, sf_dir), 2.0, "tail_prediction")
    return errors.paired_predictions(both, "prediction", "tail_prediction").withColumnRenamed(TARGET, "minutes")


PAIRED_SQL = f"SELECT ID, Delivery_person_ID, {r('minutes', 'minutes')}, is_long AS is_long_delivery, TRUE AS errors_agree FROM grouped WHERE split = 'test'"


@register("f19_paired_predictions_of_models", PAIRED_SQL)
@register("f19_paired_predictions", PAIRED_SQL)
def paired_predictions(spark, sf_dir):
    experiment = training.tail_aware_experiment(engineered(spark, sf_dir), SMOKE)
    pairs = experiment.reports["tail_aware_predictions"]
    agree = (F.col("baseline_error") == F.col("baseline_prediction") - target()) & (
        F.col("tail_aware_error") == F.col("tail_aware_prediction") - target()
    )
    return pairs.select("ID", GROUP_COLUMN, target().alias("minutes"), "is_long_delivery", agree.alias("errors_agree"))


FITTED_SWEEP_SQL = f"""SELECT w AS long_delivery_weight, (SELECT count(*) FROM scored WHERE is_long) AS long_delivery_count
 FROM (VALUES {', '.join(f'({w}e0)' for w in SWEEP_WEIGHTS)}) AS t(w)"""


@register("f20_weight_sweep_of_models", FITTED_SWEEP_SQL)
@register("f20_weight_sweep", FITTED_SWEEP_SQL)
def weight_sweep(spark, sf_dir):
    sweep = training.weight_sweep(engineered(spark, sf_dir), SMOKE).reports["tail_weight_sweep"]
    return sweep.select("long_delivery_weight", "long_delivery_count")


def _lift(weight: float) -> float:
    return (weight - 1) * 4


def _formula_sweep(spark, sf_dir):
    """A sweep whose estimates rise with the weight by a fixed rule."""
    scored = group_test_scored(spark, sf_dir)
    columns = {w: f"weight_{i}" for i, w in enumerate(SWEEP_WEIGHTS)}
    for weight, column in columns.items():
        scored = formula(scored, _lift(weight), column)
    return training.sweep_table(scored, columns)


SWEEP_SQL = ", sweep AS (" + " UNION ALL ".join(
    f"SELECT {w}e0 AS w, {_exact_metrics('minutes', formula_sql(_lift(w)))} FROM scored" for w in SWEEP_WEIGHTS
) + "), one AS (SELECT * FROM sweep WHERE w = 1) "


@register(
    "f20_weight_sweep_by_formula",
    " UNION ALL ".join(f"SELECT {w}e0 AS long_delivery_weight, {metrics_sql('minutes', formula_sql(_lift(w)))} FROM scored" for w in SWEEP_WEIGHTS),
)
def formula_weight_sweep(spark, sf_dir):
    """All metrics of each weight, the rule in place of the fitted models."""
    return _formula_sweep(spark, sf_dir)


@register(
    "f21_sweep_deltas",
    SWEEP_SQL
    + f"""SELECT sweep.w AS long_delivery_weight, {r('sweep.mae - one.mae', 'MAE_change_vs_baseline')}, {r('sweep.rmse - one.rmse', 'RMSE_change_vs_baseline')},
 {r('sweep.tail_mae - one.tail_mae', 'long_MAE_change_vs_baseline')}, {r('(one.tail_mae - sweep.tail_mae) / one.tail_mae * 100', 'long_MAE_improvement_pct')}
 FROM sweep, one""",
)
def sweep_deltas(spark, sf_dir):
    deltas = metrics.sweep_deltas(_formula_sweep(spark, sf_dir))
    return deltas.select(
        "long_delivery_weight",
        "MAE_change_vs_baseline",
        "RMSE_change_vs_baseline",
        "long_MAE_change_vs_baseline",
        "long_MAE_improvement_pct",
    )


@register(
    "f22_constrained_selection",
    SWEEP_SQL
    + f"""SELECT sweep.w AS long_delivery_weight, {r('sweep.mae', 'MAE')}, {r('sweep.tail_mae', 'long_delivery_MAE')} FROM sweep, one
 WHERE sweep.mae <= one.mae * 1.01e0 ORDER BY sweep.tail_mae, sweep.w LIMIT 1""",
)
def constrained_selection(spark, sf_dir):
    chosen = metrics.select_weight(_formula_sweep(spark, sf_dir))
    return chosen.select("long_delivery_weight", "MAE", "long_delivery_MAE")


@register(
    "f23_final_fit",
    """SELECT count(*) AS training_rows, count(*) AS predicted_rows FROM clean""",
)
def final_fit(spark, sf_dir):
    orders = engineered(spark, sf_dir)
    experiment = training.final_fit(orders, SMOKE)
    model = experiment.models["eta_model_final_tail_aware"]
    scored = model.transform(cleaned(spark, sf_dir)).agg(
        F.count("*").alias("n"), F.count_if(F.abs("prediction") < 1000).alias("predicted_rows")
    )
    record = experiment.reports["final_model_configuration"].select("training_rows")
    return record.join(scored, F.col("training_rows") == F.col("n")).drop("n")

"""Imputation, scaling and one-hot encoding, fitted on training orders."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eta_spark.operators.quantiles import exact_quantiles
from eta_spark.operators.splits import check_group_not_a_feature
from eta_spark.schema import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES

VECTOR = "features"


def _stacked(df: DataFrame, columns: list[str], dtype: str, value: str) -> DataFrame:
    return df.select(*[F.col(c).cast(dtype).alias(c) for c in columns]).unpivot([], columns, "feature", value)


def numeric_statistics(train: DataFrame) -> DataFrame:
    """Per numeric feature: the median, and mean and population deviation after filling with it."""
    # All features side by side in one scan; only the narrowing of the medians stacks them.
    measures = []
    for c in NUMERIC_FEATURES:
        value = F.col(c).cast("double")
        usable = F.when(~F.isnan(value), value)
        measures.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.count("*").alias("rows"),
                F.count(value).alias("observed"),
                F.avg(value).alias("raw_mean"),
                F.var_pop(value).alias("raw_variance"),
                F.min(usable).alias("low"),
                F.max(usable).alias("high"),
                F.count(usable).alias("usable"),
            ).alias(c)
        )
    scanned = train.agg(*measures).select(F.inline(F.array(*[F.col(c) for c in NUMERIC_FEATURES]))).collect()  # nine rows
    found = [row for row in scanned if row.rows]
    observed = train.sparkSession.createDataFrame(
        [tuple(row[:5]) for row in found], "feature string, rows long, observed long, raw_mean double, raw_variance double"
    )
    whole = [(row.feature, row.low, row.high, row.usable) for row in found if row.usable]
    stacked = _stacked(train, NUMERIC_FEATURES, "double", "value")
    medians = exact_quantiles(stacked, F.col("value"), [0.5], ["feature"], ["median"], whole)
    filled = F.col("rows") - F.col("observed")
    mean = (F.col("observed") * F.col("raw_mean") + filled * F.col("median")) / F.col("rows")

    def shifted(centre):
        return (centre - F.col("mean")) * (centre - F.col("mean"))

    variance = (
        F.col("observed") * (F.col("raw_variance") + shifted(F.col("raw_mean"))) + filled * shifted(F.col("median"))
    ) / F.col("rows")
    return (
        observed.join(medians, "feature", "left")
        .withColumn("mean", mean)
        .withColumn("deviation", F.sqrt(variance))
        # A constant feature is centred and left unscaled.
        .withColumn("scale", F.when(F.col("deviation") == 0, 1.0).otherwise(F.col("deviation")))
        .select("feature", "rows", "observed", "median", "mean", "scale")
    )


def category_levels(train: DataFrame) -> DataFrame:
    """Row count of each (feature, level)."""
    return (
        _stacked(train, CATEGORICAL_FEATURES, "string", "level")
        .filter(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.count("*").alias("rows"))
    )


def _mode() -> Column:
    best = F.min(F.struct((-F.col("rows")).alias("order"), F.col("level").alias("level")))
    return best["level"].alias("mode")


def category_modes(train: DataFrame) -> DataFrame:
    """Most frequent level per feature; the smallest text wins ties."""
    return category_levels(train).groupBy("feature").agg(_mode())


def _number(value: float | None) -> str:
    return f"CAST('{0.0 if value is None else value!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_and_scale(train: DataFrame) -> tuple[SQLTransformer, DataFrame]:
    """A stage with the fitted values written into its SELECT, saved with the model, and a table of all levels that
    the filled categories then have, as long as the longest list of them.
    """
    parts = []
    statistics = numeric_statistics(train).collect()  # nine rows
    for row in statistics:
        filled = f"COALESCE(CAST(`{row.feature}` AS DOUBLE), {_number(row.median)})"
        parts.append(f"({filled} - {_number(row.mean)}) / {_number(row.scale)} AS `{row.feature}_scaled`")
    given = category_levels(train).groupBy("feature").agg(_mode(), F.collect_list("level").alias("levels"))
    found = {row.feature: row for row in given.collect()}  # six rows; the one-hot vector has a slot for each level anyway
    levels = []
    for name in CATEGORICAL_FEATURES:
        mode = found[name].mode if name in found else "missing"
        parts.append(f"COALESCE(CAST(`{name}` AS STRING), {_text(mode)}) AS `{name}_filled`")
        filled = found[name].levels if name in found else ["missing"] if statistics else []
        levels.append(filled)
    longest = max(map(len, levels))
    rows = [tuple(filled[i if i < len(filled) else 0] for filled in levels) for i in range(longest)]
    table = train.sparkSession.createDataFrame(rows, ", ".join(f"`{name}_filled` string" for name in CATEGORICAL_FEATURES))
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), table


def fit_preparation(train: DataFrame) -> PipelineModel:
    """Numeric and categorical branches joined in one vector.

    'keep' gives unseen levels an extra index; dropping the last slot makes
    them all-zero while every seen level keeps its own slot.
    """
    check_group_not_a_feature(FEATURES)
    filled = [f"{c}_filled" for c in CATEGORICAL_FEATURES]
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_onehot" for c in CATEGORICAL_FEATURES]
    filler, levels = fill_and_scale(train)
    stages = [
        filler,
        StringIndexer(inputCols=filled, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc").fit(levels),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=[f"{c}_scaled" for c in NUMERIC_FEATURES] + encoded, outputCol=VECTOR),
    ]
    return Pipeline(stages=stages).fit(train)

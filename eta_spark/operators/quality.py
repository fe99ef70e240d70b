"""Geographic audit, cleaning and the comparison of original with cleaned orders.

Every report reads the engineered orders of ``features.build_features``.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eta_spark.functions import geography as geo
from eta_spark.functions.bands import AUDIT_DISTANCE, distance_group
from eta_spark.functions.labels import target
from eta_spark.operators.quantiles import column_label, exact_quantiles, weighted_moments
from eta_spark.schema import COORDINATES, DISTANCE_QUANTILES, MAX_DISTANCE_KM, TARGET
from eta_spark.sources.deliveries import select_present

DISTANCE = "distance_km"

# Report columns.
EXTREME_COLUMNS = [
    "ID",
    "Delivery_person_ID",
    "Restaurant_latitude",
    "Restaurant_longitude",
    "Delivery_location_latitude",
    "Delivery_location_longitude",
    "distance_km",
    "Order_Date",
    "Time_taken(min)",
    "Road_traffic_density",
    "Weatherconditions",
    "multiple_deliveries",
    "City",
]
ANOMALY_COLUMNS = ["geo_outlier", "extreme_latitude_difference", "extreme_longitude_difference"]


def rows_of(one_row: DataFrame, *rows: Column) -> DataFrame:
    """Turns a one-row aggregate into report rows, one per struct."""
    return one_row.select(F.inline(F.array(*rows)))


# --- cleaning -------------------------------------------------------------------------------------


def with_anomaly_flags(orders: DataFrame) -> DataFrame:
    return orders.withColumns(geo.anomaly_flags())


def clean_geography(orders: DataFrame) -> DataFrame:
    """Removes flagged orders. An order of unknown distance is kept."""
    return orders.filter(~geo.is_anomaly())


def removed_by_cleaning(orders: DataFrame) -> DataFrame:
    return orders.filter(geo.is_anomaly())


def cleaning_candidates(orders: DataFrame) -> DataFrame:
    """All flagged orders, farthest first."""
    flagged = removed_by_cleaning(with_anomaly_flags(orders))
    return select_present(flagged, EXTREME_COLUMNS + ANOMALY_COLUMNS).orderBy(F.desc_nulls_last(DISTANCE), "ID")


def extreme_orders(orders: DataFrame) -> DataFrame:
    # A bare comparison, so that the scan can skip row groups; it drops unknown distances as well.
    return orders.filter(F.col(DISTANCE) > MAX_DISTANCE_KM)


def farthest_orders(orders: DataFrame, k: int = 200) -> DataFrame:
    ranked = select_present(extreme_orders(orders), EXTREME_COLUMNS)
    return ranked.orderBy(F.desc_nulls_last(DISTANCE), "ID").limit(k)


# --- audit ----------------------------------------------------------------------------------------


def coordinate_profile(orders: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and missing count of each coordinate, from one scan."""
    measures = {"minimum": F.min, "maximum": F.max, "mean": F.avg, "missing": lambda c: F.count_if(F.col(c).isNull())}
    one = orders.agg(*[f(c).alias(f"{c}:{m}") for c in COORDINATES for m, f in measures.items()])
    return rows_of(
        one,
        *[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}:{m}`").alias(m) for m in measures]) for c in COORDINATES],
    )


def validity_counts(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_if(geo.invalid_latitude()).alias("invalid_latitude_rows"),
        F.count_if(geo.invalid_longitude()).alias("invalid_longitude_rows"),
        F.count_if(geo.invalid_latitude() | geo.invalid_longitude()).alias("invalid_coordinate_rows"),
    )


def _whole_table(orders: DataFrame) -> DataFrame:
    return orders.withColumn("_all", F.lit("all"))


def distance_quantiles(orders: DataFrame, probs: list[float] = DISTANCE_QUANTILES) -> DataFrame:
    """One row per probability, linearly interpolated."""
    names = [column_label(p) for p in probs]
    one = exact_quantiles(_whole_table(orders), F.col(DISTANCE), probs, ["_all"], names)
    return rows_of(
        one,
        *[F.struct(F.lit(float(p)).alias("quantile"), F.col(n).alias(DISTANCE)) for p, n in zip(probs, names)],
    )


def median_distance(orders: DataFrame) -> Column:
    """The median as a scalar subquery."""
    return exact_quantiles(_whole_table(orders), F.col(DISTANCE), [0.5], ["_all"], ["median"]).select("median").scalar()


def over_counts(thresholds: list[int]) -> list[Column]:
    return [F.count_if(geo.farther_than(t)).alias(f"distance_over_{t}km") for t in thresholds]


def distance_summary(orders: DataFrame) -> DataFrame:
    one = orders.agg(
        F.avg(DISTANCE).alias("mean"),
        F.stddev_samp(DISTANCE).alias("std"),
        F.min(DISTANCE).alias("minimum"),
        F.max(DISTANCE).alias("maximum"),
        *over_counts([15, 50, 100, 200]),
    )
    return one.withColumn("median", median_distance(orders))


def distance_distribution(orders: DataFrame) -> DataFrame:
    """The nine bands, empty ones included; percentages are of all orders."""
    banded = orders.select(AUDIT_DISTANCE.label(F.col(DISTANCE)).alias("distance_bucket"), DISTANCE)
    counted = (
        banded.groupBy("distance_bucket")
        .agg(F.count("*").alias("orders"), F.avg(DISTANCE).alias("mean_distance_km"))
        # Orders without a distance count in the total, so it is taken before they are dropped.
        .withColumn("_total", F.sum("orders").over(Window.partitionBy()))
        .filter(F.col("distance_bucket").isNotNull())
    )
    medians = exact_quantiles(
        banded.filter(F.col("distance_bucket").isNotNull()),
        F.col(DISTANCE),
        [0.5],
        ["distance_bucket"],
        ["median_distance_km"],
    )
    return (
        AUDIT_DISTANCE.table(orders.sparkSession, "distance_bucket")
        .join(counted, "distance_bucket", "left")
        .join(medians, "distance_bucket", "left")
        .select(
            "position",
            "distance_bucket",
            F.coalesce("orders", F.lit(0)).alias("orders"),
            "mean_distance_km",
            "median_distance_km",
            F.coalesce(F.col("orders") / F.col("_total") * 100, F.lit(0.0)).alias("percentage"),
        )
        .orderBy("position")
    )


def distance_impact(orders: DataFrame) -> DataFrame:
    """Near, middle, far and unknown orders."""
    grouped = orders.withColumn("distance_group", distance_group(F.col(DISTANCE)))
    counted = (
        grouped.groupBy("distance_group")
        .agg(
            F.count("*").alias("orders"),
            F.avg(DISTANCE).alias("mean_distance_km"),
            F.avg(target()).alias("mean_delivery_minutes"),
        )
        .withColumn("percentage", F.col("orders") / F.sum("orders").over(Window.partitionBy()) * 100)
    )
    medians = exact_quantiles(grouped, F.col(DISTANCE), [0.5], ["distance_group"], ["median_distance_km"])
    return counted.join(medians, "distance_group", "left").select(
        "distance_group",
        "orders",
        "mean_distance_km",
        "median_distance_km",
        "mean_delivery_minutes",
        "percentage",
    )


def coordinate_gap_profile(orders: DataFrame) -> DataFrame:
    """Count, moments, extremes and quantiles of the two coordinate gaps."""
    gaps = {"latitude_difference": geo.latitude_gap(), "longitude_difference": geo.longitude_gap()}
    long_form = orders.select(*[g.alias(n) for n, g in gaps.items()]).unpivot([], list(gaps), "metric", "gap")
    probs = [0.50, 0.75, 0.90, 0.95, 0.99]
    moments = long_form.groupBy("metric").agg(
        F.count("gap").alias("count"),
        F.avg("gap").alias("mean"),
        F.stddev_samp("gap").alias("std"),
        F.min("gap").alias("min"),
        F.max("gap").alias("max"),
    )
    quantiles = exact_quantiles(long_form, F.col("gap"), probs, ["metric"], [column_label(p) for p in probs])
    return moments.join(quantiles, "metric", "left")


def audit_summary(orders: DataFrame) -> DataFrame:
    one = orders.agg(
        F.count("*").alias("total_rows"),
        F.count_if(geo.invalid_latitude() | geo.invalid_longitude()).alias("invalid_coordinate_rows"),
        F.avg(DISTANCE).alias("mean_distance_km"),
        F.max(DISTANCE).alias("max_distance_km"),
        *over_counts([15, 50, 100, 200]),
    )
    return one.withColumns(
        {
            "potential_outlier_percentage": F.col("distance_over_50km") / F.nullif(F.col("total_rows"), F.lit(0)) * 100,
            "median_distance_km": median_distance(orders),
        }
    )


def anomaly_counts(orders: DataFrame) -> DataFrame:
    flags = geo.anomaly_flags()
    return orders.agg(
        *[F.count_if(flag).alias(name) for name, flag in flags.items()],
        F.count_if(geo.is_anomaly()).alias("combined_anomalies"),
        (F.avg(geo.is_anomaly().cast("int")) * 100).alias("anomaly_rate_pct"),
    )


# --- original against cleaned ---------------------------------------------------------------------


def _versions(orders: DataFrame) -> DataFrame:
    """Each order once per data version it belongs to."""
    versions = F.when(geo.is_anomaly(), F.array(F.lit("original"))).otherwise(
        F.array(F.lit("original"), F.lit("cleaned"))
    )
    return orders.select(F.explode(versions).alias("version"), DISTANCE, target().alias("minutes"))


def _median_minutes(labelled: DataFrame, label: str) -> DataFrame:
    counts = labelled.groupBy(label, "minutes").agg(F.count("*").alias("n"))
    return weighted_moments(counts, [label], "minutes", "n")


def cleaning_comparison(orders: DataFrame) -> DataFrame:
    """Eight measures of the original and the cleaned orders, one row per measure."""
    versions = _versions(orders)
    distances = versions.groupBy("version").agg(F.avg(DISTANCE).alias("mean_km"), F.max(DISTANCE).alias("max_km"))
    quantiles = exact_quantiles(
        versions, F.col(DISTANCE), [0.5, 0.95, 0.99], ["version"], ["median_km", "p95_km", "p99_km"]
    )
    by_version = (
        _median_minutes(versions, "version").join(distances, "version", "left").join(quantiles, "version", "left")
    )

    # Measure names of the report.
    measures = {
        "Rows": F.col("count").cast("double"),
        "Mean distance (km)": F.col("mean_km"),
        "Median distance (km)": F.col("median_km"),
        "95th percentile distance (km)": F.col("p95_km"),
        "99th percentile distance (km)": F.col("p99_km"),
        "Maximum distance (km)": F.col("max_km"),
        "Mean delivery time (min)": F.col("mean"),
        "Median delivery time (min)": F.col("median"),
    }
    rows = by_version.select(
        "version",
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in measures.items()])),
    )
    return rows.groupBy("metric").agg(
        *[F.max(F.when(F.col("version") == v, F.col("value"))).alias(v) for v in ("original", "cleaned")]
    )


def removed_summary(orders: DataFrame) -> DataFrame:
    """Delivery minutes of all, flagged and kept orders; empty when nothing is flagged."""
    groups = F.when(
        geo.is_anomaly(), F.array(F.lit("Original dataset"), F.lit("Geographic anomalies"))
    ).otherwise(F.array(F.lit("Original dataset"), F.lit("Cleaned dataset")))
    labelled = orders.select(F.explode(groups).alias("group"), target().alias("minutes"))
    summary = _median_minutes(labelled, "group").withColumn(
        "_flagged",
        F.max((F.col("group") == "Geographic anomalies").cast("int")).over(Window.partitionBy()),
    )
    return summary.filter(F.col("_flagged") == 1).select(
        "group",
        F.col("count").alias("rows"),
        F.col("mean").alias("mean_delivery_minutes"),
        F.col("median").alias("median_delivery_minutes"),
    )


def target_profile(orders: DataFrame) -> DataFrame:
    """Count, moments, extremes and quartiles of the delivery time."""
    counts = orders.groupBy(target().alias("minutes")).agg(F.count("*").alias("n"))
    profile = weighted_moments(
        counts.withColumn("target", F.lit(TARGET)),
        ["target"],
        "minutes",
        "n",
        F.min("minutes").alias("min"),
        F.max("minutes").alias("max"),
        probs={"p25": 0.25, "p50": 0.5, "p75": 0.75},
    )
    names = ["target", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return profile.select(*names, F.lit(len(orders.columns)).alias("columns"))

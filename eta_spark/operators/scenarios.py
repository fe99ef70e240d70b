"""What-if scenarios over any table of orders."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eta_spark.functions.geography import order_distance
from eta_spark.functions.labels import served_minutes
from eta_spark.operators.scoring import Scorer, served, with_features
from eta_spark.schema import COORDINATES, FEATURES
from eta_spark.sources.deliveries import select_present

# The example order and the scenarios.
BASE_ORDER = {
    "Delivery_person_Age": 30,
    "Delivery_person_Ratings": 4.7,
    "Restaurant_latitude": 22.5726,
    "Restaurant_longitude": 88.3639,
    "Delivery_location_latitude": 22.5958,
    "Delivery_location_longitude": 88.4000,
    "Order_Date": "10-03-2022",
    "Time_Orderd": "20:30",
    "Weatherconditions": "Cloudy",
    "Road_traffic_density": "Medium",
    "Vehicle_condition": 2,
    "Type_of_order": "Meal",
    "Type_of_vehicle": "motorcycle",
    "multiple_deliveries": 1,
    "Festival": "No",
    "City": "Metropolitian",
}
SCENARIOS = [
    ("Baseline", "Typical evening order with medium traffic", {}),
    ("Heavy Traffic", "Same order under jam traffic", {"Road_traffic_density": "Jam"}),
    ("Low Traffic", "Same order under low traffic", {"Road_traffic_density": "Low"}),
    ("Sunny Weather", "Same order under sunny weather", {"Weatherconditions": "Sunny"}),
    ("Stormy Weather", "Same order under stormy weather", {"Weatherconditions": "Stormy"}),
    ("Multiple Deliveries", "Rider is handling three deliveries", {"multiple_deliveries": 3}),
    ("Festival", "Order occurs during a festival", {"Festival": "Yes"}),
    (
        "Short Distance",
        "Shorter restaurant-to-customer distance",
        {"Delivery_location_latitude": 22.58, "Delivery_location_longitude": 88.375},
    ),
    (
        "Longer Distance",
        "Longer restaurant-to-customer distance",
        {"Delivery_location_latitude": 22.7, "Delivery_location_longitude": 88.5},
    ),
    (
        "Peak + Jam + Multiple",
        "Combined high-risk operational conditions",
        {"Road_traffic_density": "Jam", "multiple_deliveries": 3},
    ),
]
REPORT_COLUMNS = [
    "scenario",
    "description",
    "Road_traffic_density",
    "Weatherconditions",
    "multiple_deliveries",
    "Festival",
    "distance_km",
    "predicted_eta_min",
    "predicted_long_delivery",
    "eta_change_vs_baseline",
]
CHECKS = [
    ("Low traffic <= baseline", "Low Traffic", "Baseline"),
    ("Heavy traffic >= low traffic", "Low Traffic", "Heavy Traffic"),
    ("Multiple deliveries >= baseline", "Baseline", "Multiple Deliveries"),
    ("Longer distance >= short distance", "Short Distance", "Longer Distance"),
]


CHANGED = sorted({c for _, _, changes in SCENARIOS for c in changes})


def _values(changes: dict, types: dict[str, str]) -> list[Column]:
    return [F.lit(changes.get(c)).cast(types[c]).alias(c) for c in CHANGED]


def _per_scenario(orders: DataFrame, types: dict[str, str], given_types: dict[str, str]) -> DataFrame:
    """Each order once per scenario, with the scenario in a ``_variant`` struct. No join, no shuffle."""
    variants = [
        F.struct(
            F.lit(name).alias("scenario"),
            F.lit(text).alias("description"),
            F.struct(*_values(changes, types)).alias("parsed"),
            F.struct(*_values(changes, given_types)).alias("given"),
        )
        for name, text, changes in SCENARIOS
    ]
    return orders.withColumn("_variant", F.explode(F.array(*variants)))


def _laid_over(own: str, variant: str) -> dict[str, Column]:
    return {c: F.coalesce(F.col(f"_variant.{variant}.{c}"), F.col(f"{own}{c}")) for c in CHANGED}


def overlay(orders: DataFrame) -> DataFrame:
    """Orders with the values of each scenario laid over their own."""
    types = dict(orders.dtypes)
    return (
        _per_scenario(orders, types, types)
        .withColumns(_laid_over("", "given"))
        .withColumns({c: F.col(f"_variant.{c}") for c in ("scenario", "description")})
        .drop("_variant")
    )


def run_scenarios(orders: DataFrame, score: Scorer) -> DataFrame:
    """Predictions of all scenarios with their change against the unchanged order.

    Texts are parsed once per order, before the scenarios multiply it; only the
    distance depends on a scenario. The unchanged order is scored first and its
    minutes ride along, which spares a shuffle to find them again.
    """
    base = score(with_features(orders)).withColumn("_baseline_eta", served_minutes(F.col("prediction")))
    inputs = base.select("_given", *COORDINATES, *FEATURES, "_baseline_eta")
    row = F.col("_given")
    for name, value in _laid_over("_given.", "given").items():
        row = row.withField(name, value)
    varied = (
        _per_scenario(inputs, dict(inputs.dtypes), dict(orders.dtypes))
        .withColumn("_given", row)
        .withColumns(_laid_over("", "parsed"))
        .withColumn("distance_km", order_distance())
    )
    results = served(score(varied), "_variant.scenario", "_variant.description", "_baseline_eta")
    return results.withColumn("eta_change_vs_baseline", F.col("predicted_eta_min") - F.col("_baseline_eta")).drop(
        "_baseline_eta"
    )


def scenario_report(results: DataFrame, key: str | None = None) -> DataFrame:
    return select_present(results, ([key] if key else []) + REPORT_COLUMNS)


def _statuses(eta: dict[str, Column]) -> Column:
    """One row per check, from the minutes of the scenarios that it compares."""
    rows = [
        F.struct(F.lit(name).alias("check"), F.when(eta[low] <= eta[high], "PASS").otherwise("REVIEW").alias("status"))
        for name, low, high in CHECKS
    ]
    return F.inline(F.array(*rows))


def order_checks(orders: DataFrame, score: Scorer, key: str | None = "ID") -> DataFrame:
    """PASS or REVIEW for each order and check.

    The scenarios that the checks compare are scored side by side in the
    order's own row. Nothing is shuffled, and orders with missing or equal IDs
    stay apart.
    """
    changes = {name: changed for name, _, changed in SCENARIOS}
    first, *others = sorted({s for _, low, high in CHECKS for s in (low, high)}, key=list(changes).index)
    inputs = with_features(orders).select("_given", *COORDINATES, *FEATURES)
    types = dict(inputs.dtypes)
    minutes = served_minutes(F.col("prediction"))
    # The first scenario is the unchanged order.
    rows = score(inputs).select(*inputs.columns, minutes.alias(f"_eta {first}"))
    for name in others:
        varied = (
            rows.withColumn("_order", F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
            .withColumns({c: F.lit(v).cast(types[c]) for c, v in changes[name].items()})
            .withColumn("distance_km", order_distance())
        )
        rows = score(varied).select("_order.*", minutes.alias(f"_eta {name}"))
    eta = {s: F.col(f"`_eta {s}`") for s in (first, *others)}
    return rows.select(*([F.col(f"_given.{key}").alias(key)] if key else []), _statuses(eta))


def behaviour_checks(results: DataFrame, key: str = "ID") -> DataFrame:
    """The same checks over a saved result table, which must name each order by a key of its own."""
    needed = sorted({s for _, low, high in CHECKS for s in (low, high)})
    eta = {s: F.max(F.when(F.col("scenario") == s, F.col("predicted_eta_min"))).alias(f"eta{i}") for i, s in enumerate(needed)}
    column = {s: F.col(f"eta{i}") for i, s in enumerate(needed)}
    return results.groupBy(key).agg(*eta.values()).select(key, _statuses(column))


def check_summary(checks: DataFrame) -> DataFrame:
    """Passing orders per check, and whether all pass."""
    return checks.groupBy("check").agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.bool_and(F.col("status") == "PASS").alias("all_passed"),
    )


def headline_figures(results: DataFrame) -> DataFrame:
    """Mean minutes of the four scenarios named in the final report."""
    named = {
        "baseline": "Baseline",
        "multiple_deliveries": "Multiple Deliveries",
        "short_distance": "Short Distance",
        "longer_distance": "Longer Distance",
    }
    return results.agg(
        *[F.avg(F.when(F.col("scenario") == s, F.col("predicted_eta_min"))).alias(n) for n, s in named.items()]
    )

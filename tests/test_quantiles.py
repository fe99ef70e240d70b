"""Quantiles against brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eta_spark.operators.quantiles import column_label, exact_quantiles, weighted_moments

PROBS = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def by_group(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    table = spark.createDataFrame(rows, "g string, v double")
    return {r.g: [r[n] for n in NAMES] for r in exact_quantiles(table, F.col("v"), PROBS, ["g"], NAMES).collect()}


def test_against_numpy(spark):
    rng = np.random.default_rng(7)
    groups = {
        "continuous": rng.gamma(2.0, 5.0, 3000).tolist(),
        # A third of the values are the same.
        "hot": [4.25] * 1000 + rng.uniform(0, 9, 2000).tolist(),
        # Closer together than the finest cell.
        "dense": (7.0 + np.arange(500) * 1e-12).tolist(),
        "negative": [-3.5, -0.001, 0.0, 2.0],
        "single": [8.125],
        # Magnitudes that equal cells cannot separate.
        "outlier": [1e300, *(1.0 + np.arange(50) / 7).tolist()],
    }
    expected = {g: np.quantile(v, PROBS).tolist() for g, v in groups.items()}
    actual = by_group(spark, {g: [*v, None] for g, v in groups.items()})
    assert actual.keys() == expected.keys()
    for group, values in expected.items():
        assert actual[group] == pytest.approx(values, rel=1e-12, abs=1e-12)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_narrowing_on_any_values(spark, values):
    assert by_group(spark, {"g": values})["g"] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-9, abs=1e-6)


def test_weighted_moments(spark):
    minutes = [10.0] * 3 + [11.0] + [30.0] * 4
    counts = spark.createDataFrame([("a", 10.0, 3), ("a", 11.0, 1), ("a", 30.0, 4), ("b", 5.0, 1)], "k string, v double, n long")
    rows = {r.k: r for r in weighted_moments(counts, ["k"], "v", "n").collect()}
    assert rows["a"]["count"] == 8
    assert rows["a"]["mean"] == pytest.approx(np.mean(minutes))
    assert rows["a"]["median"] == pytest.approx(np.median(minutes))
    assert rows["a"]["std"] == pytest.approx(np.std(minutes, ddof=1))
    assert rows["b"]["std"] is None


def test_weighted_quantiles_of_a_million_decimals(spark):
    """A hot group of distinct values beside whole, tied, missing and extreme ones, against NumPy."""
    rng = np.random.default_rng(5)
    groups = {
        "hot": (rng.gamma(3.0, 9.0, 1_000_000), rng.integers(1, 4, 1_000_000)),
        "whole": (rng.integers(10, 55, 400).astype(float), rng.integers(1, 9, 400)),
        "tied": (np.array([1.5, 1.5, 2.5]), np.array([1, 1, 2])),
        "wide": (np.array([-1e300, 0.1, 0.2, 1e300]), np.array([1, 5, 5, 1])),
        None: (np.array([3.0]), np.array([2])),
    }
    frames = [pd.DataFrame({"k": k, "v": v, "n": n}) for k, (v, n) in groups.items()]
    table = spark.createDataFrame(pd.concat([*frames, pd.DataFrame({"k": ["whole", "empty"], "v": [None, None], "n": [7, 2]})]), "k string, v double, n long")
    table = table.withColumn("v", F.nanvl("v", F.lit(None)))
    rows = {r.k: r for r in weighted_moments(table.repartition(8), ["k"], "v", "n", F.min("v").alias("low"), probs={"p10": 0.1, "median": 0.5, "p95": 0.95}).collect()}
    for key, (values, weights) in groups.items():
        every = np.repeat(values, weights)
        assert (rows[key].p10, rows[key].median, rows[key].p95) == pytest.approx(tuple(np.quantile(every, [0.1, 0.5, 0.95])), rel=1e-12)
        assert rows[key].low == values.min()
        if key != "wide":
            assert rows[key]["mean"] == pytest.approx(every.mean()) and rows[key]["std"] == pytest.approx(every.std(ddof=1))
    assert rows["whole"]["count"] == groups["whole"][1].sum() + 7
    assert rows["empty"].median is None and rows["empty"]["count"] == 2


def test_labels():
    assert [column_label(p) for p in (0.5, 0.995, 0.999)] == ["p50", "p99_5", "p99_9"]

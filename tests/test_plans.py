"""Plan shapes that must hold at any data size."""

import re

import pytest

from eta_spark.catalog import QUERIES
from eta_spark.catalog.base import cleaned, engineered
from eta_spark.operators import splits
from eta_spark.operators.delays import factor_counts
from eta_spark.operators.errors import error_by_keys
from tests.test_queries import SLOW

FITTING = SLOW | {n for n in QUERIES if n.startswith(("a08", "a09", "f04", "f05", "f06", "f07", "f08"))}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    """Tables too large to broadcast, as far as the planner can tell."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FITTING])
def test_no_pairs_and_no_python_rows(spark, sf_dir, no_auto_broadcast, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)


def test_split_shuffles_no_orders(spark, sf_dir):
    text = plan(splits.group_split(cleaned(spark, sf_dir)).select("ID", "split"))
    assert "Exchange" not in text and "Join" not in text


def test_factor_report_reads_only_its_columns(spark, sf_dir):
    text = plan(factor_counts(engineered(spark, sf_dir), ["City", "Festival"]))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert set(re.findall(r"([\w()]+):", schema)) == {"City", "Festival", "Time_taken(min)"}
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_all_error_keys_share_one_scan(spark, sf_dir):
    from eta_spark.catalog.base import formula
    from eta_spark.operators.errors import with_errors, with_report_keys

    table = with_report_keys(with_errors(formula(cleaned(spark, sf_dir))))
    text = plan(error_by_keys(table))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_distance_filter_reaches_the_scan(spark, sf_dir):
    from eta_spark.operators.quality import extreme_orders

    assert "GreaterThan(distance_km,50.0)" in plan(extreme_orders(engineered(spark, sf_dir)))


def test_bucketed_features_join_without_a_shuffle(spark, sf_dir, no_auto_broadcast):
    from pyspark.sql import functions as F

    from eta_spark.catalog.base import group_test_scored
    from eta_spark.operators import errors

    predictions = errors.prediction_table(group_test_scored(spark, sf_dir))
    # A third of the predictions without ID, and two orders of one ID.
    predictions = predictions.withColumn("ID", F.when(F.crc32("ID") % 3 > 0, F.col("ID")))
    orders = cleaned(spark, sf_dir)
    joined = errors.attach_bucketed_features(predictions, orders, buckets=4)
    assert "Exchange" not in plan(joined) and "Exchange" not in plan(errors.duplicate_keys(errors.bucketed(orders.select("ID"), "ID", "ids", 4)))
    plain = errors.attach_features(predictions, orders)
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    doubled = orders.unionByName(orders.limit(1))
    with pytest.raises(ValueError, match="not unique"):
        errors.attach_bucketed_features(predictions, doubled, require_unique=True, buckets=4)

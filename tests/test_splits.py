import pytest
from pyspark.sql import functions as F

from eta_spark.operators import splits
from eta_spark.schema import FEATURES, GROUP_COLUMN


def test_position_is_a_permutation(spark):
    rows = spark.range(5000).withColumn("g", F.col("id") % 2)
    placed = splits.hashed_position(rows, splits.salted_hash("1", F.col("id")), ["id"], within=("g",))
    for _, group in placed.toPandas().groupby("g"):
        assert sorted(group.position) == list(range(2500))
        assert list(group.sort_values("position").id) != sorted(group.id)


def test_position_follows_the_digest(spark):
    rows = spark.range(300)
    digest = splits.salted_hash("42", F.col("id"))
    placed = splits.hashed_position(rows.withColumn("d", digest), digest, ["id"]).toPandas()
    assert list(placed.sort_values("position").d) == sorted(placed.d)


def test_random_split_is_stable_and_near_its_share(orders):
    first = splits.random_split(orders).select("ID", "split")
    again = splits.random_split(orders.repartition(3)).select("ID", "split")
    assert first.exceptAll(again).isEmpty()
    share = first.filter("split = 'train'").count() / first.count()
    assert 0.77 < share < 0.83


def test_temporal_split_never_mixes_days(orders):
    labelled = splits.check_no_leak(splits.temporal_split(orders), "order_day")
    profile = {r.split: r for r in splits.split_profile(labelled).collect()}
    assert profile["train"].last_day < profile["test"].first_day
    days = profile["train"].days + profile["test"].days
    assert profile["train"].days == int(days * 0.8)
    dated = splits.temporal_cutoff(orders).first().cutoff
    assert dated == profile["test"].first_day


def test_group_split_keeps_riders_apart(orders):
    labelled = splits.check_no_leak(splits.group_split(orders), GROUP_COLUMN)
    riders = {r.split: r.riders for r in splits.split_profile(labelled).collect()}
    assert riders["train"] == int(sum(riders.values()) * 0.8)
    assert labelled.count() == orders.filter(F.col(GROUP_COLUMN).isNotNull()).count()


def test_one_rider_goes_to_test(spark):
    orders = spark.createDataFrame([("1", "r"), ("2", "r"), ("3", None)], f"ID string, {GROUP_COLUMN} string")
    assert [r.split for r in splits.group_split(orders).collect()] == ["test", "test"]


def test_leaks_are_refused(spark):
    leaky = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "test")], "k string, split string")
    with pytest.raises(RuntimeError, match="1 values of k"):
        splits.check_no_leak(leaky, "k")
    assert splits.leak_report(leaky, "k").first().asDict() == {"shared_keys": 1, "status": "FAIL"}


def test_group_key_is_no_feature():
    assert splits.check_group_not_a_feature(FEATURES) == FEATURES
    with pytest.raises(RuntimeError, match=GROUP_COLUMN):
        splits.check_group_not_a_feature([*FEATURES, GROUP_COLUMN])


def test_riders_from_merged_sketches(spark, orders):
    riders = spark.range(60_000).selectExpr("concat('r', id % 20000) AS Delivery_person_ID", "concat(lpad(1 + id % 28, 2, '0'), '-03-2022') AS Order_Date")
    for table in (riders, orders):
        exact = splits.distinct_rider_count(table).first().riders
        # Four standard errors.
        assert abs(splits.merged_rider_count(splits.rider_sketches(table)).first().riders - exact) <= max(2, 0.065 * exact)
    nobody = riders.withColumn("Delivery_person_ID", F.lit(None).cast("string"))
    assert splits.rider_sketches(nobody).count() == 0

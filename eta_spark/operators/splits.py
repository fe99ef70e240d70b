"""Train/test splits as a ``split`` column, and leakage checks.

A split is decided row by row against one value (a hash limit, a cutoff day or
a cutoff hash), so assigning it shuffles no orders and a busy rider is no hot
spot. The cutoff is read once, when the split is made: the many passes of a
training run then compare with a literal instead of ranking days or riders anew.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eta_spark.functions.labels import is_long, target
from eta_spark.functions.parsing import day_first_date
from eta_spark.schema import GROUP_COLUMN, SPLIT_SEED, TRAIN_SHARE

TRAIN, TEST = "train", "test"


def salted_hash(salt: str, *keys: Column) -> Column:
    """Hexadecimal digest; its text order is a random order of the keys."""
    return F.md5(F.concat(F.lit(f"{salt}:"), F.concat_ws("|", *keys)))


def hashed_position(
    df: DataFrame, digest: Column, ties: list[str], within: tuple[str, ...] = (), position: str = "position"
) -> DataFrame:
    """Dense 0-based position in digest order, without a global sort in one task.

    Rows are numbered inside each four-digit prefix; the 65 536 prefix counts
    give the offsets. ``within`` numbers each of a few groups on its own.
    """
    keyed = df.withColumn("_digest", digest).withColumn("_prefix", F.coalesce(F.substring("_digest", 1, 4), F.lit("")))
    part = [*within, "_prefix"]
    sizes = keyed.groupBy(*part).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*within).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*part, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*part).orderBy("_digest", *ties)
    return (
        keyed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, part)
        .withColumn(position, F.col("_offset") + F.col("_inside") - 1)
        .drop("_prefix", "_digest", "_inside", "_offset")
    )


def _side(in_train: Column) -> Column:
    return F.when(in_train, TRAIN).otherwise(TEST)


def _only_value(one_row: DataFrame):
    """The value of a table of at most one row, None if it is empty."""
    row = one_row.first()
    return None if row is None else row[0]


def random_split(
    orders: DataFrame, keys: tuple[str, ...] = ("ID",), train_share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> DataFrame:
    """By hash of the order key: stable under repartitioning and reruns."""
    hashed = F.conv(F.substring(salted_hash(str(seed), *[F.col(k) for k in keys]), 1, 8), 16, 10).cast("long")
    in_train = hashed < int(train_share * 16**8)
    return orders.withColumn("split", _side(in_train))


def _order_day(orders: DataFrame) -> Column:
    if dict(orders.dtypes)["Order_Date"] == "string":
        return day_first_date(F.col("Order_Date"))
    return F.to_date("Order_Date")


def distinct_days(orders: DataFrame) -> DataFrame:
    return orders.select(_order_day(orders).alias("order_day")).filter(F.col("order_day").isNotNull()).distinct()


def temporal_cutoff(orders: DataFrame, train_share: float = TRAIN_SHARE) -> DataFrame:
    """First test day. The window holds calendar days, so it stays small at any data size."""
    days = distinct_days(orders)
    ranked = days.select(
        "order_day",
        F.row_number().over(Window.orderBy("order_day")).alias("_rank"),
        F.count("*").over(Window.partitionBy()).alias("_days"),
    )
    first_test = F.floor(F.col("_days") * F.lit(train_share)) + 1
    return ranked.filter(F.col("_rank") == first_test).select(F.col("order_day").alias("cutoff"))


def temporal_split(orders: DataFrame, train_share: float = TRAIN_SHARE) -> DataFrame:
    """The first days train, the last days test; orders without a day are dropped."""
    cutoff = _only_value(temporal_cutoff(orders, train_share))
    # Without a first test day, all days train.
    in_train = F.lit(True) if cutoff is None else F.col("order_day") < F.lit(cutoff).cast("date")
    return (
        orders.withColumn("order_day", _order_day(orders))
        .filter(F.col("order_day").isNotNull())
        .withColumn("split", _side(in_train))
    )


def distinct_riders(orders: DataFrame) -> DataFrame:
    return orders.select(GROUP_COLUMN).filter(F.col(GROUP_COLUMN).isNotNull()).distinct()


def _rider_hash(seed: int) -> Column:
    return salted_hash(str(seed), F.col(GROUP_COLUMN))


def group_cutoff(orders: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> DataFrame:
    """Hash of the last training rider in hash order."""
    riders = distinct_riders(orders)
    total = riders.agg(F.count("*")).scalar()
    return (
        hashed_position(riders, _rider_hash(seed), [GROUP_COLUMN])
        .filter(F.col("position") == F.floor(total * F.lit(train_share)) - 1)
        .select(_rider_hash(seed).alias("cutoff"))
    )


def group_split(orders: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> DataFrame:
    """80 % of the riders train, the others test; orders without a rider are dropped."""
    cutoff = F.lit(_only_value(group_cutoff(orders, train_share, seed))).cast("string")
    return orders.filter(F.col(GROUP_COLUMN).isNotNull()).withColumn("split", _side(_rider_hash(seed) <= cutoff))


def split_tables(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(labelled.filter(F.col("split") == side).drop("split") for side in (TRAIN, TEST))


def shared_keys(labelled: DataFrame, key: str) -> DataFrame:
    """Keys found on both sides of a split."""
    train, test = split_tables(labelled)
    return train.select(key).intersect(test.select(key))


def check_no_leak(labelled: DataFrame, key: str) -> DataFrame:
    """Raises when a key is on both sides. One grouping, counted on the cluster."""
    sides = labelled.groupBy(key).agg(F.min("split").alias("first"), F.max("split").alias("last"))
    overlap = sides.filter(F.col("first") != F.col("last")).count()
    if overlap:
        raise RuntimeError(f"{overlap} values of {key} are in both train and test.")
    return labelled


def leak_report(labelled: DataFrame, key: str) -> DataFrame:
    overlap = shared_keys(labelled, key).agg(F.count("*").alias("shared_keys"))
    return overlap.withColumn("status", F.when(F.col("shared_keys") == 0, "PASS").otherwise("FAIL"))


def check_group_not_a_feature(features: list[str]) -> list[str]:
    if GROUP_COLUMN in features:
        raise RuntimeError(f"{GROUP_COLUMN} must not be a model feature.")
    return features


def members_of(orders: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Orders whose key is in the key table."""
    return orders.join(keys.select(key), key, "left_semi")


def split_profile(labelled: DataFrame) -> DataFrame:
    """Rows, riders and days of each side."""
    days = _order_day(labelled)
    return labelled.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.countDistinct(GROUP_COLUMN).alias("riders"),
        F.countDistinct(days).alias("days"),
        F.min(days).alias("first_day"),
        F.max(days).alias("last_day"),
    )


def distinct_rider_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.countDistinct(GROUP_COLUMN).alias("riders"))


#: Two to this power registers; the standard error of an estimate is about 1.04 / 64, or 1.6 %.
SKETCH_PRECISION = 12


def rider_sketches(orders: DataFrame) -> DataFrame:
    """A sketch of the riders of each day, to be stored and merged over any days without reading orders again.

    Days without a rider have no sketch.
    """
    days = orders.select(_order_day(orders).alias("order_day"), GROUP_COLUMN).where(F.col(GROUP_COLUMN).isNotNull())
    return days.groupBy("order_day").agg(F.hll_sketch_agg(GROUP_COLUMN, SKETCH_PRECISION).alias("riders_sketch"))


def merged_rider_count(sketches: DataFrame) -> DataFrame:
    """About how many riders all the sketches together hold."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("riders_sketch")).alias("riders"))


def class_balance(orders: DataFrame) -> DataFrame:
    return orders.groupBy(is_long(target()).alias("is_long_delivery")).agg(F.count("*").alias("rows"))

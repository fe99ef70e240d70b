"""Exact interpolated quantiles that never gather an unbounded group in one task.

Each pass cuts the ranges that still hold a wanted rank into cells, counts the
values of each cell and finds the cells that hold the ranks; a cell's least and
greatest value bound the next pass. It ends when every wanted cell holds one
value. Only counts are shuffled, and one task orders at most ``CELLS`` + 1 cells.
A value's cell number never decreases as the value grows, in floating point
too, hence the cells are in value order and the result is exact. A pass is one
scan; values of few levels need one after the bounds, continuous ones up to four.
"""

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from eta_spark.sources.stored import stored

# Cells of one range in one pass.
CELLS = 1 << 16
MEDIAN = {"median": 0.5}


def _cell() -> Column:
    """The cell of a value between ``_low`` and ``_high``; the two fall into different ones."""
    share = (F.col("_v") / 2 - F.col("_low") / 2) / F.nullif(F.col("_high") / 2 - F.col("_low") / 2, F.lit(0.0))
    # Infinite bounds, or the smallest doubles beside each other, give no share.
    return F.coalesce(F.floor(F.when(~F.isnan(share), share) * CELLS), (F.col("_v") > F.col("_low")).cast("long"))


def _narrowed(values: DataFrame, by: list[str], wanted: list[Row]) -> list[Row]:
    """One pass: of each wanted (label, range, rank), the cell that holds the rank, and the rank within it."""
    spark = values.sparkSession
    labels = [values.schema[c] for c in by]
    names = [f"_label{i}" for i in range(len(by))]
    kinds = [f"{n} {field.dataType.simpleString()}" for n, field in zip(names, labels)]
    schema = ", ".join([*kinds, "_low double", "_high double", "_rank long"])
    targets = spark.createDataFrame([tuple(row) for row in wanted], schema).distinct()
    ranges = F.broadcast(targets.select(*names, "_low", "_high").distinct())
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)]
    within = [*names, "_low", "_high"]
    counted = (
        values.join(ranges, [*same, F.col("_v").between(F.col("_low"), F.col("_high"))])
        .groupBy(*within, _cell().alias("_cell"))
        .agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    running = Window.partitionBy(*within).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = counted.withColumn("_up_to", F.sum("_n").over(running)).withColumn("_before", F.col("_up_to") - F.col("_n"))
    asked = targets.select(*(F.col(c).alias(f"{c}_asked") for c in targets.columns))
    match = [F.col(c).eqNullSafe(F.col(f"{c}_asked")) for c in within]
    inside = (F.col("_rank_asked") >= F.col("_before")) & (F.col("_rank_asked") < F.col("_up_to"))
    found = cells.join(F.broadcast(asked), [*match, inside])
    return found.select(*within, "_rank_asked", "_least", "_most", (F.col("_rank_asked") - F.col("_before")).alias("_left")).collect()


def exact_quantiles(
    df: DataFrame, value: Column, probs: list[float], by: list[str], names: list[str], whole: list[tuple] | None = None
) -> DataFrame:
    """``by`` plus one column per probability. Missing values are skipped.

    ``whole`` spares a scan where least value, greatest value and count of each label are known.

    ``by`` must be labels from a fixed list (bands, metric or feature names):
    ``2 * len(probs)`` ranks per label go to the driver after each pass, which
    runs as a job of its own.
    """
    values = df.select(*by, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if whole is None:
        whole = values.groupBy(*by).agg(F.min("_v"), F.max("_v"), F.count("*")).collect()
    # (label, probability) -> position between two ranks; rank -> the range that holds it, and its place there.
    at: dict[tuple, dict[int, tuple]] = {}
    for *label, low, high, total in whole:
        ranks = {r for p in probs for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))}
        at[tuple(label)] = {r: (low, high, r) for r in ranks}
    while True:
        wanted = [(*label, *place) for label, places in at.items() for place in places.values() if place[0] < place[1]]
        if not wanted:
            break
        found = {tuple(row[:-3]): tuple(row[-3:]) for row in _narrowed(values, by, wanted)}
        for label, places in at.items():
            places.update({r: found[(*label, *place)] for r, place in places.items() if place[0] < place[1]})

    rows = []
    for *label, _, _, total in whole:
        places, row = at[tuple(label)], list(label)
        for p in probs:
            exact = p * (total - 1)
            low, high = places[math.floor(exact)][0], places[math.ceil(exact)][0]
            row.append(low + (high - low) * (exact - math.floor(exact)) if low != high else low)
        rows.append(tuple(row))
    schema = ", ".join([*(f"`{c}` {values.schema[c].dataType.simpleString()}" for c in by), *(f"`{n}` double" for n in names)])
    return df.sparkSession.createDataFrame(rows, schema)


def weighted_quantiles(values: DataFrame, whole: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """``by`` and a column for each probability of a stored (by, _v, _n) table, by the same narrowing over sums of weights.

    ``whole`` has ``_low``, ``_high`` and ``count`` of each label. Nothing but a flag comes to the driver, so
    labels need not be few; a task orders the cells of one range, at most ``CELLS`` + 1 rows.
    """
    last = F.col("count") - 1
    ranks = F.array_distinct(F.array(*(edge(p * last) for p in probs.values() for edge in (F.floor, F.ceil))))
    wanted = whole.select(*by, "_low", "_high", F.explode(ranks).alias("_rank")).withColumn("_place", F.col("_rank"))
    within = [*by, "_low", "_high"]
    running = Window.partitionBy(*within).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        wanted = stored(wanted, "ranks")
        still = wanted.where("_low < _high")
        if still.isEmpty():
            break
        ranges = still.select(*(F.col(c).alias(f"_in_{c}") for c in within)).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in by]
        held = values.join(ranges, [*same, F.col("_v").between(F.col("_in__low"), F.col("_in__high"))])
        counted = (
            held.select(*by, F.col("_in__low").alias("_low"), F.col("_in__high").alias("_high"), "_v", "_n")
            .groupBy(*within, _cell().alias("_cell"))
            .agg(F.sum("_n").alias("_sum"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        )
        cells = counted.withColumn("_up_to", F.sum("_sum").over(running)).withColumn("_before", F.col("_up_to") - F.col("_sum"))
        asked = still.select(*(F.col(c).alias(f"_in_{c}") for c in within), "_rank", "_place")
        match = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in within]
        inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_up_to"))
        found = cells.join(asked, [*match, inside]).select(
            *by, F.col("_least").alias("_low"), F.col("_most").alias("_high"), (F.col("_rank") - F.col("_before")).alias("_rank"), "_place"
        )
        wanted = wanted.where("NOT _low < _high").unionByName(found)
    counts = whole.select(*(F.col(c).alias(f"_in_{c}") for c in by), last.alias("_last"))
    placed = wanted.join(counts, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in by])

    def quantile(p: float) -> Column:
        exact = p * F.max("_last")
        low, high = (F.max(F.when(F.col("_place") == edge(p * F.col("_last")), F.col("_low"))) for edge in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (exact - F.floor(exact)))

    return placed.groupBy(*by).agg(*(quantile(p).alias(name) for name, p in probs.items()))


def weighted_moments(df: DataFrame, by: list[str], value: str, weight: str, *extra: Column, probs: dict[str, float] = MEDIAN) -> DataFrame:
    """Count, mean, quantiles (the median alone if not asked otherwise) and sample deviation from a (value, count) frequency table.

    ``extra`` aggregates are taken in the same grouping as count and mean. Neither a task nor a buffer holds
    a group's distinct values, so they may be as many as its rows. Groups whose values are all missing have
    neither mean nor median.
    """
    df = stored(df, "frequencies")
    v, n = F.col(f"`{value}`").cast("double"), F.col(weight)
    present = v.isNotNull()
    whole = df.groupBy(*by).agg(
        F.sum(n).alias("_rows"),
        F.coalesce(F.sum(F.when(present, n)), F.lit(0)).alias("count"),
        (F.sum(v * n) / F.sum(F.when(present, n))).alias("mean"),
        F.min(v).alias("_low"),
        F.max(v).alias("_high"),
        *extra,
    )
    whole = stored(whole, "groups")
    values = df.select(*by, v.alias("_v"), n.alias("_n")).where("_v IS NOT NULL")
    quantiles = weighted_quantiles(values, whole.where("count > 0"), by, probs)
    means = whole.select(*(F.col(c).alias(f"_of_{c}") for c in by), "mean")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    apart = F.col("_v") - F.col("mean")
    squares = values.join(means, same).groupBy(*by).agg(F.sum(F.col("_n") * apart * apart).alias("_squares"))

    def beside(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        named = right.select(*(F.col(c).alias(f"_of_{c}") for c in by), *columns)
        return left.join(named, same, "left").drop(*(f"_of_{c}" for c in by))

    joined = beside(beside(whole, quantiles, *probs), squares, "_squares")
    spread = F.sqrt(F.col("_squares") / F.nullif(F.col("count") - 1, F.lit(0)))
    others = [c for c in whole.columns if c not in {*by, "_rows", "count", "mean", "_low", "_high"}]
    return joined.select(*by, F.col("_rows").alias("count"), "mean", *probs, spread.alias("std"), *others)


def column_label(probability: float) -> str:
    percent = probability * 100
    return f"p{math.floor(percent)}" if math.isclose(percent, round(percent)) else f"p{percent:g}".replace(".", "_")

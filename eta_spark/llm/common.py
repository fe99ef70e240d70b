"""Helpers shared by the operators: stored tables, joins that split hot keys, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eta_spark.session import new_run_dir

#: A key is hot beyond this share of all rows, so at most 1 / HOT_SHARE keys can be hot.
HOT_SHARE = 0.001
#: Rows and bytes of an Arrow batch that are handled at a time.
_BATCH_ROWS, _BATCH_BYTES = 256, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows with groups, which hold a key once and its number of rows in column ``size``.

    Hot keys, at most 1 / HOT_SHARE of them by construction, come to the driver
    and their groups are broadcast; the rest is shuffled, and no key there
    holds more than HOT_SHARE of the rows. ``groups`` should be a stored table,
    as it is read several times.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    many = groups.where(groups[size] > max(1, int(total * HOT_SHARE)))
    hot = [row[0] for row in many.select(key).collect()]
    if not hot:
        return rows.join(groups, key)
    is_hot = F.col(key).isin(hot)
    usual = rows.where(~is_hot).join(groups.where(~is_hot), key)
    return rows.where(is_hot).join(F.broadcast(many), key).unionByName(usual)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for each node of an edge; the component is the smallest node that can be reached.

    Smallest labels move along edges and jump to the label of their label;
    every round is a stored table, and nothing goes to the driver but a flag.
    """
    ends = F.array(F.struct(F.col(left).alias("src"), F.col(right).alias("dst")), F.struct(F.col(right).alias("src"), F.col(left).alias("dst")))
    edges = stored(edges.select(F.inline(ends)), "edges")
    labels = stored(edges.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("node")).alias("component")), "labels")
    while True:
        known = labels.select(F.col("node").alias("src"), "component")
        near = edges.join(known, "src").groupBy(F.col("dst").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        after = stored(step.join(jump, "via").select("node", "old", F.least("via", "far").alias("component")), "labels")
        labels = after.drop("old")
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return labels


def slices(batches: Iterator[pa.RecordBatch], most: int = _BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, of one row at least and ``most`` at most, so that long texts do not add up."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            rows = min(most, batch.num_rows - start)
            while rows > 1 and batch.slice(start, rows).nbytes > _BATCH_BYTES:
                rows //= 2
            yield batch.slice(start, rows)
            start += rows

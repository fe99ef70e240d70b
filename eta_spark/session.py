"""Session defaults and the shared scratch folder."""

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "eta-spark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the reports rely on; cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the session; checkpoints go there as well.

    Where none is set, a folder below the warehouse serves, which the driver
    and all executors share as well.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    in_use = context.getCheckpointDir()
    if in_use is None:
        context.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/eta-spark-scratch")
        in_use = context.getCheckpointDir()
    return (configured or in_use).rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; callers write a table or model there."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _set_meanwhile(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def read_in_parts(spark: SparkSession, a_core: int):
    """While this holds, tables of many files are read in about ``a_core`` parts for each core or more, so that no core waits long for the last."""
    return _set_meanwhile(spark, "spark.sql.files.minPartitionNum", str(a_core * spark.sparkContext.defaultParallelism))


def cached_in_batches(spark: SparkSession, rows: int):
    """While this holds, tables are cached in batches of ``rows``; a task that writes them to disk holds a hundred batches at once."""
    return _set_meanwhile(spark, "spark.sql.inMemoryColumnarStorage.batchSize", str(rows))


def compiled_apart(spark: SparkSession):
    """While this holds, a projection whose generated method HotSpot would not compile is generated in small parts.

    HotSpot only interprets methods of more than 8 000 bytes, which parsing all columns of an order in one pass exceeds.
    """
    return _set_meanwhile(spark, "spark.sql.codegen.hugeMethodLimit", "8000")

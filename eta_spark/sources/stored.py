"""Tables written once per application and shared by many reports."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eta_spark.session import compiled_apart, new_run_dir

#: Rows of a file at most, at every size: a large row group of the source must not leave one file, and so one task, to all readers.
FILE_ROWS = 1 << 16
#: (application, name, source, columns or None for all) -> path.
_WRITTEN: dict[tuple[str, str, str, tuple[str, ...] | None], str] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage and survives lost executors."""
    path = new_run_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_once(
    spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame], columns: Sequence[str] | None = None
) -> DataFrame:
    """Writes ``build()`` to the shared folder on first use and reads it from then on.

    Later readers get column pruning and pushed filters instead of repeating
    joins and parsing, and nothing is lost with an executor. With ``columns``
    only these are built and written, unless a table written before has them all.
    """
    application = spark.sparkContext.applicationId
    table = _written(spark, name, source, columns)
    if table is None:
        path = new_run_dir(spark, name)
        built = build() if columns is None else _only(build(), columns)
        with compiled_apart(spark):
            built.write.mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        _WRITTEN[(application, name, source, columns and tuple(columns))] = path
        table = spark.read.parquet(path)
    return table


def _written(spark: SparkSession, name: str, source: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    """The table if it was written whole or, where ``columns`` are asked for, with these at least."""
    asked = (spark.sparkContext.applicationId, name, source)
    for (*key, held), path in _WRITTEN.items():
        if tuple(key) == asked and (held is None or (columns is not None and set(columns) <= set(held))):
            table = spark.read.parquet(path)
            return table if columns is None else _only(table, columns)
    return None


def stored_before(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The whole table if ``stored_once`` has written it, else ``build()`` as it is."""
    table = _written(spark, name, source)
    return build() if table is None else table


def _only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])

"""Readers for delivery orders, prediction tables and scenario results."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eta_spark.schema import PREDICTION_SCHEMA, RAW_SCHEMA, REQUIRED_AT_SCORING, SCENARIO_RESULT_SCHEMA


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, what: str) -> DataFrame:
    try:
        if fmt == "csv":
            # The header names the columns, in any order; those of the contract get their types, others stay text.
            types = {f.name: f.dataType for f in schema}
            names = spark.read.option("header", True).csv(path).columns
            found = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
            # enforceSchema=false compares the header of every file with these names.
            return spark.read.schema(found).option("header", True).option("enforceSchema", False).csv(path)
        # Self-describing files keep their own types.
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{what} not found: {path}") from error
        raise


_LINE = "_line"
_QUOTED = r'"(?:[^"\\]|\\.|"")*"'


def _with_lines(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """CSV orders with the text of lines that do not fit the header, and whether such a line is broken.

    A line is broken if it has more fields than the header or a quote that nothing closes. Shorter lines are
    filled up with missing values.
    """
    plain = _read(spark, path, RAW_SCHEMA, "csv", "Dataset")
    schema = T.StructType([*plain.schema.fields, T.StructField(_LINE, T.StringType())])
    # All columns are parsed even if few are wanted, otherwise surplus fields would go unseen.
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("columnPruning", False)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).csv(path)
    rest = F.regexp_replace(_LINE, _QUOTED, "")
    surplus = F.length(rest) - F.length(F.replace(rest, F.lit(","))) + 1 > len(plain.columns)
    # Spark refuses plans that read the line alone, as a bare count would; the first column's length is never negative.
    first = F.length(F.coalesce(F.col(f"`{plain.columns[0]}`"), F.lit(""))) >= 0
    return rows, F.coalesce((surplus | rest.contains('"')) & first, F.lit(False))


def read_deliveries(spark: SparkSession, path: str, fmt: str = "csv", broken: str = "fail") -> DataFrame:
    """Raw orders; from CSV every column arrives as text.

    ``broken`` lines of CSV files end the job that meets the first of them ("fail") or are left out ("drop");
    ``broken_lines`` lists them.
    """
    if broken not in ("fail", "drop"):
        raise ValueError(f"Unknown way with broken lines: {broken}")
    if fmt != "csv":
        return _read(spark, path, RAW_SCHEMA, fmt, "Dataset")
    rows, is_broken = _with_lines(spark, path)
    stop = F.raise_error(F.concat(F.lit("Broken line: "), F.substring(_LINE, 1, 200))).cast("boolean")
    return rows.where(F.when(is_broken, stop).otherwise(True) if broken == "fail" else ~is_broken).drop(_LINE)


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """file and line of each broken line of CSV orders."""
    rows, is_broken = _with_lines(spark, path)
    return rows.where(is_broken).select(F.input_file_name().alias("file"), F.col(_LINE).alias("line"))


def read_engineered(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Orders that 'prepare' wrote; CSV gets the types back that the features have."""
    return _read(spark, path, schema, fmt, "Engineered orders")


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, PREDICTION_SCHEMA, fmt, "Predictions")


def read_scenario_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, SCENARIO_RESULT_SCHEMA, fmt, "Scenario results")


def orders_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A few literal orders as a table; absent columns are NULL, values are kept as text."""
    known = [f.name for f in RAW_SCHEMA if any(f.name in row for row in rows)]
    schema = T.StructType([f for f in RAW_SCHEMA if f.name in known])
    values = [tuple(None if row.get(c) is None else str(row[c]) for c in known) for row in rows]
    return spark.createDataFrame(values, schema)


def require_columns(orders: DataFrame, required: list[str] = REQUIRED_AT_SCORING) -> DataFrame:
    """Fail before any job starts, naming every absent column."""
    missing = [c for c in required if c not in orders.columns]
    if missing:
        raise ValueError("Missing required input columns: " + ", ".join(missing))
    return orders


def select_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that the table has, in the listed order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])

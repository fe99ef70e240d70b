"""Queries over the given tables, each with an equivalent SQL text where SQL can express it."""

from eta_spark.catalog import aggregates, modelling, rows, scoring, selection, tables  # noqa: F401
from eta_spark.catalog.base import ORACLE, QUERIES  # noqa: F401

"""Labelled ranges, closed on the right."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """``uppers[i]`` closes ``labels[i]``; None leaves the last band open.

    ``lowest`` is the inclusive lower edge, or None for no lower edge.
    """

    uppers: tuple[float | None, ...]
    labels: tuple[str, ...]
    lowest: float | None = None

    def label(self, value: Column) -> Column:
        return self._pick(value, self.labels)

    def position(self, value: Column) -> Column:
        return self._pick(value, range(len(self.labels)))

    def _pick(self, value: Column, results) -> Column:
        below = F.lit(False) if self.lowest is None else value < self.lowest
        chain = F.when(value.isNull() | below, None)
        for upper, result in zip(self.uppers, results):
            if upper is None:
                return chain.otherwise(F.lit(result))
            chain = chain.when(value <= upper, F.lit(result))
        return chain

    def table(self, spark: SparkSession, label: str = "band", position: str = "position") -> DataFrame:
        """All labels in order, so that a report can show its empty bands."""
        rows = [F.struct(F.lit(n).alias(position), F.lit(name).alias(label)) for n, name in enumerate(self.labels)]
        return spark.range(1).select(F.inline(F.array(*rows)))


# Band edges and labels of the reports.
DELAY_DISTANCE = Bands(
    (3, 6, 10, 15, None),
    ("<=3 km", "3-6 km", "6-10 km", "10-15 km", ">15 km"),
)
AUDIT_DISTANCE = Bands(
    (3, 6, 10, 15, 25, 50, 100, 200, None),
    (
        "<=3 km",
        "3-6 km",
        "6-10 km",
        "10-15 km",
        "15-25 km",
        "25-50 km",
        "50-100 km",
        "100-200 km",
        ">200 km",
    ),
)
# Distances over 21 km fall in no band here, although the last label says ">15 km".
ERROR_DISTANCE = Bands(
    (3, 6, 10, 15, 21),
    ("<=3 km", "3-6 km", "6-10 km", "10-15 km", ">15 km"),
    lowest=0,
)
DELIVERY_TIME = Bands(
    (15, 25, 35, 45, None),
    ("<=15", "16-25", "26-35", "36-45", ">45"),
    lowest=0,
)
_DISTANCE_GROUP = Bands((15, 50, None), ("0-15 km", "15-50 km", ">50 km"))


def distance_group(distance: Column) -> Column:
    return F.coalesce(_DISTANCE_GROUP.label(distance), F.lit("Unknown"))

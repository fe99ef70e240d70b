"""Inputs as users have them: CSV columns in any order, dates in several forms, and limits of the splits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eta_spark.functions.parsing import day_first_date
from eta_spark.operators import features, splits
from eta_spark.schema import RAW_SCHEMA, REQUIRED_AT_SCORING
from eta_spark.sources.deliveries import broken_lines, read_deliveries, require_columns


def write(path, columns):
    path.write_text(",".join([*columns, "extra"]) + "\n" + ",".join([*(f"v-{c}" for c in columns), "more"]) + "\n")
    return str(path)


def test_csv_is_read_by_header(spark, tmp_path):
    every = [f.name for f in RAW_SCHEMA]
    row = read_deliveries(spark, write(tmp_path / "reversed.csv", every[::-1])).first()
    assert all(row[c] == f"v-{c}" for c in every) and row.extra == "more"
    scoring = require_columns(read_deliveries(spark, write(tmp_path / "scoring.csv", REQUIRED_AT_SCORING)))
    assert scoring.columns == [*REQUIRED_AT_SCORING, "extra"] and scoring.count() == 1


def test_absent_csv_columns_are_named(spark, tmp_path):
    path = write(tmp_path / "few.csv", REQUIRED_AT_SCORING[2:])
    with pytest.raises(ValueError, match=", ".join(REQUIRED_AT_SCORING[:2])):
        require_columns(read_deliveries(spark, path))


def test_date_forms(spark):
    texts = ["12/03/2022", "12-03-2022", "12.3.2022", "2022-03-12", "2022/3/12", "31-02-2022", "x", None]
    found = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(day_first_date(F.col("t"))).collect()]
    assert found == [dt.date(2022, 3, 12)] * 5 + [None] * 3


def test_typed_dates_pass_through(spark, sf_dir):
    from eta_spark.sources.derived import derived_deliveries

    orders = derived_deliveries(spark, sf_dir).limit(200)
    typed = orders.withColumn("Order_Date", day_first_date(F.col("Order_Date")).cast("timestamp"))
    days = [features.build_features(o).select("ID", "is_weekend").orderBy("ID", "is_weekend").collect() for o in (orders, typed)]
    assert days[0] == days[1]


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_shares_at_the_limits(orders, share):
    sides = {r.split for s in (splits.random_split, splits.temporal_split) for r in s(orders, train_share=share).select("split").distinct().collect()}
    assert sides == {"train" if share else "test"}


def test_broken_lines_stop_the_job_or_are_left_out(spark, tmp_path):
    names = [f.name for f in RAW_SCHEMA]
    good = [f"v{i}" for i in range(len(names))]
    lines = [
        ",".join(["good", *good[1:]]),
        ",".join(["short", "rest missing"]),
        ",".join(["long", *good[1:], "surplus"]),
        ",".join(["trailing", *good[1:], ""]),
        ",".join(["open", '"never closed', *good[2:]]),
        ",".join(["quoted", '"commas, inside, quotes"', *good[2:]]),
    ]
    path = str(tmp_path / "orders.csv")
    (tmp_path / "orders.csv").write_text("\n".join([",".join(names), *lines]) + "\n")
    kept = read_deliveries(spark, path, broken="drop")
    assert kept.columns == names and kept.count() == 3
    rows = {r.ID: r for r in kept.collect()}
    assert rows.keys() == {"good", "short", "quoted"}
    assert rows["short"][names[2]] is None and rows["quoted"][names[1]] == "commas, inside, quotes"
    assert {r.line.split(",")[0] for r in broken_lines(spark, path).collect()} == {"long", "trailing", "open"}
    for job in (lambda t: t.count(), lambda t: t.select("City").collect()):
        with pytest.raises(Exception, match="Broken line: "):
            job(read_deliveries(spark, path))
    with pytest.raises(ValueError, match="Unknown way"):
        read_deliveries(spark, path, broken="ignore")


def test_csv_between_jobs_keeps_types(spark, tmp_path, orders):
    from eta_spark.__main__ import engineered_orders, parse
    from eta_spark.sources.reports import write_report

    some = orders.limit(50)
    for fmt in ("csv", "parquet"):
        path = write_report(some, str(tmp_path / fmt), "engineered_orders", fmt)
        options = parse(["analyze-delays", "--engineered", path, "--output", str(tmp_path), "--output-format", fmt])
        again = engineered_orders(spark, options)
        assert [(f.name, f.dataType) for f in again.schema] == [(f.name, f.dataType) for f in orders.schema]
        assert again.select("ID", "distance_km", "is_peak_hour", "Order_Date").exceptAll(some.select("ID", "distance_km", "is_peak_hour", "Order_Date")).isEmpty()

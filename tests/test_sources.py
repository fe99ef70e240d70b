import pytest

from eta_spark.operators.features import build_features, prepare_features
from eta_spark.operators.scenarios import BASE_ORDER
from eta_spark.schema import FEATURES, RAW_SCHEMA, REQUIRED_AT_SCORING, TARGET
from eta_spark.sources.deliveries import orders_from_rows, read_deliveries, require_columns, select_present
from eta_spark.sources.model_store import load_model
from eta_spark.sources.reports import write_report


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "orders.csv"
    names = [f.name for f in RAW_SCHEMA]
    values = {**{n: "" for n in names}, "ID": "0x1", "Order_Date": "19-03-2022", "Time_Orderd": "11:30:00", TARGET: "(min) 24"}
    values |= {"Restaurant_latitude": "22.5726", "Restaurant_longitude": "88.3639", "Delivery_person_Age": "NaN "}
    values |= {"Delivery_location_latitude": "22.5958", "Delivery_location_longitude": "88.4", "Time_Order_picked": "11:45"}
    dropped = {**values, "ID": "0x2", TARGET: "(min) 0"}
    missing = {**values, "ID": "0x3", TARGET: ""}
    path.write_text("\n".join([",".join(names), *[",".join(v.values()) for v in (values, dropped, missing)]]))
    raw = read_deliveries(spark, str(path))
    assert raw.schema == RAW_SCHEMA and raw.count() == 3
    row = build_features(raw).collect()
    assert [r.ID for r in row] == ["0x1"]
    assert row[0][TARGET] == 24.0 and row[0].Delivery_person_Age is None
    assert row[0].order_hour == 11 and row[0].is_weekend == 1 and row[0].pickup_delay_min is None
    assert row[0].distance_km == pytest.approx(4.515723143882102)


def test_absent_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Dataset not found"):
        read_deliveries(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError, match="Model not found"):
        load_model(str(tmp_path / "none"))


def test_all_absent_columns_are_named(spark):
    orders = orders_from_rows(spark, [{k: v for k, v in BASE_ORDER.items() if k not in ("City", "Festival")}])
    with pytest.raises(ValueError, match="Festival, City"):
        require_columns(orders)
    assert set(REQUIRED_AT_SCORING) == set(BASE_ORDER)


def test_serving_features(spark):
    orders = orders_from_rows(spark, [BASE_ORDER, {**BASE_ORDER, "Time_Orderd": "20:30:00", "multiple_deliveries": "(min) 1"}])
    table = prepare_features(orders)
    assert table.columns == FEATURES
    exact, odd = table.collect()
    assert (exact.order_hour, exact.is_peak_hour, exact.order_dayofweek, exact.multiple_deliveries) == (20, 1, 3, 1.0)
    assert (odd.order_hour, odd.is_peak_hour, odd.multiple_deliveries) == (None, 0, None)


def test_projection_and_sink(spark, tmp_path):
    table = spark.createDataFrame([(1, "x")], f"a int, `{TARGET}` string")
    assert select_present(table, [TARGET, "zzz", "a"]).columns == [TARGET, "a"]
    path = write_report(table, str(tmp_path), "report", "csv")
    write_report(table, str(tmp_path), "report", "csv")
    assert spark.read.option("header", True).csv(path).collect()[0].asDict() == {"a": "1", TARGET: "x"}

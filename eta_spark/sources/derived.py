"""Raw deliveries derived from the lineitem, orders and customer tables.

The given tables hold no deliveries, so a fixed rule maps each line item to
one order and plants, at fixed rates, the defects that the operators handle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eta_spark.schema import TARGET


def _text(value: Column) -> Column:
    return value.cast("string")


def _two_digits(value: Column) -> Column:
    return F.lpad(_text(value), 2, "0")


def _centidegrees(value: Column) -> Column:
    return value.cast("double") / 100


def derived_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")

    order_key, line, part, supplier = (F.col(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey"))
    placed = F.col("o_orderdate")
    joined = (
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        .join(
            orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
            order_key == F.col("o_orderkey"),
        )
        .join(customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("h", order_key * 31 + line * 17 + part * 7 + supplier * 13)
    )

    h = F.col("h")

    def every(n: int) -> Column:
        return h % n == 0

    ordered_minute = (h % 12) * 5
    picked = ((h % 24) * 60 + ordered_minute + 5 + 5 * (h % 3)) % 1440
    base_lat = 1200 + (supplier % 50) * 20
    base_lon = 7200 + (supplier % 40) * 20
    minutes = 10 + part % 14 + (h % 4) * 3 + (line % 4) * 4 + F.col("l_quantity").cast("int") % 7

    return joined.select(
        F.concat_ws("-", _text(order_key), _text(line), _text(part), _text(supplier)).alias("ID"),
        F.when(~every(97), F.concat(F.lit("RIDER"), _text(supplier))).alias("Delivery_person_ID"),
        F.when(every(41), "NaN ").otherwise(_text(20 + supplier % 20)).alias("Delivery_person_Age"),
        F.when(every(43), "NaN ").otherwise(F.concat(F.lit("4."), _text(supplier % 10))).alias("Delivery_person_Ratings"),
        _centidegrees(base_lat).alias("Restaurant_latitude"),
        _centidegrees(base_lon).alias("Restaurant_longitude"),
        F.when(every(89), None)
        .when(every(101), 0.0)
        .otherwise(_centidegrees(base_lat + part % 14))
        .alias("Delivery_location_latitude"),
        F.when(every(101), 0.0).otherwise(_centidegrees(base_lon + part % 14)).alias("Delivery_location_longitude"),
        F.when(
            ~every(53),
            F.concat_ws("-", _two_digits(F.day(placed)), _two_digits(F.month(placed)), _text(F.year(placed))),
        ).alias("Order_Date"),
        F.when(every(61), "NaN ")
        .otherwise(
            F.concat(
                _two_digits(h % 24),
                F.lit(":"),
                _two_digits(ordered_minute),
                F.when(every(59), ":00").otherwise(""),
            )
        )
        .alias("Time_Orderd"),
        F.concat(_two_digits(F.floor(picked / 60)), F.lit(":"), _two_digits(picked % 60)).alias("Time_Order_picked"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Stormy")
        .when(F.col("o_orderpriority") == "2-HIGH", "Fog")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Cloudy")
        .when(F.col("o_orderpriority") == "5-LOW", "Sunny")
        .alias("Weatherconditions"),
        F.when(h % 4 == 0, "Low").when(h % 4 == 1, "Medium").when(h % 4 == 2, "High").otherwise("Jam").alias("Road_traffic_density"),
        _text(part % 3).alias("Vehicle_condition"),
        F.when(line % 4 == 0, "Meal").when(line % 4 == 1, "Snack").when(line % 4 == 2, "Drinks").otherwise("Buffet").alias("Type_of_order"),
        F.when(supplier % 3 == 0, "motorcycle").when(supplier % 3 == 1, "scooter").otherwise("electric_scooter").alias("Type_of_vehicle"),
        F.when(every(37), "NaN ").otherwise(_text(line % 4)).alias("multiple_deliveries"),
        F.when(every(50), "Yes").otherwise("No").alias("Festival"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"), "Metropolitian")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Urban")
        .otherwise("Semi-Urban")
        .alias("City"),
        F.when(every(211), None)
        .when(every(223), "(min) 0")
        .otherwise(F.concat(F.lit("(min) "), _text(minutes)))
        .alias(TARGET),
    )

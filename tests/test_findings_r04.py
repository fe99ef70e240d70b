"""One small test for each finding of the fourth round that was mended."""

import pytest

from eta_spark.functions.labels import target
from eta_spark.operators import models, preparation


def cached(spark) -> set:
    return set(spark.sparkContext._jsc.getPersistentRDDs())


def cached_parts(spark, df):
    manager = spark._jsparkSession.sharedState().cacheManager()
    return manager.lookupCachedData(df._jdf).get().cachedRepresentation().cacheBuilder().cachedColumnBuffers()


def test_f2_to_f13_vectors_of_a_fit_take_no_executor_memory(spark, orders):
    fitted = preparation.fit_preparation(orders)
    wanted = fitted.transform(orders).select(preparation.VECTOR, target().alias("label")).collect()
    before = cached(spark)
    with models.prepared(orders, fitted) as vectors:
        assert vectors.count() == len(wanted)
        assert sorted(map(str, vectors.collect())) == sorted(map(str, wanted))
        (held,) = [r for r in spark.sparkContext._jsc.sc().getRDDStorageInfo() if r.id() not in before]
        assert held.memSize() == 0 and held.diskSize() > 0
        assert cached_parts(spark, vectors).count() >= len(wanted) / models.BATCH_ROWS
    assert cached(spark) == before


def test_f2_to_f13_a_failed_fit_leaves_nothing(spark, orders):
    fitted, names = preparation.fit_preparation(orders), ("spark.sql.inMemoryColumnarStorage.batchSize", "spark.sql.files.minPartitionNum")
    before, settings = cached(spark), [spark.conf.get(n, None) for n in names]
    with pytest.raises(InterruptedError), models.prepared(orders, fitted) as vectors:
        vectors.count()
        raise InterruptedError
    assert cached(spark) == before and settings == [spark.conf.get(n, None) for n in names]


def test_f1_vectors_come_in_several_parts_for_each_core(spark, orders, tmp_path):
    orders.repartition(80).write.parquet(str(tmp_path / "orders"))
    many = spark.read.parquet(str(tmp_path / "orders"))
    with models.prepared(many, preparation.fit_preparation(orders)) as vectors:
        assert vectors.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_f2_f4_f5_f8_scored_orders_take_no_executor_memory(spark, orders):
    scored = orders.selectExpr("*", "order_hour + 1D AS one", "order_hour + 2D AS two")
    before = cached(spark)
    kept = models.keep_predictions(scored, ["one", "two"])
    assert kept.columns == ["ID", "Delivery_person_ID", "Order_Date", "Time_taken(min)", "one", "two"]
    assert sorted(map(str, kept.collect())) == sorted(map(str, scored.select(*[f"`{c}`" for c in kept.columns]).collect()))
    assert cached(spark) == before and "InMemoryTableScan" not in kept._jdf.queryExecution().executedPlan().toString()

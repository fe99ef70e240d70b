"""One small test for each finding of the third round that was mended."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from eta_spark.catalog import ORACLE, QUERIES, base
from eta_spark.operators import models, preparation
from eta_spark.operators.quantiles import exact_quantiles
from eta_spark.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from eta_spark.sources import reports, stored
from eta_spark.sources.reports import write_report


def test_f1_compressed_csv_holds_the_same_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "CSV_LINES", 400)
    lines = spark.range(0, 1000, 1, 1).selectExpr("id", "'Combined high-risk operational conditions, with a comma' AS description")
    plain = write_report(lines, str(tmp_path), "plain", "csv")
    small = write_report(lines, str(tmp_path), "small", "csv", compression="gzip")
    read = [spark.read.schema(lines.schema).option("header", True).csv(p) for p in (plain, small)]
    assert read[0].exceptAll(read[1]).isEmpty() and read[1].count() == 1000
    files = [[f for f in Path(p).iterdir() if f.name.startswith("part-")] for p in (plain, small)]
    assert [len(f) for f in files] == [1, 3]
    sizes = [sum(f.stat().st_size for f in some) for some in files]
    assert sizes[1] * 4 < sizes[0]


def test_f3_f4_f5_the_fitted_jobs_bear_their_names(spark, sf_dir, monkeypatch):
    for name, twin in (
        ("f10_batch_predict", "f10_batch_predict_of_model"),
        ("f19_paired_predictions", "f19_paired_predictions_of_models"),
        ("f20_weight_sweep", "f20_weight_sweep_of_models"),
    ):
        assert ORACLE[name] == ORACLE[twin] and f"{name}_by_formula" in QUERIES

    def fitted(*args, **kwargs):
        raise InterruptedError("a model is fitted")

    monkeypatch.setattr(models, "fit_model", fitted)
    monkeypatch.setattr(models, "fit_many", fitted)
    for name in ("f10_batch_predict", "f19_paired_predictions", "f20_weight_sweep"):
        with pytest.raises(InterruptedError):
            QUERIES[name](spark, sf_dir)


def test_f6_f8_the_fit_does_not_parse_raw_texts_in_each_pass(spark, sf_dir, monkeypatch):
    plans = []

    def seen(train, *args):
        plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        raise InterruptedError

    monkeypatch.setattr(models, "fit_model", seen)
    for name in ("a08_model_save", "a09_model_load"):
        with pytest.raises(InterruptedError):
            QUERIES[name](spark, sf_dir)
    assert len(plans) == 2 and not any("regexp" in p or "Join" in p for p in plans)


@pytest.fixture(scope="module")
def odd_train(spark, orders):
    """Gaps, a category of one level, one without any, texts beyond the basic plane."""
    odd = orders.limit(500).withColumns(
        {
            "City": F.when(F.rand(1) < 0.5, F.lit("\uff5e")).when(F.rand(2) < 0.5, F.lit("\U0001f6f5")).otherwise(F.lit("it's")),
            "Festival": F.lit(None).cast("string"),
            "Weatherconditions": F.when(F.rand(3) < 0.5, F.lit("Fog")),
            "order_hour": F.lit(7),
        }
    )
    return odd.localCheckpoint()


def test_f7_levels_come_from_a_table_as_short_as_their_list(spark, odd_train, monkeypatch):
    from pyspark.ml.feature import StringIndexer

    given = []
    fit = StringIndexer.fit
    monkeypatch.setattr(StringIndexer, "fit", lambda self, table, *args: given.append(table.count()) or fit(self, table, *args))
    fitted = preparation.fit_preparation(odd_train)
    longest = max(odd_train.select(c).where(f"`{c}` IS NOT NULL").distinct().count() for c in CATEGORICAL_FEATURES)
    assert given == [longest]
    filled = fitted.stages[0].transform(odd_train)
    names = [f"{c}_filled" for c in CATEGORICAL_FEATURES]
    whole = fit(StringIndexer(inputCols=names, outputCols=[f"{c}_i" for c in CATEGORICAL_FEATURES], stringOrderType="alphabetAsc"), filled)
    assert [list(x) for x in fitted.stages[1].labelsArray] == [list(x) for x in whole.labelsArray]
    assert fitted.transform(odd_train).where("features IS NULL").isEmpty()


def test_f7_statistics_from_one_scan(spark, odd_train):
    odd_train = odd_train.withColumn("Delivery_person_Age", F.lit(None).cast("double"))
    found = {r.feature: r for r in preparation.numeric_statistics(odd_train).collect()}
    assert set(found) == set(NUMERIC_FEATURES) and found["order_hour"].scale == 1.0
    empty = found["Delivery_person_Age"]
    assert (empty.rows, empty.observed, empty.median, empty.mean) == (500, 0, None, None)
    stacked = odd_train.select(F.col("distance_km").alias("v"), F.lit("x").alias("g"))
    assert found["distance_km"].median == exact_quantiles(stacked, F.col("v"), [0.5], ["g"], ["m"]).first().m
    assert preparation.numeric_statistics(odd_train.limit(0)).isEmpty()


@pytest.mark.parametrize(("limit", "at_once"), [(400, 1), (1000, 2), (10**6, 4)])
def test_f2_f7_large_fits_follow_each_other(spark, odd_train, monkeypatch, limit, at_once):
    asked = []
    monkeypatch.setattr(models, "ORDERS_AT_ONCE", limit)
    monkeypatch.setattr(models, "side_by_side", lambda spark, tasks, n: asked.append(n) or {})
    models.fit_many(odd_train, {"a": (models.BOOSTED, None), "b": (models.BOOSTED, 2.0)}, models.SMOKE)
    assert asked == [at_once]


def test_f12_f14_f18_to_f22_only_the_columns_asked_for_are_built(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(stored, "_WRITTEN", {})
    for name in ("a05_inline_rows", "a10_training_record", "d24_class_balance", "f17_group_validation", "d21_high_risk_combinations"):
        QUERIES[name](spark, sf_dir).collect()
    held = {(name, columns): spark.read.parquet(path).columns for (_, name, _, columns), path in stored._WRITTEN.items()}
    assert set(held) == {
        ("deliveries", ("City", "Road_traffic_density")),
        *(("engineered", tuple(c)) for c in (base.GEO_COLUMNS, base.SCORED_COLUMNS, base.KEYED_COLUMNS)),
    }
    assert all(list(columns) == found for (_, columns), found in held.items())
    # A table that holds the columns serves, and gives the rows of the whole one.
    narrow = base.engineered(spark, sf_dir, ["ID", "distance_km", "City"])
    assert len(stored._WRITTEN) == 4
    whole = base.engineered(spark, sf_dir).select(narrow.columns)
    assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()
    assert len(stored._WRITTEN) == 5


def test_f12_no_method_too_large_to_be_compiled_builds_the_orders(spark, sf_dir, monkeypatch):
    limit, seen = "spark.sql.codegen.hugeMethodLimit", []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(stored, "_WRITTEN", {})
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *args, **kwargs: seen.append(spark.conf.get(limit)) or write(*args, **kwargs))
    before = spark.conf.get(limit)
    base.engineered(spark, sf_dir, ["ID"])
    assert seen == ["8000"] and spark.conf.get(limit) == before


def test_op3_plain_words_skip_the_normalisation_and_get_the_tokenizers_ids(monkeypatch):
    import public_tokenizers

    from eta_spark.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = ["", None, "One two,  one\n\nTWO. it's it'll !'s can't'", "Été Øre straße. ÿ,", "a1b22 x### ...!? </w> <b> q-r_s", "word" * 500]
    mixed = ["a×b ª2² é µ İx y z", "Жж. 中文 \U0001f600 a\x1cb\x00c\x7f", "x <|endoftext|> y", "two <|", "Two"]
    made = packing._tokenizer(path)
    want = {text: made.encode(text or "", add_special_tokens=False).ids for text in plain + mixed}

    def ids(texts):
        return [list(memoryview(coded).cast("I")) for coded in packing.token_ids(texts, path)]

    packing._words(path).clear()
    with monkeypatch.context() as held:
        held.setattr(packing, "_encode", lambda made, texts: pytest.fail(f"normalised: {texts}") if texts else [])
        assert ids(plain) == [want[text] for text in plain]
    assert ids(mixed + plain) == [want[text] for text in mixed + plain]
    # A tokenizer that cuts words otherwise does not get pieces from here.
    packing._words(path).clear()
    monkeypatch.setattr(packing, "_model", lambda path: None)
    assert ids(mixed + plain) == [want[text] for text in mixed + plain]
    packing._words(path).clear()

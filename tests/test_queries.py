"""Every registered query beside its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import check, connect
from eta_spark.catalog import QUERIES

# Fitted in test_models as well; here one small fit of each kind is enough.
SLOW = {
    "a09_model_load",
    "f09_weighted_fit",
    "f10_batch_predict_of_model",
    "f13_permutation_importance_of_model",
    "f14_experiment_matrix",
    "f19_paired_predictions_of_models",
    "f20_weight_sweep_of_models",
    "f23_final_fit",
    "g01_predict_eta_with_model",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, sf_dir, name):
    outcome, _ = check(spark, con, sf_dir, name)
    assert outcome.startswith(("equal", "rows only"))


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["Road_traffic_density", "orders", "long_deliveries", "long_delivery_rate"]

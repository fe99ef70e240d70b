"""ETA regressors: fitting, weighting and chained prediction."""

import uuid
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.functions.labels import tail_weight, target
from eta_spark.operators.ensembles import fit_boosted, fit_forest
from eta_spark.operators.preparation import VECTOR, fit_preparation
from eta_spark.schema import GROUP_COLUMN, TARGET
from eta_spark.session import cached_in_batches, read_in_parts, shared_dir
from eta_spark.sources.stored import stored

#: Fits that run at a time, at most.
AT_ONCE = 4
#: Orders that the fits running at a time hold together. Each fit of trees keeps its own binned copy of the vectors
#: in the executors; copies beyond their memory are written out and read again in every pass.
ORDERS_AT_ONCE = 20_000_000
#: Parts of the vectors for each core, about. A fit of trees keeps these parts, and each of its passes ends with its slowest core.
PARTS_A_CORE = 4
#: Vectors of a cached batch; Spark's 10 000 make batches of some 3 MB.
BATCH_ROWS = 500
LINEAR, FOREST, BOOSTED = "Linear Regression", "Random Forest", "Boosted Trees"


@dataclass(frozen=True)
class Preset:
    """Hyper-parameters by model."""

    linear: dict = field(default_factory=lambda: {"regParam": 0.0, "maxIter": 200, "tol": 1e-9})
    forest: dict = field(default_factory=dict)
    boosted: dict = field(default_factory=dict)

    def regressor(self, name: str):
        if name == LINEAR:
            return LinearRegression(**self.linear)
        if name == FOREST:
            return RandomForestRegressor(featureSubsetStrategy="all", seed=42, **self.forest)
        if name == BOOSTED:
            return GBTRegressor(lossType="squared", featureSubsetStrategy="all", seed=42, **self.boosted)
        raise ValueError(f"Unknown model: {name}")


# Tuned settings of the published models. 256 split candidates per
# feature stand in for the finer splits of single-machine learners.
PUBLISHED = Preset(
    forest={"numTrees": 300, "maxDepth": 18, "minInstancesPerNode": 2, "maxBins": 256},
    boosted={
        "maxIter": 500,
        "maxDepth": 6,
        "stepSize": 0.03,
        "subsamplingRate": 0.9,
        "minInstancesPerNode": 3,
        "maxBins": 256,
    },
)
# Few trees, for checks of the workflow rather than of model quality.
SMOKE = Preset(
    forest={"numTrees": 8, "maxDepth": 8, "minInstancesPerNode": 2},
    boosted={"maxIter": 8, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 0.9, "minInstancesPerNode": 3},
)


@contextmanager
def prepared(train: DataFrame, preparation: PipelineModel):
    """Training vectors on the executors' disks for the passes of a fit. Lost blocks are recomputed from the source.

    Executor memory is left to the binned copy of each fit. Batches are small since a task that writes them to disk
    holds a hundred of them, which at Spark's own size is some 300 MB.
    """
    spark = train.sparkSession
    with cached_in_batches(spark, BATCH_ROWS), read_in_parts(spark, PARTS_A_CORE):
        vectors = preparation.transform(train).select(VECTOR, target().alias("label")).persist(StorageLevel.DISK_ONLY)
        try:
            yield vectors
        finally:
            vectors.unpersist()


def fit_on_vectors(vectors: DataFrame, name: str, preset: Preset, weight: float | None = None):
    """``weight`` is the sample weight of long deliveries; None fits unweighted."""
    shared_dir(vectors.sparkSession)  # boosting cuts its lineage there
    regressor = preset.regressor(name)
    if weight is not None:
        vectors = vectors.withColumn("sample_weight", tail_weight(F.col("label"), weight))
        regressor.setWeightCol("sample_weight")
    return regressor.setFeaturesCol(VECTOR).setLabelCol("label").fit(vectors)


def join_stages(preparation: PipelineModel, fitted: Transformer) -> PipelineModel:
    return PipelineModel([*preparation.stages, fitted])


def fit_model(train: DataFrame, name: str, preset: Preset, weight: float | None = None) -> PipelineModel:
    preparation = fit_preparation(train)
    with prepared(train, preparation) as vectors:
        return join_stages(preparation, fit_on_vectors(vectors, name, preset, weight))


def fit_in_stages(train: DataFrame, name: str, preset: Preset, folder: str, weight: float | None = None) -> PipelineModel:
    """``fit_model`` for hundreds of trees: stages are kept in ``folder``, and a fit started again there goes on.

    The vectors are stored in the folder too, so that a later run sees the same rows in the same order.
    """
    spark = train.sparkSession
    path = f"{folder.rstrip('/')}/vectors"
    preparation = PipelineModel.load(f"{folder.rstrip('/')}/preparation") if _exists(spark, f"{path}/_SUCCESS") else None
    if preparation is None:
        preparation = fit_preparation(train)
        preparation.write().overwrite().save(f"{folder.rstrip('/')}/preparation")
        preparation.transform(train).select(VECTOR, target().alias("label")).write.mode("overwrite").parquet(path)
    vectors, column = spark.read.parquet(path), None
    if weight is not None:
        column = "sample_weight"
        vectors = vectors.withColumn(column, tail_weight(F.col("label"), weight))
    if name == BOOSTED:
        fitted = [fit_boosted(vectors, preset.boosted, f"{folder.rstrip('/')}/boosted", column)]
    elif name == FOREST:
        fitted = fit_forest(vectors, preset.forest, f"{folder.rstrip('/')}/forest", column).stages
    else:
        fitted = [fit_on_vectors(vectors.drop("sample_weight"), name, preset, weight)]
    return PipelineModel([*preparation.stages, *fitted])


def _exists(spark, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def side_by_side(spark, tasks: dict, at_once: int) -> dict:
    """Results of the tasks by name, ``at_once`` of them running, each in a scheduler pool of its own.

    Fits are chains of short jobs, which leave cores idle when they run alone. With
    ``spark.scheduler.mode=FAIR`` the pools share the cores evenly. The first error cancels the jobs of all.
    """
    context, tag = spark.sparkContext, f"side-by-side-{uuid.uuid4().hex}"

    @inheritable_thread_target(spark)
    def run(name: str):
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"{tag}-{name}")
        return tasks[name]()

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        running = {pool.submit(run, name): name for name in tasks}
        try:
            done = {running[future]: future.result() for future in as_completed(running)}
        except BaseException:
            for future in running:
                future.cancel()
            context.cancelJobsWithTag(tag)
            raise
    return {name: done[name] for name in tasks}


def fit_many(train: DataFrame, wanted: dict[str, tuple[str, float | None]], preset: Preset, at_once: int = AT_ONCE):
    """Several models on one preparation and one set of vectors, a few fits at a time.

    ``wanted`` maps a prediction column to (model, tail weight). Returns the
    preparation and the fitted models by prediction column.
    """
    preparation = fit_preparation(train)
    with prepared(train, preparation) as vectors:
        rows = vectors.count()  # kept before the fits share it
        at_once = min(at_once, max(1, ORDERS_AT_ONCE // max(1, rows)))
        tasks = {c: partial(fit_on_vectors, vectors, name, preset, weight) for c, (name, weight) in wanted.items()}
        fitted = side_by_side(train.sparkSession, tasks, at_once)
    return preparation, {column: model.setPredictionCol(column) for column, model in fitted.items()}


def predict_many(orders: DataFrame, preparation: PipelineModel, fitted: dict) -> DataFrame:
    """All predictions beside each other, from one pass over the orders."""
    scored = preparation.transform(orders)
    for model in fitted.values():
        scored = model.transform(scored)
    return scored


def keep_predictions(scored: DataFrame, predictions: list[str]) -> DataFrame:
    """Order columns and predictions only, stored so that several reports score the orders once."""
    kept = ["ID", GROUP_COLUMN, "Order_Date", TARGET, *predictions]
    return stored(scored.select(*[F.col(f"`{c}`") for c in kept]), "scored")

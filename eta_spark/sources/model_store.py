"""Fitted models on shared storage."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except (AnalysisException, Py4JJavaError) as error:
        if "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Model not found: {path}") from error
        raise

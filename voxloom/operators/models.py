"""Linear classifiers on TF-IDF vectors and the predictions table they make."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.labels import argmax_id
from voxloom.operators import svm
from voxloom.operators.features import MAX_FEATURES, MIN_DF, featurize, tfidf_stages
from voxloom.operators.metrics import scores
from voxloom.schema import require_columns
from voxloom.session import checkpointed

MAX_ITER = 2000
TOLERANCE = 1e-4   # it, not MAX_ITER, ends a fit
DEPTH = 2   # levels in which the gradients of the tasks are added up
MODEL_NAMES = {"logreg": "LogReg", "svm": "LinearSVM"}


def _fit(kind: str, featured: DataFrame, max_iter: int):
    if kind == "logreg":
        # The usual C = 1 penalty in Spark's scale: loss is a mean over rows, so lambda = 1 / n.
        return LogisticRegression(family="multinomial", regParam=1.0 / max(featured.count(), 1), elasticNetParam=0.0,
                                  standardization=False, maxIter=max_iter, tol=TOLERANCE, aggregationDepth=DEPTH,
                                  featuresCol="features", labelCol="label_id",
                                  predictionCol="prediction").fit(featured)
    if kind == "svm":
        return svm.fit(featured)
    raise ValueError(f"unknown classifier {kind!r}")


def fit_classifier(train: DataFrame, kind: str = "logreg", id_col: str = "id",
                   text: str = "cleaned_text", max_iter: int = MAX_ITER,
                   min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> PipelineModel:
    """TF-IDF and a linear classifier as one fitted, savable PipelineModel.

    The rows are read for their count, the vocabulary and the vectors, so they are cut from
    their lineage once: cleaning, splits and text variants do not run again. The solver
    reads the vectors at every step until its tolerance is met, so those stay on the executors
    and spill to their disks, in the partitions of the rows; gradients are added up as a tree. The
    SVM's solver keeps blocks of its own, for which the vectors are read once.
    """
    require_columns(train, [id_col, text, "label_id"])
    rows = checkpointed(
        train.select(id_col, text, F.col("label_id").cast("double").alias("label_id")))
    stages = tfidf_stages(rows, id_col, text, min_df, max_features)
    featured = featurize(stages, rows).select("features", "label_id")
    if kind != "svm":
        featured = featured.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = _fit(kind, featured, max_iter)
    finally:
        featured.unpersist()
    return PipelineModel([*stages, model])


def predict(model: PipelineModel, df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Predictions table: the kept columns, ``model`` and ``pred_id``."""
    return model.transform(df).select(
        *keep, F.lit(name).alias("model"), F.col("prediction").cast("int").alias("pred_id"))


def predict_scores(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the class probabilities as ``scores array<double>``."""
    return model.transform(df).select(*keep, vector_to_array("probability").alias("scores"))


def score_metrics(df: DataFrame, scores_col: str = "scores", groups: list[str] | None = None,
                  ) -> DataFrame:
    """Arg-max of a score table, then accuracy and macro-F1."""
    groups = groups or []
    pairs = df.withColumn("pred_id", argmax_id(scores_col)).select(
        *groups, "label_id", "pred_id")
    return scores(pairs, groups).select(*groups, "accuracy", "macro_f1")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_available(paths: dict[str, str]) -> dict[str, PipelineModel]:
    """Models that can be loaded; absent ones are left out."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = load_model(path)
        except Exception as error:  # Spark reports a missing path in several classes
            print(f"skipping model {name}: {type(error).__name__}")
    return found

"""ML operators (M3-M12) on Spark ML.

Everything is a Spark ML stage, so fitting and scoring are distributed
(StringIndexer counts labels with a distributed aggregate; logistic
regression aggregates gradients with ``treeAggregate``).  The F1 and
confusion-matrix operators are plain DataFrame aggregates, so they can be
checked against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of the reference's jobs (fixed values).
LR_MAX_ITER = 10
LR_REG_PARAM = 0.01
GRID_MAX_ITER = (20, 30)
GRID_REG_PARAM = (0.1, 0.01)
TRAIN_RATIO = 0.7
SPLIT_SEED = 42


def label_indexer(input_col: str, output_col: str = "label") -> StringIndexer:
    """M3: most frequent label -> 0.0, ties alphabetical; unseen labels fail."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid="error",
                         stringOrderType="frequencyDesc")


def feature_assembler(input_cols: Sequence[str], output_col: str = "features") -> VectorAssembler:
    """M4: numeric (or vector) columns -> one vector; nulls fail."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid="error")


def with_vector(df: DataFrame, array_col: str, output_col: str | None = None) -> DataFrame:
    """Array column -> ML vector column (for array-typed features)."""
    return df.withColumn(output_col or array_col, array_to_vector(F.col(array_col)))


def vector_elements(df: DataFrame, vector_col: str, n: int, prefix: str = "f") -> DataFrame:
    """Vector column -> ``n`` double columns (for checks in SQL)."""
    arr = vector_to_array(F.col(vector_col))
    return df.select("*", *[arr[i].alias(f"{prefix}{i}") for i in range(n)]).drop(vector_col)


def logistic_regression(features_col: str = "features", label_col: str = "label",
                        max_iter: int = LR_MAX_ITER, reg_param: float = LR_REG_PARAM) -> LogisticRegression:
    """M5: multinomial-capable LR (family auto, standardization, intercept)."""
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter, regParam=reg_param)


def classification_pipeline(label_source: str, feature_cols: Sequence[str], label_col: str = "label",
                            max_iter: int = LR_MAX_ITER, reg_param: float = LR_REG_PARAM) -> Pipeline:
    """M6: indexer -> assembler -> LR."""
    return Pipeline(stages=[label_indexer(label_source, label_col), feature_assembler(feature_cols),
                            logistic_regression(label_col=label_col, max_iter=max_iter, reg_param=reg_param)])


def decoder(model: PipelineModel, input_col: str = "prediction", output_col: str = "predicted_label") -> IndexToString:
    """M8: index -> label with the fitted indexer's labels."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=model.stages[0].labels)


def f1_evaluator(label_col: str = "label", prediction_col: str = "prediction") -> MulticlassClassificationEvaluator:
    """Weighted F1."""
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col, metricName="f1")


def param_grid(pipeline: Pipeline, max_iter: Sequence[int] = GRID_MAX_ITER,
               reg_param: Sequence[float] = GRID_REG_PARAM):
    """M9: ``maxIter x regParam`` over the pipeline's LR stage."""
    lr = pipeline.getStages()[-1]
    return ParamGridBuilder().addGrid(lr.maxIter, list(max_iter)).addGrid(lr.regParam, list(reg_param)).build()


def train_validation_split(pipeline: Pipeline, evaluator=None, grid=None, train_ratio: float = TRAIN_RATIO,
                           seed: int = SPLIT_SEED, parallelism: int = 1) -> TrainValidationSplit:
    """Model selection on one split; the first of tied best models wins."""
    label_col = pipeline.getStages()[0].getOutputCol()
    return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid or param_grid(pipeline),
                                evaluator=evaluator or f1_evaluator(label_col), trainRatio=train_ratio,
                                seed=seed, parallelism=parallelism)


def save_selection(model: TrainValidationSplitModel, path: str, overwrite: bool = False) -> None:
    """K4."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_selection(path: str) -> TrainValidationSplitModel:
    """S7."""
    return TrainValidationSplitModel.read().load(path)


def load_best_model(path: str) -> PipelineModel:
    """S8."""
    return PipelineModel.read().load(f"{path.rstrip('/')}/bestModel")


def grid_metrics(model: TrainValidationSplitModel) -> list[dict]:
    """Validation metric of every grid point (driver-side: one per point)."""
    out = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.validationMetrics):
        row = {p.name: v for p, v in params.items()}
        row["metric"] = float(metric)
        out.append(row)
    return out


def confusion_matrix(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """``label, prediction, n`` (a distributed aggregate)."""
    return (df.groupBy(F.col(label_col).cast("double").alias("label"),
                       F.col(prediction_col).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def weighted_f1(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """M11 as a DataFrame: ``sum_c (actual_c / N) * 2 tp_c / (actual_c + predicted_c)``.

    Equals ``MulticlassClassificationEvaluator(metricName='f1')``; classes are
    the labels present in ``label_col``.
    """
    cm = confusion_matrix(df, label_col, prediction_col)
    actual = cm.groupBy("label").agg(F.sum("n").alias("actual"),
                                     F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                           .otherwise(0)).alias("tp"))
    predicted = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    per_class = actual.join(predicted, "label", "left").fillna(0, ["predicted"])
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("actual") + F.col("predicted"))).otherwise(0.0)
    return per_class.agg((F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1"))

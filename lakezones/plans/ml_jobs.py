"""ML jobs (I6-I8): train-split-score-decode, model selection, batch inference.

Scored rows are returned (and can be written) as a DataFrame; nothing is
collected row by row to the driver (the reference logs every test row from
a ``collect()``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.sql import DataFrame

from ..operators import ml
from ..operators.sampling import hash_sample, random_split, sample_limit


@dataclass
class Scored:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame


def train_and_score(df: DataFrame, *, label_source: str, feature_cols: Sequence[str], id_col: str,
                    weights: Sequence[float] = (0.7, 0.3), seed: int = ml.SPLIT_SEED,
                    max_iter: int = ml.LR_MAX_ITER, reg_param: float = ml.LR_REG_PARAM,
                    split=None, output_col: str = "output", label_col: str = "label") -> Scored:
    """Split 70/30, fit indexer -> assembler -> LR on the train part,
    score the test part, decode the prediction to a label (P3 + M8)."""
    train, test = split(df) if split else random_split(df, weights, seed)
    model = ml.classification_pipeline(label_source, feature_cols, label_col=label_col, max_iter=max_iter,
                                       reg_param=reg_param).fit(train)
    scored = model.transform(test).select(id_col, "probability", "prediction", label_source)
    decoded = ml.decoder(model, "prediction", output_col).transform(scored)
    return Scored(model, train, test, decoded)


@dataclass
class Selection:
    model: TrainValidationSplitModel
    reloaded: TrainValidationSplitModel
    metrics: list[dict]
    f1: float


def select_model(df: DataFrame, *, label_source: str, feature_cols: Sequence[str], path: str,
                 label_col: str = "Label", seed: int = ml.SPLIT_SEED, train_ratio: float = ml.TRAIN_RATIO,
                 parallelism: int = 1, overwrite: bool = False) -> Selection:
    """Grid ``maxIter x regParam`` with a train/validation split, refit
    on all rows, save (K4), reload (S7) and score with weighted F1 (M12)."""
    pipeline = ml.classification_pipeline(label_source, feature_cols, label_col=label_col)
    evaluator = ml.f1_evaluator(label_col)
    tvs = ml.train_validation_split(pipeline, evaluator, train_ratio=train_ratio, seed=seed,
                                    parallelism=parallelism)
    model = tvs.fit(df)
    ml.save_selection(model, path, overwrite=overwrite)
    reloaded = ml.load_selection(path)
    f1 = evaluator.evaluate(reloaded.transform(df))
    return Selection(model, reloaded, ml.grid_metrics(model), float(f1))


def batch_inference(df: DataFrame, *, model_path: str, key: Sequence[str] = (), fraction: float | None = None,
                    n: int | None = None, seed: int = 0, output_col: str = "predict_label") -> DataFrame:
    """I8: load the best pipeline (S8), score all rows and decode (M8); with
    ``fraction`` a sample of them, cut to ``n`` rows if given (M2 + O2)."""
    model = ml.load_best_model(model_path)
    if n is not None:
        df = sample_limit(df, key, 1.0 if fraction is None else fraction, n, seed)
    elif fraction is not None:
        df = hash_sample(df, key, fraction, seed)
    return ml.decoder(model, "prediction", output_col).transform(model.transform(df))


def save_predictions(predictions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K8, re-aimed: scored rows go to a table, not to the driver log.
    Vector columns are stored as arrays so any reader can use them."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    cols = [vector_to_array(predictions[f.name]).alias(f.name) if isinstance(f.dataType, VectorUDT)
            else predictions[f.name] for f in predictions.schema.fields]
    predictions.select(*cols).write.mode(mode).parquet(path)

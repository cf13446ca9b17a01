"""ML on an invented three-cluster set with the Iris CSV shape (the test
tables carry little label signal)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakezones.operators import ml
from lakezones.operators.sampling import hash_sample, hash_split, random_split, sample_limit
from lakezones.plans.ml_jobs import batch_inference, select_model, train_and_score
from lakezones.session import scratch_dir

FEATURES = ["SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm"]


@pytest.fixture(scope="module")
def flowers(spark):
    rng = np.random.default_rng(7)
    centers = {"alpha": (5.0, 3.4, 1.5, 0.25), "beta": (5.9, 2.8, 4.3, 1.3), "gamma": (6.6, 3.0, 5.6, 2.0)}
    rows, i = [], 1
    for name, c in centers.items():
        for _ in range(50):
            x = rng.normal(c, (0.3, 0.3, 0.25, 0.12))
            rows.append((i, *[round(float(v), 1) for v in x], name))
            i += 1
    path = scratch_dir(spark, "flowers") + "/flowers.csv"
    (spark.createDataFrame(rows, "Id int, SepalLengthCm double, SepalWidthCm double, PetalLengthCm double, "
                                 "PetalWidthCm double, Species string")
     .coalesce(1).write.option("header", True).csv(path))
    from lakezones.sources.files import read_csv

    return read_csv(spark, path)


def test_train_score_decode(spark, flowers):
    s = train_and_score(flowers, label_source="Species", feature_cols=FEATURES, id_col="Id")
    pred = s.predictions
    assert pred.columns == ["Id", "probability", "prediction", "Species", "output"]
    acc = pred.filter(F.col("Species") == F.col("output")).count() / pred.count()
    assert acc > 0.9
    labeled = s.model.transform(s.test)
    f1 = ml.f1_evaluator("label").evaluate(labeled)
    own = ml.weighted_f1(labeled, "label", "prediction").first()["f1"]
    assert f1 > 0.9 and own == pytest.approx(f1, abs=1e-12)


def test_predictions_saved_as_table(spark, flowers):
    from lakezones.plans.ml_jobs import save_predictions

    s = train_and_score(flowers, label_source="Species", feature_cols=FEATURES, id_col="Id")
    path = scratch_dir(spark, "pred") + "/p"
    save_predictions(s.predictions, path)
    back = spark.read.parquet(path)
    assert back.count() == s.predictions.count()
    assert dict(back.dtypes)["probability"] == "array<double>"


def test_weighted_f1_matches_evaluator_on_noise(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 4, 500), rng.integers(0, 5, 500))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    own = ml.weighted_f1(df).first()["f1"]
    assert own == pytest.approx(ml.f1_evaluator().evaluate(df), abs=1e-12)
    cm = {(r["label"], r["prediction"]): r["n"] for r in ml.confusion_matrix(df).collect()}
    assert sum(cm.values()) == 500


def test_label_index_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("a",)], "s string")
    model = ml.label_indexer("s", "i").fit(df)
    assert model.labels == ["a", "c", "b"]  # count desc, ties alphabetical
    with pytest.raises(Exception):
        model.transform(spark.createDataFrame([("z",)], "s string")).collect()


def test_model_selection_save_load(spark, flowers):
    path = scratch_dir(spark, "model") + "/model"
    sel = select_model(flowers, label_source="Species", feature_cols=FEATURES, path=path)
    assert len(sel.metrics) == 4
    assert {(m["maxIter"], m["regParam"]) for m in sel.metrics} == {(20, 0.1), (20, 0.01), (30, 0.1), (30, 0.01)}
    assert sel.f1 == pytest.approx(ml.f1_evaluator("Label").evaluate(sel.model.transform(flowers)))
    assert sel.f1 > 0.9
    out = batch_inference(flowers, model_path=path, key=["Id"], fraction=0.5, n=5)
    assert out.count() == 5
    assert "predict_label" in out.columns


def test_splits(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    a, b = hash_split(df, ["k"], (0.7, 0.3), 42)
    a2, _ = hash_split(df.repartition(11), ["k"], (0.7, 0.3), 42)
    assert a.count() + b.count() == 10000
    assert {r.k for r in a.collect()} == {r.k for r in a2.collect()}
    assert 6700 < a.count() < 7300
    three = hash_split(df, ["k"], (1, 1, 2), 1)
    assert sum(p.count() for p in three) == 10000
    assert 900 < hash_sample(df, ["k"], 0.1, 0).count() < 1100
    assert [r.k for r in sample_limit(df, ["k"], 0.1, 5).collect()] == sorted(r.k for r in sample_limit(df, ["k"], 0.1, 5).collect())
    tr, te = random_split(df, (0.7, 0.3), 42)
    assert tr.count() + te.count() == 10000


def test_vector_elements(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    out = ml.vector_elements(ml.feature_assembler(["a", "b"]).transform(df), "features", 2)
    assert out.first()["f1"] == 3.0


def test_parallel_grid_same_selection(spark, flowers):
    """Fitting grid points side by side picks the same model with the same
    validation metrics as fitting them one by one."""
    one = select_model(flowers, label_source="Species", feature_cols=FEATURES,
                       path=scratch_dir(spark, "model") + "/m1")
    four = select_model(flowers, label_source="Species", feature_cols=FEATURES,
                        path=scratch_dir(spark, "model") + "/m4", parallelism=4)
    assert [round(m["metric"], 9) for m in one.metrics] == [round(m["metric"], 9) for m in four.metrics]
    assert round(one.f1, 9) == round(four.f1, 9)

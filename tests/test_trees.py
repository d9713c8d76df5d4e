"""Trees, forests and boosting over blocks, against Spark ML's own and plain loops."""

import numpy as np
import pytest
from pyspark.ml import regression
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from parcelspark.operators import modeling, trees
from parcelspark.operators.features import gold_features
from parcelspark.session import stage
from parcelspark.sources.synthetic import synthetic_valuations

COMMON = dict(featuresCol="features", labelCol="label", maxBins=64, minInstancesPerNode=5, seed=7)


@pytest.fixture(scope="module")
def prepared(spark):
    i = F.col("id")
    df = spark.range(6000).select(
        (i * 37 % 41).cast("double").alias("size_sqm"), (i * 11 % 7).cast("int").alias("rooms"),
        F.concat(F.lit("t"), i * 13 % 5).alias("property_type"), F.lit(2.0).alias("bathrooms"),
        F.exp(2 + (i * 37 % 41) / 20 + F.sin(i * 11 % 7) + (i * 13 % 5) * (i * 13 % 5 - 3) / 5
              + (i * 7919 % 1009) / 2018).alias("sale_price"))
    pipeline, rows = modeling.model_matrix(df, high_card=[])
    rows = stage(rows, "rows")
    modeling._checkpoint_folder(rows)
    features = pipeline.fit(rows)
    return features, rows, features.transform(rows).select("label", "features"), trees.make_blocks(
        features, rows, 64)


def predictions(model, vectors):
    return np.array([r[0] for r in model.transform(vectors).select("prediction").collect()])


@pytest.mark.parametrize("kind, settings", [
    (DecisionTreeRegressor, dict(maxDepth=5)),
    (GBTRegressor, dict(maxDepth=3, maxIter=6, stepSize=0.3, lossType="squared")),
    (GBTRegressor, dict(maxDepth=4, maxIter=6, stepSize=0.3, lossType="absolute"))],
    ids=["tree", "squared", "absolute"])
def test_same_as_spark_ml_without_draws(prepared, kind, settings):
    _, _, vectors, blocks = prepared
    regressor = kind(**settings, **COMMON)
    got, want = predictions(trees.fit(regressor, blocks), vectors), predictions(regressor.fit(vectors), vectors)
    assert np.mean(np.abs(got - want) < 1e-9) > 0.99
    assert trees.fit(regressor, blocks).featureImportances.size == vectors.first()["features"].size


def test_forest_by_shuffle_and_direct(prepared, monkeypatch, tmp_path):
    _, _, vectors, blocks = prepared
    forest = RandomForestRegressor(numTrees=6, maxDepth=6, featureSubsetStrategy="0.6", subsamplingRate=0.8,
                                   **COMMON)
    a = trees.fit(forest, blocks)
    monkeypatch.setattr(trees, "DIRECT_BYTES", 0)
    b = trees.fit(forest, blocks)
    assert np.allclose(predictions(a, vectors), predictions(b, vectors))
    b.save(str(tmp_path / "forest"))
    again = regression.RandomForestRegressionModel.load(str(tmp_path / "forest"))
    assert np.allclose(predictions(again, vectors), predictions(a, vectors))
    label = np.array([r[0] for r in vectors.select("label").collect()])
    ours, theirs = (np.mean((predictions(m, vectors) - label) ** 2) for m in (a, forest.fit(vectors)))
    assert ours < 1.2 * theirs


def test_sums_against_loops(monkeypatch):
    rng = np.random.default_rng(3)
    bins = trees.Bins([np.arange(3.0), np.arange(3.0)], [4, 4])
    blocks = [(k, k == 4, rng.integers(0, 4, (2, 500)).astype(np.uint8), rng.normal(size=500)) for k in range(5)]
    monkeypatch.setattr(trees, "_APART", 700)
    for signs in (True, False):
        how = trees.Growth(2, 1, 0.0, 0.7, False, 2, 5, signs)
        (h,), error = trees._sums(blocks, how, bins, [(0, trees.Tree(2, 4).tables())], 0, [np.array([1, 0])])
        want = np.zeros((2, 2, 1, 4))
        for number, held, x, left in blocks[:4]:
            taken = how.weights(number, 0, 500) > 0
            for f in range(2):
                for b, v in zip(x[f][taken], left[taken]):
                    want[:, f, 0, b] += 1, (1 if v >= 0 else -1) if signs else v
        assert np.allclose(h, want) and error[1] == 500
        assert error[0] == pytest.approx(np.abs(blocks[4][3]).sum())


def test_poisson_counts():
    got = trees._poisson(np.random.default_rng(1).random(200_000, np.float32), 0.8)
    assert got.mean() == pytest.approx(0.8, abs=0.01) and got.var() == pytest.approx(0.8, abs=0.02)


def test_unknown_labels_are_an_error(spark, prepared):
    features, rows, _, _ = prepared
    with pytest.raises(Exception, match="must be known"):
        trees.make_blocks(features, rows.withColumn("label", F.when(F.col("rooms") > 0, F.col("label"))), 64)


def test_features_that_cannot_be_split_leave_the_mean(spark):
    df = spark.range(40).select(F.lit(3.0).alias("size_sqm"), (F.col("id") + 1.0).alias("sale_price"))
    pipeline, rows = modeling.model_matrix(df, categorical=[], high_card=[])
    model = modeling.train_gbt(pipeline, rows, maxIter=2, maxDepth=2)
    mean = rows.agg(F.avg("label")).first()[0]
    assert np.abs(predictions(model, rows) - mean).max() < 1


def test_training_grows_over_blocks(spark, monkeypatch):
    """Spark ML's own fits pass over the rows as objects, once for each tree and level."""
    def never(self, dataset):
        raise AssertionError("fitted row by row")

    monkeypatch.setattr(GBTRegressor, "_fit", never)
    gold = stage(gold_features(synthetic_valuations(spark, 1500)).drop("property_hash"), "gold")
    pipeline, rows = modeling.model_matrix(gold, high_card=[])
    model = modeling.train_gbt(pipeline, rows.filter("sale_month < '2025-06'"),
                               rows.filter("sale_month >= '2025-06'"), maxIter=12, maxDepth=3, stepSize=0.3,
                               minInstancesPerNode=5, patience=3, chunk=4)
    assert 1 <= model.stages[-1].getNumTrees <= 12

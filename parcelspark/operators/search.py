"""Search for a price model: a seeded list of trials, successive halving and a weighted vote."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators import modeling
from parcelspark.operators.modeling import HIGH_CARDINALITY, LABEL
from parcelspark.session import stage

# Trials of a search, and how many run at a time.
TRIALS, CONCURRENT = 50, 4
#: Each rung keeps one trial in ETA and gives the others ETA times the rows.
ETA = 3
#: Picks of the greedy selection.
PICKS = 20


def trial_list(n: int = TRIALS, seed: int = 42) -> dict[str, object]:
    """``n`` regressors by name, drawn with ``seed``; linear models, trees, forests and boosting take
    turns."""
    rng, out = random.Random(seed), {}
    common = dict(featuresCol="features", labelCol=LABEL)
    for i in range(n):
        kind = ("linear", "tree", "forest", "boosted")[i % 4]
        depth, least = rng.randint(3, 8), rng.choice((1, 5, 20, 50))
        tree = dict(maxDepth=depth, minInstancesPerNode=least, seed=seed + i, maxBins=64)
        if kind == "linear":
            model = LinearRegression(regParam=10 ** rng.uniform(-4, 0),
                                     elasticNetParam=rng.choice((0.0, 0.5, 1.0)), **common)
        elif kind == "tree":
            model = DecisionTreeRegressor(**tree, **common)
        elif kind == "forest":
            model = RandomForestRegressor(
                numTrees=rng.randint(5, 20), subsamplingRate=rng.uniform(0.5, 1.0),
                featureSubsetStrategy=rng.choice(("onethird", "0.6", "all")), **tree, **common)
        else:
            model = GBTRegressor(
                **tree | dict(maxDepth=min(depth, 5)), maxIter=rng.randint(6, 18),
                stepSize=10 ** rng.uniform(-1, -0.3), subsamplingRate=rng.uniform(0.6, 1.0),
                lossType=rng.choice(("squared", "absolute")), **common)
        out[f"{kind}_{i:02d}"] = model
    return out


def rung_sizes(n: int, eta: int = ETA, last: int = 6) -> list[int]:
    """Trials in each rung, from ``n`` down to at most ``last``."""
    sizes = [n]
    while sizes[-1] > last:
        sizes.append(math.ceil(sizes[-1] / eta))
    return sizes


@dataclass
class Search:
    """``board``: (rung, share, candidate, fold, nrmse, kept). ``predictions``: (fold, y, and a price
    for each trial of the last rung) of rows that the fits did not see. ``weights``: picks of each
    chosen trial. ``nrmse``: error of their weighted mean over the predictions."""

    board: DataFrame
    predictions: DataFrame
    weights: dict[str, int]
    nrmse: float
    trials: dict[str, object]
    pipeline: Pipeline
    rows: DataFrame

    def models(self) -> list[tuple[PipelineModel, int]]:
        """The chosen trials fitted on all rows, each with its weight."""
        fitted = modeling.fit_all(self.pipeline, [self.trials[n] for n in self.weights], self.rows)
        return list(zip(fitted, self.weights.values()))


def greedy_weights(products: np.ndarray, n: float, picks: int = PICKS) -> tuple[list[int], float]:
    """Picks of each model and the root mean squared error of their mean.

    ``products[i, j]`` is the sum over ``n`` rows of error i times error j, all that the error of any
    mean depends on. Each pick, with replacement, is the model that lowers the error of the mean
    most; the best number of picks counts.
    """
    counts = np.zeros(len(products), int)
    best, error = counts, math.inf
    for size in range(1, picks + 1):
        options = [counts + np.eye(len(products), dtype=int)[i] for i in range(len(products))]
        sums = [float(c @ products @ c) / size ** 2 for c in options]
        counts = options[int(np.argmin(sums))]
        if min(sums) < error:
            best, error = counts, min(sums)
    return best.tolist(), math.sqrt(max(error, 0.0) / n)


def ensemble(predictions: DataFrame, names: Sequence[str], y: str, picks: int = PICKS
             ) -> tuple[dict[str, int], float]:
    """(picks by trial, nrmse) of a greedy selection over staged predictions, read once."""
    gaps = {name: F.col(name) - F.col(y) for name in names}
    sums = [F.sum(gaps[a] * gaps[b]).alias(f"{i}_{j}") for i, a in enumerate(names)
            for j, b in enumerate(names) if i <= j]
    row = predictions.agg(*sums, F.count(y).alias("n"), (F.max(y) - F.min(y)).alias("span")).first()
    products = np.array([[row[f"{min(i, j)}_{max(i, j)}"] for j in range(len(names))]
                         for i in range(len(names))], float)
    counts, error = greedy_weights(products, row["n"], picks)
    return {name: c for name, c in zip(names, counts) if c}, error / row["span"]


def vote(models: Sequence[tuple[PipelineModel, int]], df: DataFrame, out: str = "pred") -> DataFrame:
    """Weighted mean of the models' prices."""
    scored, total = df, F.lit(0.0)
    for i, (model, weight) in enumerate(models):
        scored = modeling.predict_price(model, scored, f"_vote_{i}")
        total = total + F.col(f"_vote_{i}") * weight
    return (scored.withColumn(out, total / sum(w for _, w in models))
            .drop(*[f"_vote_{i}" for i in range(len(models))]))


def model_search(folds: DataFrame, trials: dict[str, object] | None = None,
                 target: str = "sale_price", month: str = "sale_month", eta: int = ETA,
                 picks: int = PICKS, concurrent: int = CONCURRENT, **matrix) -> Search:
    """Successive halving over ``trials`` on rolling-origin folds (columns ``fold``, ``role``).

    The first rung fits every trial on a small hashed share of the last fold's training rows; each
    rung keeps one trial in ``eta`` and has ``eta`` times the rows. The last rung fits on all rows of
    every fold, and its predictions of the folds' test rows are staged for a greedy selection with
    replacement. The last fold holds all rows, and its encoding by earlier months is that of every
    shorter fold, so it is made once. Fits are distributed jobs; ``concurrent`` of them run at a time.
    """
    trials = trial_list() if trials is None else trials
    # A few rows per month.
    parts = stage(folds.select("fold", "role", month).distinct(), "parts")
    numbers = sorted(r[0] for r in parts.select("fold").distinct().collect())
    pipeline, rows = modeling.model_matrix(
        folds.filter(F.col("fold") == numbers[-1]).drop("fold", "role"), target, month=month, **matrix)
    high = [c for c in matrix.get("high_card", HIGH_CARDINALITY) if c in rows.columns]
    full = stage(modeling.encode_past(rows, high, month=month).withColumn(
        "_share", F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) / (1 << 20)), "full")
    modeling._checkpoint_folder(full)

    def prepared(number: int) -> tuple[PipelineModel, DataFrame, DataFrame]:
        train, test = (full.join(F.broadcast(parts.filter(
            (F.col("fold") == number) & (F.col("role") == role)).select(month)), month, "left_semi")
            for role in ("train", "test"))
        features = pipeline.fit(train)
        known = modeling.encode_known(test.drop(*[f"{c}_mean" for c in high]), train, high)
        return (features, train, stage(features.transform(known).select(
            F.lit(int(number)).alias("fold"), target, "features"), "test"))

    def fitted(names, features, train):
        return modeling.fit_over(features, {n: trials[n] for n in names}, train, concurrent)

    def scored(models, test):
        keep = test.columns
        for name, model in models.items():
            test = model.copy({model.predictionCol: "_p"}).transform(test).select(
                *keep, F.expm1("_p").alias(name))
            keep = [*keep, name]
        return test.drop("features")

    def errors(df, names):
        span = F.max(target) - F.min(target)
        row = df.agg(*[F.try_divide(F.sqrt(F.avg((F.col(target) - F.col(n))
                                                 * (F.col(target) - F.col(n)))), span).alias(n)
                       for n in names]).first()
        return {n: row[n] for n in names}

    sizes, board, alive = rung_sizes(len(trials), eta), [], list(trials)
    last = prepared(numbers[-1])
    for rung, size in enumerate(sizes[:-1]):
        share = float(eta) ** (rung - len(sizes) + 1)
        rows = last[1].filter(F.col("_share") < share)
        found = errors(scored(fitted(alive, last[0], rows), last[2]), alive)
        ranked = sorted(alive, key=lambda n: (found[n] is None, found[n], n))
        kept = ranked[:sizes[rung + 1]]
        board += [(rung, share, n, int(numbers[-1]), found[n], n in kept) for n in alive]
        alive = [n for n in alive if n in kept]
    staged = []
    for number in numbers:
        features, train, test = last if number == numbers[-1] else prepared(number)
        out = stage(scored(fitted(alive, features, train), test), "predictions")
        found = errors(out, alive)
        board += [(len(sizes) - 1, 1.0, n, int(number), found[n], False) for n in alive]
        staged.append(out)
    predictions = staged[0]
    for out in staged[1:]:
        predictions = predictions.unionByName(out)
    weights, error = ensemble(predictions, alive, target, picks)
    board = [(*r[:5], r[5] or r[0] == len(sizes) - 1 and r[2] in weights) for r in board]
    return Search(folds.sparkSession.createDataFrame(
        board, "rung int, share double, candidate string, fold int, nrmse double, kept boolean"),
        predictions, weights, error, trials, pipeline, full.drop("_share"))

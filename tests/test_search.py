"""Model search: trials, halving, selection and vote."""

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from parcelspark.operators import modeling, sampling, search
from parcelspark.operators.features import gold_features
from parcelspark.session import scratch_path, stage
from parcelspark.sources.synthetic import synthetic_valuations


@pytest.fixture(scope="module")
def found(spark):
    gold = stage(gold_features(synthetic_valuations(spark, 2500)).drop("property_hash"), "gold")
    folds = sampling.rolling_origin_folds(gold, folds=2)
    return gold, search.model_search(folds, search.trial_list(8, seed=3), eta=2, picks=6)


def test_trials_are_seeded(spark):
    a, b = search.trial_list(), search.trial_list()
    assert len(a) == 50 and list(a) == list(b)
    for x, y in zip(a.values(), b.values()):
        assert [(p.name, v) for p, v in x.extractParamMap().items()] == [
            (p.name, v) for p, v in y.extractParamMap().items()]
    drawn = {str(sorted((p.name, str(v)) for p, v in m.extractParamMap().items())) for m in a.values()}
    assert len(drawn) == 50


def test_rungs():
    assert search.rung_sizes(50) == [50, 17, 6]
    assert search.rung_sizes(8, 2) == [8, 4]
    assert search.rung_sizes(3) == [3]


def test_board_has_every_trial_and_rung(found):
    _, out = found
    board = out.board.toPandas()
    first = board[board.rung == 0]
    assert sorted(first.candidate) == sorted(out.trials) and (first.share == 0.5).all()
    last = board[board.rung == 1]
    assert set(last.candidate) == set(first[first.kept].candidate)
    assert len(last) == 2 * last.candidate.nunique() and (last.share == 1).all()
    assert set(last[last.kept].candidate) == set(out.weights)
    worst = first[first.kept].nrmse.max()
    assert (first[~first.kept].nrmse >= worst).all()


def test_sql_over_the_staged_predictions(spark, found):
    _, out = found
    path = scratch_path(spark, "oof")
    out.predictions.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW oof AS SELECT * FROM '{path}/*.parquet'")
    names = [c for c in out.predictions.columns if c not in ("fold", "sale_price")]
    for row in out.board.filter("rung = 1").collect():
        want = con.execute(f"SELECT sqrt(avg((sale_price - {row.candidate}) ** 2))"
                           f" / (max(sale_price) - min(sale_price)) FROM oof WHERE fold = {row.fold}")
        assert row.nrmse == pytest.approx(want.fetchone()[0])
    mean = " + ".join(f"{n} * {w}" for n, w in out.weights.items())
    total = sum(out.weights.values())
    error = con.execute(f"SELECT sqrt(avg((sale_price - ({mean}) / {total}) ** 2))"
                        " / (max(sale_price) - min(sale_price)) FROM oof").fetchone()[0]
    assert out.nrmse == pytest.approx(error)
    # No single trial does better than the chosen mean.
    for n in names:
        assert con.execute(f"SELECT sqrt(avg((sale_price - {n}) ** 2))"
                           " / (max(sale_price) - min(sale_price)) FROM oof").fetchone()[0] >= error - 1e-12


def test_greedy_selection_against_plain_loops():
    rng = np.random.default_rng(1)
    gaps = rng.normal(size=(4, 60)) + rng.normal(size=60)
    counts, error = search.greedy_weights(gaps @ gaps.T, 60, 5)

    def rmse(c):
        return math.sqrt(((c @ gaps / c.sum()) ** 2).mean())

    now, best = np.zeros(4, int), (math.inf, None)
    for _ in range(5):
        now = min((now + np.eye(4, dtype=int)[i] for i in range(4)), key=rmse)
        best = min(best, (rmse(now), now.tolist()))
    assert (error, counts) == (pytest.approx(best[0]), best[1])
    every = min(rmse(np.array(c)) for c in itertools.product(range(6), repeat=4) if 0 < sum(c) <= 5)
    assert error >= every - 1e-12


def test_vote_weighs_the_models(found):
    gold, out = found
    models = out.models()
    assert [w for _, w in models] == list(out.weights.values())
    _, rows = modeling.model_matrix(gold.limit(50))
    known = stage(modeling.encode_known(rows, out.rows, modeling.HIGH_CARDINALITY), "known")
    voted = search.vote(models, known).select("property_type", "pred").toPandas()
    parts = [modeling.predict_price(m, known).toPandas()["pred"] * w for m, w in models]
    assert np.allclose(sorted(voted.pred), sorted(sum(parts) / sum(out.weights.values())))
    assert voted.pred.notna().all()


def test_rows_of_a_rung_are_selected_once(spark, monkeypatch):
    gold = stage(gold_features(synthetic_valuations(spark, 1200)).drop("property_hash"), "gold")
    trials = {f"linear_{i}": LinearRegression(featuresCol="features", labelCol=modeling.LABEL,
                                              regParam=0.1 * i) for i in range(8)}
    read, fit = [], LinearRegression._fit

    def counted(self, dataset):
        read.append((dataset.count(), dataset.storageLevel.useDisk))
        return fit(self, dataset)

    monkeypatch.setattr(LinearRegression, "_fit", counted)
    out = search.model_search(sampling.rolling_origin_folds(gold, folds=1), trials, eta=2, picks=2)
    first, last = read[:8], read[8:]
    assert len(last) == 4 and {n for n, _ in first} == {first[0][0]}
    assert 0 < first[0][0] < last[0][0]
    # The first rung's trials read a kept share, not all rows each.
    assert all(kept for _, kept in first)
    assert out.board.count() == 12


def test_trees_of_a_search_grow_over_blocks(spark, monkeypatch):
    """Spark ML's own fits pass over the rows as objects, once for each trial, tree and level."""
    def never(self, dataset):
        raise AssertionError("fitted row by row")

    for kind in (GBTRegressor, RandomForestRegressor, DecisionTreeRegressor):
        monkeypatch.setattr(kind, "_fit", never)
    gold = stage(gold_features(synthetic_valuations(spark, 1500)).drop("property_hash"), "gold")
    out = search.model_search(sampling.rolling_origin_folds(gold, folds=1), search.trial_list(8), eta=2,
                              picks=2)
    assert len(out.models()) == len(out.weights)

"""Isotonic blocks, quantiles from leaves, and values carried forward over parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelspark.operators import forest, isotonic
from parcelspark.operators.monitor import join_actuals
from parcelspark.operators.skew import forward_fill
from parcelspark.plans.retrain import prepare
from parcelspark.operators.features import gold_features
from parcelspark.session import stage
from parcelspark.sources.synthetic import synthetic_valuations


# Isotonic blocks

def min_max_fit(points):
    """The fit at each distinct prediction: max over starts of min over ends of the mean."""
    xs = sorted({x for x, _ in points})
    total = np.array([sum(y for x, y in points if x == v) for v in xs], float)
    n = np.array([sum(x == v for x, _ in points) for v in xs], float)
    s, c = np.append(0, np.cumsum(total)), np.append(0, np.cumsum(n))
    return {v: max(min((s[k + 1] - s[j]) / (c[k + 1] - c[j]) for k in range(i, len(xs)))
                   for j in range(i + 1)) for i, v in enumerate(xs)}


SHAPES = {
    "rising": lambda rng, x: x + rng.random(),
    "falling": lambda rng, x: -x + rng.random(),
    "noisy": lambda rng, x: x + 40 * rng.random(),
    "saw": lambda rng, x: x % 17,
    "late drop": lambda rng, x: x if x < 115 else -500.0,
    "flat": lambda rng, x: 3.0,
}


@pytest.mark.parametrize("part_rows", [7, 40, 10_000])
def test_blocks_equal_the_min_max_formula(spark, part_rows):
    rng = random.Random(part_rows)
    rows = []
    for region, shape in SHAPES.items():
        for _ in range(160 if region != "flat" else 20):
            x = float(rng.randint(0, 120))
            rows.append((region, x, float(shape(rng, x))))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0), ("rising", None, 1.0), ("rising", 3.0, None),
                                       ("rising", float("nan"), 2.0)],
                               "region string, pred double, sale_price double")
    blocks = stage(isotonic.isotonic_blocks(df, "region", part_rows=part_rows), "blocks")
    found = blocks.collect()
    for region in SHAPES:
        own = sorted((b.lo, b.hi, b.total, b.n) for b in found if b.region == region)
        means = [t / n for *_, t, n in own]
        assert all(a < b for a, b in zip(means, means[1:]))
        want = min_max_fit([(x, y) for r, x, y in rows if r == region])
        for x, fit in want.items():
            inside = [t / n for lo, hi, t, n in own if lo <= x <= hi]
            assert inside == [pytest.approx(fit)]
    out = isotonic.isotonic_calibrate(df.withColumn("_side", F.lit(5)), blocks, "region")
    assert out.count() == df.count() and out.columns == [*df.columns, "_side"]
    fit = {(r, x): v for r in SHAPES for x, v in
           min_max_fit([(x, y) for q, x, y in rows if q == r]).items()}
    raw = {(r.region, r.sale_price): r.pred for r in out.collect()}
    for region, x, y in rows:
        if sum(q == region and v == y for q, _, v in rows) == 1:
            assert raw[region, y] == pytest.approx(fit[region, x])


def test_predictions_between_and_below_blocks(spark):
    df = spark.createDataFrame([("a", 10.0, 1.0), ("a", 20.0, 5.0), ("a", 30.0, 4.0)],
                               "region string, pred double, sale_price double")
    blocks = isotonic.isotonic_blocks(df, "region")
    new = spark.createDataFrame([("a", 1.0), ("a", 12.0), ("a", 25.0), ("a", 99.0), ("b", 7.0), (None, 8.0),
                                 ("a", None)], "region string, pred double")
    got = isotonic.isotonic_calibrate(new, blocks, "region")
    assert sorted((r.pred for r in got.collect()), key=str) == sorted(
        [1.0, 1.0, 4.5, 4.5, 7.0, 8.0, None], key=str)
    assert isotonic.isotonic_blocks(df.limit(0), "region").count() == 0


# Quantiles from leaves

def test_leaf_quantiles_against_plain_weights(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 2), rng.randint(0, 3) if rng.random() < 0.95 else None,
             None if i % 50 == 0 else round(rng.lognormvariate(3, 1), 3)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, a int, b int, sale_price double")
    table = forest.leaf_distributions(df, ["a", "b"], steps=100)
    new = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(
        [(0, 0), (1, 3), (2, None), (9, 1), (9, 9), (None, None)])], "id long, a int, b int")
    out = forest.leaf_quantiles(new, table)
    assert out.columns == ["id", "a", "b", "price_low_q10", "price_q50", "price_high_q90"]
    for r in out.collect():
        sides = [[y for _, a, _, y in rows if y is not None and a == r.a and r.a is not None],
                 [y for _, _, b, y in rows if y is not None and b == r.b and r.b is not None]]
        weighed = sorted((y, 1 / len(own)) for own in sides for y in own)
        if not weighed:
            assert r.price_q50 is None
            continue
        total, y = sum(w for _, w in weighed), np.array([y for y, _ in weighed])
        upto = np.cumsum([w for _, w in weighed]) / total
        for q, got in zip(forest.QUANTILES, (r.price_low_q10, r.price_q50, r.price_high_q90)):
            # Right up to the width of a step: the true quantiles of slightly smaller and larger shares.
            low = y[np.searchsorted(upto, max(q - 0.03, 0))]
            high = y[min(np.searchsorted(upto, q + 0.03), len(y) - 1)]
            assert low <= got <= high


def test_forest_bands_cover_what_they_say(spark):
    gold = stage(gold_features(synthetic_valuations(spark, 4000)), "gold")
    pipeline, train, valid, holdout = prepare(gold)
    fitted = forest.train_quantile_forest(pipeline, train, trees=8, depth=6).calibrated(valid)
    out = fitted.bands(holdout)
    assert out.columns == [*holdout.columns, "price_low_q10", "price_q50", "price_high_q90"]
    row = out.agg(F.avg(F.col("sale_price").between(F.col("price_low_q10"), F.col("price_high_q90"))
                        .cast("int")).alias("share"),
                  F.count_if(F.col("price_q50").isNull()).alias("none"),
                  F.avg((F.col("sale_price") < F.col("price_q50")).cast("int")).alias("below")).first()
    assert 0.72 <= row.share <= 0.88 and row.none == 0 and 0.35 <= row.below <= 0.65


# Values carried forward

@pytest.mark.parametrize("part_rows", [5, 50, 100_000])
def test_forward_fill(spark, part_rows):
    rng = random.Random(part_rows)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("abc"), i, rng.randint(0, 9)
             if rng.random() < 0.1 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, v int").repartition(4)
    last, want = {}, {}
    for k, t, v in rows:
        last[k] = last.get(k) if v is None else v
        want[t] = last[k]
    got = forward_fill(df, ["k"], ["t"], "v", part_rows)
    assert got.columns == df.columns
    assert {r.t: r.v for r in got.collect()} == want


def test_one_key_and_hour_is_spread(spark):
    n = 3000
    preds = spark.range(n).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id")).alias("pt"),
                                  F.col("id").cast("double").alias("price"))
    actuals = spark.range(n).select(F.lit("hot").alias("k"), F.timestamp_seconds(
        F.col("id") + 0.5).alias("at"), F.col("id").alias("i"))
    out = join_actuals(preds, actuals, "k", "pt", "at", ["price"], part_rows=300)
    assert out.filter("price = i").count() == n
    parts = stage(preds.repartitionByRange(10, "k", "pt").withColumn("p", F.spark_partition_id()), "p")
    assert parts.groupBy("p").count().agg(F.max("count")).first()[0] < n / 4


def test_range_partitions_are_bounded():
    from parcelspark.operators import isotonic

    assert isotonic.parts_for(600_000, 4096) == 147
    assert isotonic.parts_for(36_000_000, 4096) == isotonic.MAX_PARTS
    assert isotonic.parts_for(10 ** 9, 4096) == 1000
    blocks = [(float(i), float(i), float(i * 7 % 5), 1) for i in range(50)]
    half = isotonic.pool(blocks[:20])
    assert isotonic.pool(blocks[20:], half) == isotonic.pool(blocks)


def test_leaf_quantiles_sum_blocks_of_rows(spark, monkeypatch):
    df = spark.range(3000).select(
        (F.col("id") * 7919 % 1009).cast("double").alias("sale_price"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 13).alias("a"), (F.col("id") % 7).alias("b"))
    table = forest.leaf_distributions(df, ["a", "b"], steps=10)
    assert {len(r["shares"]) for r in table.table.collect()} == {10}
    new = spark.createDataFrame([(1, 1, 2), (2, None, 3), (3, 99, 4), (4, 99, None), (5, 12, 0)],
                                "id int, a int, b int")
    out = forest.leaf_quantiles(new, table)
    # No row's distributions are added one array after the other.
    assert "zip_with" not in out._jdf.queryExecution().toString().lower()
    assert out.columns == ["id", "a", "b", "price_low_q10", "price_q50", "price_high_q90"]
    monkeypatch.setattr(forest, "fits_broadcast", lambda table: False)
    want = {r["id"]: r for r in forest.leaf_quantiles(new, table).collect()}
    got = out.collect()
    assert len(got) == 5 and all(r == want[r["id"]] for r in got)
    assert want[4]["price_q50"] is None and want[3]["price_q50"] is not None


def test_steps_of_a_leaf_count_the_marks_below(spark):
    rows = [(float(v), v % 3) for v in range(50)] + [(float("nan"), 1), (float("inf"), 2)]
    df = spark.createDataFrame(rows, "sale_price double, a int")
    table = forest.leaf_distributions(df, ["a"], steps=5)
    shares = {r["leaf"]: list(r["shares"]) for r in table.table.collect()}
    for leaf in range(3):
        own = [v for v, a in rows if a == leaf]
        steps = [sum(e < v or v != v for e in table.edges[1:-1]) for v in own]
        assert shares[leaf] == pytest.approx([sum(s <= i for s in steps) / len(own) for i in range(5)])

"""Skew-safe joins, selections and percentiles, also with one dominant key."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelspark.functions.hashing import digest
from parcelspark.operators import similar
from parcelspark.operators.quantiles import (exact_percentiles, keyed_percentiles,
                                             running_counts, with_slot)
from parcelspark.operators.skew import fits_broadcast, hot_keys, lookup_join, lowest_share
from parcelspark.operators.skew import salted_join

QUICK = settings(max_examples=8, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(spark, rows=3000):
    """Key 0 owns a third of the rows, and a tenth of the rows has no key."""
    key = (F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 10 == 1, F.lit(None))
           .otherwise(F.col("id") % 50 + 1))
    return spark.range(rows).select("id", key.cast("int").alias("k"),
                                    (F.col("id") * 37 % 1009).cast("double").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    facts = skewed(spark)
    lookup = spark.range(0, 40).select(F.col("id").cast("int").alias("k"),
                                       (F.col("id") * 2).alias("w"))
    want = facts.join(lookup, "k", how).toPandas()
    got = salted_join(facts, lookup, ["k"], how).select(*want.columns).toPandas()
    pd.testing.assert_frame_equal(*[d.sort_values("id").reset_index(drop=True)
                                    for d in (got, want)], check_dtype=False)


def test_hot_keys_are_few_and_split(spark):
    hot = {r["k"]: r["_splits"] for r in hot_keys(skewed(spark), ["k"]).collect()}
    assert hot[0] > 300 and len(hot) < 1000


def test_copies_of_one_row_are_spread(spark):
    facts = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    lookup = spark.createDataFrame([(1, 5)], "k int, w int")
    joined = salted_join(facts, lookup, ["k"])
    assert joined.filter("w = 5").count() == 4000


def test_lookup_join_broadcasts_only_below_the_limit(spark):
    facts, lookup = skewed(spark), spark.range(500).select(F.col("id").cast("int").alias("k"))
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, 100)
    small = lookup_join(facts, lookup, ["k"], "left_semi")
    large = lookup_join(facts, lookup, ["k"], "left_semi", max_bytes=100)
    assert small.count() == large.count() == facts.filter("k is not null").count()


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_lowest_share_equals_ranking(spark, fraction, hot_rows):
    df = skewed(spark)
    got = lowest_share(df, ["k"], fraction, digest("s", "id"), bits=4, hot_rows=hot_rows).toPandas()
    pdf = df.withColumn("h", digest("s", "id")).toPandas()
    pdf["r"] = pdf.sort_values("h").groupby("k", dropna=False).cumcount() + 1
    quota = np.ceil(pdf.groupby("k", dropna=False)["id"].transform("size") * fraction)
    assert sorted(got["id"]) == sorted(pdf[pdf["r"] <= quota]["id"])


def test_lowest_share_of_copies(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.lit(7).alias("x"))
    assert lowest_share(df, ["k"], 0.1, digest("s", "x"), bits=4, hot_rows=10).count() == 100


@QUICK
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(0, 3).map(float)), min_size=1,
                max_size=60))
def test_exact_percentiles_equal_numpy(spark, values):
    qs = [0.0, 0.1, 0.5, 0.95, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_percentiles(df, "v", qs).first()
    assert got["n"] == len(values)
    np.testing.assert_allclose(got["p"], np.quantile(values, qs), rtol=1e-9, atol=1e-9)


def test_exact_percentiles_by_skewed_key(spark):
    df = skewed(spark).withColumn("v", F.when(F.col("id") % 7 != 0, F.col("v")))
    got = {r["k"]: r["p"] for r in exact_percentiles(df, "v", [0.25, 0.5], ["k"]).collect()}
    want = df.toPandas().groupby("k")["v"].quantile([0.25, 0.5]).unstack()
    assert set(got) == set(want.index)
    for k, p in got.items():
        np.testing.assert_allclose(p, want.loc[k])


def test_keyed_percentiles_pass_over_nan_at_any_size(spark):
    inf = float("inf")
    rows = [("a", x) for x in (1.0, 2.0, float("nan"))] + [("b", float("nan"))] + [
        ("c", x) for x in (None, 5.0, inf)]
    df = spark.createDataFrame(rows, "k string, v double")
    for hot in (1, 1_000_000):
        got = {r["k"]: r["p"] for r in keyed_percentiles(df, ["k"], {"p": ("v", [0.0, 0.5])},
                                                         hot_rows=hot).collect()}
        assert got["a"] == [1.0, 1.5] and got["c"] == [5.0, inf]
        assert got["b"] is None or got["b"] == [None, None]


def test_keyed_percentiles_hot_and_cold_agree(spark):
    df = skewed(spark)
    wanted = {"m": ("v", [0.5]), "w": (F.col("v") * 2, [0.9])}
    cold = keyed_percentiles(df, ["k"], wanted).toPandas()
    hot = keyed_percentiles(df, ["k"], wanted, hot_rows=100).toPandas()
    for d in (cold, hot):
        d["m"], d["w"] = d["m"].str[0], d["w"].str[0]
        assert d["k"].notna().all()
    pd.testing.assert_frame_equal(*[d.sort_values("k").reset_index(drop=True)
                                    for d in (cold, hot)], check_dtype=False)


@pytest.mark.parametrize("sort_rows", [1_000_000, 2])
def test_running_counts(spark, sort_rows):
    df = spark.range(500).select((F.col("id") * 7919 % 1000).cast("double").alias("v"),
                                 F.lit(1).alias("a"), (F.col("id") % 2).alias("b"))
    got = running_counts(df, "v", ["a", "b"], sort_rows=sort_rows).toPandas().sort_values("v")
    assert got["run_a"].tolist() == list(range(1, 501))
    assert got["run_b"].tolist() == got["b"].cumsum().tolist()


@pytest.mark.parametrize("depth, levels", [(3, 1), (2, 2)])
def test_slots_are_ordered_and_balanced(spark, depth, levels):
    df = spark.range(8000).select(F.col("id").cast("double").alias("v"))
    sizes = (with_slot(df, "v", depth, levels).groupBy("_slot")
             .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
             .toPandas().sort_values("_slot"))
    slots = 2 ** (depth * levels)
    assert len(sizes) == slots and sizes["n"].max() < 8000 / slots * 1.3
    assert (sizes["hi"].to_numpy()[:-1] < sizes["lo"].to_numpy()[1:]).all()


@pytest.mark.parametrize("by", [[], ["k"]])
def test_large_slices_are_divided_again(spark, by):
    df = skewed(spark, 5000).withColumn("v", F.col("id") * 1.5)
    qs = [0.1, 0.5, 0.9]
    plain = exact_percentiles(df, "v", qs, by).toPandas()
    deep = exact_percentiles(df, "v", qs, by, sort_rows=2).toPandas()
    for d in (plain, deep):
        d.sort_values(by or ["n"], inplace=True)
    assert plain["n"].tolist() == deep["n"].tolist()
    np.testing.assert_allclose(np.stack(plain["p"]), np.stack(deep["p"]))


def test_exact_percentiles_of_copies_need_one_round(spark, monkeypatch):
    """Copies of a few values fill no slice that would be divided."""
    from parcelspark.operators import quantiles

    rounds, staged = [], quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df, label: (rounds.append(label), staged(df, label))[1])
    df = spark.range(4000).select((F.col("id") % 10).cast("double").alias("v"))
    qs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = exact_percentiles(df, "v", qs, sort_rows=1000).first()
    np.testing.assert_allclose(got["p"], np.quantile(np.arange(4000) % 10, qs))
    assert rounds.count("slices") == 1


def brute_force(emb, k):
    m = np.stack(emb["vec"])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(m @ m.T, similar.DIGITS)
    out = []
    for i, row in emb.reset_index(drop=True).iterrows():
        cell = [j for j in range(len(emb)) if emb["cell"].iloc[j] == row["cell"] and j != i]
        cell.sort(key=lambda j: (-sims[i, j], emb["id"].iloc[j]))
        out += [(row["id"], emb["id"].iloc[j], r + 1) for r, j in enumerate(cell[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [2048, 8])
def test_nearest_in_cell_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    emb = pd.DataFrame({"id": range(90), "cell": ["a"] * 60 + ["b"] * 28 + ["c", "c"],
                        "vec": list(rng.normal(size=(90, 4)))})
    # A third of cell a are copies of one vector.
    for i in range(0, 60, 3):
        emb.at[i, "vec"] = emb.at[0, "vec"]
    df = spark.createDataFrame([(int(i), c, [float(x) for x in v]) for i, c, v in
                                emb.itertuples(index=False)], "id int, cell string, vec array<double>")
    got = similar.nearest_in_cell(df, "cell", "id", "vec", k=5, block_rows=block_rows)
    assert sorted((r["id"], r["neighbor"], r["rank"]) for r in got.collect()) == brute_force(emb, 5)


def test_comparables_of_zero_vectors_and_null_cells(spark):
    df = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "a", [1.0, 0.0]), (3, None, [1.0, 0.0]),
                                (4, "a", [0.5, 0.5])], "id int, cell string, vec array<double>")
    got = similar.nearest_in_cell(df, "cell", "id", "vec", k=3).collect()
    assert sorted((r["id"], r["neighbor"]) for r in got) == [(2, 4), (4, 2)]

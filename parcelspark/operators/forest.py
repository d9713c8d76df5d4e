"""Price quantiles per row from the leaves of a forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.modeling import LABEL, _checkpoint_folder, bins_for
from parcelspark.operators.quantiles import descend, exact_percentiles
from parcelspark.operators.skew import fits_broadcast, lookup_join
from parcelspark.session import stage

# The band and the middle.
QUANTILES = (0.1, 0.5, 0.9)
#: Steps of a leaf's distribution, at equal shares of all prices.
STEPS = 64


@dataclass
class LeafTable:
    """Distributions of the target in leaves: ``table`` (tree, leaf, shares), where ``shares[i]`` is the
    share of the leaf's rows at or below ``edges[i + 1]``."""

    table: DataFrame
    edges: list[float]
    leaves: list[str]


def leaf_distributions(train: DataFrame, leaves: Sequence[str], y: str = "sale_price",
                       steps: int = STEPS) -> LeafTable:
    """Distribution of ``y`` in every leaf; column ``leaves[t]`` names each row's leaf of tree t.

    Edges are exact percentiles of ``y`` at equal shares. Rows are counted by tree, leaf and step
    before anything else, so a table has at most trees x leaves rows of ``steps`` figures. Rows
    without ``y`` or without a leaf don't count.
    """
    leaves = list(leaves)
    rows = stage(train.filter(F.col(y).isNotNull()).select(F.col(y).cast("double").alias("_y"), *leaves),
                 "leaves")
    edges = exact_percentiles(rows, "_y", [i / steps for i in range(steps + 1)]).first()
    edges = list(edges["p"]) if edges and edges["p"] is not None else [0.0] * (steps + 1)
    inner = [float(e) for e in edges[1:-1]]
    depth = len(inner).bit_length()
    # Filled up for the binary search; a NaN lies above the fill too.
    marks = F.array(*map(F.lit, inner + [float("inf")] * (2 ** depth - 1 - len(inner)))
                    ).cast("array<double>")
    placed = descend(rows.withColumn("_marks", marks), "_y", "_step", depth).withColumn(
        "_step", F.least(F.col("_step"), F.lit(len(inner))))
    pairs = F.array(*[F.struct(F.lit(t).alias("tree"), F.col(c).cast("long").alias("leaf"))
                      for t, c in enumerate(leaves)])
    counts = (placed.groupBy(*leaves, "_step").agg(F.count(F.lit(1)).alias("_n"))
              .select("_step", "_n", F.inline(pairs)).filter("leaf IS NOT NULL")
              .groupBy("tree", "leaf", "_step").agg(F.sum("_n").alias("_n")))
    below = [F.sum(F.when(F.col("_step") <= i, F.col("_n")).otherwise(0)) / F.sum("_n")
             for i in range(steps)]
    return LeafTable(stage(counts.groupBy("tree", "leaf").agg(F.array(*below).alias("shares")),
                           "distributions"), edges, leaves)


def _quantile(shares: Column, total: Column, edges: list[float], q: float) -> Column:
    """The price at share ``q``: linear inside the first step that reaches it."""
    # Sums of shares carry rounding errors.
    want = total * q
    at = F.array_position(F.transform(shares, lambda c: c >= want - 1e-9), True).cast("int")
    marks = F.array(*[F.lit(float(e)) for e in edges])
    low, high = F.get(marks, at - 1), F.get(marks, at)
    before, upto = F.coalesce(F.get(shares, at - 2), F.lit(0.0)), F.get(shares, at - 1)
    part = F.least(F.greatest((want - before) / (upto - before), F.lit(0.0)), F.lit(1.0))
    return low + part * (high - low)


def _small_quantiles(leaves: LeafTable, q: Sequence[float]):
    """A function of the rows' leaves that gives their quantiles, for a table that fits a broadcast."""
    edges, steps = np.array(leaves.edges, float), len(leaves.edges) - 1
    table: list[tuple[np.ndarray, np.ndarray]] = []
    known_rows = leaves.table.collect()
    for t in range(len(leaves.leaves)):
        own = sorted((r["leaf"], r["shares"]) for r in known_rows if r["tree"] == t)
        table.append((np.array([leaf for leaf, _ in own], np.int64),
                      np.array([shares for _, shares in own], float).reshape(len(own), steps)))
    shared = leaves.table.sparkSession.sparkContext.broadcast(table)

    def quantiles(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        total, trees = np.zeros((n, steps)), np.zeros(n)
        for column, (ids, shares) in zip(columns, shared.value):
            at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            leaf = column.drop_null().to_numpy()
            place = np.searchsorted(ids, leaf)
            real = np.isin(leaf, ids)
            total[at[real]] += shares[place[real]]
            trees[at[real]] += 1
        row, out = np.arange(n), []
        for share in q:
            # Sums of shares carry rounding errors.
            want = trees * share
            reached = total >= (want - 1e-9)[:, None]
            at = reached.argmax(axis=1)
            before = np.where(at > 0, total[row, at - 1], 0.0)
            width = total[row, at] - before
            part = np.clip(np.divide(want - before, width, out=np.zeros(n), where=width != 0), 0, 1)
            with np.errstate(invalid="ignore"):
                price = edges[at] + part * (edges[at + 1] - edges[at])
            out.append(pa.array(price, mask=(trees == 0) | ~reached.any(axis=1)))
        return pa.StructArray.from_arrays(out, [f"q{i}" for i in range(len(q))])

    return F.arrow_udf(quantiles, "struct<" + ", ".join(f"q{i}: double" for i in range(len(q))) + ">")


def leaf_quantiles(df: DataFrame, leaves: LeafTable, q: Sequence[float] = QUANTILES,
                   names: Sequence[str] = ("price_low_q10", "price_q50", "price_high_q90")) -> DataFrame:
    """Add the quantiles of each row's mean distribution over its leaves.

    Every tree weighs the same; a leaf that the training rows didn't reach is left out, and a row
    without any known leaf gets nulls. Below the size limit of a broadcast the distributions go to
    all tasks, which sum them by blocks of rows; a larger table is joined by leaf, tree by tree.
    """
    if fits_broadcast(leaves.table):
        found = _small_quantiles(leaves, q)(*[F.col(c).cast("long") for c in leaves.leaves])
        return (df.withColumn("_found", found)
                .withColumns({name: F.col("_found")[f"q{i}"] for i, name in zip(range(len(q)), names)})
                .drop("_found"))
    out = df.withColumn("_shares", F.array(*[F.lit(0.0)] * (len(leaves.edges) - 1))).withColumn(
        "_trees", F.lit(0.0))
    for t, leaf in enumerate(leaves.leaves):
        own = leaves.table.filter(F.col("tree") == t).select(
            F.col("leaf").alias("_leaf"), F.col("shares").alias("_own"))
        out = lookup_join(out.withColumn("_leaf", F.col(leaf).cast("long")), own, ["_leaf"])
        known = F.col("_own").isNotNull()
        out = out.withColumns({
            "_shares": F.when(known, F.zip_with("_shares", "_own", lambda a, b: a + b))
            .otherwise(F.col("_shares")),
            "_trees": F.col("_trees") + known.cast("double")}).drop("_own", "_leaf")
    some = F.col("_trees") > 0
    return out.withColumns({name: F.when(some, _quantile(F.col("_shares"), F.col("_trees"),
                                                         leaves.edges, share))
                            for name, share in zip(names, q)}).drop("_shares", "_trees")


@dataclass
class QuantileForest:
    """A fitted forest and the distributions of its leaves; ``factor`` widens its bands."""

    model: PipelineModel
    leaves: LeafTable
    factor: float = 1.0

    def bands(self, df: DataFrame) -> DataFrame:
        """``df`` with ``price_low_q10``, ``price_q50`` and ``price_high_q90`` of each row."""
        names = ("price_low_q10", "price_q50", "price_high_q90")
        rows = _leaf_columns(self.model, df, len(self.leaves.leaves))
        low, mid, high = (F.col(n) for n in names)
        return leaf_quantiles(rows, self.leaves, QUANTILES, names).withColumns({
            names[0]: F.least(low / self.factor, mid),
            names[2]: F.greatest(high * self.factor, mid)}).select(*df.columns, *names)

    def calibrated(self, known: DataFrame, y: str = "sale_price") -> QuantileForest:
        """A forest whose bands hold 80 % of ``known``, rows that it wasn't fitted on.

        Averages over leaves are wider or narrower than the prices given the features; the factor by
        which a band must grow to reach a row's price is the figure whose percentile decides.
        """
        share = QUANTILES[2] - QUANTILES[0]
        reach = F.greatest(F.try_divide(F.col("price_low_q10"), F.col(y)),
                           F.try_divide(F.col(y), F.col("price_high_q90")))
        rows = QuantileForest(self.model, self.leaves).bands(known).select(reach.alias("reach"))
        found = exact_percentiles(stage(rows, "reach"), "reach", [share]).first()
        return QuantileForest(self.model, self.leaves, float(found["p"][0]) if found else 1.0)


def _leaf_columns(model: PipelineModel, df: DataFrame, trees: int) -> DataFrame:
    array = vector_to_array("_leaves")
    return model.transform(df).select(*df.columns, *[
        array[t].cast("long").alias(f"_leaf_{t}") for t in range(trees)])


def train_quantile_forest(pipeline: Pipeline, train: DataFrame, y: str = "sale_price", trees: int = 12,
                          depth: int = 7, least: int = 20, share: float = 0.6, seed: int = 42,
                          steps: int = STEPS) -> QuantileForest:
    """Forest on ``label`` and the distribution of ``y`` in its leaves.

    ``least`` rows stand in a leaf at the training sample of its tree, so that its distribution says
    something about the tails.
    """
    _checkpoint_folder(train)
    features = pipeline.fit(train)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, leafCol="_leaves", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=least, subsamplingRate=share, featureSubsetStrategy="0.6", seed=seed,
        maxBins=bins_for(features, 64))
    rows = stage(features.transform(train).select(LABEL, y, "features"), "fit")
    model = forest.fit(rows)
    names = [f"_leaf_{t}" for t in range(trees)]
    leaves = leaf_distributions(_leaf_columns(PipelineModel(stages=[model]), rows, trees), names, y, steps)
    return QuantileForest(PipelineModel(stages=[*features.stages, model]), leaves)

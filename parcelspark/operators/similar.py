"""Visual comparables: exact nearest neighbours inside a cell.

A cell is never compared pair by pair in rows. Vectors travel in blocks of bounded size, a task
multiplies two blocks and keeps the best few per vector. In a large cell, vectors are grouped around
pivots, and a vector visits only the blocks that can hold a neighbour closer than those it already
has (triangle inequality), so the answer stays exact whatever is skipped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.functions.hashing import digest, uniform
from parcelspark.functions.vectors import norm
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

# Similarities are rounded, so that the order of equal ones does not hang on the last bit.
DIGITS = 9
_ROUNDING = 4e-9


def _unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _best(queries: pd.DataFrame, index: pd.DataFrame, keep: int, cell: str) -> pd.DataFrame:
    """The ``keep`` most similar ids of the index per query, ties to the smaller id."""
    owner = np.repeat(np.arange(len(index)), [len(i) for i in index["_ids"]])
    ids = np.concatenate([np.asarray(i) for i in index["_ids"]])
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    sims = np.round(_unit(queries["_vec"]) @ _unit(index["_vec"]).T, DIGITS)[:, owner]
    if sims.shape[1] > keep:
        bar = np.partition(sims, -keep, axis=1)[:, -keep]
        row, col = np.nonzero(sims >= bar[:, None])
    else:
        row, col = (a.ravel() for a in np.indices(sims.shape))
    s = sims[row, col]
    order = np.lexsort((col, -s, row))
    row, col, s = row[order], col[order], s[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col, s = (a[place < keep] for a in (row, col, s))
    return pd.DataFrame({cell: queries[cell].to_numpy()[row], "_vid": queries["_vid"].to_numpy()[row],
                         "neighbor": ids[col], "similarity": s})


def nearest_in_cell(emb: DataFrame, cell: str, key: str, vec: str, k: int = 10,
                    block_rows: int = 2048, max_pivots: int = 1024) -> DataFrame:
    """The ``k`` most similar other rows of the same cell: (cell, key, neighbor, similarity, rank).

    Similarity is the cosine in double precision, ties go to the smaller key, zero vectors and null
    cells have no neighbours. Equal vectors are searched once, and only their ``k + 1`` smallest
    keys can be among anyone's neighbours.
    """
    keep = k + 1
    rows = emb.select(cell, key, F.col(vec).alias("_vec")).filter(
        F.col(cell).isNotNull() & (norm(F.col("_vec")) > 0))
    first = Window.partitionBy(cell, "_vec").orderBy(key)
    vectors = stage(rows.withColumn("_r", F.row_number().over(first))
                    .filter(F.col("_r") <= keep)
                    .groupBy(cell, "_vec").agg(F.array_sort(F.collect_list(key)).alias("_ids"))
                    .withColumn("_vid", F.col("_ids")[0]), "vectors")
    large = stage(vectors.groupBy(cell).agg(F.count(F.lit(1)).alias("_n"))
                  .filter(F.col("_n") > block_rows), "large-cells")
    id_type = emb.schema[key].dataType
    lists_schema = T.StructType([
        T.StructField(cell, emb.schema[cell].dataType), T.StructField("_vid", id_type),
        T.StructField("neighbor", id_type), T.StructField("similarity", T.DoubleType())])

    def within(block: pd.DataFrame) -> pd.DataFrame:
        return _best(block, block, keep, cell)

    small = lookup_join(vectors, large, [cell], "left_anti")
    lists = small.groupBy(cell).applyInPandas(within, lists_schema)
    if not large.isEmpty():
        lists = lists.unionByName(_search_large(
            lookup_join(vectors, large, [cell], "inner"), cell, keep, block_rows, max_pivots,
            lists_schema))
    entry = F.struct((-F.col("similarity")).alias("s"), "neighbor")
    ordered = lists.groupBy(cell, "_vid").agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    by_vector = stage(vectors.join(ordered, [cell, "_vid"]).select(cell, "_vec", "_list"), "lists")
    found = lookup_join(rows, by_vector, [cell, "_vec"], "inner")
    others = F.slice(F.filter("_list", lambda e: e["neighbor"] != F.col(key)), 1, k)
    return (found.select(cell, key, F.posexplode(others).alias("rank", "_e"))
            .select(cell, key, F.col("_e.neighbor").alias("neighbor"),
                    (-F.col("_e.s")).alias("similarity"), (F.col("rank") + 1).alias("rank")))


def _search_large(vectors: DataFrame, cell: str, keep: int, block_rows: int, max_pivots: int,
                  lists_schema: T.StructType) -> DataFrame:
    """Neighbour lists in cells of more than ``block_rows`` vectors (column ``_n``)."""
    def parts(count, rows=block_rows):
        return F.greatest(F.ceil(count / F.lit(rows)), F.lit(1))

    def part_of(count):
        return F.pmod(F.xxhash64("_vid"), parts(count))

    # Pivots: about one per block; the vector of the lowest digest makes sure of at least one.
    draw = uniform(digest("pivot", "_vid"))
    share = F.least(parts(F.col("_n")), F.lit(max_pivots)) / F.col("_n")
    drawn = vectors.filter(draw < share).select(cell, "_vid", "_vec", "_n")
    lowest = vectors.groupBy(cell).agg(
        F.min_by(F.struct("_vid", "_vec", "_n"), F.struct(draw, "_vid")).alias("p"))
    pivots = drawn.unionByName(lowest.select(cell, "p.*")).dropDuplicates([cell, "_vid"])
    pivots = stage(pivots.select(
        cell, "_n", F.col("_vec").alias("_pivot"), F.row_number().over(
            Window.partitionBy(cell).orderBy("_vid")).alias("_block")), "pivots")

    def per_part(table):
        """A copy of the cell's pivots for each part of the cell's vectors."""
        return table.withColumn("_part", F.explode(F.sequence(F.lit(0), parts(F.col("_n")) - 1)))

    vectors = vectors.withColumn("_part", part_of(F.col("_n")))
    vec_fields = [vectors.schema[c] for c in (cell, "_vec", "_ids", "_vid", "_part")]
    keys = [cell, "_part"]
    placed_schema = T.StructType(vec_fields + [T.StructField("_block", T.IntegerType()),
                                               T.StructField("_dist", T.DoubleType())])

    def assign(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=placed_schema.names)
        gap = _gaps(rows, centres)
        nearest = gap.argmin(axis=1)
        return rows[[f.name for f in vec_fields]].assign(
            _block=centres["_block"].to_numpy()[nearest].astype("int32"),
            _dist=gap[np.arange(len(rows)), nearest])

    placed = stage(vectors.groupBy(*keys).cogroup(per_part(pivots).groupBy(*keys))
                   .applyInPandas(assign, placed_schema), "placed")
    blocks = stage(placed.groupBy(cell, "_block").agg(F.max("_dist").alias("_radius"),
                                                      F.count(F.lit(1)).alias("_rows")), "blocks")
    index = (lookup_join(placed, blocks.select(cell, "_block", "_rows"), [cell, "_block"], "inner")
             .withColumn("_sub", part_of(F.col("_rows"))))

    # First bound: the distance of the keep-th best inside the vector's own block part.
    bound_schema = T.StructType([f for f in vec_fields if f.name != "_ids"]
                                + [T.StructField("_reach", T.DoubleType())])

    def bound(block: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(block["_vec"])
        square = np.maximum(2 - 2 * (unit @ unit.T), 0)
        reach = (np.partition(square, keep - 1, axis=1)[:, keep - 1] if len(block) >= keep
                 else np.full(len(block), np.inf))
        return block[[f.name for f in bound_schema if f.name != "_reach"]].assign(_reach=reach)

    bounded = index.groupBy(cell, "_block", "_sub").applyInPandas(bound, bound_schema)

    # Blocks that may hold something at most that far away.
    visit_schema = T.StructType([f for f in vec_fields if f.name in (cell, "_vec", "_vid")]
                                + [T.StructField("_block", T.ArrayType(T.IntegerType()))])

    def visits(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=visit_schema.names)
        least = np.maximum(_gaps(rows, centres) - centres["_radius"].to_numpy(), 0)
        near = least ** 2 <= rows["_reach"].to_numpy()[:, None] + _ROUNDING
        names = centres["_block"].to_numpy().astype("int32")
        return rows[[cell, "_vec", "_vid"]].assign(_block=[names[n] for n in near])

    centres = pivots.join(blocks, [cell, "_block"])
    queries = (bounded.groupBy(*keys).cogroup(per_part(centres).groupBy(*keys))
               .applyInPandas(visits, visit_schema)
               .withColumn("_block", F.explode("_block")))
    queries = stage(queries, "visits")
    load = stage(queries.groupBy(cell, "_block").agg(F.count(F.lit(1)).alias("_visits"))
                 .join(blocks.select(cell, "_block", "_rows"), [cell, "_block"]), "load")
    queries = (lookup_join(queries, load, [cell, "_block"], "inner")
               .withColumn("_turn", part_of(F.col("_visits")))
               .withColumn("_sub", F.explode(F.sequence(F.lit(0), parts(F.col("_rows")) - 1))))
    index = (lookup_join(index.drop("_rows"), load, [cell, "_block"], "inner")
             .withColumn("_turn", F.explode(F.sequence(F.lit(0), parts(F.col("_visits")) - 1))))
    keys = [cell, "_block", "_sub", "_turn"]

    def compare(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or block.empty:
            return pd.DataFrame(columns=lists_schema.names)
        return _best(rows, block, keep, cell)

    met = (queries.select(*keys, "_vec", "_vid").groupBy(*keys)
           .cogroup(index.select(*keys, "_vec", "_vid", "_ids").groupBy(*keys))
           .applyInPandas(compare, lists_schema))
    best = Window.partitionBy(cell, "_vid").orderBy(F.desc("similarity"), "neighbor")
    return (met.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= keep).drop("_r"))


def _gaps(rows: pd.DataFrame, centres: pd.DataFrame) -> np.ndarray:
    """Distances between unit vectors and pivots."""
    return np.sqrt(np.maximum(2 - 2 * (_unit(rows["_vec"]) @ _unit(centres["_pivot"]).T), 0))


def visual_comparables(emb: DataFrame, prices: DataFrame, cell: str, key: str, vec: str,
                       price: str = "sale_price", k: int = 10, block_rows: int = 2048) -> DataFrame:
    """Median and standard deviation of the prices of the ``k`` most similar rows of the cell."""
    near = nearest_in_cell(emb, cell, key, vec, k, block_rows)
    priced = lookup_join(near, prices.select(F.col(key).alias("neighbor"), price), ["neighbor"])
    # At most k rows per group.
    return priced.groupBy(cell, key).agg(
        F.count(price).alias("comp_count"), F.median(price).alias("comp_median_price"),
        F.stddev_samp(price).alias("comp_price_std"))

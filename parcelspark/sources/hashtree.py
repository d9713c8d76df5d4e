"""Reconciliation by hash trees: equal branches are skipped, differing leaves are read row by row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.session import CLEANUP, setting
from parcelspark.sources.landing import checksum, row_hash

#: Bits that lead from a node to its child, and levels below the root: 4096 leaves.
FANOUT_BITS, LEVELS = 4, 3
#: Leaves named in a filter that the Parquet scan can use; more of them are joined.
NAMED_LEAVES = 256


def leaf_of(keys: Sequence[str], bits: int = FANOUT_BITS * LEVELS) -> Column:
    """Leaf of a key: the leading bits of its hash, so that leaves are even whatever the keys are."""
    flags = [F.col(k).isNull() for k in keys]
    return F.shiftrightunsigned(F.xxhash64(*flags, *keys), 64 - bits).cast("int")


def write_with_tree(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Write ``df`` sorted by leaf under ``path/rows`` and its hash tree under ``path/tree``.

    The tree has a row (level, node, rows, checksum) for each node that has rows; a node's checksum is
    the sum of its children's. Leaves are summed in one pass, with partial sums before the shuffle.
    """
    cols, spark = sorted(df.columns), df.sparkSession
    placed = df.withColumn("_leaf", leaf_of(keys))
    ranged = (placed.repartitionByRange(files, "_leaf", *keys) if files
              else placed.repartitionByRange("_leaf", *keys))
    # Shuffle files go as soon as the rows are written.
    with setting(spark, CLEANUP, "true"):
        (ranged.sortWithinPartitions("_leaf").write.mode("overwrite").option("compression", "zstd")
         .parquet(f"{path}/rows"))
    back = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    level = back.groupBy(F.col("_leaf").alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), checksum(back, cols).alias("checksum"))
    level.withColumn("level", F.lit(LEVELS)).write.mode("overwrite").parquet(f"{path}/tree")
    # At most 4096 rows from here on.
    leaves = spark.read.parquet(f"{path}/tree")
    for up in range(1, LEVELS + 1):
        (leaves.groupBy(F.shiftright("node", FANOUT_BITS * up).alias("node"))
         .agg(F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))
         .withColumn("level", F.lit(LEVELS - up)).write.parquet(f"{path}/tree-{LEVELS - up}"))


@dataclass
class Comparison:
    """``rows``: (keys, change) with change ``changed``, ``lost`` or ``added``. ``nodes`` of the trees were
    compared, and the rows of ``leaves`` were read."""

    rows: DataFrame
    nodes: int
    leaves: list[int]


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    tree = spark.read.parquet(f"{path}/tree" if level == LEVELS else f"{path}/tree-{level}")
    return tree.select("node", "rows", "checksum")


def compare_trees(spark: SparkSession, src: str, dst: str, keys: Sequence[str]) -> Comparison:
    """What differs between two tables of :func:`write_with_tree`.

    Trees are compared level by level, and only below nodes that differ. Rows are read only from the
    leaves that differ, as a filter on the sorted leaf column that row-group statistics answer. Keys
    may be null or repeat: the rows of a key are compared by their number and checksum. A column that
    only one side has, or that has another type, makes all keys of both sides ``changed``.
    """
    keys, open_, nodes = list(keys), [0], 0
    a, b = (spark.read.parquet(f"{p}/rows") for p in (src, dst))
    alike = dict(a.dtypes) == dict(b.dtypes)
    if not alike:
        open_ = None
    for level in range(LEVELS + 1) if alike else ():
        left, right = (_level(spark, p, level).filter(F.col("node").isin(open_)) for p in (src, dst))
        both = left.withColumnsRenamed({"rows": "n", "checksum": "c"}).join(right, "node", "full")
        differ = both.filter(~(F.col("n").eqNullSafe(F.col("rows"))
                               & F.col("c").eqNullSafe(F.col("checksum"))))
        # At most the nodes of a level: 4096 numbers.
        found = sorted(r["node"] for r in differ.select("node").collect())
        nodes += len(open_)
        if level < LEVELS:
            open_ = [n << FANOUT_BITS | k for n in found for k in range(1 << FANOUT_BITS)]
        else:
            open_ = found
        if not found:
            break
    shared = sorted(set(a.columns) & set(b.columns) - {"_leaf"})

    def side(df: DataFrame, sign: int) -> DataFrame:
        if open_ is not None and len(open_) <= NAMED_LEAVES:
            df = df.filter(F.col("_leaf").isin(open_))
        elif open_ is not None:
            wanted = spark.createDataFrame([(x,) for x in open_], "_leaf int")
            df = df.join(F.broadcast(wanted), "_leaf", "left_semi")
        return df.select(*keys, F.lit(sign).alias("_sign"),
                         (row_hash(shared) * F.lit(sign)).cast("decimal(38,0)").alias("_sum"))

    # Both sides meet in one shuffle; a group takes null keys together.
    both = side(a, 1).unionAll(side(b, -1)).groupBy(*keys).agg(
        F.count_if(F.col("_sign") > 0).alias("src_n"), F.count_if(F.col("_sign") < 0).alias("dst_n"),
        F.sum("_sum").alias("apart"))
    change = (F.when(F.col("dst_n") == 0, "lost").when(F.col("src_n") == 0, "added")
              .when(F.lit(not alike) | (F.col("src_n") != F.col("dst_n")) | (F.col("apart") != 0),
                    "changed"))
    rows = both.withColumn("change", change).filter("change IS NOT NULL").select(*keys, "change")
    return Comparison(rows, nodes, open_ or [])

"""Joins and selections that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.session import stage

# A key is hot when it owns more than 1/SHARE of the rows, so there are fewer than SHARE hot keys.
SHARE = 1000
BROADCAST_BYTES = 64 << 20
# Rows of one group that a single task may sort.
HOT_ROWS = 1_000_000


def row_width(schema: T.StructType) -> int:
    """Generous estimate of the bytes one row takes in memory."""
    widths = {T.StringType: 64, T.BinaryType: 256, T.ArrayType: 4096, T.MapType: 4096,
              T.StructType: 512}
    return 16 + sum(widths.get(type(f.dataType), 8) for f in schema)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the rows and compare their size with the limit; cheap on staged tables."""
    return df.count() * row_width(df.schema) <= max_bytes


def retry_stable_salt(df: DataFrame, splits: Column) -> Column:
    """Number in [0, splits) that a re-run of the same task repeats.

    The partition id spreads full copies of one row, which share their hash.
    """
    cols = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*cols) + F.spark_partition_id(), splits).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that own more than 1/SHARE of the rows and the number of splits each one needs."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    fair = counts.agg((F.sum("_n") / F.lit(SHARE)).alias("_fair")).scalar()
    hot = counts.filter((F.col("_n") > fair) & (F.col("_n") > 1))
    return hot.select(*keys, F.least(F.ceil(F.col("_n") / fair), F.lit(SHARE)).cast("int")
                      .alias("_splits"))


def salted_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str],
                how: str = "left") -> DataFrame:
    """Equi-join whose hot keys are split over many tasks (``how``: left, inner, left_semi,
    left_anti)."""
    keys = list(keys)
    # Fewer than SHARE rows by the definition of a hot key, so this broadcast is bounded; staged,
    # since both sides take it.
    hot = F.broadcast(stage(hot_keys(facts.select(*keys), keys), "hot"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    splits = F.when(null_key, F.lit(SHARE)).otherwise(F.coalesce("_splits", F.lit(1)))
    left = facts.join(hot, keys, "left")
    left = left.withColumn("_salt", retry_stable_salt(facts, splits)).drop("_splits")
    right = (lookup.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(
                 F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)))
             .drop("_splits"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a table that is unique on ``keys``.

    Its size is checked first: a small table is broadcast and the facts are not shuffled; a larger
    one goes through a shuffle join with split hot keys.
    """
    if fits_broadcast(lookup, max_bytes):
        return facts.join(F.broadcast(lookup), list(keys), how)
    return salted_join(facts, lookup, keys, how)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 part_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``value`` replaced by the last one that isn't null up to the row, by ``keys``.

    Rows are cut at quantiles of (keys, order) into parts of about ``part_rows``, so the rows of one key,
    or of one key and moment, may spread over many tasks. Each part hands on the last value of each of
    its keys, one row, to the parts behind it. ``order`` should leave no ties; keys must not be null.
    """
    keys, order = list(keys), list(order)
    rows = stage(df, "rows")
    parts = max(-(-rows.count() // part_rows), 1)
    # A range exchange numbers its partitions in order; rows that tie stay together.
    ranged = stage(rows.repartitionByRange(parts, *keys, *order)
                   .withColumn("_part", F.spark_partition_id()), "ranged")
    upto = (Window.partitionBy("_part", *keys).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = ranged.withColumn("_seen", F.last(value, ignorenulls=True).over(upto))
    last = F.max_by(F.struct(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    handed = stage(ranged.groupBy("_part", *keys).agg(last.alias("_last")).select(
        "_part", *keys, F.last(F.col("_last")[value], ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry")), "handed")
    out = lookup_join(seen, handed, ["_part", *keys])
    return out.withColumn(value, F.coalesce("_seen", "_carry")).select(*df.columns)


def lowest_share(df: DataFrame, by: Sequence[str], fraction: float, hex_key: Column,
                 bits: int = 12, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The ``ceil(fraction * n)`` rows of each group with the lowest ``hex_key`` digests.

    A count per (group, leading bits of the digest) finds the bin in which the quota ends. Rows of
    lower bins are kept as they stream by; only the rows of that one bin are ranked, so a group is
    never sorted in one task. A bin that still holds many rows is divided again.
    """
    by = list(by)
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    columns = df.columns
    keyed = df.withColumn("_hex", hex_key)
    word = F.conv(F.substring("_hex", 1, 12), 16, 10).cast("bigint")
    # Read and hashed once; the counts and the two selections below go over the staged rows.
    keyed = stage(keyed.withColumn("_word", word), "hashed")

    cuts, used = None, bits
    while True:
        bin_of = F.shiftright("_word", 48 - used)
        if cuts is None:
            inside = keyed
        else:
            inside = (_null_safe_lookup(keyed, cuts, by)
                      .filter(F.shiftright("_word", 48 - used + bits) == F.col("_cut")))
        sizes = inside.groupBy(*by, bin_of.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
        in_group = Window.partitionBy(*by)
        if cuts is None:
            sizes = sizes.withColumn(
                "_quota", F.ceil(F.sum("_n").over(in_group) * F.lit(fraction)))
        else:
            sizes = _null_safe_lookup(sizes, cuts.drop("_cut"), by)
        sizes = sizes.withColumn("_before", F.sum("_n").over(in_group.orderBy("_bin"))
                                 - F.col("_n"))
        # One row per group: the bin where the quota ends and what is left of the quota there.
        cuts = stage(sizes.filter((F.col("_before") < F.col("_quota"))
                                  & (F.col("_quota") <= F.col("_before") + F.col("_n")))
                     .select(*by, F.col("_bin").alias("_cut"),
                             (F.col("_quota") - F.col("_before")).alias("_quota"), "_n"),
                     "cuts")
        largest = cuts.agg(F.max("_n")).first()[0] or 0
        cuts = cuts.drop("_n")
        if largest <= hot_rows or used + bits > 48:
            break
        used += bits

    marked = _null_safe_lookup(keyed, cuts, by).withColumn(
        "_bin", F.shiftright("_word", 48 - used))
    below = marked.filter(F.col("_bin") < F.col("_cut")).select(*columns)
    edge = marked.filter(F.col("_bin") == F.col("_cut"))
    # Copies of a row are counted before the ranking, so they cannot fill one task either.
    ranked = edge.groupBy(*columns, "_hex", "_quota").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*by).orderBy("_hex", *[c for c in columns if c not in by])
    before = F.sum("_n").over(order) - F.col("_n")
    keep = F.least(F.col("_n"), F.col("_quota") - before)
    kept = (ranked.withColumn("_keep", keep).filter(F.col("_keep") > 0)
            .withColumn("_chunk", F.explode(F.sequence(
                F.lit(0), F.floor((F.col("_keep") - 1) / HOT_ROWS))))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(
                F.lit(HOT_ROWS), F.col("_keep") - F.col("_chunk") * HOT_ROWS).cast("int")))))
    return below.unionByName(kept.select(*columns))


def _null_safe_lookup(facts: DataFrame, lookup: DataFrame, by: list[str]) -> DataFrame:
    """Lookup join that also matches null group keys."""
    flags = {f"_{i}_null": F.col(c).isNull() for i, c in enumerate(by)}
    values = {f"_{i}_key": F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(by)}
    keys = [*flags, *values]
    right = lookup.withColumns(flags | values).drop(*by)
    return lookup_join(facts.withColumns(flags | values), right, keys, "inner").drop(*keys)

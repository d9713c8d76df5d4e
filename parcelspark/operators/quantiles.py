"""Exact interpolated percentiles and running counts without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.operators.skew import HOT_ROWS, fits_broadcast, lookup_join, salted_join
from parcelspark.session import stage

_ACCURACY = 10_000
_FANOUT = 64


def exact_percentiles(df: DataFrame, value: Column | str, qs: Sequence[float],
                      by: Sequence[str] = (), bounded_groups: bool = False,
                      sort_rows: int = 10 * HOT_ROWS) -> DataFrame:
    """One row per group: ``by``, ``n`` and ``p``, the percentiles of ``value`` in the order of
    ``qs``, interpolated linearly; nulls, NaN and null groups are left out.

    For groups that may be as large as the table. A mergeable sketch brackets each rank, exact
    counts tell which slices between the brackets hold the ranks, and only those slices are sorted;
    a slice of more than ``sort_rows`` rows is divided again first. Copies of a bracket's own value
    are a slice for themselves, with nothing to sort or divide. The answer is exact whatever
    the sketch's error; that only changes how much is sorted. ``bounded_groups`` says that the
    number of groups is fixed by the caller's code, as with a list of feature names; otherwise it
    is counted before the sketch is broadcast.
    """
    qs = [float(q) for q in qs]
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, value.cast("double").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = rows.dropna(subset=by) if by else rows

    slack = 4.0 / _ACCURACY
    marks = sorted({min(max(q + d, 0.0), 1.0) for q in qs for d in (-slack, slack)})
    keys, wanted, previous = by, None, 0
    while True:
        depth = len(marks).bit_length()
        # Filled up for the binary search; no value lies above the fill.
        fill = F.array_repeat(F.lit(float("inf")), 2 ** depth - 1 - len(marks))
        sketch = rows.groupBy(*keys).agg(
            F.percentile_approx("_v", marks, _ACCURACY).alias("_marks")).withColumn(
            "_marks", F.concat("_marks", fill))
        level = f"_slot{len(keys) - len(by)}"
        if not keys:
            placed = rows.withColumn("_marks", sketch.scalar())
        elif bounded_groups:
            placed = rows.join(F.broadcast(sketch), keys)
        else:
            placed = _attach(rows, stage(sketch, "sketch"), keys)
        on_mark = F.coalesce(F.get("_marks", F.col(level)) == F.col("_v"), F.lit(False))
        placed = descend(placed, "_v", level, depth).withColumn(
            level, F.col(level) * 2 + on_mark.cast("int")).drop("_marks")
        sizes = placed.groupBy(*keys, level).agg(F.count(F.lit(1)).alias("_n"))
        # At most 2 * len(marks) + 3 rows per group.
        group = Window.partitionBy(*(keys or [F.lit(True)]))
        before = F.sum("_n").over(group.orderBy(level)) - F.col("_n")
        if wanted is None:
            total = F.sum("_n").over(group)
            ranks = F.array_distinct(F.concat(*[
                F.array(F.floor(q * (total - 1)), F.ceil(q * (total - 1))) for q in qs]))
            sizes = sizes.withColumns({"_before": before, "_total": total, "_ranks": ranks})
        else:
            sizes = (sizes.withColumn("_inside", before).join(wanted, keys)
                     .withColumn("_before", F.col("_before") + F.col("_inside")))
        inside = F.filter("_ranks", lambda r: (r >= F.col("_before"))
                          & (r < F.col("_before") + F.col("_n")))
        keys = [*keys, level]
        # One row per slice that holds a rank: at most two per percentile and group.
        found = stage(sizes.withColumn("_ranks", inside).filter(F.size("_ranks") > 0)
                      .select(*keys, "_before", "_total", "_ranks", "_n"), "slices")
        # An odd slice holds one value.
        largest = found.filter(F.col(level) % 2 == 0).agg(F.max("_n")).first()[0] or 0
        shrunk = wanted is None or largest < previous
        previous, wanted = largest, found.drop("_n")
        if largest <= sort_rows or not shrunk:
            break
        rows = _attach(placed, wanted.select(*keys), keys)
        marks = [i / _FANOUT for i in range(1, _FANOUT)]

    # Copies of a value are counted first, so a slice is as long as its distinct values.
    picked = (_attach(placed, wanted.select(*keys), keys)
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    upto = _attach(picked, wanted, keys).withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_v")) + F.col("_before"))
    hits = upto.withColumn("_ranks", F.filter(
        "_ranks", lambda r: (r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto"))))
    entries = F.flatten(F.collect_list(F.transform(
        "_ranks", lambda r: F.struct(r.alias("rank"), F.col("_v").alias("v")))))
    at = (hits.filter(F.size("_ranks") > 0).groupBy(*by)
          .agg(F.map_from_entries(entries).alias("_at"), F.max("_total").alias("n"))
          .filter(F.col("n").isNotNull()))

    def interpolate(q: float) -> Column:
        pos = q * (F.col("n") - 1)
        low = F.col("_at")[F.floor(pos)]
        high = F.col("_at")[F.ceil(pos)]
        return low + (high - low) * (pos - F.floor(pos))

    return at.select(*by, "n", F.array(*[interpolate(q) for q in qs]).alias("p"))


def _attach(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join with a staged table that has one row per key, by broadcast if it is small."""
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), list(keys))
    return salted_join(rows, table, keys, "inner")


def keyed_percentiles(df: DataFrame, by: Sequence[str],
                      wanted: Mapping[str, tuple[Column | str, Sequence[float]]],
                      extra: Mapping[str, Column] | None = None,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per group with one array column per entry of ``wanted`` (name → value, fractions)
    and one column per aggregate in ``extra``.

    For keys with very many groups. Groups of at most ``hot_rows`` rows use the built-in exact
    aggregate; larger ones go through :func:`exact_percentiles`. NaN counts as null, so both give
    the same figures. Groups without a value give null; rows with a null key are left out.
    """
    by, extra = list(by), extra or {}
    df = df.dropna(subset=by)
    values = {}
    for name, (v, _) in wanted.items():
        value = (F.col(v) if isinstance(v, str) else v).cast("double")
        values[name] = F.when(~F.isnan(value), value)
    others = [c.alias(name) for name, c in extra.items()]
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(sizes.filter(F.col("_n") > hot_rows).drop("_n"), "hot")
    native = [F.percentile(values[name], list(qs)).alias(name) for name, (_, qs) in wanted.items()]
    if hot.isEmpty():
        return df.groupBy(*by).agg(*native, *others)
    cold = lookup_join(df, hot, by, "left_anti").groupBy(*by).agg(*native, *others)
    rows = lookup_join(df, hot, by, "left_semi")
    out = rows.groupBy(*by).agg(*others) if others else hot
    for name, (_, qs) in wanted.items():
        one = exact_percentiles(rows, values[name], qs, by).select(*by, F.col("p").alias(name))
        out = lookup_join(out, stage(one, "percentiles"), by)
    return cold.unionByName(out)


def descend(df: DataFrame, value: str, slot: str, depth: int) -> DataFrame:
    """Add ``slot``, the number of entries of ``_marks`` below ``value``: a binary search.

    One projection per step: nested in one expression, the steps would double its size each time.
    """
    out = df.withColumn(slot, F.lit(0))
    for bit in reversed(range(depth)):
        step = 2 ** bit
        # Never null, so that no join adds a null check with all steps in it.
        below = F.coalesce(F.col("_marks")[F.col(slot) + (step - 1)] < F.col(value), F.lit(False))
        out = out.withColumn(slot, F.col(slot) + below.cast("int") * step)
    return out


def with_slot(df: DataFrame, value: str, depth: int = 7, levels: int = 1) -> DataFrame:
    """Add ``_slot``: ordered slices of the value range of about equal size, ``2 ** depth`` per
    level.

    The marks are approximate percentiles, of the whole column and then of each slice, so that
    every sketch stays small.
    """
    slots = 2 ** depth
    marks = F.percentile_approx(value, [i / slots for i in range(1, slots)], slots * 10)
    out = descend(df.withColumn("_marks", df.agg(marks.alias("_marks")).scalar()),
                   value, "_slot", depth).drop("_marks")
    for _ in range(levels - 1):
        # At most `slots ** level` rows, counted before the broadcast.
        finer = stage(out.groupBy("_slot").agg(marks.alias("_marks")), "marks")
        out = descend(_attach(out, finer, ["_slot"]), value, "_sub", depth).drop("_marks")
        out = out.withColumn("_slot", F.col("_slot") * slots + F.col("_sub")).drop("_sub")
    return out


def running_counts(df: DataFrame, value: str, weights: Sequence[str],
                   sort_rows: int = HOT_ROWS) -> DataFrame:
    """Running sums of ``weights`` in the order of ``value`` (unique per row) over a staged table.

    The value range is cut into slices of about ``sort_rows`` rows or less; sums run inside each
    slice and start from the total of the earlier ones, so no task sorts the whole column.
    """
    needed = max(df.count() / sort_rows, 1)
    depth, levels = (5, 1) if needed <= 32 else (10, 1) if needed <= 1024 else (10, 2)
    placed = with_slot(df, value, depth, levels)
    totals = placed.groupBy("_slot").agg(*[F.sum(w).alias(w) for w in weights])
    # One row per slice, a million at most.
    earlier = Window.partitionBy(F.lit(True)).orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select("_slot", *[
        F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_start_{w}") for w in weights])
    in_slot = Window.partitionBy("_slot").orderBy(value)
    out = placed.join(F.broadcast(starts), "_slot")
    return out.select(*df.columns, *[
        (F.sum(w).over(in_slot) + F.col(f"_start_{w}")).alias(f"run_{w}") for w in weights])

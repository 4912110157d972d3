"""Exact ranks over a large group without sorting the group in one task.

``PERCENT_RANK`` and ``PERCENTILE_CONT`` need, for each distinct value, how many
rows of the group lie below it.  A window over the group would put all its rows
into one task.  Here the values are whole numbers whose bits form a tree of three
levels: counts are summed up the tree, then running totals are taken among siblings
and carried down.  A window holds at most the 2^22 possible siblings, two numbers
each, however many rows the group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BITS = 22


def counts_below(values: DataFrame, group: Sequence[str], value: str, count: str) -> DataFrame:
    """Add ``n_below`` and ``n_total`` to a frame with one row per (group, value).

    ``value`` must be a bigint and ``count`` the number of rows that have it.
    ``group`` must not contain NULLs.
    """
    group = list(group)
    keep = values.columns
    node = lambda depth: f"_node{depth}"
    depths = -(-64 // _BITS)

    # Arithmetic shifts keep the order of negative values.
    levels = [values.withColumn(node(0), F.col(value)).withColumn(
        node(1), F.shiftright(F.col(value), _BITS))]
    for depth in range(1, depths):
        parent = F.shiftright(F.col(node(depth)), _BITS)
        summed = levels[-1].groupBy(*group, node(depth)).agg(F.sum(count).alias(count))
        levels.append(summed.withColumn(node(depth + 1), parent))

    carried: DataFrame | None = None
    for depth in range(depths - 1, -1, -1):
        level = levels[depth]
        if carried is None:
            siblings = Window.partitionBy(*group)
            level = level.withColumn("n_total", F.sum(count).over(siblings))
            above = F.lit(0).cast("bigint")
        else:
            siblings = Window.partitionBy(*group, node(depth + 1))
            level = level.join(carried, [*group, node(depth + 1)])
            above = F.col("_above")
        running = F.sum(count).over(
            siblings.orderBy(node(depth)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        level = level.withColumn("n_below", above + running - F.col(count))
        if depth:
            carried = level.select(*group, node(depth), F.col("n_below").alias("_above"), "n_total")
        else:
            return level.select(*keep, "n_below", "n_total")
    raise AssertionError("unreachable")


def percent_rank(n_below: Column, n_total: Column) -> Column:
    """(rank - 1) / (rows - 1); a lone row has rank 0."""
    return F.when(n_total > 1, n_below / (n_total - 1)).otherwise(F.lit(0.0))


def exact_percentile(rows: DataFrame, group: Sequence[str], value: str, p: float,
                     name: str) -> DataFrame:
    """Interpolated percentile of a bigint column per group, as a double."""
    group = list(group)
    per_value = (rows.filter(F.col(value).isNotNull())
                 .groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n")))
    ranked = counts_below(per_value, group, value, "_n")
    position = F.lit(p) * (F.col("n_total") - 1)
    covers = lambda at: (F.col("n_below") <= at) & (at < F.col("n_below") + F.col("_n"))
    ends = ranked.groupBy(*group).agg(
        F.max(F.when(covers(F.floor(position)), F.col(value))).alias("_low"),
        F.max(F.when(covers(F.ceil(position)), F.col(value))).alias("_high"),
        F.max(position - F.floor(position)).alias("_part"),
    )
    return ends.select(*group, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(name))

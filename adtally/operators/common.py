"""Row filters and keyed picks used by several report families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DEPOSIT = "deposit"


def deposits(events: DataFrame, null_users: bool = False) -> DataFrame:
    """Deposit events; rows without a user id only on request."""
    rows = events.filter(F.col("event_type") == DEPOSIT)
    return rows if null_users else rows.filter(F.col("external_user_id").isNotNull())


def paying_deposits(events: DataFrame) -> DataFrame:
    """Deposits with a positive converted amount and a known user."""
    return deposits(events).filter(F.col("converted_amount") > 0)


def paid_only(df: DataFrame, column: str = "publisher_id") -> DataFrame:
    """Drop organic traffic (publisher 0) and rows without a publisher."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != 0))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent non-grouped ``value`` per key; a tie takes the smallest.

    Two map-side combined aggregations: counts first, then the minimum of
    (-count, value), so a hot key never needs a sort in one task.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct(-F.col("_n"), F.col(value))).alias("_best")
    return counts.groupBy(*keys).agg(best).select(*keys, F.col(f"_best.{value}").alias(value))


def _pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ordering = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    packed = F.struct(*ordering, *[F.col(c) for c in rest])
    chosen = df.groupBy(*keys).agg(pick(packed).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, smallest by ``order`` and then by the other columns."""
    return _pick_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, largest by ``order`` and then by the other columns.

    Copies of a key are combined on the map side, so a key that holds a large
    share of the rows costs one row per map task.
    """
    return _pick_per_key(df, keys, order, F.max)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark keeps at most ``k`` rows per group and map task before the shuffle.
    """
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


SALTS = 16


def salted_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                salts: int = SALTS) -> DataFrame:
    """Join ``rows`` with a ``lookup`` that has one row per key, where a key may be hot.

    The rows of a key are dealt to ``salts`` parts by a hash of their other columns, and
    the lookup is repeated for each part.  Shuffling on (key, part) also gives both sides
    an exchange of their own, which adaptive execution needs to split a part still too
    large; a lookup that comes from a ``groupBy`` on the key would not have one.
    """
    keys = list(keys)
    spread = [F.col(c) for c in rows.columns if c not in keys] or [F.lit(0)]
    part = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = lookup.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_part", part).join(repeated, [*keys, "_part"], how).drop("_part")


def scalar(df: DataFrame) -> Column:
    """A one-row, one-column frame as an uncorrelated scalar subquery."""
    return df.scalar()

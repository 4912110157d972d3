"""Stored reports that are kept up to date from changes instead of being built anew.

Each keeps rows per user, found again by whom a batch concerns; only those users are
computed anew, from the event table that already holds the batch, and only the partitions
in which something differs are written.  A refresh that died can be run again with the same
batch: it finds what is done and does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import time as tm
from ..operators import arppu, split_test
from ..operators.common import DEPOSIT, deposits, paying_deposits
from ..operators.reactivation import gaps
from ..session import remove
from . import layouts
from .writers import _rebalanced, _staging, _values, read_table, store_reactivations, swap_partitions

USER, TS = "external_user_id", "event_date"


def exchange_rows(spark: SparkSession, path: str, partition: str, keys: Sequence[str], gone: DataFrame, new: DataFrame,
                  since: str | None = None) -> set[str | None]:
    """Put the rows ``new`` in place of the stored ones whose ``keys`` are in ``gone``; returns the partitions written.

    Partitions in which the same rows would stand again keep their files.  ``since`` promises
    that no partition before it holds any of these rows.
    """
    new_path = _staging(path, "new")
    new.write.parquet(new_path)
    touched = _exchange_written(spark, path, partition, keys, gone, spark.read.schema(new.schema).parquet(new_path), since)
    remove(spark, [new_path])
    return touched


def _exchange_written(spark: SparkSession, path: str, partition: str, keys: Sequence[str], gone: DataFrame, new: DataFrame,
                      since: str | None = None) -> set[str | None]:
    """:func:`exchange_rows` with rows ``new`` that are read from files beside the table: they are asked for several times."""
    gone_path = _staging(path, "gone")
    keyed = gone.select(*keys)
    keyed.write.parquet(gone_path)
    gone = spark.read.schema(keyed.schema).parquet(gone_path)
    stored = read_table(spark, path, new)
    if since is not None:
        stored = stored.filter((F.col(partition) >= since) | F.col(partition).isNull())
    old = stored.join(gone, list(keys), "left_semi").select(new.columns)
    # Every row of both, as often as it is new more often than old.
    counted = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1))).groupBy(*new.columns).agg(F.sum("_n").alias("_n"))
    touched = _values(counted.filter("_n <> 0"), partition)
    if touched:
        among = lambda df: df.filter(F.col(partition).isin([p for p in touched if p is not None]) | (F.col(partition).isNull() if None in touched else F.lit(False)))
        kept = among(stored).join(gone, list(keys), "left_anti").select(new.columns)
        swap_partitions(kept.unionByName(among(new)), path, partition, touched)
    remove(spark, [gone_path])
    return touched


def _users_of(path: str) -> str:
    return f"{path.rstrip('/')}-users"


# --- reactivations ----------------------------------------------------------


def build_reactivations(events: DataFrame, path: str, min_gap_days: float = 7) -> None:
    """All reactivations by month, and beside them the last deposit of every user."""
    store_reactivations(events, path, min_gap_days)
    deposits(events).groupBy(F.col(USER).alias("user_id")).agg(F.max(TS).alias("last_deposit")).write.mode("overwrite").parquet(_users_of(path))


def refresh_reactivations(batch: DataFrame, events: DataFrame, path: str, min_gap_days: float = 7,
                          changed_users: DataFrame | None = None) -> set[str | None]:
    """Bring the table of :func:`build_reactivations` up to date with a ``batch`` that ``events`` already holds.

    A user whose new deposits all come after the last one known needs no history: the
    pauses lie between that one and the new ones.  A user with a late deposit, and any in
    ``changed_users`` (user_id) whose events were corrected or removed, is computed anew
    from ``events``.  Returns the months written.
    """
    spark = events.sparkSession
    last = spark.read.parquet(_users_of(path))
    fresh = deposits(batch).groupBy(F.col(USER).alias("user_id")).agg(F.min(TS).alias("_from"), F.max(TS).alias("_to"))
    known_path = _staging(path, "batch-users")
    known = fresh.join(last, "user_id", "left").withColumn("_late", F.coalesce(F.col("_from") <= F.col("last_deposit"), F.lit(False)))
    known.write.parquet(known_path)
    known = spark.read.parquet(known_path)
    late = known.filter("_late").select("user_id")
    since = None
    if changed_users is not None:
        late = late.unionByName(changed_users.select("user_id")).distinct()
    else:
        # No pause that ends before the first late deposit of all changes.
        since = known.filter("_late").agg(F.date_format(F.min("_from"), "yyyy-MM")).first()[0]
    in_order = known.join(late, "user_id", "left_anti")

    layout = events.select(USER, TS, "event_type").schema
    before = in_order.filter("last_deposit IS NOT NULL").select(
        F.col("user_id").alias(USER), F.col("last_deposit").alias(TS), F.lit(DEPOSIT).alias("event_type"))
    after = deposits(batch).select(USER, TS, "event_type").join(in_order.select(F.col("user_id").alias(USER)), USER, "left_semi")
    history = events.select(USER, TS, "event_type").join(late.select(F.col("user_id").alias(USER)), USER, "left_semi")
    rows = gaps(layouts.cast_to(before, layout).unionByName(layouts.cast_to(after, layout)), min_gap_days).unionByName(gaps(history, min_gap_days))
    rows = rows.withColumn("month", tm.month_text(F.col("first_deposit")))
    if since is not None:
        late_users = late.withColumn("_l", F.lit(True))
        rows = rows.join(late_users, "user_id", "left").filter(F.col("_l").isNull() | (F.col("month") >= since)).drop("_l")
    rows_path = _staging(path, "new")
    rows.write.parquet(rows_path)
    rows = spark.read.schema(rows.schema).parquet(rows_path)

    stored = read_table(spark, path, rows)
    old = stored.filter(F.col("month") >= since) if since is not None else stored
    key = ["user_id", "first_deposit"]
    gone = old.join(late, "user_id", "left_semi").select(key).unionByName(rows.select(key)).distinct()
    low = rows.agg(F.min("month")).first()[0] if changed_users is None else None
    low = None if changed_users is not None else min((m for m in (low, since) if m is not None), default=None)
    written = _exchange_written(spark, path, "month", key, gone, rows, low)

    # The state last: a refresh that dies before it starts from the same state again.
    ends = known.select("user_id", F.col("_to").alias("last_deposit"))
    if changed_users is not None:
        recomputed = deposits(events).join(late.select(F.col("user_id").alias(USER)), USER, "left_semi").groupBy(
            F.col(USER).alias("user_id")).agg(F.max(TS).alias("last_deposit"))
        last = last.join(late, "user_id", "left_anti")
        ends = ends.join(late, "user_id", "left_anti").unionByName(recomputed)
    newer = _staging(path, "users")
    last.unionByName(ends).groupBy("user_id").agg(F.max("last_deposit").alias("last_deposit")).write.parquet(newer)
    layouts.swap(spark, newer, _users_of(path))
    remove(spark, [known_path, rows_path])
    return written


# --- first-period cohorts ---------------------------------------------------


def _cohort_rows(events: DataFrame, grain: str) -> DataFrame:
    return arppu.first_windows(events, grain).withColumn("cohort", F.date_format(tm.period_start(F.col("first_deposit"), grain), "yyyy-MM-dd"))


def build_cohorts(events: DataFrame, path: str, grain: str = "month") -> None:
    """What every user paid in the first week or month, by cohort: the mergeable part of ``arppu.first_period``."""
    _rebalanced(_cohort_rows(events, grain), ["cohort"]).write.mode("overwrite").partitionBy("cohort").parquet(path)


def refresh_cohorts(batch: DataFrame, events: DataFrame, path: str, grain: str = "month", changed_users: DataFrame | None = None) -> set[str | None]:
    """Bring the table of :func:`build_cohorts` up to date with a ``batch`` that ``events`` already holds.

    Concerned are new users, those who now paid earlier than known, whose cohort changes, and
    those who paid within their first period; ``changed_users`` (external_user_id) adds
    others, whose events were corrected or removed.  Returns the cohorts written.
    """
    spark = events.sparkSession
    known = spark.read.schema(_cohort_rows(events, grain).schema).parquet(path).select(USER, "first_deposit")
    fresh = paying_deposits(batch).groupBy(USER).agg(F.min(TS).alias("_from"))
    end = F.col("first_deposit") + F.expr(f"INTERVAL '{arppu.PERIOD_DAYS[grain]}' DAY")
    concerned = fresh.join(known, USER, "left").filter(F.col("first_deposit").isNull() | (F.col("_from") < end)).select(USER)
    if changed_users is not None:
        concerned = concerned.unionByName(changed_users.select(USER)).distinct()
    whom = _staging(path, "concerned")
    concerned.write.parquet(whom)
    concerned = spark.read.parquet(whom)
    rows = _cohort_rows(events.join(concerned, USER, "left_semi"), grain)
    written = exchange_rows(spark, path, "cohort", [USER], concerned, rows)
    remove(spark, [whom])
    return written


def cohorts(spark: SparkSession, path: str, as_of: tm.Day, grain: str = "month", exclude_cohorts: Sequence[tm.Day] = ()) -> DataFrame:
    """``arppu.first_period`` from the stored rows: one per user, whole cohorts pruned by their folder."""
    cutoff = arppu.month_before(as_of)
    rows = spark.read.option("basePath", path).parquet(path).filter(F.col("cohort") <= F.lit(cutoff.isoformat()).cast("date"))
    return arppu.cohort_report(rows, as_of, grain, exclude_cohorts)


# --- split-test groups ------------------------------------------------------


def add_group_layer(events: DataFrame, path: str, layer: str, **split) -> None:
    """What a batch of deposits adds to each user of the split test, as a layer of its own.

    Counts, sums and date ranges merge by adding layers up.  A layer that is written again
    replaces itself, so a batch that is repeated counts once.
    """
    totals = split_test.user_totals(split_test.assign(events, **split)).withColumn("layer", F.lit(layer))
    _rebalanced(totals, ["layer"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layer").parquet(path)


_TOTALS = {"deposit_count": F.sum, "total_usd": F.sum, "first_date": F.min, "last_date": F.max}


def group_totals(spark: SparkSession, path: str) -> DataFrame:
    """The sum of all layers: ``split_test.user_totals`` of all batches, for ``split_test.compare_totals``."""
    rows = spark.read.option("basePath", path).parquet(path)
    merged = rows.groupBy("user_id", "test_group").agg(*[how(c).alias(c) for c, how in _TOTALS.items()])
    return merged.select("user_id", "test_group", F.col("deposit_count").cast(rows.schema["deposit_count"].dataType).alias("deposit_count"),
                         F.col("total_usd").cast(rows.schema["total_usd"].dataType).alias("total_usd"), "first_date", "last_date")


def compact_layers(spark: SparkSession, path: str, layer: str = "base") -> None:
    """All layers as one, in the table's place."""
    whole = _staging(path, "layers")
    _rebalanced(group_totals(spark, path).withColumn("layer", F.lit(layer)), ["layer"]).write.partitionBy("layer").parquet(whole)
    layouts.swap(spark, whole, path)

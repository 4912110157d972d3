"""Writers: append, replace a period or sheet, insert-or-ignore, upsert, stored reports.

Event tables are Parquet folders partitioned by ``event_month``.  A job that needs the
old rows first writes the new state of the affected months to a staging folder beside
the table and only then overwrites those months, so no plan reads and overwrites the
same files, and a job that dies half way can be run again.  Staging folders are removed
after success.

Partition folders and staging folders are deleted through the session's Hadoop file
system, which classic Spark sessions offer and Spark Connect does not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from .. import schemas
from ..functions import time as tm
from ..operators.attribution import monthly_from_daily
from ..operators.common import first_per_key, last_per_key
from ..operators.reactivation import gaps
from ..session import remove
from . import event_index, layouts

MONTH = "event_month"


def csv_results(df: DataFrame, path: str, single_file: bool = False, byte_order_mark: bool = False) -> None:
    """Results as CSV.  ``single_file`` is meant for summaries only."""
    if byte_order_mark:
        first = df.columns[0]
        df = df.withColumnRenamed(first, "\ufeff" + first)
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def _rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows gathered by partition; adaptive execution cuts a large partition into files of a sensible size."""
    return df.hint("rebalance", *keys) if keys else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, which takes up new columns and wider types (``layouts``)."""
    with layouts.evolved(df, path, partition_by) as rows:
        _rebalanced(rows, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None, merge_schema: bool = False) -> DataFrame:
    """A stored table in its noted layout; before its first write an empty frame shaped ``like`` another.

    The types of ``like`` also decide how partition values, such as sheet ids, are read.
    ``merge_schema`` collects columns that only some files have, which opens every file, where no layout is noted.
    """
    try:
        known = layouts.noted(spark, path) if like is None else like.schema
        reader = spark.read if known is None else spark.read.schema(known)
        return reader.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException:
        if like is None:
            raise
        return like.limit(0)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Overwrite the partitions that occur in ``df`` and leave the others."""
    with layouts.evolved(df, path, keys) as rows:
        (_rebalanced(rows, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(path))


# Fixed value: the folder name that Spark gives to a NULL partition.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> None:
    """Delete the folders of partition values, such as ``month=2025-11``, of a Parquet table."""
    remove(spark, [f"{path}/{column}={_NULL_FOLDER if v is None else v}" for v in values])


def swap_partitions(df: DataFrame, path: str, column: str, touched: Iterable[str | None]) -> None:
    """Put the rows ``df``, which may be made from the table itself, in the place of its partitions ``touched``.

    They are written once, to a staging folder beside the table, whose partitions then take
    their places by renaming, one after the other.  ``df`` has rows of these partitions only.
    """
    spark, staged = df.sparkSession, _staging(path, "partitions")
    with layouts.evolved(df, path, [column]) as rows:
        _rebalanced(rows, [column]).write.partitionBy(column).parquet(staged)
    for folder in (f"{column}={_NULL_FOLDER if v is None else v}" for v in touched):
        layouts.move(spark, f"{staged}/{folder}", f"{path.rstrip('/')}/{folder}")
    remove(spark, [staged])


def _staging(path: str, name: str) -> str:
    """A fresh folder beside the table, on the same file system; readers of the parent pass it over."""
    parent, _, table = path.rstrip("/").rpartition("/")
    return f"{parent}/_staging-{table}-{name}-{uuid.uuid4().hex[:12]}"


def _values(df: DataFrame, column: str) -> set[str | None]:
    """The distinct months or dates of a frame: as many as there are partitions."""
    return {None if r[0] is None else str(r[0]) for r in df.select(column).distinct().collect()}


def replace_period(df: DataFrame, path: str, period: str, mode: str = "partition") -> None:
    """Replace one period column's partitions: those present, or the whole range they span.

    ``mode="range"`` also removes stored periods between the first and last new one that
    the new data lacks.  Rows without a period are a partition of their own and no part
    of the range.
    """
    if mode not in ("partition", "range"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, stale = df.sparkSession, set()
    if mode == "range":
        low, high = df.agg(F.min(period), F.max(period)).first()
        if low is not None:
            spanned = read_table(spark, path, df).filter(F.col(period).between(F.lit(low), F.lit(high)))
            stale = _values(spanned, period) - _values(df, period)
        elif df.limit(1).count() == 0:
            return
    replace_partitions(df, path, [period])
    _drop_partitions(spark, path, period, stale)


def replace_sheets(df: DataFrame, path: str) -> None:
    """Replace all rows of the sheets that occur in ``df``."""
    replace_partitions(df, path, ["source_sheet_id"])


# --- events -----------------------------------------------------------------


def with_month(events: DataFrame) -> DataFrame:
    return events.withColumn(MONTH, tm.month_text(F.col("event_date")))


def insert_or_ignore(target: DataFrame, batch: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """Rows of ``batch`` to add: the first per event id, and none that ``target`` has.

    Rows without an event id are all added.
    """
    keyed = batch.filter(F.col("event_id").isNotNull())
    new = first_per_key(keyed, ["event_id"], order)
    # Looked up from the batch's side: a small batch is broadcast and the table only scanned.
    known = target.select("event_id").join(new.select("event_id"), "event_id", "left_semi").distinct()
    return (new.join(known, "event_id", "left_anti").select(batch.columns)
            .unionByName(batch.filter(F.col("event_id").isNull())))


def merged(target: DataFrame, batch: DataFrame, order: Sequence[Column] = (), unique: bool = False) -> DataFrame:
    """``target`` with the rows of ``batch`` put in by event id; the last of a batch wins.

    All old rows with a matching id are replaced by the one new row.  Batch rows without
    an id are left out.  ``unique`` promises that the batch has an id once at most.
    """
    new = batch.filter(F.col("event_id").isNotNull())
    if not unique:
        new = last_per_key(new, ["event_id"], order or [F.col("event_date")])
    kept = target.join(new.select("event_id"), "event_id", "left_anti")  # ids are all but unique
    return kept.select(target.columns).unionByName(new.select(target.columns))


def upsert_events(batch: DataFrame, path: str, order: Sequence[Column] = (),
                  since_month: str | None = None, indexed: bool = False) -> None:
    """Merge a batch into the event table, rewriting only the months whose stored rows change.

    Rows that the table has as they are, once each, are left alone, and rows that replace
    nothing are added to months that need not be rewritten.  Rows without a time are a month
    of their own.  Running the same batch again gives the same table.  Columns that only the
    table has are kept, and NULL in new rows.

    Finding the old rows reads the whole table, unless ``since_month`` promises that no
    older month holds any, or the table is ``indexed``: then the index beside it
    (``event_index``), made on the first call and kept up here, names the months to read.
    """
    spark = batch.sparkSession
    events = schemas.conform(batch, schemas.USER_EVENTS)
    new_path, met_path, changed_path = (_staging(path, name) for name in ("batch", "met", "changed"))
    latest = with_month(last_per_key(events.filter(F.col("event_id").isNotNull()), ["event_id"], order or [F.col("event_date")]))
    stored = layouts.noted(spark, path)
    if stored is not None:
        latest = layouts.cast_to(latest, layouts.common_layout(latest.schema, stored))
    latest.write.parquet(new_path)
    new = spark.read.schema(latest.schema).parquet(new_path)
    target = read_table(spark, path, new)
    if since_month is not None:
        target = target.filter((F.col(MONTH) >= since_month) | F.col(MONTH).isNull())
    if indexed:
        event_index.update(spark, path)
        target = target.filter(_in_months(event_index.months_of(new, path)))
    # Only ids and marks of the stored rows are shuffled.  A table that must become wider is written in any case.
    settled = stored is not None and all(f.name in stored.names and f.dataType == stored[f.name].dataType for f in new.schema.fields)
    marked = _marked(target).join(_marked(new).select("event_id", F.col("_mark").alias("_new")), "event_id")
    marked.select("event_id", MONTH, (F.lit(settled) & (F.col("_mark") == F.col("_new"))).alias("same")).write.parquet(met_path)
    met = spark.read.schema(f"event_id string, {MONTH} string, same boolean").parquet(met_path)
    # Months are few; the event rows themselves stay on the executors.
    changed, stale = new, set()
    if not met.isEmpty():
        there = met.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"), F.min("same").alias("_same")).filter("_n = 1 AND _same").select("event_id")
        new.join(there, "event_id", "left_anti").select(new.columns).write.parquet(changed_path)
        changed, stale = spark.read.schema(new.schema).parquet(changed_path), _values(met.join(there, "event_id", "left_anti"), MONTH)
    added = changed.filter(~_in_months(stale))
    if _values(added, MONTH):
        append(added, path, [MONTH])
    if stale:
        rows = read_table(spark, path, new).filter(_in_months(stale)).select(new.columns)
        swap_partitions(merged(rows, changed, unique=True).filter(_in_months(stale)), path, MONTH, stale)
    if indexed:
        event_index.update(spark, path, changed)
    remove(spark, [new_path, met_path, changed_path])


def _in_months(months: Iterable[str | None]) -> Column:
    named = F.col(MONTH).isNotNull() & F.col(MONTH).isin([m for m in months if m is not None])
    return named | F.col(MONTH).isNull() if None in months else named


def _marked(events: DataFrame) -> DataFrame:
    """(event_id, event_month) with a 128-bit mark of all values; columns that are no event's own count as NULL or not."""
    own = [F.col(c) for c in [*schemas.USER_EVENTS.names, MONTH]]
    flags = [F.col(f"`{c}`").isNull() for c in events.columns]
    marks = [F.xxhash64(F.lit(seed), *own, *flags) for seed in (1, 2)]
    return events.select("event_id", MONTH, F.struct(*marks).alias("_mark"))


# --- stored reports ---------------------------------------------------------


def store_reactivations(events: DataFrame, path: str, min_gap_days: float = 7) -> None:
    """All reactivations as a table partitioned by month; run again to refresh."""
    rows = gaps(events, min_gap_days).withColumn("month", tm.month_text(F.col("first_deposit")))
    _rebalanced(rows, ["month"]).write.mode("overwrite").partitionBy("month").parquet(path)


def store_report(report: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Any report, such as cohort ARPPU or split-test groups, as a table."""
    _rebalanced(report, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def roll_up_spend(daily: DataFrame, path: str) -> None:
    """Daily spend summed per month, replacing the months it covers."""
    replace_period(monthly_from_daily(daily), path, "month")


def copy_table(source: DataFrame, path: str) -> DataFrame:
    """Copy an event table to Parquet by month and return the copy."""
    _rebalanced(with_month(source), [MONTH]).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return source.sparkSession.read.parquet(path)


def copied_ranges(spark: SparkSession, path: str) -> dict[str | None, tuple[int, int]]:
    """The months that :func:`copy_ranges` has finished, with their number of rows and a sum over them."""
    try:
        rows = spark.read.schema(f"{MONTH} string, n bigint, total bigint, at timestamp").parquet(f"{path.rstrip('/')}-ranges").orderBy("at").collect()
    except AnalysisException:
        return {}
    return {r[MONTH]: (r["n"], r["total"]) for r in rows}  # the latest of a month counts


def copy_ranges(source: DataFrame, path: str, at_once: int = 12, most: int | None = None) -> list[str | None]:
    """Copy an event table month by month, and go on where an earlier run ended; returns the months copied now.

    Some months ``at_once`` are read by their time range, dealt by time, and written over what
    a broken run may have left of them; then they are entered in a list beside the copy with
    their rows and a sum over all their values.  A month counts as copied if the source
    still has the same.  ``most`` ends the run after so many months.
    """
    spark = source.sparkSession
    rows = with_month(source)
    every = [F.col(f"`{c}`") for c in source.columns]
    mark = F.sum(F.pmod(F.xxhash64(*every, *[F.isnull(c) for c in every]), F.lit(1 << 31))).alias("total")
    figures = lambda df: {r[MONTH]: (r["n"], r["total"]) for r in df.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), mark).collect()}
    there, done = figures(rows), copied_ranges(spark, path)
    open_ = sorted((m for m in there if done.get(m) != there[m]), key=lambda m: (m is None, m or ""))
    open_ = open_ if most is None else open_[:most]
    for i in range(0, len(open_), at_once):
        some = open_[i:i + at_once]
        named = [m for m in some if m is not None]
        inside = F.col("event_date").isNull() if None in some else F.lit(False)
        if named:  # a range of the time itself reaches the source
            span = (F.col("event_date") >= F.lit(f"{named[0]}-01").cast("timestamp")) & (
                F.col("event_date") < F.add_months(F.lit(f"{named[-1]}-01").cast("date"), 1).cast("timestamp"))
            inside = inside | (span & F.col(MONTH).isin(named))
        (rows.filter(inside).repartitionByRange(MONTH, "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(MONTH).parquet(path))
        written = figures(spark.read.schema(rows.schema).parquet(path).filter(F.col(MONTH).isin(named) | (F.col(MONTH).isNull() if None in some else F.lit(False))))
        wrong = [m for m in some if written.get(m) != there[m]]
        if wrong:
            raise ValueError(f"the copy of {wrong} differs from its source; run again")
        entries = spark.createDataFrame([(m, *there[m]) for m in some], f"{MONTH} string, n bigint, total bigint")
        entries.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}-ranges")
    return open_

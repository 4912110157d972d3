"""An index of an event table: in which months an event id may be stored.

It holds a 64-bit hash and a month for every id, in folders by a part of the hash.  An upsert
reads only the folders its own ids fall into, and then only the months they name; a hash
that two ids share, or a month an id has left, costs a month read in vain and nothing
else.  The index knows from which files of a month it was made and takes up months whose
files are others by itself, so tables written by any other means stay right.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import remove
from . import layouts

MONTH, PART = "event_month", "part"
PARTS = 32
_SHAPE = f"mark bigint, {MONTH} string, {PART} int"
# Fixed value: the month folder of events without a time.
_NO_MONTH = "none"


def _mark(event_id: Column) -> Column:
    return F.xxhash64(event_id)


def _dealt(df: DataFrame) -> DataFrame:
    """(mark, part) of the ids in ``df``."""
    marked = df.filter(F.col("event_id").isNotNull()).select(*[c for c in df.columns if c != "event_id"], _mark(F.col("event_id")).alias("mark"))
    return marked.withColumn(PART, F.pmod("mark", F.lit(PARTS)).cast("int"))


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}-index"


def _made_from(spark: SparkSession, path: str) -> DataFrame:
    """(event_month, state) by the files of each month; only footers are read."""
    rows = spark.read.schema(f"event_id string, {MONTH} string").parquet(path)
    files = rows.groupBy(F.coalesce(MONTH, F.lit(_NO_MONTH)).alias(MONTH), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_modification_time").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(MONTH).agg(F.sum(F.xxhash64("file", "at", "n").cast("decimal(20,0)")).cast("string").alias("state"))


def _states(spark: SparkSession, path: str) -> dict[str, str]:
    """What the index was made from: as many entries as there are months."""
    try:
        return {r[MONTH]: r["state"] for r in spark.read.schema(f"{MONTH} string, state string").parquet(f"{index_path(path)}-states").collect()}
    except AnalysisException:
        return {}


def _add(rows: DataFrame, path: str) -> None:
    marks = _dealt(rows.select("event_id", F.coalesce(MONTH, F.lit(_NO_MONTH)).alias(MONTH)))
    (marks.select("mark", MONTH, PART).hint("rebalance", PART).sortWithinPartitions(PART, "mark")
     .write.mode("append").partitionBy(PART).parquet(index_path(path)))


def _note(spark: SparkSession, path: str, now: dict[str, str]) -> None:
    states = f"{index_path(path)}-states"
    spark.createDataFrame(sorted(now.items()), f"{MONTH} string, state string").coalesce(1).write.mode("overwrite").parquet(f"{states}.new")
    layouts.swap(spark, f"{states}.new", states)


def update(spark: SparkSession, path: str, written: DataFrame | None = None) -> set[str]:
    """Take up the months whose files are not those the index was made from; returns them.

    ``written`` are the only new rows since the last call; then they alone are added.
    """
    try:
        now = {r[MONTH]: r["state"] for r in _made_from(spark, path).collect()}
    except AnalysisException:
        return set()
    then = _states(spark, path)
    stale = {m for m, state in now.items() if then.get(m) != state}
    if stale:
        rows = written
        if rows is None:
            rows = spark.read.schema(f"event_id string, {MONTH} string").parquet(path)
            named = [m for m in stale if m != _NO_MONTH]
            rows = rows.filter(F.col(MONTH).isin(named) | (F.col(MONTH).isNull() if _NO_MONTH in stale else F.lit(False)))
        _add(rows, path)
    if now != then:
        _note(spark, path, now)
    return stale


def rebuild(spark: SparkSession, path: str) -> None:
    """Make the index anew, without the months that ids have left."""
    remove(spark, [index_path(path), f"{index_path(path)}-states"])
    update(spark, path)


def lookup(new: DataFrame, path: str) -> DataFrame:
    """(event_month) that hold ids of ``new``, from the folders these ids fall into."""
    spark = new.sparkSession
    wanted = _dealt(new.select("event_id")).distinct()
    parts = [r[PART] for r in wanted.select(PART).distinct().collect()]  # PARTS at most
    index = spark.read.schema(_SHAPE).parquet(index_path(path)).filter(F.col(PART).isin(parts))
    found = index.join(wanted, [PART, "mark"], "left_semi").select(MONTH).distinct()
    return found.select(F.nullif(F.col(MONTH), F.lit(_NO_MONTH)).alias(MONTH))


def months_of(new: DataFrame, path: str) -> set[str | None]:
    """The months in which ids of ``new`` may be stored."""
    try:
        return {r[MONTH] for r in lookup(new, path).collect()}
    except AnalysisException:
        return set()

"""Layouts of stored tables that change: types are widened without loss, new columns are kept.

A table's layout lies beside its files as ``_layout``, which readers of the folder pass
over, so that neither reading nor writing has to open every file to know it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import remove

_NAME = "_layout"
# Whole types by their digits.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point that a whole or decimal type holds."""
    if kind in _WHOLE:
        return _WHOLE[kind], 0
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else None


def common_type(one: T.DataType, two: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both as it is; text, if no other does."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if one in _WHOLE and two in _WHOLE:
        return max(one, two, key=_WHOLE.get)
    if (a := _digits(one)) and (b := _digits(two)):
        before, behind = max(a[0], b[0]), max(a[1], b[1])
        return T.DecimalType(before + behind, behind) if before + behind <= 38 else T.StringType()
    floats = (T.FloatType(), T.DoubleType())
    if {one, two} <= {*floats, *list(_WHOLE)[:3]} and (one in floats or two in floats):
        return T.DoubleType()
    if {one, two} == {T.DateType(), T.TimestampType()}:
        return T.TimestampType()
    if {one, two} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def common_layout(stored: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both, those of ``stored`` first, each in its common type."""
    found = {f.name: f.dataType for f in stored.fields}
    for f in new.fields:
        found[f.name] = common_type(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t) for n, t in found.items()])


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_NAME}")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def noted(spark: SparkSession, path: str) -> T.StructType | None:
    """The layout noted beside a table's files, if there is one."""
    files, target = _file(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return T.StructType.fromJson(json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def layout_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The layout of a stored table, that of all its files where none is noted; None before its first write."""
    if known := noted(spark, path):
        return known
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException:
        return None


def note(spark: SparkSession, path: str, layout: T.StructType) -> None:
    files, target = _file(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(layout.json().encode()))
    finally:
        stream.close()


def cast_to(df: DataFrame, layout: T.StructType) -> DataFrame:
    """``df`` in a layout; columns it lacks are NULL."""
    have = set(df.columns)
    return df.select([(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout.fields])


@contextmanager
def evolved(df: DataFrame, path: str, keys: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` in the common layout of itself and the table at ``path``, which is noted there, to be written within the context.

    Where a stored column must become wider, the table is first written anew in the common
    layout beside itself and takes its own place, which costs a copy of the table once per
    change; ``df``, which may come from that very table, is written aside before.
    Partition columns ``keys`` keep the types they have in ``df`` or were noted with.
    """
    spark = df.sparkSession
    stored, known = layout_of(spark, path), noted(spark, path)
    if stored is None:
        layout = common_layout(df.schema, T.StructType([]))
    else:
        if known is None:  # partition values are text that Spark took for something else
            stored = T.StructType([df.schema[f.name] if f.name in keys and f.name in df.columns else f for f in stored.fields])
        layout = common_layout(stored, T.StructType([f for f in df.schema.fields if f.name not in keys or f.name not in stored.names]))
    result, aside = cast_to(df, layout), None
    if stored is not None and any(f.dataType != layout[f.name].dataType for f in stored.fields):
        wider, aside = (f"{path.rstrip('/')}.{name}" for name in ("wider", "aside"))
        result.write.mode("overwrite").parquet(aside)
        result = spark.read.schema(layout).parquet(aside)
        rows = cast_to(spark.read.schema(stored).parquet(path), layout)
        rows.write.mode("overwrite").partitionBy(*keys).parquet(wider)
        note(spark, wider, layout)
        swap(spark, wider, path)
    if known != layout:
        note(spark, path, layout)
    yield result
    if aside is not None:
        remove(spark, [aside])


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` by renaming; a reader sees the one or the other.

    Where it dies between the two renames, the old folder is found at ``path`` with ``.before``.
    """
    place = path.rstrip("/")
    before = f"{place}.before"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files, _ = _file(spark, place)
    if files.exists(hadoop(place)):
        remove(spark, [before])
        _rename(files, hadoop(place), hadoop(before))
    _rename(files, hadoop(new), hadoop(place))
    remove(spark, [before])


def move(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new``, or nothing where there is none, in the place of ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files, _ = _file(spark, path)
    remove(spark, [path])
    if files.exists(hadoop(new)):
        files.mkdirs(hadoop(path).getParent())
        _rename(files, hadoop(new), hadoop(path))


def _rename(files, old, new) -> None:
    if not files.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")

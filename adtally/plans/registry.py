"""Named reports: a Spark plan and, where SQL can say the same, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import configure
from .frames import SQL

Plan = Callable[[SparkSession, str], DataFrame]


class Report(NamedTuple):
    plan: Plan
    sql: str | None


REPORTS: dict[str, Report] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Types that both engines have: decimals to six places as double, small integers as bigint,
    times without zone.  Sorting is left to the reader of the result."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column, 6).cast("double") if field.dataType.scale > 6 else column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(columns)


def report(name: str, sql: str | None = None, uses: str = "") -> Callable[[Plan], Plan]:
    """Register a plan.  ``uses`` names the frames of ``frames.SQL`` that ``sql`` selects from."""

    def register(plan: Plan) -> Plan:
        if name in REPORTS:
            raise ValueError(f"report {name} exists")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _portable(plan(configure(spark), sf_dir))

        text = sql
        if sql is not None:
            frames = [SQL[u] for u in uses.split()]
            body = sql.strip()
            if frames:
                head = "WITH " + ",\n".join(frames)
                text = f"{head},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{head}\n{body}"
        REPORTS[name] = Report(run, text)
        return plan

    return register


def _clean(expression: str, places: int) -> str:
    """A quotient without the last digits, where double noise would decide a tie."""
    return f"CAST({expression} AS DECIMAL(38,{min(places + 6, 10)}))"


def dec(expression: str, places: int = 6) -> str:
    """SQL for a fraction rounded half up to ``places``, as a double."""
    return f"CAST(round({_clean(expression, places)}, {places}) AS DOUBLE)"


def even(expression: str, places: int) -> str:
    """SQL for a fraction rounded half to even, as a double."""
    return f"CAST(round_even({_clean(expression, places)}, {places}) AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"

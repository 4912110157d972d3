"""Estimates that merge: distinct counts and quantiles over any period from stored sketches.

A sketch per day and group is small and of bounded size; sketches of any days and
groups add up without the rows they came from.  The exact operators remain the
default; these are for totals over periods that are asked for again and again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SKETCH = "sketch"


def distinct_sketches(rows: DataFrame, keys: Sequence[Column | str], value: str, precision: int = 12) -> DataFrame:
    """A sketch of the distinct non-null values of each group, of 2^precision registers: one standard error is 1.04 / sqrt(2^precision), 1.6 % for 12."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), precision).alias(SKETCH))


def distinct_estimate(sketches: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """The number of distinct values per group of any coarser ``keys``."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("distinct_values"))


def quantile_sketches(rows: DataFrame, keys: Sequence[Column | str], value: str, size: int = 400) -> DataFrame:
    """A sketch of the non-null values of each group; the rank of a quantile is off by about 1.7 / size, 0.4 % for 400 (normalised, at 99 % confidence)."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias(SKETCH))


def quantile_estimate(sketches: DataFrame, keys: Sequence[Column | str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The number of values and some quantiles per group of any coarser ``keys``, as columns n_values and p25, p50 ..."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))
    names = [c for c in whole.columns if c != SKETCH]
    of = lambda q: F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(q))).alias(f"p{round(100 * q):02d}")
    return whole.select(*names, F.kll_sketch_get_n_double(SKETCH).alias("n_values"), *[of(q) for q in quantiles])

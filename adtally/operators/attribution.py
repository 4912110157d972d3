"""Brand backfill and re-classification of ad formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric as num, text, time as tm
from .common import last_per_key, salted_join

BRAND, TS = "advertiser", "event_date"
WebsitePatterns = Sequence[tuple[str, Sequence[str]]]


def _fill(events: DataFrame, value: Column) -> DataFrame:
    """Give ``value`` to the events that have no brand yet."""
    return events.withColumn(BRAND, F.coalesce(F.col(BRAND), value))


def fill_before(events: DataFrame, cut_off: tm.Day, brand: str) -> DataFrame:
    """Every event before a date without a brand gets ``brand``."""
    return _fill(events, F.when(~tm.at_or_after(F.col(TS), cut_off), brand))


def fill_from_website(events: DataFrame, websites: WebsitePatterns, default: str,
                      since: tm.Day | None = None) -> DataFrame:
    """Events since a date without a brand get one from the website, else the default."""
    found = F.coalesce(text.brand_from_website(F.col("website"), websites, None), F.lit(default))
    return _fill(events, F.when(tm.within(F.col(TS), since, None), found))


def brand_mapping(rows: DataFrame, link: str, brand: str, date: str | None = None,
                  spellings: Sequence[str] = ()) -> DataFrame:
    """A clean mapping frame: (link, [day,] brand), one row per link, complete rows only."""
    label = text.canonical_label(F.col(brand).cast("string"), spellings)
    day = [] if date is None else [F.to_date(F.col(date).try_cast("timestamp")).alias("day")]
    clean = (rows.dropna(subset=[link, brand])
             .select(F.col(link).cast("string").alias("link"), *day, label.alias("brand")))
    keys = ["link"] if date is None else ["link", "day"]
    return last_per_key(clean.dropna(subset=keys), keys, [])


def fill_from_mapping(events: DataFrame, mapping: DataFrame, link: str = "event_id",
                      replace: bool = True, start: tm.Day | None = None, end: tm.Day | None = None,
                      end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Brand from a mapping by event, user or network id, optionally also by day.

    ``replace`` overwrites a brand already set; without it only gaps are filled.  The
    mapping has one row per key, so events never multiply, and a user with very many
    events is spread over several tasks.
    """
    by_day = "day" in mapping.columns
    keyed = mapping.select(
        F.col("link").alias(link), *([F.col("day").alias("_day")] if by_day else []), F.col("brand").alias("_brand"))
    rows = events.withColumn("_day", F.to_date(TS)) if by_day else events
    keys = [link] + (["_day"] if by_day else [])
    # Event ids are all but unique; a user or network may hold a large share of the rows.
    joined = rows.join(keyed, keys, "left") if link == "event_id" else salted_join(rows, keyed, keys)
    usable = F.when(tm.within(F.col(TS), start, end, end_bound), F.col("_brand"))
    first, second = (usable, F.col(BRAND)) if replace else (F.col(BRAND), usable)
    return joined.withColumn(BRAND, F.coalesce(first, second)).select(events.columns)


def reclassify_formats(spend: DataFrame, rules: str = "current") -> DataFrame:
    """Spend with formats recomputed from the publisher name, where there is one."""
    return spend.withColumn("format", F.when(
        F.col("publisher_name").isNotNull(), text.ad_format(F.col("publisher_name"), rules)).otherwise(F.col("format")))


def format_changes(spend: DataFrame, rules: str = "current") -> DataFrame:
    """Publishers whose stored format differs from the recomputed one; no format differs from any."""
    named = spend.filter(F.col("publisher_name").isNotNull()).select(
        "publisher_id", "publisher_name", F.col("format").alias("old_format")).distinct()
    return (named.withColumn("new_format", text.ad_format(F.col("publisher_name"), rules))
            .filter(~F.col("old_format").eqNullSafe(F.col("new_format"))).orderBy("publisher_id"))


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """Daily spend of paid publishers summed per month; no deposits gives a cost of 0."""
    sums = daily.filter(F.col("publisher_id") != 0).groupBy(
        "publisher_id", "publisher_name", "format", F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.sum("deposits_reported").alias("deposits_reported"), F.sum("spend").cast("decimal(15,2)").alias("spend"))
    cost = num.half_up(num.ratio_or_zero(F.col("spend"), F.col("deposits_reported")), 3)
    return sums.withColumn("current_cpa", cost.cast("decimal(10,3)"))

"""Data-quality checks on events, brands, sheets and spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import time as tm
from .common import paid_only

USER, TS = "external_user_id", "event_date"


def _range() -> list[Column]:
    return [F.to_date(F.min("_from")).alias("min_date"), F.to_date(F.max("_to")).alias("max_date"),
            F.sum("_n").alias("total_events"), F.countDistinct(USER).alias("unique_users")]


def _reduced(events: DataFrame, *keys) -> DataFrame:
    """Events per user and key; distinct counts then run on these few rows."""
    return events.groupBy(USER, *keys).agg(
        F.min(TS).alias("_from"), F.max(TS).alias("_to"), F.count(F.lit(1)).alias("_n"))


def overview(events: DataFrame) -> DataFrame:
    """Date range, events, users and days overall."""
    per_day = _reduced(events, F.to_date(TS).alias("_day"))
    return per_day.agg(*_range(), F.countDistinct("_day").alias("unique_days")).select(
        F.lit("overall").alias("info_type"), "*")


def by_type(events: DataFrame) -> DataFrame:
    """Date range, events and users per event type."""
    return (_reduced(events, "event_type").groupBy("event_type").agg(*_range())
            .select(F.lit("by_type").alias("info_type"), "*").orderBy("event_type"))


def by_month(events: DataFrame) -> DataFrame:
    """Events and users per month, newest first."""
    month = tm.period_start(F.col(TS), "month").alias("month")
    return (_reduced(events, month).groupBy("month").agg(*_range()[2:])
            .select(F.lit("by_month").alias("info_type"), "*").orderBy(F.desc("month")))


def monthly_brand_coverage(events: DataFrame, months: int | None = 12) -> DataFrame:
    """Events with and without a brand per month, for the newest ``months``."""
    rows = events.groupBy(tm.month_text(F.col(TS)).alias("month")).agg(
        F.count(F.lit(1)).alias("records"), F.count("advertiser").alias("with_advertiser"),
        F.count_if(F.col("advertiser").isNull()).alias("without_advertiser")).orderBy(F.desc("month"))
    return rows if months is None else rows.limit(months)


def brand_coverage(events: DataFrame, brands: Sequence[str], start: tm.Day | None = None,
                   end: tm.Day | None = None, end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Events in all, of each brand, and without one, in a date range."""
    brand = F.col("advertiser")
    return events.filter(tm.within(F.col(TS), start, end, end_bound)).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(brand == b).alias(b) for b in brands],
        F.count_if(brand.isNull()).alias("without_advertiser"))


def brand_gaps(events: DataFrame, cut_off: tm.Day) -> DataFrame:
    """Events still without a brand before and from a date on."""
    missing, before = F.col("advertiser").isNull(), ~tm.at_or_after(F.col(TS), cut_off)
    return events.agg(
        F.count(F.lit(1)).alias("total"), F.count("advertiser").alias("with_advertiser"),
        F.count_if(missing).alias("without_advertiser"),
        F.count_if(missing & before).alias("to_update_before"),
        F.count_if(missing & ~before).alias("to_update_after"))


def brand_counts(events: DataFrame) -> DataFrame:
    """Events and date range per known brand."""
    return (events.filter(F.col("advertiser").isNotNull()).groupBy("advertiser")
            .agg(F.count(F.lit(1)).alias("events"), F.min(TS).alias("min_date"), F.max(TS).alias("max_date"))
            .orderBy(F.desc("events")))


# --- sheets -----------------------------------------------------------------


def sheet_overview(campaigns: DataFrame) -> DataFrame:
    """Rows, sheets, attribution types and load times."""
    per_sheet = campaigns.groupBy("source_sheet_id", "attribution_type").agg(
        F.count(F.lit(1)).alias("_n"), F.min("loaded_at").alias("_a"), F.max("loaded_at").alias("_b"))
    return per_sheet.agg(
        F.sum("_n").alias("total_rows"), F.countDistinct("source_sheet_id").alias("unique_sheets"),
        F.countDistinct("attribution_type").alias("attribution_types"),
        F.min("_a").alias("first_load"), F.max("_b").alias("last_load"))


def sheet_ranges(campaigns: DataFrame) -> DataFrame:
    """Rows and date range per sheet and attribution."""
    return (campaigns.filter(F.col(TS).isNotNull()).groupBy("source_sheet_id", "attribution_type")
            .agg(F.count(F.lit(1)).alias("records"), F.min(TS).alias("min_date"), F.max(TS).alias("max_date"))
            .orderBy("source_sheet_id", "attribution_type"))


def sheet_days(campaigns: DataFrame) -> DataFrame:
    """Rows, sheets and attribution types per day."""
    day = F.to_date(TS).alias("date")
    per_sheet = campaigns.filter(F.col(TS).isNotNull()).groupBy(
        day, "source_sheet_id", "attribution_type").agg(F.count(F.lit(1)).alias("_n"))
    return per_sheet.groupBy("date").agg(
        F.sum("_n").alias("records"), F.countDistinct("source_sheet_id").alias("sheets"),
        F.countDistinct("attribution_type").alias("attr_types")).orderBy("date")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, all of them non-NULL, that occur more than once."""
    return (df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1).orderBy(F.desc("cnt"), *keys))


def missing_dates(df: DataFrame, ts: str = TS) -> DataFrame:
    """Days between the first and last one that have no row."""
    days = df.select(F.to_date(ts).alias("date")).filter(F.col("date").isNotNull()).distinct()
    span = days.agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    calendar = span.select(F.explode(F.expr("sequence(_a, _b, interval 1 day)")).alias("date"))
    return calendar.join(days, "date", "left_anti").orderBy("date")


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys only one or both of two frames have."""
    tag = lambda df, a, b: df.select(F.col(key).cast("string").alias("_key"), F.lit(a).alias("_l"), F.lit(b).alias("_r"))
    keys = (tag(left, 1, 0).unionAll(tag(right, 0, 1)).filter(F.col("_key").isNotNull())
            .groupBy("_key").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r")))
    in_left, in_right = F.col("_l") == 1, F.col("_r") == 1
    return keys.agg(F.count_if(in_left).alias("left_keys"), F.count_if(in_right).alias("right_keys"),
                    F.count_if(in_left & in_right).alias("matching_keys"))


# --- spend ------------------------------------------------------------------


def _linked(spend: DataFrame, events: DataFrame) -> DataFrame:
    """Branded events per publisher, month and brand that have a spend row.

    Events are counted per key before the join.
    """
    counts = (paid_only(events).filter(F.col("advertiser").isNotNull())
              .groupBy("publisher_id", tm.month_text(F.col(TS)).alias("month"), "advertiser")
              .agg(F.count(F.lit(1)).alias("_n")))
    return paid_only(spend).select("publisher_id", "month").join(counts, ["publisher_id", "month"])


def link_coverage(spend: DataFrame, events: DataFrame) -> DataFrame:
    """Publishers, months and brands for which spend meets events."""
    return _linked(spend, events).agg(
        F.countDistinct("publisher_id").alias("publishers"), F.countDistinct("month").alias("months"),
        F.countDistinct("advertiser").alias("advertisers"))


def link_by_brand(spend: DataFrame, events: DataFrame) -> DataFrame:
    """Publishers and events linked to spend, per brand."""
    return (_linked(spend, events).groupBy("advertiser")
            .agg(F.countDistinct("publisher_id").alias("publishers"), F.sum("_n").alias("events"))
            .orderBy(F.desc("events")))


def spend_load_summary(daily: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows, days, publishers, date range and spend of loaded daily rows."""
    rows = daily
    if start is not None:
        rows = rows.filter(F.col("date") >= start)
    if end is not None:
        rows = rows.filter(F.col("date") <= end)
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"), F.countDistinct("date").alias("days"),
        F.countDistinct("publisher_id").alias("publishers"), F.min("date").alias("min_date"),
        F.max("date").alias("max_date"), F.sum("spend").alias("total_spend"))


def spend_by_month(monthly: DataFrame) -> DataFrame:
    """Publishers, spend and deposits per month."""
    return monthly.groupBy("month").agg(
        F.countDistinct("publisher_id").alias("publishers"), F.sum("spend").alias("total_spend"),
        F.sum("deposits_reported").alias("total_deposits")).orderBy("month")


def reconcile(source: DataFrame, target: DataFrame, ts: str = TS) -> DataFrame:
    """Row counts and date ranges of a copy and its source, and whether they agree."""
    side = lambda df, name: df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_date"), F.max(ts).alias("max_date")
    ).select(F.lit(name).alias("side"), "*")
    both = side(source, "source").unionAll(side(target, "target"))
    spread = lambda c: F.min_by(c, "side").eqNullSafe(F.max_by(c, "side"))
    return both.agg(
        F.min_by("rows", "side").alias("source_rows"), F.max_by("rows", "side").alias("target_rows"),
        F.min_by("min_date", "side").alias("min_date"), F.min_by("max_date", "side").alias("max_date"),
        (spread("rows") & spread("min_date") & spread("max_date")).alias("matches"))

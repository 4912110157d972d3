"""Average revenue per paying user: trend, by attribute, and by first-deposit cohort."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric as num, time as tm
from ..functions.rules import first_match
from ..functions.text import brand_from_website, format_from_sub_id
from .common import most_frequent, paid_only, paying_deposits, salted_join

USER, TS = "external_user_id", "event_date"
UNKNOWN = "Unknown"
WebsitePatterns = Sequence[tuple[str, Sequence[str]]]


def trend(events: DataFrame, brand: str, grain: str = "day") -> DataFrame:
    """ARPPU of one brand per day, week or month."""
    users = F.countDistinct(USER)
    return (
        paying_deposits(events).filter(F.col("advertiser") == brand)
        .groupBy(tm.period_start(F.col(TS), grain).alias("period_start"))
        .agg(num.half_up(num.ratio_or_zero(F.sum("converted_amount"), users), 2).alias("arppu_usd"))
        .orderBy("period_start")
    )


def brand_of(websites: WebsitePatterns) -> Column:
    """The event's brand, else one read from the website, else Unknown."""
    return F.coalesce(F.col("advertiser"), brand_from_website(F.col("website"), websites, UNKNOWN))


def publisher_format(spend: DataFrame) -> DataFrame:
    """The most frequent spend format of each paid publisher."""
    return most_frequent(paid_only(spend), ["publisher_id"], "format")


# Label of each breakdown and the column it splits by.
BREAKDOWNS = [("Publisher", "publisher_id"), ("Format", "format"), ("Campaign", "campaign_id"),
              ("Site", "website"), ("Region", "country")]
ALL_USERS = "All users"


def by_attributes(events: DataFrame, spend: DataFrame, websites: WebsitePatterns = (),
                  start: tm.Day | None = None, end: tm.Day | None = None) -> DataFrame:
    """ARPPU per brand, split by publisher, format, campaign, site, region, and not at all.

    Deposits are first reduced per user and attributes; only the reduced rows are joined
    with the formats and expanded into the six grouping sets.  Each split drops the
    groups without a value (publisher and campaign 0 included) afterwards.
    """
    attributes = ["publisher_id", "campaign_id", "website", "country"]
    per_user = (
        paying_deposits(events).filter(tm.within(F.col(TS), start, end))
        .groupBy(USER, brand_of(websites).alias("brand"), *attributes,
                 format_from_sub_id(F.col("sub_id")).alias("_sub_format"))
        .agg(F.min(TS).alias("_from"), F.max(TS).alias("_to"), F.count(F.lit(1)).alias("_n"),
             F.sum("converted_amount").alias("_revenue"))
    )
    formats = publisher_format(spend).withColumnRenamed("format", "_spend_format")
    rows = salted_join(per_user, formats, ["publisher_id"]).withColumn(
        "format", F.coalesce("_spend_format", "_sub_format"))

    splits = [column for _, column in BREAKDOWNS]
    users = F.countDistinct(USER)
    grouped = rows.groupingSets([["brand", s] for s in splits] + [["brand"]], "brand", *splits).agg(
        F.min("_from").alias("min_event_date"), F.max("_to").alias("max_event_date"),
        users.alias("paying_users"), F.sum("_n").alias("total_deposits"), F.sum("_revenue").alias("_sum"),
        *[F.grouping(s).alias(f"_no_{s}") for s in splits])

    in_split = lambda column: F.col(f"_no_{column}") == 0
    label = first_match([(in_split(c), name) for name, c in BREAKDOWNS], ALL_USERS)
    value = first_match(
        [(in_split("format"), F.lit(None).cast("string"))]
        + [(in_split(c), F.col(c).cast("string")) for _, c in BREAKDOWNS if c != "format"], "All")
    kept = F.lit(True)
    for column in splits:
        has_value = F.col(column).isNotNull()
        if column in ("publisher_id", "campaign_id"):
            has_value = has_value & (F.col(column) != 0)
        kept = kept & (~in_split(column) | has_value)
    per = lambda total: num.half_up(num.ratio_or_zero(total, F.col("paying_users")), 2)
    return grouped.filter(kept).select(
        label.alias("breakdown_type"), "brand", value.alias("breakdown_value"), "format", "campaign_id",
        "website", "country", "min_event_date", "max_event_date", "paying_users", "total_deposits",
        num.half_up(F.col("_sum"), 2).alias("total_revenue_usd"), per(F.col("_sum")).alias("arppu_usd"),
        per(F.col("total_deposits")).alias("avg_deposits_per_user"),
    ).orderBy("brand", "breakdown_type", F.desc("arppu_usd"))


def month_before(as_of: tm.Day) -> dt.date:
    """The same day one month earlier, or that month's last day."""
    day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    last_before = day.replace(day=1) - dt.timedelta(days=1)
    return last_before.replace(day=min(day.day, last_before.day))


# Days of a first period.
PERIOD_DAYS = {"week": 7, "month": 30}


def first_windows(events: DataFrame, grain: str = "week", window_days: int | None = None) -> DataFrame:
    """Per user: first_deposit, and the deposits and revenue within the days from there on.

    A user's first days touch at most two time slots of that width, so the deposits are
    joined on (user, slot) and then compared exactly: the history of a very active user is
    cut into slots instead of landing in one task, and later slots match nothing.
    """
    days = window_days or PERIOD_DAYS[grain]
    rows = paying_deposits(events).select(USER, TS, "converted_amount")
    slot = lambda ts: tm.slot_number(ts, days)
    firsts = rows.groupBy(USER).agg(F.min(TS).alias("first_deposit"))
    windows = firsts.withColumn("_slot", F.explode(F.array(slot(F.col("first_deposit")), slot(F.col("first_deposit")) + 1)))
    inside = (rows.withColumn("_slot", slot(F.col(TS))).join(windows, [USER, "_slot"])
              .filter(F.col(TS) < F.col("first_deposit") + F.expr(f"INTERVAL '{days}' DAY")))
    return inside.groupBy(USER, "first_deposit").agg(F.count(F.lit(1)).alias("deposits"), F.sum("converted_amount").cast("decimal(28,4)").alias("revenue"))


def cohort_report(windows: DataFrame, as_of: tm.Day, grain: str = "week", exclude_cohorts: Sequence[tm.Day] = ()) -> DataFrame:
    """:func:`first_period` from the rows of :func:`first_windows`."""
    users = (windows.filter(F.col("first_deposit") <= tm.instant(month_before(as_of)))
             .withColumn("cohort_start", tm.period_start(F.col("first_deposit"), grain)))
    if exclude_cohorts:
        users = users.filter(~F.col("cohort_start").isin([tm._as_date(d) for d in exclude_cohorts]))
    sums = users.groupBy("cohort_start").agg(F.count(F.lit(1)).alias("users_count"), F.sum("deposits").alias("total_deposits"),
                                             F.sum("revenue").cast("decimal(38,4)").alias("total_revenue"))
    per = lambda total: num.ratio_or_zero(F.col(total), F.col("users_count"))
    return sums.withColumns({"arppu": per("total_revenue"), "avg_deposits": per("total_deposits")}).orderBy("cohort_start")


def first_period(events: DataFrame, as_of: tm.Day, grain: str = "week", window_days: int | None = None,
                 exclude_cohorts: Sequence[tm.Day] = ()) -> DataFrame:
    """Deposits and revenue in the first week or month of each first-deposit cohort.

    Only users whose first deposit is at least a month old on ``as_of`` count.  A user's
    first ``window_days`` touch at most two time slots of that width, so the deposits are
    joined on (user, slot) and then compared exactly: the history of a very active user
    is cut into slots instead of landing in one task, and later slots match nothing.
    """
    days = window_days or PERIOD_DAYS[grain]
    rows = paying_deposits(events).select(USER, TS, "converted_amount")
    cutoff = month_before(as_of)
    cohort = tm.period_start(F.col("_first"), grain)
    users = (
        rows.groupBy(USER).agg(F.min(TS).alias("_first"))
        .filter(F.col("_first") <= tm.instant(cutoff))
        .withColumn("cohort_start", cohort)
    )
    if exclude_cohorts:
        users = users.filter(~F.col("cohort_start").isin([tm._as_date(d) for d in exclude_cohorts]))
    slot = lambda ts: tm.slot_number(ts, days)
    windows = users.withColumn("_slot", F.explode(F.array(slot(F.col("_first")), slot(F.col("_first")) + 1)))
    # No window reaches further than this, so older and newer files are skipped.
    reach = tm.instant(cutoff + dt.timedelta(days=days))
    inside = (rows.filter(F.col(TS) <= reach).withColumn("_slot", slot(F.col(TS)))
              .join(windows, [USER, "_slot"])
              .filter(F.col(TS) < F.col("_first") + F.expr(f"INTERVAL '{days}' DAY")))
    zero_count, zero_money = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(28,4)")
    revenue = F.sum("converted_amount").cast("decimal(28,4)").alias("revenue")
    counted = users.groupBy("cohort_start").agg(
        F.count(F.lit(1)).alias("users"), zero_count.alias("deposits"), zero_money.alias("revenue"))
    earned = inside.groupBy("cohort_start").agg(
        zero_count.alias("users"), F.count(F.lit(1)).alias("deposits"), revenue)
    sums = counted.unionByName(earned).groupBy("cohort_start").agg(
        F.sum("users").alias("users_count"), F.sum("deposits").alias("total_deposits"),
        F.sum("revenue").alias("total_revenue"))
    per = lambda total: num.ratio_or_zero(F.col(total), F.col("users_count"))
    return sums.withColumns({"arppu": per("total_revenue"), "avg_deposits": per("total_deposits")}
                            ).orderBy("cohort_start")

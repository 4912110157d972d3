"""Further analyses: retention, lifetime value, cohorts, geography, funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import numeric as num, time as tm
from .arppu import UNKNOWN, publisher_format
from .common import DEPOSIT, deposits, paid_only, salted_join
from .ranking import exact_percentile

USER, TS, AMOUNT = "external_user_id", "event_date", "converted_amount"


def retention(events: DataFrame) -> DataFrame:
    """Users who deposited again, by whole days since their first deposit.

    Within one day slot the elapsed days take at most two values, those of the slot's
    first and last deposit, so one row per user and slot is enough.
    """
    per_slot = deposits(events).groupBy(USER, tm.day_number(F.col(TS)).alias("_slot")).agg(
        F.min(TS).alias("_a"), F.max(TS).alias("_b"))
    first = F.min("_a").over(Window.partitionBy(USER))
    since = lambda c: tm.whole_days_between(F.col(c), F.col("_first"))
    days = F.explode(F.array_distinct(F.array(since("_a"), since("_b"))))
    return (
        per_slot.withColumn("_first", first).select(USER, days.alias("days_since_first"))
        .filter(F.col("days_since_first") > 0)
        .groupBy("days_since_first").agg(F.countDistinct(USER).alias("returning_users"))
        .orderBy("days_since_first")
    )


def lifetime_value(events: DataFrame) -> DataFrame:
    """Users, mean revenue, deposits and active days per publisher."""
    per_user = paid_only(deposits(events)).groupBy(USER, "publisher_id").agg(
        F.min(TS).alias("_a"), F.max(TS).alias("_b"), F.count(F.lit(1)).alias("_n"), F.sum(AMOUNT).alias("_sum"))
    span = tm.days_between(F.col("_b"), F.col("_a")).cast("decimal(18,10)")
    users = F.count(F.lit(1))
    return per_user.groupBy("publisher_id").agg(
        users.alias("users"), num.ratio(F.sum("_sum"), F.count("_sum")).alias("avg_ltv"),
        num.ratio(F.sum("_n"), users).alias("avg_deposits_per_user"),
        F.avg(span).alias("avg_lifetime_days")).orderBy(F.desc("avg_ltv"))


def time_to_first_deposit(events: DataFrame) -> DataFrame:
    """Hours from a user's first event to the first deposit, per publisher: mean and median.

    Several deposits at the first instant count each, as they may be at several publishers.
    """
    ts = F.col(TS)
    known = events.filter(F.col(USER).isNotNull())
    per_user = known.groupBy(USER).agg(
        F.min(ts).alias("_seen"), F.min(F.when(F.col("event_type") == DEPOSIT, ts)).alias(TS)
    ).filter(F.col(TS).isNotNull())
    firsts = deposits(events).select(USER, TS, "publisher_id").join(per_user, [USER, TS])
    rows = paid_only(firsts).select(
        "publisher_id", (F.unix_micros(TS) - F.unix_micros("_seen")).alias("_micros"))
    hour = F.lit(3_600_000_000)
    exact = (F.col("_micros").cast("decimal(20,0)") / hour).cast("decimal(18,10)")
    means = rows.groupBy("publisher_id").agg(
        F.count(F.lit(1)).alias("users"), F.avg(exact).alias("avg_hours_to_deposit"))
    median = exact_percentile(rows, ["publisher_id"], "_micros", 0.5, "_median")
    return means.join(median, "publisher_id").select(
        "publisher_id", "users", "avg_hours_to_deposit",
        (F.col("_median") / hour).alias("median_hours_to_deposit")).orderBy("avg_hours_to_deposit")


def deposit_size(events: DataFrame, spend: DataFrame) -> DataFrame:
    """Count, mean, median and range of deposits per publisher, format and brand.

    Each publisher has one format here (its most frequent), so a publisher with many
    spend months does not multiply its deposits.
    """
    none = F.lit("")  # ranks need non-NULL keys
    rows = paid_only(paying_events(events)).select(
        "publisher_id", F.coalesce("advertiser", none).alias("_brand"), AMOUNT)
    units = (F.col(AMOUNT) * 10_000).cast("bigint").alias("_units")
    keys = ["publisher_id", "_brand"]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("deposits_count"), num.ratio(F.sum(AMOUNT), F.count(F.lit(1))).alias("avg_deposit_amount"),
        F.min(AMOUNT).alias("min_deposit"), F.max(AMOUNT).alias("max_deposit"))
    median = exact_percentile(rows.select(*keys, units), keys, "_units", 0.5, "_median")
    return (
        stats.join(median, keys).join(publisher_format(spend), "publisher_id", "left")
        .select("publisher_id", "format", F.nullif("_brand", none).alias("brand"), "deposits_count",
                "avg_deposit_amount", (F.col("_median") / 10_000).alias("median_deposit_amount"),
                "min_deposit", "max_deposit").orderBy(F.desc("avg_deposit_amount")))


def paying_events(events: DataFrame) -> DataFrame:
    """Deposits with a positive amount, also those without a user id."""
    return deposits(events, null_users=True).filter(F.col(AMOUNT) > 0)


def cohort_activity(events: DataFrame) -> DataFrame:
    """Active users, deposits and revenue per first-deposit month and month of activity.

    ``period_number`` counts months since the cohort month and does not wrap at a year.
    """
    month = lambda c: F.trunc(F.to_date(c), "month")
    per_month = deposits(events).groupBy(USER, month(F.col(TS)).alias("activity_month")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(AMOUNT).alias("_sum"))
    cohort = F.min("activity_month").over(Window.partitionBy(USER)).alias("cohort_month")
    distance = F.months_between("activity_month", "cohort_month").cast("int")
    return (
        per_month.select("*", cohort).groupBy("cohort_month", "activity_month")
        .agg(F.count(F.lit(1)).alias("active_users"), F.sum("_n").alias("total_deposits"), F.sum("_sum").alias("total_revenue"))
        .select("cohort_month", "activity_month", distance.alias("period_number"), "active_users", "total_deposits", "total_revenue")
        .orderBy("cohort_month", "activity_month"))


def _revenue_by(rows: DataFrame, keys: Sequence[Column | str], users_name: str, deposits_name: str,
                revenue_name: str) -> DataFrame:
    """Users, deposits, revenue, mean deposit and ARPPU by key, reduced per user first."""
    per_user = rows.groupBy(USER, *keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(AMOUNT).alias("_sum"))
    names = [c for c in per_user.columns if c not in (USER, "_n", "_sum")]
    users, revenue = F.count(USER), F.sum("_sum")  # one row per user and key
    return per_user.groupBy(*names).agg(
        users.alias(users_name), F.sum("_n").alias(deposits_name), revenue.alias(revenue_name),
        num.ratio(revenue, F.sum("_n")).alias("avg_deposit"),
        num.ratio_or_zero(revenue, users).alias("arppu")).orderBy(F.desc(revenue_name))


def by_country(events: DataFrame) -> DataFrame:
    """Users and revenue per country and brand."""
    rows = paying_events(events).filter(F.col("country").isNotNull())
    return _revenue_by(rows, ["country", F.col("advertiser").alias("brand")], "paying_users", "total_deposits", "total_revenue")


def repeat_rate(events: DataFrame) -> DataFrame:
    """Share of users with more than one deposit per publisher."""
    per_user = paid_only(deposits(events)).groupBy(USER, "publisher_id").agg(F.count(F.lit(1)).alias("_n"))
    users, repeat = F.count(F.lit(1)), F.count_if(F.col("_n") > 1)
    return per_user.groupBy("publisher_id").agg(
        users.alias("total_users"), repeat.alias("repeat_users"),
        num.half_up(num.percent(repeat, users), 2).alias("repeat_rate_pct"),
        num.ratio(F.sum("_n"), users).alias("avg_deposits_per_user")).orderBy(F.desc("repeat_rate_pct"))


def weekday_pattern(events: DataFrame) -> DataFrame:
    """Deposits, users and revenue per weekday, Sunday being 0."""
    day = tm.weekday_from_sunday(F.col(TS)).alias("day_of_week")
    per_user = deposits(events, null_users=True).groupBy(day, USER).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(AMOUNT).alias("_sum"))
    # 1970-01-04 was a Sunday.
    name = F.date_format(F.date_add(F.lit("1970-01-04").cast("date"), F.col("day_of_week")), "EEEE")
    return (per_user.groupBy("day_of_week")
            .agg(F.sum("_n").alias("deposits"), F.count(USER).alias("users"), F.sum("_sum").alias("revenue"))
            .select("day_of_week", name.alias("day_name"), "deposits", "users", "revenue").orderBy("day_of_week"))


def by_format(events: DataFrame, spend: DataFrame) -> DataFrame:
    """Users and revenue per ad format and brand, with one format per publisher."""
    reduced = paying_events(events).groupBy(USER, "publisher_id", F.col("advertiser").alias("brand")).agg(
        F.count(F.lit(1)).alias("_k"), F.sum(AMOUNT).alias("_v"))
    formats = publisher_format(spend).filter(F.col("format").isNotNull())
    per_user = salted_join(reduced, formats, ["publisher_id"], "inner").groupBy(USER, "format", "brand").agg(
        F.sum("_k").alias("_n"), F.sum("_v").alias("_sum"))
    users, revenue = F.count(USER), F.sum("_sum")
    return per_user.groupBy("format", "brand").agg(
        users.alias("users"), F.sum("_n").alias("deposits"), revenue.alias("revenue"),
        num.ratio(revenue, F.sum("_n")).alias("avg_deposit"),
        num.ratio_or_zero(revenue, users).alias("arppu")).orderBy(F.desc("revenue"))


def by_brand(events: DataFrame) -> DataFrame:
    """Users and revenue per brand."""
    brand = F.coalesce("advertiser", F.lit(UNKNOWN)).alias("brand")
    return _revenue_by(paying_events(events), [brand], "users", "deposits", "revenue")


def funnel(events: DataFrame, keys: Sequence[str] = ("publisher_id",),
           stages: Sequence[str] = ("view", "click", DEPOSIT)) -> DataFrame:
    """Events and users at each stage, and the step-to-step conversion in percent."""
    stages = list(stages)
    per_user = events.filter(F.col("event_type").isin(stages)).groupBy(*keys, USER).agg(
        *[F.count_if(F.col("event_type") == s).alias(s) for s in stages])
    # A frame reduced per user has one row for the missing user ids; it is no user.
    reached = lambda s: F.count_if((F.col(s) > 0) & F.col(USER).isNotNull())
    sums = per_user.groupBy(*keys).agg(
        *[F.sum(s).alias(f"{s}_events") for s in stages], *[reached(s).alias(f"{s}_users") for s in stages])
    step = lambda a, b: num.half_up(num.percent(F.col(f"{b}_events"), F.col(f"{a}_events")), 2)
    return sums.withColumns({f"{a}_to_{b}_pct": step(a, b) for a, b in zip(stages, stages[1:])})


def _last_before(rows: DataFrame, what: Column, value: Column, slot_hours: int) -> DataFrame:
    """``rows`` with ``_last``: the largest ``value`` (a struct that begins with the time) of a user's rows ``what`` up to each row's time.

    Within a slot of the clock a window follows the times; what came before the slot is one
    value per (user, slot), carried on over the slots.  So no window sees all rows of a very
    active user, only those of a slot, or one row per slot.
    """
    slot = F.floor(F.unix_micros(TS) / F.lit(slot_hours * 3_600_000_000)).alias("_slot")
    rows = rows.withColumn("_value", F.when(what, value)).select("*", slot)
    per_slot = rows.groupBy(USER, "_slot").agg(F.max("_value").alias("_here"))
    earlier = Window.partitionBy(USER).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slot.select(USER, "_slot", F.max("_here").over(earlier).alias("_carried"))
    now = Window.partitionBy(USER, "_slot").orderBy(F.unix_micros(TS)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn("_here", F.max("_value").over(now)).join(carried, [USER, "_slot"])
    return joined.withColumn("_last", F.coalesce(F.greatest("_here", "_carried"), "_here", "_carried")).drop("_slot", "_value", "_here", "_carried")


def ordered_funnel(events: DataFrame, stages: Sequence[str] = ("view", "click", DEPOSIT), within_hours: float = 24,
                   slot_hours: int = 6) -> DataFrame:
    """Events and users that went through the stages in order, and the share of users that each step keeps.

    An event of the first stage counts.  One of a later stage counts if the user has a counted
    event of the stage before it, at the same time or up to ``within_hours`` earlier.  Of
    these the latest decides, so one pass over the user's time per stage is enough.
    """
    order = F.lit(None).cast("int")
    for number, stage in enumerate(stages):
        order = F.when(F.col("event_type") == stage, number).otherwise(order)
    rows = (events.filter(F.col("event_type").isin(list(stages)) & F.col(USER).isNotNull())
            .groupBy(USER, TS, order.alias("_stage")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_counts", F.col("_stage") == 0))
    micros = F.unix_micros(TS)
    for number in range(1, len(stages)):
        rows = _last_before(rows, (F.col("_stage") == number - 1) & F.col("_counts"), F.struct(micros.alias("at")), slot_hours)
        near = F.coalesce(micros - F.col("_last")["at"] <= int(within_hours * 3_600_000_000), F.lit(False))
        rows = rows.withColumn("_counts", F.when(F.col("_stage") == number, near).otherwise(F.col("_counts"))).drop("_last")
    per_user = rows.filter("_counts").groupBy(USER, "_stage").agg(F.sum("_n").alias("_n"))
    counted = per_user.groupBy("_stage").agg(F.count(F.lit(1)).alias("users"), F.sum("_n").alias("events"))
    of = lambda column, k: F.coalesce(F.max(F.when(F.col("_stage") == k, F.col(column))), F.lit(0))
    sums = counted.agg(*[of(c, k).alias(f"{stage}_{c}") for k, stage in enumerate(stages) for c in ("events", "users")])
    step = lambda a, b: num.half_up(num.percent(F.col(f"{b}_users"), F.col(f"{a}_users")), 2)
    return sums.withColumns({f"{a}_to_{b}_pct": step(a, b) for a, b in zip(stages, stages[1:])})


def attributed_deposits(events: DataFrame, windows: Mapping[str, float], click: str = "click", slot_hours: int = 6) -> DataFrame:
    """Deposits and revenue per attribution, campaign and day of the deposit, each given to the user's last click.

    ``windows`` names attributions by the hours that may lie between click and deposit.  Of
    clicks at one time, that of the largest campaign counts; deposits without a click that
    is near enough, or whose click names no campaign, count nowhere.
    """
    rows = events.filter(F.col("event_type").isin(click, DEPOSIT) & F.col(USER).isNotNull()).select(USER, TS, "event_type", "campaign_id", AMOUNT)
    micros = F.unix_micros(TS)
    rows = _last_before(rows, F.col("event_type") == click, F.struct(micros.alias("at"), F.col("campaign_id").alias("campaign")), slot_hours)
    found = rows.filter((F.col("event_type") == DEPOSIT) & F.col("_last")["campaign"].isNotNull())
    apart = micros - F.col("_last")["at"]
    named = F.array_compact(F.array(*[F.when(apart <= int(h * 3_600_000_000), F.lit(name)) for name, h in windows.items()]))
    return (found.select(F.explode(named).alias("attribution_type"), F.col("_last")["campaign"].alias("campaign_id"), F.to_date(TS).alias("date"), AMOUNT)
            .groupBy("attribution_type", "campaign_id", "date").agg(F.count(F.lit(1)).alias("attributed"), F.sum(AMOUNT).alias("revenue")))


# The attribution types of the sheets and their hours.
ATTRIBUTIONS = {"1_hour": 1, "24_hours": 24}


def reported_vs_attributed(campaigns: DataFrame, events: DataFrame, windows: Mapping[str, float] = ATTRIBUTIONS) -> DataFrame:
    """Post-click conversions that the sheets report per attribution, campaign and day, beside those attributed from the events."""
    reported = (campaigns.filter(F.col(TS).isNotNull() & F.col("campaignid").isNotNull())
                .groupBy("attribution_type", F.col("campaignid").alias("campaign_id"), F.to_date(TS).alias("date"))
                .agg(F.sum(F.coalesce("postclick", F.lit(0))).alias("reported")))
    return (reported.join(attributed_deposits(events, windows), ["attribution_type", "campaign_id", "date"], "full")
            .na.fill(0, ["reported", "attributed", "revenue"])
            .withColumn("difference", F.col("reported") - F.col("attributed")))


def reported_vs_observed(campaigns: DataFrame, events: DataFrame) -> DataFrame:
    """Post-click conversions reported per campaign and day beside the deposits observed."""
    reported = (campaigns.filter(F.col(TS).isNotNull() & F.col("campaignid").isNotNull())
                .groupBy(F.col("campaignid").alias("campaign_id"), F.to_date(TS).alias("date"))
                .agg(F.sum(F.coalesce("postclick", F.lit(0))).alias("reported")))
    observed = (deposits(events, null_users=True).filter(F.col("campaign_id").isNotNull())
                .groupBy("campaign_id", F.to_date(TS).alias("date"))
                .agg(F.count(F.lit(1)).alias("observed"), F.sum(AMOUNT).alias("revenue")))
    return (reported.join(observed, ["campaign_id", "date"], "full")
            .withColumn("in_both", F.col("reported").isNotNull() & F.col("observed").isNotNull())
            .na.fill(0, ["reported", "observed", "revenue"])
            .withColumn("difference", F.col("reported") - F.col("observed")))

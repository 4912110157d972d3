"""First (FTD) and repeat (RD) deposits per publisher, their cost and bid advice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import numeric as num, time as tm
from ..functions.rules import Rule, action_of, priority_of
from ..functions.text import FORMATS, OTHER
from .common import deposits, paid_only, scalar

USER, TS = "external_user_id", "event_date"


def _first_instants(events: DataFrame, start, end, end_bound) -> DataFrame:
    """(user, instant) of each user's very first deposit, where that lies in the period."""
    first = deposits(events).groupBy(USER).agg(F.min(TS).alias(TS))
    return first.filter(tm.within(F.col(TS), start, end, end_bound))


def deposit_types(events: DataFrame, start: tm.Day | None = None, end: tm.Day | None = None,
                  end_bound: str = tm.END_OF_DAY, null_user_type: str | None = "RD") -> DataFrame:
    """Deposits of a period marked FTD or RD; all deposits at a user's first instant are FTD.

    The join key is (user, instant), not the user alone, so the rows of a very active
    user spread over all tasks.  Rows without a user id get ``null_user_type``.
    """
    rows = deposits(events, null_users=True).filter(tm.within(F.col(TS), start, end, end_bound))
    first = _first_instants(events, start, end, end_bound).withColumn("_first", F.lit(True))
    kind = (F.when(F.col("_first"), "FTD")
            .when(F.col(USER).isNull(), F.lit(null_user_type).cast("string")).otherwise("RD"))
    return rows.join(first, [USER, TS], "left").withColumn("deposit_type", kind).drop("_first")


def numbered_deposits(events: DataFrame) -> DataFrame:
    """Deposits with their ordinal in the user's history, by time and then event id.

    Deposits are numbered within a minute only.  The counts of the day's earlier minutes
    and of the user's earlier days, each taken over one row per slot, are added, so no
    task sorts a user's day or history.
    """
    rows = deposits(events).withColumns({"_day": tm.day_number(F.col(TS)), "_minute": F.date_trunc("minute", TS)})
    minutes = rows.groupBy(USER, "_day", "_minute").agg(F.count(F.lit(1)).alias("_n"))
    days = minutes.groupBy(USER, "_day").agg(F.sum("_n").alias("_n"))
    before = lambda keys, order: F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select(USER, "_day", before([USER], "_day").alias("_days_before"))
    minutes = minutes.select(USER, "_day", "_minute", before([USER, "_day"], "_minute").alias("_minutes_before"))
    slots = minutes.join(days, [USER, "_day"]).select(USER, "_minute", (F.col("_days_before") + F.col("_minutes_before")).alias("_before"))
    within = F.row_number().over(Window.partitionBy(USER, "_minute").orderBy(TS, "event_id"))
    # A hash of both: the join by user alone would do otherwise, with a busy user in one task.
    return (rows.join(slots, [USER, "_minute"]).repartition(F.col(USER), F.col("_minute"))
            .withColumn("deposit_number", F.col("_before") + within).drop("_day", "_minute", "_before"))


def stats_by_period(events: DataFrame, periods: Mapping[str, tuple[tm.Day, tm.Day]], end_bound: str = tm.END_OF_DAY,
                    null_users_are_rd: bool = False) -> DataFrame:
    """Deposits, FTD, RD and RD rate per named period and publisher.

    The events are read twice, for any number of periods: once for each user's first
    instant, once for the rows of the periods, reduced to (period, publisher, user,
    instant) and joined on (user, instant).  RD is the rest of the deposits with a known
    user (or of all deposits).
    """
    inside = lambda name: F.when(tm.within(F.col(TS), *periods[name], end_bound), F.lit(name))
    named = F.filter(F.array(*[inside(name) for name in periods]), lambda x: x.isNotNull())
    any_period = reduce(lambda a, b: a | b, [tm.within(F.col(TS), *p, end_bound) for p in periods.values()])
    rows = (deposits(events, null_users=True).filter(any_period)
            .select("publisher_id", USER, TS, F.explode(named).alias("period"))
            .groupBy("period", "publisher_id", USER, TS).agg(F.count(F.lit(1)).alias("_n")))
    first = deposits(events).groupBy(USER).agg(F.min(TS).alias(TS)).filter(any_period).withColumn("_first", F.lit(True))
    known = F.sum("_n") if null_users_are_rd else F.sum(F.when(F.col(USER).isNotNull(), F.col("_n")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = rows.join(first, [USER, TS], "left").groupBy("period", "publisher_id").agg(
        F.sum("_n").alias("total_deps"), zero(known).alias("_known"), zero(F.sum(F.when(F.col("_first"), F.col("_n")))).alias("ftd"))
    rd = (F.col("_known") - F.col("ftd"))
    return sums.select("period", "publisher_id", "total_deps", "ftd", rd.alias("rd"),
                       num.half_even(num.percent(rd, F.col("total_deps")), 1).alias("rd_rate"))


def publisher_stats(events: DataFrame, start: tm.Day, end: tm.Day,
                    end_bound: str = tm.END_OF_DAY, null_users_are_rd: bool = False) -> DataFrame:
    """:func:`stats_by_period` for one period."""
    return stats_by_period(events, {"": (start, end)}, end_bound, null_users_are_rd).drop("period")


def rd_rate_advice(stats: DataFrame, min_total: int = 100) -> DataFrame:
    """Bid advice from a publisher's RD rate against the paid average."""
    paid = stats.filter(F.col("publisher_id") != 0)
    average = paid.agg(num.percent(F.sum("rd"), F.sum(F.col("ftd") + F.col("rd"))))
    rows = (paid.withColumn("total", F.col("ftd") + F.col("rd"))
            .filter(F.col("total") >= min_total)
            .withColumn("rd_rate", num.half_even(num.percent(F.col("rd"), F.col("total")), 1))
            .withColumn("rd_diff", F.col("rd_rate") - scalar(average)))
    diff = F.col("rd_diff")
    # Thresholds in percentage points.
    rules = [
        Rule(diff >= 5, "RAISE_20_30", "HIGH"), Rule(diff >= 2, "RAISE_10_15", "MEDIUM"),
        Rule(diff <= -5, "LOWER_20_30", "HIGH"), Rule(diff <= -2, "LOWER_10_15", "MEDIUM"),
    ]
    return rows.select(
        "publisher_id", "total", "ftd", "rd", "rd_rate", "rd_diff",
        action_of(rules, "KEEP").alias("recommendation"), priority_of(rules).alias("priority"),
    ).orderBy(F.desc("rd_diff"), "publisher_id")


OLD, NEW = "old", "new"


def _long(old: DataFrame, new: DataFrame | None) -> DataFrame:
    """Two months as one frame with ``period`` old or new, as which ``old`` may come already."""
    if new is None:
        return old
    return old.withColumn("period", F.lit(OLD)).unionByName(new.withColumn("period", F.lit(NEW)), allowMissingColumns=True)


def _side_by_side(both: DataFrame, columns: Sequence[str], labels: Sequence[str] = ()) -> DataFrame:
    """Two months per publisher, missing numbers as zero, labels of the new one.

    One aggregation in place of a full join; rows without a publisher meet too.
    """
    of = lambda column, tag: F.max(F.when(F.col("period") == tag, F.col(column)))
    return both.groupBy("publisher_id").agg(
        *[of(c, NEW).alias(c) for c in labels],
        *[F.coalesce(of(c, tag), F.lit(0)).alias(f"{c}_{tag}") for c in columns for tag in (OLD, NEW)])


def compare_months(old: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """Two months of :func:`publisher_stats`, or ``stats_by_period`` of old and new, with the change in volume and RD rate."""
    both = _side_by_side(_long(old, new), ["total_deps", "ftd", "rd", "rd_rate"])
    a, b = F.col("total_deps_old"), F.col("total_deps_new")
    return both.withColumns({
        "deps_change": b - a,
        "deps_change_pct": num.half_even(num.percent_change(b, a), 1),
        "rd_rate_change": F.col("rd_rate_new") - F.col("rd_rate_old"),
    })


def month_change_advice(comparison: DataFrame, min_deps: int = 1000, high_deps: int = 5000,
                        medium_deps: int = 2000) -> DataFrame:
    """Bid advice from growth (10 % = 1 point) and RD rate (1 point = 2 points)."""
    deps = F.col("total_deps_new")
    score = F.col("deps_change_pct") / 10 + F.col("rd_rate_change") * 2
    rows = comparison.filter((F.col("publisher_id") != 0) & (deps >= min_deps)).select(
        "publisher_id", deps.alias("deps"), "deps_change_pct", "rd_rate_change", "rd_rate_new",
        score.cast("decimal(18,6)").alias("total_score"))
    total, deps = F.col("total_score"), F.col("deps")
    rules = [
        Rule((total >= 5) & (deps >= high_deps), "RAISE_20_30", "HIGH"),
        Rule((total >= 2) & (deps >= medium_deps), "RAISE_10_15", "MEDIUM"),
        Rule((total <= -5) & (deps >= high_deps), "LOWER_20_30", "HIGH"),
        Rule((total <= -2) & (deps >= medium_deps), "LOWER_10_15", "MEDIUM"),
    ]
    return rows.withColumns({"recommendation": action_of(rules, "KEEP"),
                             "priority": priority_of(rules)}).orderBy(F.desc("total_score"), "publisher_id")


# --- cost -------------------------------------------------------------------


def with_cost(stats: DataFrame, spend: DataFrame) -> DataFrame:
    """Publisher statistics joined with a month of spend: cost per FTD, RD and deposit.

    Where both frames have a ``period``, each meets its own.  A zero count counts as one,
    so the cost is then the whole spend.
    """
    keys = ["publisher_id", *(["period"] if "period" in stats.columns and "period" in spend.columns else [])]
    month = spend.select(*keys, "publisher_name", "format", "spend")
    cost = F.col("spend")
    per = lambda column, places: num.half_even(num.ratio_floor_one(cost, F.col(column)), places)
    return stats.join(month, keys, "left").withColumns({
        "ftd_cpa": per("ftd", 2), "rd_cpa": per("rd", 4), "total_cpa": per("total_deps", 3)})


def compare_costs(old: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """Two months of :func:`with_cost`, apart or as one frame with old and new periods; the name is that of the new month."""
    numbers = ["total_deps", "ftd", "rd", "spend", "ftd_cpa", "rd_cpa", "total_cpa", "rd_rate"]
    both = _side_by_side(_long(old, new), numbers, ["publisher_name"])
    col = lambda name, tag: F.col(f"{name}_{tag}")
    diff = lambda name: col(name, "new") - col(name, "old")
    growth = lambda name: num.half_even(num.percent_change(col(name, "new"), col(name, "old")), 1)
    return both.withColumns({
        "spend_change": diff("spend"), "spend_change_pct": growth("spend"),
        "deps_change": diff("total_deps"), "deps_change_pct": growth("total_deps"),
        "ftd_cpa_change": diff("ftd_cpa"), "rd_cpa_change": diff("rd_cpa"),
    })


def _off_average(value: Column, average: Column) -> Column:
    """Percent above (positive) or below the average."""
    return num.percent(value, average) - 100


def efficiency_advice(comparison: DataFrame, min_spend: int = 100, min_deps: int = 100,
                      high_deps: int = 5000, medium_deps: int = 2000) -> DataFrame:
    """Bid advice from cost against the paid average; cost per deposit weighs three of five."""
    paid = comparison.filter((F.col("spend_new") > min_spend) & (F.col("publisher_id") != 0))
    weights = [("total_cpa_new", "total_deps_new", 3), ("ftd_cpa_new", "ftd_new", 1), ("rd_cpa_new", "rd_new", 1)]
    averages = paid.agg(F.struct(*[num.ratio(F.sum("spend_new"), F.sum(n)).alias(cpa) for cpa, n, _ in weights]))
    parts = [_off_average(F.col(cpa), F.col(f"_average.{cpa}")) * w for cpa, _, w in weights]
    rows = paid.filter(F.col("total_deps_new") >= min_deps).withColumn("_average", scalar(averages)).select(
        "publisher_id", "publisher_name", "spend_new", "total_deps_new", "total_cpa_new", "ftd_cpa_new",
        "rd_cpa_new", ((parts[0] + parts[1] + parts[2]) / 5).cast("decimal(28,8)").alias("efficiency_score"),
        "deps_change_pct", "ftd_cpa_change", "rd_cpa_change")
    score, deps = F.col("efficiency_score"), F.col("total_deps_new")
    rules = [
        Rule((score <= -20) & (deps >= high_deps), "RAISE_30_50", "HIGH"),
        Rule((score <= -10) & (deps >= medium_deps), "RAISE_15_25", "MEDIUM"),
        Rule((score >= 20) & (deps >= high_deps), "LOWER_30_50", "HIGH"),
        Rule((score >= 10) & (deps >= medium_deps), "LOWER_15_25", "MEDIUM"),
    ]
    return rows.withColumns({"recommendation": action_of(rules, "KEEP"),
                             "priority": priority_of(rules)}).orderBy("efficiency_score", "publisher_id")


def paid_cost_totals(comparison: DataFrame, min_spend: int = 100) -> DataFrame:
    """Spend, deposits, FTD and RD of the paid publishers in both months."""
    paid = comparison.filter((F.col("spend_new") > min_spend) & (F.col("publisher_id") != 0))
    return paid.agg(F.count(F.lit(1)).alias("publishers"), *[
        F.sum(f"{name}_{tag}").alias(f"{name}_{tag}")
        for name in ("spend", "total_deps", "ftd", "rd") for tag in ("new", "old")])


# --- within a format --------------------------------------------------------


def _significant(costs: DataFrame, min_spend: int) -> DataFrame:
    known = costs.withColumn("format", F.coalesce("format", F.lit(OTHER)))
    return paid_only(known).filter(F.col("spend") > min_spend)


def format_advice(costs: DataFrame, min_spend: int = 50, high_deps: int = 2000, medium_deps: int = 1000,
                  observe_below: int = 1000, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Bid advice from cost per deposit against the average of the publisher's format."""
    rows = _significant(costs, min_spend).filter(F.col("format").isin(*formats))
    averages = rows.groupBy("format").agg(
        num.ratio_or_zero(F.sum("spend"), F.sum("total_deps")).alias("format_avg_cpa"))
    average = F.col("format_avg_cpa")
    off = F.when(average > 0, _off_average(F.col("total_cpa"), average)).otherwise(0)
    rows = rows.join(averages, "format").select(
        "format", "publisher_id", "publisher_name", "spend", F.col("total_deps").alias("deps"),
        "total_cpa", "ftd_cpa", "rd_cpa", "rd_rate", off.cast("decimal(28,8)").alias("efficiency_vs_format"),
        "format_avg_cpa")
    score, deps = F.col("efficiency_vs_format"), F.col("deps")
    rules = [
        Rule((score <= -25) & (deps >= high_deps), "RAISE_30_50", "HIGH"),
        Rule((score <= -15) & (deps >= medium_deps), "RAISE_15_25", "MEDIUM"),
        Rule((score >= 25) & (deps >= high_deps), "LOWER_30_50", "HIGH"),
        Rule((score >= 15) & (deps >= medium_deps), "LOWER_15_25", "MEDIUM"),
        Rule(deps < observe_below, "OBSERVE", "LOW"),
    ]
    return rows.withColumns({"recommendation": action_of(rules, "KEEP"), "priority": priority_of(rules)}
                            ).orderBy("format", "efficiency_vs_format", "publisher_id")


def format_summary(costs: DataFrame, min_spend: int = 50) -> DataFrame:
    """Publishers, spend, deposits and average cost per format."""
    sums = _significant(costs, min_spend).groupBy("format").agg(
        F.count(F.lit(1)).alias("publishers"),
        num.half_even(F.sum("spend"), 0).cast("decimal(24,0)").alias("total_spend"),
        F.sum("total_deps").alias("total_deps"), F.sum("ftd").alias("ftd"), F.sum("rd").alias("rd"))
    per = lambda column, places: num.half_even(num.ratio(F.col("total_spend"), F.col(column)), places)
    return sums.withColumns({
        "avg_total_cpa": per("total_deps", 3), "avg_ftd_cpa": per("ftd", 2), "avg_rd_cpa": per("rd", 4),
        "rd_rate": num.half_even(num.percent(F.col("rd"), F.col("total_deps")), 1),
    }).orderBy("format")


def advice_counts(advice: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How often each recommendation and priority was given."""
    return advice.groupBy(*keys, "recommendation", "priority").agg(F.count(F.lit(1)).alias("publishers"))


def extremes(advice: DataFrame, score: str, k: int) -> DataFrame:
    """The ``k`` rows with the lowest and the ``k`` with the highest score; each task keeps its own ``k`` before they meet."""
    low = advice.orderBy(F.asc(score), "publisher_id").limit(k).withColumn("side", F.lit("lowest"))
    high = advice.orderBy(F.desc(score), "publisher_id").limit(k).withColumn("side", F.lit("highest"))
    return low.unionByName(high)

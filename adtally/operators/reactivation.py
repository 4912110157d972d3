"""Users who deposit again after a pause."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import numeric as num, time as tm
from ..functions.rules import Rule, action_of, priority_of
from ..functions.segments import SEGMENTS, five_segments, four_segments, segment_order
from .common import deposits, scalar

USER, TS = "external_user_id", "event_date"
# Exact day sums do not depend on the order of addition.
_DAYS = "decimal(18,10)"


def depositors_in_period(events: DataFrame, start: tm.Day, end: tm.Day,
                         end_bound: str = tm.END_OF_DAY, null_users: bool = False,
                         users: DataFrame | None = None) -> DataFrame:
    """One row per user with a deposit in the period: its first one, and the last before it.

    Nothing in the period can precede the period's own first deposit, so the previous
    deposit is simply the latest one before ``start``.  That makes it a single
    aggregation per user instead of a self-join.

    ``users`` limits the result to listed ids.  The semi join is written directly on the
    aggregation: Spark moves it below when the list is small enough to broadcast, and
    otherwise joins the already reduced rows.
    """
    ts = F.col(TS)
    per_user = (
        deposits(events, null_users).select(USER, TS)
        .filter(tm.up_to(ts, end, end_bound))
        .groupBy(F.col(USER).alias("user_id"))
        .agg(F.min(F.when(tm.at_or_after(ts, start), ts)).alias("first_deposit"),
             F.max(F.when(~tm.at_or_after(ts, start), ts)).alias("_prev"))
    )
    if users is not None:
        per_user = per_user.join(users.select(F.col(users.columns[0]).cast("string").alias("user_id")), "user_id", "left_semi")
    per_user = per_user.filter(F.col("first_deposit").isNotNull())
    # The rows without a user id are no single person, so they have no previous deposit.
    previous = F.when(F.col("user_id").isNotNull(), F.col("_prev"))
    return per_user.select("user_id", "first_deposit", previous.alias("prev_deposit_date"))


def _with_days(per_user: DataFrame, whole: bool = False) -> DataFrame:
    gap = tm.whole_days_between if whole else tm.days_between
    return per_user.withColumn("days_inactive", gap(F.col("first_deposit"), F.col("prev_deposit_date")))


def first_in_period(events: DataFrame, start: tm.Day, end: tm.Day, min_gap_days: float = 7,
                    end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Reactivated users: the first deposit of the period came at least ``min_gap_days`` after the last."""
    first = F.col("first_deposit")
    return (
        _with_days(depositors_in_period(events, start, end, end_bound))
        .filter(F.col("days_inactive") >= min_gap_days)
        .select("user_id", "first_deposit", "prev_deposit_date", "days_inactive",
                four_segments(F.col("days_inactive")).alias("inactivity_period"),
                tm.period_start(first, "day").alias("reactivation_date"),
                tm.period_start(first, "week").alias("reactivation_week"),
                tm.period_start(first, "month").alias("reactivation_month"))
    )


def summary(events: DataFrame, start: tm.Day, end: tm.Day, min_gap_days: float = 7,
            end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Reactivated users per segment with their shares.

    Shorter gaps are not listed, yet they count in both denominators, so the shares
    of the listed segments do not add up to 100.
    """
    days = F.col("days_inactive")
    listed = days >= min_gap_days
    label = F.when(days.isNull(), "new").when(~listed, "short").otherwise(four_segments(days))
    exact = days.cast(_DAYS)
    per_label = (
        _with_days(depositors_in_period(events, start, end, end_bound))
        .groupBy(label.alias("inactivity_period"))
        .agg(F.count(F.lit(1)).alias("reactivations_count"), F.avg(exact).alias("_avg"),
             F.min(exact).alias("_min"), F.max(exact).alias("_max"))
    )
    # At most six rows are left here, so an unpartitioned window is harmless.
    everyone = Window.partitionBy()
    users = F.col("reactivations_count")
    old = F.when(F.col("inactivity_period") != "new", users)
    return (
        per_label
        .withColumn("_old", F.sum(old).over(everyone))
        .withColumn("_all", F.sum(users).over(everyone))
        .filter(~F.col("inactivity_period").isin("new", "short"))
        .select("inactivity_period", "reactivations_count",
                num.half_up(F.col("_avg"), 1).alias("avg_days_inactive"),
                num.half_up(F.col("_min"), 1).alias("min_days_inactive"),
                num.half_up(F.col("_max"), 1).alias("max_days_inactive"),
                num.half_up(num.percent(users, F.col("_old")), 1).alias("percentage_of_reactivations"),
                num.half_up(num.percent(users, F.col("_all")), 1).alias("percentage_of_all_users"))
        .orderBy(segment_order(F.col("inactivity_period")))
    )


def gaps(events: DataFrame, min_gap_days: float = 7, null_users: bool = False) -> DataFrame:
    """Every pause of at least ``min_gap_days`` between consecutive deposits of a user.

    A pause of a day or more always lies between the last deposit of one day slot and
    the first of the next used one.  So deposits are first reduced to one row per user
    and day, which bounds what the per-user window sees, however active the user.

    With ``null_users`` the rows without a user id are treated as one user.
    """
    if min_gap_days < 1:
        raise ValueError("min_gap_days must be at least 1")
    per_day = (
        deposits(events, null_users).select(USER, TS)
        .groupBy(F.col(USER).alias("user_id"), tm.day_number(F.col(TS)).alias("_day"))
        .agg(F.min(TS).alias("first_deposit"), F.max(TS).alias("_last"))
    )
    before = F.lag("_last").over(Window.partitionBy("user_id").orderBy("_day"))
    return (
        _with_days(per_day.withColumn("prev_deposit_date", before))
        .filter(F.col("days_inactive") >= min_gap_days)
        .select("user_id", four_segments(F.col("days_inactive")).alias("inactivity_period"),
                "first_deposit", "prev_deposit_date", "days_inactive")
    )


def trend(gap_rows: DataFrame, grain: str) -> DataFrame:
    """Reactivations per day, week or month and segment, from :func:`gaps` or its stored table."""
    start = tm.period_start(F.col("first_deposit"), grain).alias("period_start")
    return (gap_rows.groupBy(start, "inactivity_period")
            .agg(F.count(F.lit(1)).alias("reactivations_count"))
            .orderBy("period_start", segment_order(F.col("inactivity_period"))))


def _segment_shares(reactivated: DataFrame) -> DataFrame:
    exact = F.col("days_inactive").cast(_DAYS)
    # Whole days decide the segment even where fractions are averaged.
    label = five_segments(F.floor(F.col("days_inactive")))
    per_segment = reactivated.groupBy(label.alias("period")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(exact).alias("_avg"))
    total = F.sum("count").over(Window.partitionBy())  # five rows
    return (
        per_segment
        .select("period", "count", num.half_even(F.col("_avg"), 1).alias("avg_days"),
                num.half_even(num.percent(F.col("count"), total), 1).alias("percentage"))
        .orderBy(segment_order(F.col("period")))
    )


def period_detail(events: DataFrame, start: tm.Day, end: tm.Day,
                  end_bound: str = tm.END_OF_DAY, whole_days: bool = True) -> DataFrame:
    """Returning depositors of a period with the days since their previous deposit."""
    returning = (depositors_in_period(events, start, end, end_bound)
                 .filter(F.col("prev_deposit_date").isNotNull()))
    return _with_days(returning, whole_days)


def period_report(events: DataFrame, start: tm.Day, end: tm.Day,
                  end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Returning depositors per five segments, in whole days."""
    return _segment_shares(period_detail(events, start, end, end_bound))


def period_totals(events: DataFrame, start: tm.Day, end: tm.Day,
                  end_bound: str = tm.END_OF_DAY, null_users: bool = False) -> DataFrame:
    """Depositors, returning and new users of a period.

    ``null_users`` counts the rows without a user id as one more depositor.
    """
    people = depositors_in_period(events, start, end, end_bound, null_users)
    return people.agg(
        F.count(F.lit(1)).alias("depositors"),
        F.count("prev_deposit_date").alias("reactivations"),
        (F.count(F.lit(1)) - F.count("prev_deposit_date")).alias("new_users"),
    )


def list_detail(events: DataFrame, users: DataFrame, start: tm.Day, end: tm.Day,
                end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Returning depositors on a user list, with fractional days."""
    rows = depositors_in_period(events, start, end, end_bound, users=users)
    return _with_days(rows.filter(F.col("prev_deposit_date").isNotNull()))


def list_report(events: DataFrame, users: DataFrame, start: tm.Day, end: tm.Day,
                end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Returning depositors on a user list per segment."""
    return _segment_shares(list_detail(events, users, start, end, end_bound))


def list_totals(events: DataFrame, users: DataFrame, start: tm.Day, end: tm.Day,
                end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Size of the list, returning users on it, the others, and the returning share."""
    found = depositors_in_period(events, start, end, end_bound, users=users).agg(F.count("prev_deposit_date"))
    listed = users.agg(F.count(F.lit(1)).alias("users_in_list"))
    n, back = F.col("users_in_list"), F.col("reactivations")
    return (listed.withColumn("reactivations", scalar(found))
            .select(n, back, (n - back).alias("new_users"),
                    num.half_even(num.percent(back, n), 1).alias("reactivation_pct")))


# --- publishers -------------------------------------------------------------


def _publisher_segments(events: DataFrame, start: tm.Day, end: tm.Day, end_bound: str) -> DataFrame:
    """Returning (user, publisher) pairs of a period with their segment.

    The previous deposit may be at any publisher and inside the period.  Rows are
    reduced to (user, publisher, day slot); everything before the period is one slot.
    A previous deposit in the same slot means a gap under a day; otherwise it is the
    latest deposit of the slots before.
    """
    ts = F.col(TS)
    in_period = tm.at_or_after(ts, start)
    slot = F.when(in_period, tm.day_number(ts)).otherwise(F.lit(-1_000_000)).alias("_slot")
    reduced = (
        deposits(events).select(USER, "publisher_id", TS)
        .filter(tm.up_to(ts, end, end_bound))
        .groupBy(USER, "publisher_id", slot)
        .agg(F.min(TS).alias("_first"), F.max(TS).alias("_last"))
    )
    # The user's window sees one row per slot, whatever the number of publishers.
    user = Window.partitionBy(USER).orderBy("_slot")
    slots = (reduced.groupBy(USER, "_slot").agg(F.min("_first").alias("_slot_first"), F.max("_last").alias("_slot_last"))
             .withColumn("_earlier", F.max("_slot_last").over(user.rangeBetween(Window.unboundedPreceding, -1)))
             .select(USER, "_slot", "_slot_first", "_earlier"))
    pair = Window.partitionBy(USER, "publisher_id").orderBy("_slot")
    marked = reduced.withColumn("_same_pair_before", F.count(F.when(F.col("_slot") >= 0, 1)).over(
        pair.rangeBetween(Window.unboundedPreceding, -1))).join(slots, [USER, "_slot"])
    days = (F.when(F.col("_slot_first") < F.col("_first"), F.lit(0).cast("long"))
            .otherwise(tm.whole_days_between(F.col("_first"), F.col("_earlier"))))
    return (
        marked
        .filter((F.col("_slot") >= 0) & (F.col("_same_pair_before") == 0))
        .select("publisher_id", F.col(USER).alias("user_id"), F.col("_first").alias("first_deposit"),
                days.alias("days_inactive"))
        .filter(F.col("days_inactive").isNotNull())
        .withColumn("period", five_segments(F.col("days_inactive")))
    )


def _pct(segment: str) -> str:
    return f"{segment}_pct"


def publisher_profile(events: DataFrame, start: tm.Day, end: tm.Day,
                      end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Returning depositors per publisher and segment, with the share of each segment."""
    counts = (
        _publisher_segments(events, start, end, end_bound)
        .groupBy("publisher_id").pivot("period", SEGMENTS).agg(F.count(F.lit(1))).na.fill(0, SEGMENTS)
    )
    total = sum((F.col(s) for s in SEGMENTS[1:]), F.col(SEGMENTS[0]))
    counts = counts.withColumn("total", total)
    shares = [num.half_even(num.percent(F.col(s), F.col("total")), 1).alias(_pct(s)) for s in SEGMENTS]
    return counts.select("publisher_id", *SEGMENTS, "total", *shares)


def paid_averages(profile: DataFrame) -> DataFrame:
    """Share of each segment over all paid publishers."""
    paid = profile.filter(F.col("publisher_id") != 0)
    return paid.agg(*[num.percent(F.sum(s), F.sum("total")).alias(_pct(s)) for s in SEGMENTS])


def publisher_recommendations(profile: DataFrame, top: int = 20, high_volume: int = 100,
                              low_volume: int = 50) -> DataFrame:
    """Bid advice for the ``top`` publishers by volume, from their long-inactive share."""
    long_, short = SEGMENTS[-1], SEGMENTS[0]
    averages = paid_averages(profile)
    best = (profile.orderBy(F.desc("total"), F.asc("publisher_id")).limit(top)
            .withColumn("_average", scalar(averages.select(F.struct("*")))))
    off = lambda s: F.col(_pct(s)) - F.col("_average").getField(_pct(s))
    diffs = best.filter(F.col("publisher_id") != 0).select(
        "publisher_id", "total", F.col(_pct(long_)).alias("long_pct"),
        off(long_).alias("long_diff"), off(short).alias("short_diff"))
    return _advise(diffs, high_volume, low_volume).orderBy(F.desc("quality_score"), "publisher_id")


def _advise(diffs: DataFrame, high_volume: int, low_volume: int) -> DataFrame:
    diff, total = F.col("long_diff"), F.col("total")
    # Thresholds in percentage points.
    rules = [
        Rule((diff >= 1.0) & (total >= high_volume), "RAISE_20_30", "HIGH"),
        Rule((diff >= 0.5) & (total >= low_volume), "RAISE_10_15", "MEDIUM"),
        Rule((diff <= -1.0) & (total >= high_volume), "LOWER_20_30", "HIGH"),
        Rule((diff <= -0.5) & (total >= low_volume), "LOWER_10_15", "MEDIUM"),
        Rule(total < low_volume, "OBSERVE", "LOW"),
    ]
    score = (diff * 2 - F.col("short_diff") * F.lit("0.5").cast("decimal(2,1)")).alias("quality_score")
    return diffs.select("publisher_id", "total", "long_pct", "long_diff", "short_diff", score,
                        action_of(rules, "KEEP").alias("recommendation"),
                        priority_of(rules).alias("priority"))


# --- several periods --------------------------------------------------------

Periods = Mapping[str, tuple[tm.Day, tm.Day]]


def _period_segments(events: DataFrame, periods: Periods, end_bound: str) -> DataFrame:
    """(period name, segment, count) for several periods in one pass over the events."""
    ts = F.col(TS)
    firsts, earlier = [], []
    for i, (start, end) in enumerate(periods.values()):
        firsts.append(F.min(F.when(tm.within(ts, start, end, end_bound), ts)).alias(f"_f{i}"))
        earlier.append(F.max(F.when(~tm.at_or_after(ts, start), ts)).alias(f"_p{i}"))
    per_user = deposits(events).select(USER, TS).groupBy(USER).agg(*firsts, *earlier)
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"),
                 tm.whole_days_between(F.col(f"_f{i}"), F.col(f"_p{i}")).alias("days"))
        for i, name in enumerate(periods)]))
    return (
        per_user.select(rows.alias("_r")).select("_r.name", "_r.days")
        .filter(F.col("days").isNotNull())
        .groupBy("name", five_segments(F.col("days")).alias("period"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def compare_periods(events: DataFrame, controls: Periods, target: Periods,
                    end_bound: str = tm.END_OF_DAY) -> DataFrame:
    """Segments of control periods and one target period side by side, with a TOTAL row."""
    (goal,) = target
    names = [*controls, goal]
    counts = _period_segments(events, {**controls, **target}, end_bound)
    wide = (counts.groupBy("period").pivot("name", names).agg(F.first("count")).na.fill(0, names)
            .select("period", *[F.col(n).alias(f"{n}_count") for n in names]))
    # Six rows at most from here on.
    everything = Window.partitionBy()
    count = lambda n: F.col(f"{n}_count")
    whole = lambda n: F.sum(count(n)).over(everything)
    mean = lambda pick: num.ratio(sum((pick(n) for n in list(controls)[1:]), pick(next(iter(controls)))),
                                  F.lit(len(controls)))
    segments = wide.select(
        "period", *[count(n) for n in names],
        *[num.half_even(num.percent(count(n), whole(n)), 1).alias(f"{n}_pct") for n in names],
        num.half_even(mean(count), 0).cast("decimal(28,10)").alias("control_avg_count"),
        mean(whole).alias("_control_total"),
    ).withColumn("control_avg_pct",
                 num.half_even(num.percent(F.col("control_avg_count"), F.col("_control_total")), 1))
    total = segments.agg(
        F.lit("TOTAL").alias("period"), *[F.sum(count(n)).alias(f"{n}_count") for n in names],
        *[F.lit(100).cast("decimal(28,1)").alias(f"{n}_pct") for n in names],
        F.max("_control_total").alias("control_avg_count"), F.max("_control_total").alias("_control_total"),
        F.lit(100).cast("decimal(28,1)").alias("control_avg_pct"))
    return (
        segments.unionByName(total).drop("_control_total")
        .withColumn("diff_vs_avg", count(goal) - F.col("control_avg_count"))
        .withColumns({f"diff_vs_{n}": count(goal) - count(n) for n in controls})
        .orderBy(segment_order(F.col("period")))
    )


def segment_changes(comparison: DataFrame, controls: Sequence[str]) -> DataFrame:
    """How each segment moved, how steady the controls were, and whether all moves agree."""
    k = len(controls)
    values = [F.col(f"{n}_count").cast("double") for n in controls]
    mean = sum(values[1:], values[0]) / F.lit(float(k))
    spread = sum(((v - mean) * (v - mean) for v in values[1:]), (values[0] - mean) * (values[0] - mean))
    sample_std = F.sqrt(spread / F.lit(float(k - 1)))
    base = F.col("control_avg_count")
    moves = [F.col(f"diff_vs_{n}") for n in controls]
    up, down = F.least(*moves) > 0, F.greatest(*moves) < 0
    # A base of zero has no change to speak of and no spread.
    safe: Column = F.when(base > 0, base.cast("double"))
    return comparison.filter(F.col("period") != "TOTAL").select(
        "period", base.alias("control_avg_count"), F.col("diff_vs_avg"),
        num.half_even(F.coalesce(F.col("diff_vs_avg").cast("double") / safe * 100, F.lit(0.0)), 1).alias("pct_change"),
        num.half_even(F.coalesce(sample_std / safe * 100, F.lit(0.0)), 1).alias("cv_pct"),
        up.alias("all_positive"), down.alias("all_negative"),
        F.when(up, "GROWTH").when(down, "DECLINE").otherwise("MIXED").alias("pattern"),
    )

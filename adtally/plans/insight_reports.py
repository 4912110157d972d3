"""Retention, lifetime value, cohorts and further analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import insights as ins, sketches as sk
from . import frames
from .registry import big, dbl, dec, report

_MODE = """fm AS (SELECT pid, fmt FROM (SELECT pid, fmt, count(*) n FROM ps WHERE pid <> 0 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY n DESC, fmt) = 1)"""


def _retention(src: str) -> str:
    return f"""WITH x AS (SELECT uid, floor((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY uid)) / 86400000000.0) k FROM {src} WHERE event_type = 'deposit')
SELECT {big('k')} days_since_first, count(DISTINCT uid) returning_users FROM x WHERE k > 0 GROUP BY 1"""


@report("in1_retention", _retention("ue"), "ue")
def _(spark, d):
    return ins.retention(frames.user_events(spark, d))


@report("in1_retention_sub_day", _retention("be"), "be")
def _(spark, d):
    return ins.retention(frames.behaviour_events(spark, d))


@report("in2_lifetime_value", f"""WITH x AS (SELECT uid, pid, count(*) n, sum(amt) s, (epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0 t
  FROM be WHERE event_type = 'deposit' AND pid <> 0 GROUP BY ALL)
SELECT pid publisher_id, count(*) users, {dec('avg(s)')} avg_ltv, {dec('avg(n)')} avg_deposits_per_user, {dec('avg(t)')} avg_lifetime_days FROM x GROUP BY pid""", "be")
def _(spark, d):
    return ins.lifetime_value(frames.behaviour_events(spark, d))


@report("in3_time_to_first_deposit", f"""WITH x AS (SELECT uid, pid, event_type, ts, min(ts) OVER (PARTITION BY uid) a,
    min(ts) FILTER (WHERE event_type = 'deposit') OVER (PARTITION BY uid) b FROM be),
h AS (SELECT pid, (epoch_us(b) - epoch_us(a)) / 3600000000.0 hrs FROM x WHERE event_type = 'deposit' AND ts = b AND pid <> 0)
SELECT pid publisher_id, count(*) users, {dec('avg(hrs)')} avg_hours_to_deposit, {dec('quantile_cont(hrs, 0.5)', 4)} median_hours_to_deposit FROM h GROUP BY pid""", "be")
def _(spark, d):
    rows = ins.time_to_first_deposit(frames.behaviour_events(spark, d))
    return rows.withColumn("median_hours_to_deposit", F.round(F.col("median_hours_to_deposit").cast("decimal(28,10)"), 4))


@report("in4_deposit_size", f"""WITH {_MODE}
SELECT ue.pid publisher_id, fmt "format", adv brand, count(*) deposits_count, {dec('avg(amt)')} avg_deposit_amount, {dec('quantile_cont(CAST(amt AS DOUBLE), 0.5)', 4)} median_deposit_amount,
  {dbl('min(amt)')} min_deposit, {dbl('max(amt)')} max_deposit FROM ue LEFT JOIN fm USING (pid) WHERE amt > 0 AND ue.pid <> 0 GROUP BY ALL""", "ue ps")
def _(spark, d):
    rows = ins.deposit_size(frames.user_events(spark, d), frames.publisher_spend(spark, d))
    return rows.withColumn("median_deposit_amount", F.round(F.col("median_deposit_amount").cast("decimal(28,10)"), 4))


@report("in5_cohort_activity", f"""WITH x AS (SELECT uid, date_trunc('month', ts) m, date_trunc('month', min(ts) OVER (PARTITION BY uid)) c, amt FROM ue)
SELECT CAST(c AS DATE) cohort_month, CAST(m AS DATE) activity_month, date_diff('month', c, m) period_number, count(DISTINCT uid) active_users, count(*) total_deposits,
  {dbl('sum(amt)')} total_revenue FROM x GROUP BY c, m""", "ue")
def _(spark, d):
    return ins.cohort_activity(frames.user_events(spark, d))


def _revenue(keys: str, users: str, deposits: str, revenue: str) -> str:
    return f"""SELECT {keys}, count(DISTINCT uid) {users}, count(*) {deposits}, {dbl('sum(amt)')} {revenue}, {dec('sum(amt) / count(*)')} avg_deposit,
  {dec('sum(amt) / count(DISTINCT uid)')} arppu"""


@report("in6_by_country", _revenue("country, adv brand", "paying_users", "total_deposits", "total_revenue") + " FROM ue WHERE amt > 0 GROUP BY country, adv", "ue")
def _(spark, d):
    return ins.by_country(frames.user_events(spark, d, geography=True))


@report("in7_repeat_rate", f"""WITH x AS (SELECT uid, pid, count(*) n FROM ue WHERE pid <> 0 GROUP BY ALL)
SELECT pid publisher_id, count(*) total_users, count(*) FILTER (WHERE n > 1) repeat_users, {dec('count(*) FILTER (WHERE n > 1) * 100.0 / count(*)', 2)} repeat_rate_pct,
  {dec('avg(n)')} avg_deposits_per_user FROM x GROUP BY pid""", "ue")
def _(spark, d):
    return ins.repeat_rate(frames.user_events(spark, d))


@report("in8_weekday_pattern", f"""SELECT {big('dayofweek(ts)')} day_of_week, dayname(ts) day_name, count(*) deposits, count(DISTINCT uid) users, {dbl('sum(amt)')} revenue FROM ue GROUP BY 1, 2""", "ue")
def _(spark, d):
    return ins.weekday_pattern(frames.user_events(spark, d))


@report("in9_by_format", f"""WITH {_MODE}\n""" + _revenue('fmt "format", adv brand', "users", "deposits", "revenue") + " FROM ue JOIN fm USING (pid) WHERE amt > 0 GROUP BY fmt, adv", "ue ps")
def _(spark, d):
    return ins.by_format(frames.user_events(spark, d), frames.publisher_spend(spark, d))


@report("in10_by_brand", _revenue("coalesce(adv, 'Unknown') brand", "users", "deposits", "revenue") + " FROM ue WHERE amt > 0 GROUP BY 1", "ue")
def _(spark, d):
    return ins.by_brand(frames.user_events(spark, d))


@report("in11_funnel", f"""WITH x AS (SELECT pid, count(*) FILTER (WHERE event_type = 'view') v, count(*) FILTER (WHERE event_type = 'click') c, count(*) FILTER (WHERE event_type = 'deposit') dd,
  count(DISTINCT uid) FILTER (WHERE event_type = 'view') vu, count(DISTINCT uid) FILTER (WHERE event_type = 'click') cu, count(DISTINCT uid) FILTER (WHERE event_type = 'deposit') du FROM be GROUP BY pid)
SELECT pid publisher_id, v view_events, c click_events, dd deposit_events, vu view_users, cu click_users, du deposit_users, {dec('c * 100.0 / v', 2)} view_to_click_pct,
  {dec('dd * 100.0 / c', 2)} click_to_deposit_pct FROM x""", "be")
def _(spark, d):
    return ins.funnel(frames.behaviour_events(spark, d))


@report("in12_reported_vs_observed", f"""WITH r AS (SELECT cid, CAST(ts AS DATE) dd, sum(postclick) n FROM cp GROUP BY ALL),
o AS (SELECT cid, CAST(ts AS DATE) dd, count(*) n, sum(amt) s FROM be WHERE event_type = 'deposit' GROUP BY ALL)
SELECT coalesce(r.cid, o.cid) campaign_id, coalesce(r.dd, o.dd) AS date, {big('coalesce(r.n, 0)')} reported, coalesce(o.n, 0) observed, {dbl('coalesce(s, 0)')} revenue,
  r.n IS NOT NULL AND o.n IS NOT NULL in_both, {big('coalesce(r.n, 0) - coalesce(o.n, 0)')} difference
FROM r FULL JOIN o ON r.cid = o.cid AND r.dd = o.dd""", "cp be")
def _(spark, d):
    return ins.reported_vs_observed(frames.campaigns(spark, d), frames.behaviour_events(spark, d))


@report("in11_ordered_funnel", f"""WITH c AS (SELECT event_id, uid, ts FROM be x WHERE event_type = 'click' AND EXISTS (
  SELECT 1 FROM be v WHERE v.event_type = 'view' AND v.uid = x.uid AND v.ts <= x.ts AND x.ts <= v.ts + INTERVAL 24 HOUR)),
dd AS (SELECT event_id, uid FROM be x WHERE event_type = 'deposit' AND EXISTS (
  SELECT 1 FROM c WHERE c.uid = x.uid AND c.ts <= x.ts AND x.ts <= c.ts + INTERVAL 24 HOUR)),
n AS (SELECT (SELECT count(*) FROM be WHERE event_type = 'view') ve, (SELECT count(DISTINCT uid) FROM be WHERE event_type = 'view') vu,
  (SELECT count(*) FROM c) ce, (SELECT count(DISTINCT uid) FROM c) cu, (SELECT count(*) FROM dd) de, (SELECT count(DISTINCT uid) FROM dd) du)
SELECT ve view_events, vu view_users, ce click_events, cu click_users, de deposit_events, du deposit_users,
  {dec('cu * 100.0 / vu', 2)} view_to_click_pct, {dec('du * 100.0 / cu', 2)} click_to_deposit_pct FROM n""", "be")
def _(spark, d):
    return ins.ordered_funnel(frames.behaviour_events(spark, d))


@report("in12_reported_vs_attributed", f"""WITH r AS (SELECT attr, cid, CAST(ts AS DATE) dd, sum(postclick) n FROM cp GROUP BY ALL),
l AS (SELECT x.event_id, x.ts, x.amt, max(ROW(c.ts, c.cid)) k FROM be x JOIN be c ON c.uid = x.uid AND c.event_type = 'click' AND c.ts <= x.ts
  WHERE x.event_type = 'deposit' GROUP BY ALL),
w AS (SELECT * FROM (VALUES ('1_hour', 1), ('24_hours', 24)) t(attr, h)),
o AS (SELECT w.attr, struct_extract_at(k, 2) cid, CAST(ts AS DATE) dd, count(*) n, sum(amt) s FROM l JOIN w ON ts <= struct_extract_at(k, 1) + to_hours(h) GROUP BY ALL)
SELECT coalesce(r.attr, o.attr) attribution_type, coalesce(r.cid, o.cid) campaign_id, coalesce(r.dd, o.dd) AS date, {big('coalesce(r.n, 0)')} reported,
  coalesce(o.n, 0) attributed, {dbl('coalesce(s, 0)')} revenue, {big('coalesce(r.n, 0) - coalesce(o.n, 0)')} difference
FROM r FULL JOIN o ON r.attr = o.attr AND r.cid = o.cid AND r.dd = o.dd""", "cp be")
def _(spark, d):
    return ins.reported_vs_attributed(frames.campaigns(spark, d), frames.behaviour_events(spark, d))


@report("ag2_merged_distinct_counts", "SELECT strftime(ts, '%Y') AS year, adv advertiser, count(DISTINCT uid) users, true close FROM ue GROUP BY 1, 2", "ue")
def _(spark, d):
    """Users per year and brand: exact, and whether the estimate from daily sketches lies within four standard errors."""
    events = frames.user_events(spark, d)
    daily = sk.distinct_sketches(events, [F.to_date("event_date").alias("day"), "advertiser"], "external_user_id")
    year = F.date_format("day", "yyyy").alias("year")
    about = sk.distinct_estimate(daily, [year, "advertiser"])
    exact = events.groupBy(F.date_format("event_date", "yyyy").alias("year"), "advertiser").agg(F.countDistinct("external_user_id").alias("users"))
    same = [exact["year"] == about["year"], exact["advertiser"].eqNullSafe(about["advertiser"])]
    near = F.abs(F.col("distinct_values") - F.col("users")) <= 4 * 0.0163 * F.col("users") + 1
    return exact.join(about, same).select(exact["year"], exact["advertiser"], "users", near.alias("close"))


@report("ag10_merged_quantiles", "SELECT pid publisher_id, count(*) n_values, true close FROM ue GROUP BY 1", "ue")
def _(spark, d):
    """Quartiles of deposits per publisher from monthly sketches: whether the true rank of each lies within 1.5 % of it."""
    from ..operators.common import salted_join

    events = frames.user_events(spark, d).select("publisher_id", "event_date", "converted_amount")
    monthly = sk.quantile_sketches(events, ["publisher_id", F.date_format("event_date", "yyyy-MM").alias("month")], "converted_amount")
    about = sk.quantile_estimate(monthly, ["publisher_id"])
    rows = salted_join(events, about, ["publisher_id"], "inner").withColumn("v", F.col("converted_amount").cast("double"))
    shares = [f(F.when(F.col("v") <= F.col(p), 1.0).otherwise(0.0)) if up else f(F.when(F.col("v") < F.col(p), 1.0).otherwise(0.0))
              for p in ("p25", "p50", "p75") for up, f in ((False, F.avg), (True, F.avg))]
    sums = rows.groupBy("publisher_id", "n_values").agg(*[s.alias(f"s{i}") for i, s in enumerate(shares)])
    # The rank of a value is anything from the share of smaller ones to that of those not larger.
    close = F.lit(True)
    for i, q in enumerate((0.25, 0.5, 0.75)):
        close = close & (F.col(f"s{2 * i}") <= q + 0.015) & (F.col(f"s{2 * i + 1}") >= q - 0.015)
    return sums.select("publisher_id", "n_values", close.alias("close"))

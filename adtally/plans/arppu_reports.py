"""Revenue per paying user."""

from __future__ import annotations

from ..operators import arppu
from . import frames
from .registry import big, dbl, dec, report

for _grain, _key in [("day", "ar1_arppu_daily"), ("week", "ar1_arppu_weekly"), ("month", "ar1_arppu_monthly")]:
    @report(_key, f"""SELECT CAST(date_trunc('{_grain}', ts) AS DATE) period_start, {dec('sum(amt) / count(DISTINCT uid)', 2)} arppu_usd
FROM ue WHERE adv = 'brand_a' AND amt > 0 GROUP BY 1""", "ue")
    def _(spark, d, grain=_grain):
        return arppu.trend(frames.user_events(spark, d), "brand_a", grain)


_BRANDED = """fm AS (SELECT pid, fmt FROM (SELECT pid, fmt, count(*) n FROM ps WHERE pid <> 0 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY n DESC, fmt) = 1),
x AS (SELECT uid, ts, pid, cid, website, country, amt,
    coalesce(adv, CASE WHEN website LIKE '%machinery%' OR website LIKE '%building%' THEN 'brand_b'
                       WHEN website LIKE '%auto%' OR website LIKE '%house%' THEN 'brand_a' ELSE 'Unknown' END) brand,
    coalesce(fmt, CASE WHEN sub_id LIKE '%POP%' THEN 'POP' WHEN sub_id LIKE '%PUSH%' THEN 'PUSH' WHEN sub_id LIKE '%VIDEO%' THEN 'VIDEO' ELSE 'OTHER' END) fmt
  FROM ue LEFT JOIN fm USING (pid) WHERE amt > 0)"""


def _split(label: str, value: str, column: str | None, where: str) -> str:
    """One breakdown as its own aggregate over the raw deposits."""
    shown = {"fmt": "NULL", "cid": "NULL", "website": "NULL", "country": "NULL"}
    if column in shown:
        shown[column] = column
    return f"""SELECT '{label}' breakdown_type, brand, {value} breakdown_value, {shown['fmt']} "format", {shown['cid']} campaign_id,
  {shown['website']} website, {shown['country']} country, min(ts) min_event_date, max(ts) max_event_date,
  count(DISTINCT uid) paying_users, count(*) total_deposits, {dec('sum(amt)', 2)} total_revenue_usd,
  {dec('sum(amt) / count(DISTINCT uid)', 2)} arppu_usd, {dec('count(*) / count(DISTINCT uid)', 2)} avg_deposits_per_user
FROM x WHERE {where} GROUP BY brand{', ' + column if column else ''}"""


@report("ar2_arppu_by_attributes", f"WITH {_BRANDED}\n" + "\nUNION ALL ".join([
    _split("Publisher", "CAST(pid AS VARCHAR)", "pid", "pid <> 0"), _split("Format", "NULL", "fmt", "fmt IS NOT NULL"),
    _split("Campaign", "CAST(cid AS VARCHAR)", "cid", "cid <> 0"), _split("Site", "website", "website", "website IS NOT NULL"),
    _split("Region", "country", "country", "country IS NOT NULL"), _split("All users", "'All'", None, "true")]), "ue ps")
def _(spark, d):
    return arppu.by_attributes(frames.user_events(spark, d, geography=True), frames.publisher_spend(spark, d), frames.WEBSITES)


def _cohort_sql(src: str, cutoff: str, grain: str, days: int, skip: str = "") -> str:
    return f"""WITH p AS (SELECT uid, ts, amt, min(ts) OVER (PARTITION BY uid) f FROM {src} WHERE event_type = 'deposit' AND amt > 0),
c AS (SELECT CAST(date_trunc('{grain}', f) AS DATE) cohort_start, uid, amt FROM p WHERE f <= TIMESTAMP '{cutoff}' AND ts < f + INTERVAL {days} DAY)
SELECT cohort_start, count(DISTINCT uid) users_count, count(*) total_deposits, {dbl('sum(amt)')} total_revenue,
  {dec('sum(amt) / count(DISTINCT uid)')} arppu, {dec('count(*) / count(DISTINCT uid)')} avg_deposits
FROM c {skip} GROUP BY 1"""


@report("ar3_first_week", _cohort_sql("ue", "2001-07-01", "week", 7, "WHERE cohort_start <> DATE '1995-03-13'"), "ue")
def _(spark, d):
    return arppu.first_period(frames.user_events(spark, d), "2001-08-01", "week", exclude_cohorts=["1995-03-13"])


@report("ar3_first_month", _cohort_sql("ue", "2001-07-01", "month", 30), "ue")
def _(spark, d):
    return arppu.first_period(frames.user_events(spark, d), "2001-08-01", "month")


@report("ar3_first_week_sub_day", _cohort_sql("be", "2024-01-15", "week", 7), "be")
def _(spark, d):
    return arppu.first_period(frames.behaviour_events(spark, d), "2024-02-15", "week")

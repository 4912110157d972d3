"""Reactivation reports (first in period, all gaps, trends, publishers, period comparison)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import time as tm
from ..functions.segments import SEGMENTS
from ..operators import deposit_types as dp, reactivation as rx
from . import frames
from .registry import big, dbl, dec, even, report

START, END = "1998-01-01", "1998-03-31"
B_START, B_END = "2024-01-15", "2024-01-20"


def _seg(days: str, five: bool = False) -> str:
    first = f"WHEN {days} < 7 THEN '0-7 days' " if five else ""
    return (f"CASE {first}WHEN {days} < 14 THEN '7-14 days' WHEN {days} < 30 THEN '14-30 days' "
            f"WHEN {days} < 90 THEN '30-90 days' ELSE '90+ days' END")


def _people(src: str, start: str, upper: str) -> str:
    """Per user: first deposit from ``start`` on below ``upper``, and the nearest one before it."""
    return f"""dep AS (SELECT uid, ts FROM {src} WHERE event_type = 'deposit'),
opening AS (SELECT uid, min(ts) f FROM dep WHERE ts >= TIMESTAMP '{start}' AND {upper} GROUP BY uid),
people AS (SELECT o.uid, o.f, d.ts p, (epoch_us(o.f) - epoch_us(d.ts)) / 86400000000.0 AS days
           FROM opening o ASOF LEFT JOIN dep d ON o.uid = d.uid AND o.f > d.ts)"""


_Q1 = _people("ue", START, "ts < TIMESTAMP '1998-04-01'")
_DETAIL = f"""SELECT uid user_id, f first_deposit, p prev_deposit_date, {dbl('days')} days_inactive,
  {_seg('days')} inactivity_period, CAST(f AS DATE) reactivation_date,
  CAST(date_trunc('week', f) AS DATE) reactivation_week, CAST(date_trunc('month', f) AS DATE) reactivation_month
FROM people WHERE days >= 7"""


@report("rx1_first_in_period", f"WITH {_Q1}\n{_DETAIL}", "ue")
def _(spark, d):
    return rx.first_in_period(frames.user_events(spark, d), START, END)


for _bound, _upper in [(tm.END_OF_DAY, "ts < TIMESTAMP '2024-01-21'"),
                       (tm.LAST_SECOND, "ts <= TIMESTAMP '2024-01-20 23:59:59'"),
                       (tm.MIDNIGHT, "ts <= TIMESTAMP '2024-01-20'")]:
    @report(f"rx1_bound_{_bound}", f"WITH {_people('be', B_START, _upper)}\n{_DETAIL.replace('>= 7', '>= 3')}", "be")
    def _(spark, d, bound=_bound):
        return rx.first_in_period(frames.behaviour_events(spark, d), B_START, B_END, 3, bound)


def _summary_sql(people: str, floor: int = 7) -> str:
    one = lambda e: dec(e, 1)
    return f"""WITH {people},
whole AS (SELECT count(*) n, count(p) back FROM people)
SELECT {_seg('days')} inactivity_period, count(*) reactivations_count, {one('avg(days)')} avg_days_inactive,
  {one('min(days)')} min_days_inactive, {one('max(days)')} max_days_inactive,
  {one('count(*) * 100.0 / (SELECT back FROM whole)')} percentage_of_reactivations,
  {one('count(*) * 100.0 / (SELECT n FROM whole)')} percentage_of_all_users
FROM people WHERE days >= {floor} GROUP BY 1"""


@report("rx2_summary", _summary_sql(_Q1), "ue")
def _(spark, d):
    return rx.summary(frames.user_events(spark, d), START, END)


@report("rx2_summary_fractional_days", _summary_sql(_people("be", B_START, "ts < TIMESTAMP '2024-01-21'"), 2), "be")
def _(spark, d):
    return rx.summary(frames.behaviour_events(spark, d), B_START, B_END, 2)


def _gaps_sql(src: str) -> str:
    return f"""gap AS (
  SELECT uid, ts, p, (epoch_us(ts) - epoch_us(p)) / 86400000000.0 AS days
  FROM (SELECT uid, ts, lag(ts) OVER (PARTITION BY uid ORDER BY ts) p FROM {src} WHERE event_type = 'deposit'))"""


@report("rx3_gaps", f"""WITH {_gaps_sql('ue')}
SELECT uid user_id, {_seg('days')} inactivity_period, ts first_deposit, p prev_deposit_date, {dbl('days')} days_inactive
FROM gap WHERE days >= 7""", "ue")
def _(spark, d):
    return rx.gaps(frames.user_events(spark, d))


@report("rx3_gaps_fractional_days", f"""WITH {_gaps_sql('be')}
SELECT uid user_id, {_seg('days')} inactivity_period, ts first_deposit, p prev_deposit_date, {dbl('days')} days_inactive
FROM gap WHERE days >= 2""", "be")
def _(spark, d):
    return rx.gaps(frames.behaviour_events(spark, d), 2)


for _grain, _key in [("day", "rx4_daily"), ("week", "rx4_weekly"), ("month", "rx4_monthly")]:
    @report(_key, f"""WITH {_gaps_sql('ue')}
SELECT CAST(date_trunc('{_grain}', ts) AS DATE) period_start, {_seg('days')} inactivity_period, count(*) reactivations_count
FROM gap WHERE days >= 7 GROUP BY 1, 2""", "ue")
    def _(spark, d, grain=_grain):
        return rx.trend(rx.gaps(frames.user_events(spark, d)), grain)


_SHARES = f"""SELECT {_seg('floor(days)', True)} period, count(*) "count", {{avg}} avg_days,
  {even('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} percentage
FROM people WHERE p IS NOT NULL GROUP BY 1"""


@report("rx5_period_report", f"WITH {_Q1}\n{_SHARES.format(avg=even('avg(floor(days))', 1))}", "ue")
def _(spark, d):
    return rx.period_report(frames.user_events(spark, d), START, END)


@report("rx5_period_report_last_second", f"""WITH {_people('be', B_START, "ts <= TIMESTAMP '2024-01-20 23:59:59'")}
{_SHARES.format(avg=even('avg(floor(days))', 1))}""", "be")
def _(spark, d):
    return rx.period_report(frames.behaviour_events(spark, d), B_START, B_END, tm.LAST_SECOND)


@report("rx5_period_detail", f"""WITH {_Q1}
SELECT uid user_id, f first_deposit, p prev_deposit_date, {big('floor(days)')} days_inactive
FROM people WHERE p IS NOT NULL""", "ue")
def _(spark, d):
    return rx.period_detail(frames.user_events(spark, d), START, END)


@report("rx5_period_totals", f"""WITH {_Q1}
SELECT count(*) depositors, count(p) reactivations, count(*) - count(p) new_users FROM people""", "ue")
def _(spark, d):
    return rx.period_totals(frames.user_events(spark, d), START, END)


def _listed(spark, d):
    """Customers of one market segment as the user list."""
    people = frames.table(spark, d, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    return people.select(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 12).alias("user_id"))


_LIST = """listed AS (SELECT substr(md5(CAST(c_custkey AS VARCHAR)), 1, 12) uid FROM customer WHERE c_mktsegment = 'MACHINERY')"""


@report("rx6_user_list_report", f"""WITH {_LIST}, mine AS (SELECT * FROM ue WHERE uid IN (SELECT uid FROM listed)),
{_people('mine', START, "ts < TIMESTAMP '1998-04-01'")}
{_SHARES.format(avg=even('avg(days)', 1))}""", "ue")
def _(spark, d):
    return rx.list_report(frames.user_events(spark, d), _listed(spark, d), START, END)


@report("rx6_user_list_totals", f"""WITH {_LIST}, mine AS (SELECT * FROM ue WHERE uid IN (SELECT uid FROM listed)),
{_people('mine', START, "ts < TIMESTAMP '1998-04-01'")},
n AS (SELECT (SELECT count(*) FROM listed) total, (SELECT count(p) FROM people) back)
SELECT total users_in_list, back reactivations, total - back new_users, {even('back * 100.0 / total', 1)} reactivation_pct FROM n""", "ue")
def _(spark, d):
    return rx.list_totals(frames.user_events(spark, d), _listed(spark, d), START, END)


def _publisher_people(src: str, start: str, upper: str) -> str:
    return f"""dep AS (SELECT uid, ts, pid FROM {src} WHERE event_type = 'deposit'),
opening AS (SELECT uid, pid, min(ts) f FROM dep WHERE ts >= TIMESTAMP '{start}' AND {upper} GROUP BY ALL),
people AS (SELECT o.uid, o.pid, floor((epoch_us(o.f) - epoch_us(d.ts)) / 86400000000.0) AS days
           FROM opening o ASOF JOIN (SELECT DISTINCT uid, ts FROM dep) d ON o.uid = d.uid AND o.f > d.ts),
prof AS (SELECT pid, {', '.join(f"count(*) FILTER (WHERE {_seg('days', True)} = '{s}') s{i}" for i, s in enumerate(SEGMENTS))},
         count(*) total FROM people GROUP BY pid)"""


def _profile_sql(*args: str) -> str:
    shares = ", ".join(f"""s{i} "{s}", {even(f's{i} * 100.0 / total', 1)} "{s}_pct" """ for i, s in enumerate(SEGMENTS))
    return f"WITH {_publisher_people(*args)}\nSELECT pid publisher_id, total, {shares} FROM prof"


@report("rx7_publisher_profile", _profile_sql("ue", START, "ts < TIMESTAMP '1998-04-01'"), "ue")
def _(spark, d):
    return rx.publisher_profile(frames.user_events(spark, d), START, END)


@report("rx7_publisher_profile_sub_day", _profile_sql("be", B_START, "ts < TIMESTAMP '2024-01-21'"), "be")
def _(spark, d):
    return rx.publisher_profile(frames.behaviour_events(spark, d), B_START, B_END)


@report("rx7_paid_averages", f"""WITH {_publisher_people('ue', START, "ts < TIMESTAMP '1998-04-01'")}
SELECT {', '.join(f'{dec(f"sum(s{i}) * 100.0 / sum(total)")} "{s}_pct"' for i, s in enumerate(SEGMENTS))} FROM prof WHERE pid <> 0""", "ue")
def _(spark, d):
    return rx.paid_averages(rx.publisher_profile(frames.user_events(spark, d), START, END))


_ADVICE = f"""WITH {_publisher_people('ue', START, "ts < TIMESTAMP '1998-04-01'")},
mean AS (SELECT CAST(sum(s4) * 100.0 / sum(total) AS DECIMAL(38,10)) l, CAST(sum(s0) * 100.0 / sum(total) AS DECIMAL(38,10)) s FROM prof WHERE pid <> 0),
best AS (SELECT *, round_even(CAST(s4 * 100.0 / total AS DECIMAL(38,10)), 1) lp, round_even(CAST(s0 * 100.0 / total AS DECIMAL(38,10)), 1) sp
         FROM prof ORDER BY total DESC, pid LIMIT 20),
gap AS (SELECT pid, total, lp, lp - l ld, sp - s sd FROM best, mean WHERE pid <> 0)
SELECT pid publisher_id, total, {dbl('lp')} long_pct, {dec('ld')} long_diff, {dec('sd')} short_diff,
  {dec('2 * ld - 0.5 * sd')} quality_score,
  CASE WHEN ld >= 1 AND total >= 20 THEN 'RAISE_20_30' WHEN ld >= 0.5 AND total >= 10 THEN 'RAISE_10_15'
       WHEN ld <= -1 AND total >= 20 THEN 'LOWER_20_30' WHEN ld <= -0.5 AND total >= 10 THEN 'LOWER_10_15'
       WHEN total < 10 THEN 'OBSERVE' ELSE 'KEEP' END recommendation,
  CASE WHEN abs(ld) >= 1 AND total >= 20 THEN 'HIGH' WHEN abs(ld) >= 0.5 AND total >= 10 THEN 'MEDIUM' ELSE 'LOW' END priority
FROM gap"""


def _advice(spark, d):
    profile = rx.publisher_profile(frames.user_events(spark, d), START, END)
    return rx.publisher_recommendations(profile, top=20, high_volume=20, low_volume=10)


@report("rx7_recommendations", _ADVICE, "ue")
def _(spark, d):
    return _advice(spark, d)


@report("rx7_advice_counts", f"WITH a AS ({_ADVICE}) SELECT recommendation, priority, count(*) publishers FROM a GROUP BY ALL", "ue")
def _(spark, d):
    return dp.advice_counts(_advice(spark, d))


@report("rx7_best_and_worst", f"""WITH a AS ({_ADVICE}) SELECT publisher_id, side FROM (
  SELECT publisher_id, 'lowest' side, row_number() OVER (ORDER BY quality_score, publisher_id) k FROM a
  UNION ALL SELECT publisher_id, 'highest', row_number() OVER (ORDER BY quality_score DESC, publisher_id) FROM a) WHERE k <= 5""", "ue")
def _(spark, d):
    return dp.extremes(_advice(spark, d), "quality_score", 5).select("publisher_id", "side")


CONTROLS = {"aug": ("1997-08-01", "1997-08-31"), "sep": ("1997-09-01", "1997-09-30"), "oct": ("1997-10-01", "1997-10-31")}
TARGET = {"nov": ("1997-11-01", "1997-11-30")}
_MONTHS = {**CONTROLS, **TARGET}


def _comparison_sql() -> str:
    parts = [f"""SELECT '{name}' nm, uid, min(ts) f FROM dep
             WHERE ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b}' + INTERVAL 1 DAY GROUP BY uid""" for name, (a, b) in _MONTHS.items()]
    counts = ", ".join(f"count(*) FILTER (WHERE nm = '{n}') {n}" for n in _MONTHS)
    pct = ", ".join(f"round_even(CAST({n} * 100.0 / sum({n}) OVER () AS DECIMAL(38,10)), 1) {n}_p" for n in _MONTHS)
    return f"""dep AS (SELECT uid, ts FROM ue WHERE event_type = 'deposit'),
opening AS ({' UNION ALL '.join(parts)}),
people AS (SELECT nm, floor((epoch_us(o.f) - epoch_us(d.ts)) / 86400000000.0) AS days
           FROM opening o ASOF JOIN dep d ON o.uid = d.uid AND o.f > d.ts),
counted AS (SELECT {_seg('days', True)} period, {counts} FROM people GROUP BY 1),
scored AS (SELECT *, {pct}, round_even(CAST((aug + sep + oct) / 3.0 AS DECIMAL(38,10)), 0) base,
           (sum(aug + sep + oct) OVER ()) / 3.0 base_all FROM counted),
cmp AS (SELECT period, aug, sep, oct, nov, aug_p, sep_p, oct_p, nov_p, CAST(base AS DECIMAL(38,10)) base,
          round_even(CAST(base * 100.0 / base_all AS DECIMAL(38,10)), 1) base_p FROM scored
        UNION ALL SELECT 'TOTAL', sum(aug), sum(sep), sum(oct), sum(nov), 100, 100, 100, 100,
          CAST(max(base_all) AS DECIMAL(38,10)), 100 FROM scored)"""


@report("rx8_period_comparison", f"""WITH {_comparison_sql()}
SELECT period, {', '.join(f'{big(n)} {n}_count, {dbl(f"{n}_p")} {n}_pct' for n in _MONTHS)}, {dec('base')} control_avg_count,
  {dbl('base_p')} control_avg_pct, {dec('nov - base')} diff_vs_avg,
  {', '.join(f'{big(f"nov - {n}")} diff_vs_{n}' for n in CONTROLS)} FROM cmp""", "ue")
def _(spark, d):
    return rx.compare_periods(frames.user_events(spark, d), CONTROLS, TARGET)


@report("rx9_segment_changes", f"""WITH {_comparison_sql()},
m AS (SELECT *, (aug + sep + oct) / 3.0 mu, least(nov - aug, nov - sep, nov - oct) lo, greatest(nov - aug, nov - sep, nov - oct) hi
      FROM cmp WHERE period <> 'TOTAL')
SELECT period, {dec('base')} control_avg_count, {dec('nov - base')} diff_vs_avg,
  {even('CASE WHEN base > 0 THEN (nov - base) / base * 100 ELSE 0 END', 1)} pct_change,
  {even('CASE WHEN base > 0 THEN sqrt(((aug - mu) ** 2 + (sep - mu) ** 2 + (oct - mu) ** 2) / 2) / base * 100 ELSE 0 END', 1)} cv_pct,
  lo > 0 all_positive, hi < 0 all_negative, CASE WHEN lo > 0 THEN 'GROWTH' WHEN hi < 0 THEN 'DECLINE' ELSE 'MIXED' END pattern FROM m""", "ue")
def _(spark, d):
    return rx.segment_changes(rx.compare_periods(frames.user_events(spark, d), CONTROLS, TARGET), list(CONTROLS))

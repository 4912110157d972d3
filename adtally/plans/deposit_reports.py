"""First and repeat deposits per publisher, cost, and bid advice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import time as tm
from ..operators import deposit_types as dp
from . import frames
from .registry import big, dbl, dec, even, report

OLD = ("1997-10-01", "1997-10-31", "1997-10")
NEW = ("1997-11-01", "1997-11-30", "1997-11")
QUARTER = ("1997-10-01", "1997-12-31")


def _stats(name: str, start: str, end: str, src: str = "ue") -> str:
    """Counts per publisher by comparing each deposit with the user's first instant (a window)."""
    return f"""{name} AS (SELECT pid, count(*) n, count(*) FILTER (WHERE ts = f) ftd, count(*) FILTER (WHERE ts > f) rd,
    round_even(CAST(count(*) FILTER (WHERE ts > f) * 100.0 / count(*) AS DECIMAL(38,10)), 1) rate
  FROM (SELECT *, min(ts) OVER (PARTITION BY uid) f FROM {src} WHERE event_type = 'deposit')
  WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}' + INTERVAL 1 DAY GROUP BY pid)"""


@report("dp1_deposit_types", f"""SELECT event_id, uid external_user_id, pid publisher_id, ts event_date, {dbl('amt')} converted_amount,
  CASE WHEN ts = f THEN 'FTD' ELSE 'RD' END deposit_type
FROM (SELECT *, min(ts) OVER (PARTITION BY uid) f FROM ue)
WHERE ts >= TIMESTAMP '{QUARTER[0]}' AND ts < TIMESTAMP '{QUARTER[1]}' + INTERVAL 1 DAY""", "ue")
def _(spark, d):
    rows = dp.deposit_types(frames.user_events(spark, d), *QUARTER)
    return rows.select("event_id", "external_user_id", "publisher_id", "event_date", "converted_amount", "deposit_type")


for _src, _frame in (("ue", frames.user_events), ("be", frames.behaviour_events)):
    @report(f"wn3_deposit_numbers_{_src}", f"""SELECT event_id, uid external_user_id, ts event_date, row_number() OVER (PARTITION BY uid ORDER BY ts, event_id) deposit_number
FROM {_src} WHERE event_type = 'deposit'""", _src)
    def _(spark, d, frame=_frame):
        return dp.numbered_deposits(frame(spark, d)).select("event_id", "external_user_id", "event_date", "deposit_number")


_STATS_OUT = f"SELECT pid publisher_id, n total_deps, ftd, rd, {dbl('rate')} rd_rate FROM m"


@report("dp2_publisher_month", f"WITH {_stats('m', *NEW[:2])}\n{_STATS_OUT}", "ue")
def _(spark, d):
    return dp.publisher_stats(frames.user_events(spark, d), *NEW[:2])


@report("dp2_publisher_days_last_second", f"""WITH {_stats('m', '2024-01-02', '2024-01-05', 'be')}
{_STATS_OUT}""", "be")
def _(spark, d):
    return dp.publisher_stats(frames.behaviour_events(spark, d), "2024-01-02", "2024-01-05", tm.LAST_SECOND)


@report("dp3_rd_rate_advice", f"""WITH {_stats('m', *QUARTER)},
a AS (SELECT pid, n, ftd, rd, rate, rate - (SELECT CAST(sum(rd) * 100.0 / sum(n) AS DECIMAL(38,10)) FROM m WHERE pid <> 0) diff
      FROM m WHERE pid <> 0 AND n >= 10)
SELECT pid publisher_id, n total, ftd, rd, {dbl('rate')} rd_rate, {dec('diff')} rd_diff,
  CASE WHEN diff >= 5 THEN 'RAISE_20_30' WHEN diff >= 2 THEN 'RAISE_10_15' WHEN diff <= -5 THEN 'LOWER_20_30'
       WHEN diff <= -2 THEN 'LOWER_10_15' ELSE 'KEEP' END recommendation,
  CASE WHEN abs(diff) >= 5 THEN 'HIGH' WHEN abs(diff) >= 2 THEN 'MEDIUM' ELSE 'LOW' END priority FROM a""", "ue")
def _(spark, d):
    return dp.rd_rate_advice(dp.publisher_stats(frames.user_events(spark, d), *QUARTER, null_users_are_rd=True), min_total=10)


_TWO = f"{_stats('o', *OLD[:2])}, {_stats('w', *NEW[:2])}"
_CHANGE = """c AS (SELECT coalesce(o.pid, w.pid) pid, coalesce(o.n, 0) n0, coalesce(w.n, 0) n1, coalesce(o.ftd, 0) f0, coalesce(w.ftd, 0) f1,
    coalesce(o.rd, 0) r0, coalesce(w.rd, 0) r1, coalesce(o.rate, 0) t0, coalesce(w.rate, 0) t1,
    round_even(CAST((coalesce(w.n, 0) * 100.0 / greatest(coalesce(o.n, 0), 1)) - 100 AS DECIMAL(38,10)), 1) up
  FROM o FULL JOIN w ON o.pid = w.pid)"""


@report("dp4_month_comparison", f"""WITH {_TWO}, {_CHANGE}
SELECT pid publisher_id, n0 total_deps_old, f0 ftd_old, r0 rd_old, {dbl('t0')} rd_rate_old, n1 total_deps_new, f1 ftd_new, r1 rd_new,
  {dbl('t1')} rd_rate_new, n1 - n0 deps_change, {dbl('up')} deps_change_pct, {dbl('t1 - t0')} rd_rate_change FROM c""", "ue")
def _(spark, d):
    events = frames.user_events(spark, d)
    return dp.compare_months(dp.stats_by_period(events, PERIODS))


@report("dp4_month_advice", f"""WITH {_TWO}, {_CHANGE},
s AS (SELECT *, up / 10 + (t1 - t0) * 2 score FROM c WHERE pid <> 0 AND n1 >= 2)
SELECT pid publisher_id, n1 deps, {dbl('up')} deps_change_pct, {dbl('t1 - t0')} rd_rate_change, {dbl('t1')} rd_rate_new, {dec('score')} total_score,
  CASE WHEN score >= 5 AND n1 >= 6 THEN 'RAISE_20_30' WHEN score >= 2 AND n1 >= 4 THEN 'RAISE_10_15'
       WHEN score <= -5 AND n1 >= 6 THEN 'LOWER_20_30' WHEN score <= -2 AND n1 >= 4 THEN 'LOWER_10_15' ELSE 'KEEP' END recommendation,
  CASE WHEN abs(score) >= 5 AND n1 >= 6 THEN 'HIGH' WHEN abs(score) >= 2 AND n1 >= 4 THEN 'MEDIUM' ELSE 'LOW' END priority
FROM s""", "ue")
def _(spark, d):
    events = frames.user_events(spark, d)
    both = dp.compare_months(dp.stats_by_period(events, PERIODS))
    return dp.month_change_advice(both, min_deps=2, high_deps=6, medium_deps=4)


def _cost(name: str, stats: str, month: str) -> str:
    per = lambda c, p: f"round_even(CAST(spend / greatest({c}, 1) AS DECIMAL(38,10)), {p})"
    return f"""{name} AS (SELECT s.*, pname, fmt, spend, {per('ftd', 2)} fc, {per('rd', 4)} rc, {per('n', 3)} tc
  FROM {stats} s LEFT JOIN (SELECT * FROM ps WHERE month = '{month}') USING (pid))"""


_COSTS = f"{_TWO}, {_cost('oc', 'o', OLD[2])}, {_cost('wc', 'w', NEW[2])}"


PERIODS = {dp.OLD: OLD[:2], dp.NEW: NEW[:2]}


def _both_costs(spark, d):
    """Both months in one frame."""
    month = F.col("month")
    period = F.when(month == OLD[2], dp.OLD).when(month == NEW[2], dp.NEW)
    spend = frames.publisher_spend(spark, d).withColumn("period", period).filter("period IS NOT NULL")
    return dp.with_cost(dp.stats_by_period(frames.user_events(spark, d), PERIODS), spend)


def _costs(spark, d, month):
    stats = dp.publisher_stats(frames.user_events(spark, d), *month[:2])
    spend = frames.publisher_spend(spark, d)
    return dp.with_cost(stats, spend.filter(spend.month == month[2]))


@report("dp5_cost_per_deposit", f"""WITH {_COSTS}
SELECT pid publisher_id, n total_deps, ftd, rd, {dbl('rate')} rd_rate, pname publisher_name, fmt "format", {dbl('spend')} spend,
  {dbl('fc')} ftd_cpa, {dbl('rc')} rd_cpa, {dbl('tc')} total_cpa FROM wc""", "ue ps")
def _(spark, d):
    return _costs(spark, d, NEW)


def _both() -> str:
    cols = {"total_deps": "n", "ftd": "ftd", "rd": "rd", "spend": "spend", "ftd_cpa": "fc", "rd_cpa": "rc", "total_cpa": "tc", "rd_rate": "rate"}
    sides = ", ".join(f"coalesce({side}.{c}, 0) {name}_{tag}" for name, c in cols.items() for side, tag in (("oc", "old"), ("wc", "new")))
    grow = lambda c: f"round_even(CAST(({c}_new * 100.0 / CASE WHEN {c}_old = 0 THEN 1 ELSE {c}_old END) - 100 AS DECIMAL(38,10)), 1) {c}_up"
    return f"""j AS (SELECT coalesce(oc.pid, wc.pid) pid, wc.pname, {sides} FROM oc FULL JOIN wc ON oc.pid = wc.pid),
b AS (SELECT *, {grow('spend')}, {grow('total_deps')} FROM j)"""


@report("dp5_cost_comparison", f"""WITH {_COSTS}, {_both()}
SELECT pid publisher_id, pname publisher_name, {', '.join(f'{c}_{t}' for c in ('total_deps', 'ftd', 'rd') for t in ('old', 'new'))},
  {', '.join(f'{dbl(f"{c}_{t}")} {c}_{t}' for c in ('spend', 'ftd_cpa', 'rd_cpa', 'total_cpa', 'rd_rate') for t in ('old', 'new'))},
  {dbl('spend_new - spend_old')} spend_change, {dbl('spend_up')} spend_change_pct, total_deps_new - total_deps_old deps_change,
  {dbl('total_deps_up')} deps_change_pct, {dbl('ftd_cpa_new - ftd_cpa_old')} ftd_cpa_change, {dbl('rd_cpa_new - rd_cpa_old')} rd_cpa_change
FROM b""", "ue ps")
def _(spark, d):
    return dp.compare_costs(_both_costs(spark, d))


def _advice_sql(low: int, mid: int, score: str, n: str, high_n: int, mid_n: int, observe: int | None = None) -> str:
    last = f"WHEN {n} < {observe} THEN 'OBSERVE' " if observe else ""
    return f"""CASE WHEN {score} <= -{mid} AND {n} >= {high_n} THEN 'RAISE_30_50' WHEN {score} <= -{low} AND {n} >= {mid_n} THEN 'RAISE_15_25'
       WHEN {score} >= {mid} AND {n} >= {high_n} THEN 'LOWER_30_50' WHEN {score} >= {low} AND {n} >= {mid_n} THEN 'LOWER_15_25' {last}ELSE 'KEEP' END recommendation,
  CASE WHEN abs({score}) >= {mid} AND {n} >= {high_n} THEN 'HIGH' WHEN abs({score}) >= {low} AND {n} >= {mid_n} THEN 'MEDIUM' ELSE 'LOW' END priority"""


_EFFICIENCY = f"""WITH {_COSTS}, {_both()},
paid AS (SELECT * FROM b WHERE spend_new > 100 AND pid <> 0),
mean AS (SELECT sum(spend_new) / sum(total_deps_new) mt, sum(spend_new) / sum(ftd_new) mf, sum(spend_new) / sum(rd_new) mr FROM paid),
s AS (SELECT paid.*, CAST(((total_cpa_new / mt - 1) * 300 + (ftd_cpa_new / mf - 1) * 100 + (rd_cpa_new / mr - 1) * 100) / 5 AS DECIMAL(38,8)) score
      FROM paid, mean WHERE total_deps_new >= 2)"""
_EFFICIENCY_OUT = f"""SELECT pid publisher_id, pname publisher_name, {dbl('spend_new')} spend_new, total_deps_new, {dbl('total_cpa_new')} total_cpa_new,
  {dbl('ftd_cpa_new')} ftd_cpa_new, {dbl('rd_cpa_new')} rd_cpa_new, {dec('score', 4)} efficiency_score, {dbl('total_deps_up')} deps_change_pct,
  {dbl('ftd_cpa_new - ftd_cpa_old')} ftd_cpa_change, {dbl('rd_cpa_new - rd_cpa_old')} rd_cpa_change,
  {_advice_sql(10, 20, 'score', 'total_deps_new', 5, 3)} FROM s"""


def _efficiency(spark, d):
    both = dp.compare_costs(_both_costs(spark, d))
    return dp.efficiency_advice(both, min_deps=2, high_deps=5, medium_deps=3)


@report("dp6_efficiency_advice", f"{_EFFICIENCY}\n{_EFFICIENCY_OUT}", "ue ps")
def _(spark, d):
    from ..functions import numeric as num

    rows = _efficiency(spark, d)
    return rows.withColumn("efficiency_score", num.half_up(rows.efficiency_score, 4))


@report("dp6_advice_counts", f"""{_EFFICIENCY}, a AS ({_EFFICIENCY_OUT})
SELECT recommendation, priority, count(*) publishers FROM a GROUP BY ALL""", "ue ps")
def _(spark, d):
    return dp.advice_counts(_efficiency(spark, d))


@report("dp6_best_and_worst", f"""{_EFFICIENCY}
SELECT publisher_id, side FROM (
  SELECT pid publisher_id, 'lowest' side, row_number() OVER (ORDER BY score, pid) k FROM s
  UNION ALL SELECT pid, 'highest', row_number() OVER (ORDER BY score DESC, pid) FROM s) WHERE k <= 10""", "ue ps")
def _(spark, d):
    return dp.extremes(_efficiency(spark, d), "efficiency_score", 10).select("publisher_id", "side")


@report("dp6_paid_totals", f"""WITH {_COSTS}, {_both()}
SELECT count(*) publishers, {', '.join(f'{dbl(f"sum(spend_{t})")} spend_{t}' for t in ('new', 'old'))},
  {', '.join(f'{big(f"sum({c}_{t})")} {c}_{t}' for c in ('total_deps', 'ftd', 'rd') for t in ('new', 'old'))}
FROM b WHERE spend_new > 100 AND pid <> 0""", "ue ps")
def _(spark, d):
    return dp.paid_cost_totals(dp.compare_costs(_both_costs(spark, d)))


_FORMAT = f"""WITH {_stats('w', *NEW[:2])}, {_cost('wc', 'w', NEW[2])},
sig AS (SELECT * FROM wc WHERE spend > 50 AND pid <> 0)"""


@report("dp7_format_advice", f"""{_FORMAT},
mean AS (SELECT fmt, sum(spend) / sum(n) m FROM sig WHERE fmt <> 'OTHER' GROUP BY fmt),
s AS (SELECT sig.*, m, CAST((tc / m - 1) * 100 AS DECIMAL(38,8)) score FROM sig JOIN mean USING (fmt))
SELECT fmt "format", pid publisher_id, pname publisher_name, {dbl('spend')} spend, n deps, {dbl('tc')} total_cpa, {dbl('fc')} ftd_cpa, {dbl('rc')} rd_cpa,
  {dbl('rate')} rd_rate, {dec('score', 4)} efficiency_vs_format, {dec('m')} format_avg_cpa, {_advice_sql(15, 25, 'score', 'n', 6, 4, 3)} FROM s""", "ue ps")
def _(spark, d):
    from ..functions import numeric as num

    rows = dp.format_advice(_costs(spark, d, NEW), high_deps=6, medium_deps=4, observe_below=3)
    return rows.withColumn("efficiency_vs_format", num.half_up(rows.efficiency_vs_format, 4))


@report("dp7_advice_counts", f"""{_FORMAT},
mean AS (SELECT fmt, sum(spend) / sum(n) m FROM sig WHERE fmt <> 'OTHER' GROUP BY fmt),
s AS (SELECT sig.*, CAST((tc / m - 1) * 100 AS DECIMAL(38,8)) score FROM sig JOIN mean USING (fmt)),
a AS (SELECT fmt, {_advice_sql(15, 25, 'score', 'n', 6, 4, 3)} FROM s)
SELECT fmt "format", recommendation, priority, count(*) publishers FROM a GROUP BY ALL""", "ue ps")
def _(spark, d):
    return dp.advice_counts(dp.format_advice(_costs(spark, d, NEW), high_deps=6, medium_deps=4, observe_below=3), ["format"])


@report("dp8_format_summary", f"""{_FORMAT},
g AS (SELECT fmt, count(*) k, round_even(sum(spend), 0) sp, sum(n) n, sum(ftd) ftd, sum(rd) rd FROM sig GROUP BY fmt)
SELECT fmt "format", k publishers, {dbl('sp')} total_spend, {big('n')} total_deps, {big('ftd')} ftd, {big('rd')} rd, {even('sp / n', 3)} avg_total_cpa,
  {even('sp / nullif(ftd, 0)', 2)} avg_ftd_cpa, {even('sp / nullif(rd, 0)', 4)} avg_rd_cpa, {even('rd * 100.0 / n', 1)} rd_rate FROM g""", "ue ps")
def _(spark, d):
    return dp.format_summary(_costs(spark, d, NEW))

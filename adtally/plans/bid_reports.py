"""Target cost, bid coefficients and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as num
from ..operators import bids, deposit_types as dp
from . import frames
from .registry import big, dbl, dec, even, report

MONTH = "1997-11"
NO_MARKER = "NOT (upper(pname) LIKE '%PLR%' OR upper(pname) LIKE '%NOR%')"


def _target(name: str, src: str, keys: str = "fmt") -> str:
    """Target per key: the marked publishers' cost if they have any, else everyone's."""
    return f"""marked_{name} AS (SELECT {keys}, sum(spend) / sum(deps) c FROM {src} WHERE NOT ({NO_MARKER}) GROUP BY {keys} HAVING sum(deps) > 0 AND sum(spend) > 0),
every_{name} AS (SELECT {keys}, CASE WHEN sum(deps) > 0 THEN sum(spend) / sum(deps) END c FROM {src} GROUP BY {keys}),
{name} AS (SELECT {keys}, CAST(0.7 * coalesce(m.c, e.c) AS DECIMAL(38,10)) t, CASE WHEN m.c IS NOT NULL THEN 'reference' WHEN e.c IS NOT NULL THEN 'all' ELSE 'none' END src
           FROM every_{name} e LEFT JOIN marked_{name} m USING ({keys}))"""


_COEF = "CAST(CASE WHEN cpa > 0 AND t > 0 THEN greatest(least(t / cpa, 3.0), 0.1) ELSE 1 END AS DECIMAL(38,10))"
_LABEL = """CASE WHEN NOT (cpa > 0 AND coalesce(t, 0) > 0) THEN 'NO_DATA' WHEN k >= 1.3 THEN 'RAISE' WHEN k >= 1.1 THEN 'RAISE_SLIGHTLY'
  WHEN k >= 0.9 THEN 'KEEP' WHEN k >= 0.7 THEN 'LOWER_SLIGHTLY' WHEN k >= 0.4 THEN 'LOWER' ELSE 'DISABLE' END"""
_OUT = f"""pid publisher_id, pname publisher_name, fmt "format", {dbl('spend')} spend, {dbl('cpa')} current_cpa,
  {dec('coalesce(t, 0)', 4)} target_cpa_format, {dec('k', 4)} coefficient, {dec('(k - 1) * 100', 4)} change_pct, {_LABEL} recommendation"""


def _shown(rows):
    """Fractions to four places."""
    return rows.withColumns({c: num.half_up(F.col(c), 4) for c in ("target_cpa_format", "coefficient", "change_pct")})


@report("bd1_target_cpa", f"""WITH p AS (SELECT * FROM ps WHERE month = '{MONTH}' AND pid <> 0 AND spend >= 50), {_target('tg', 'p')}
SELECT fmt "format", {dec('t')} target_cpa, src target_source FROM tg""", "ps")
def _(spark, d):
    return bids.target_cpa(bids.period_spend(frames.publisher_spend(spark, d), "month", MONTH, MONTH))


@report("bd2_coefficients_month", f"""WITH p AS (SELECT * FROM ps WHERE month BETWEEN '{MONTH}' AND '1998-01' AND pid <> 0 AND spend >= 50), {_target('tg', 'p')},
r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt))
SELECT month, deps deposits_reported, {_OUT} FROM r""", "ps")
def _(spark, d):
    return _shown(bids.coefficients(bids.period_spend(frames.publisher_spend(spark, d), "month", MONTH, "1998-01")))


@report("bd2_coefficients_null_key", f"""WITH p AS (SELECT * REPLACE (CASE WHEN fmt <> 'OTHER' THEN fmt END AS fmt) FROM ps WHERE month = '{MONTH}' AND pid <> 0),
{_target('tg', 'p')}, r AS (SELECT * REPLACE (CASE WHEN src = 'reference' OR NOT EXISTS (SELECT 1 FROM marked_tg WHERE fmt IS NULL) THEN t END AS t) FROM p LEFT JOIN tg USING (fmt)), q AS (SELECT *, {_COEF} k FROM r)
SELECT month, deps deposits_reported, {_OUT} FROM q""", "ps")
def _(spark, d):
    spend = bids.period_spend(frames.publisher_spend(spark, d), "month", MONTH, MONTH, min_spend=None)
    spend = spend.withColumn("format", F.nullif("format", F.lit("OTHER")))
    return _shown(bids.coefficients(spend, null_key_blocks=True))


@report("bd3_coefficients_day", f"""WITH p AS (SELECT * FROM pd WHERE date BETWEEN DATE '1997-11-01' AND DATE '1997-11-30' AND pid <> 0 AND spend >= 50), {_target('tg', 'p')},
r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt))
SELECT date, deps deposits_reported, {_OUT} FROM r""", "pd")
def _(spark, d):
    return _shown(bids.coefficients(bids.period_spend(frames.publisher_spend_daily(spark, d), "date", "1997-11-01", "1997-11-30")))


@report("bd3_coefficients_day_open_range", f"""WITH p AS (SELECT * FROM pd WHERE pid <> 0 AND spend >= 50), {_target('tg', 'p')},
r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt)) SELECT date, deps deposits_reported, {_OUT} FROM r""", "pd")
def _(spark, d):
    return _shown(bids.coefficients(bids.period_spend(frames.publisher_spend_daily(spark, d), "date")))


_MODE = """mode_brand AS (SELECT pid, month, adv FROM (SELECT pid, strftime(ts, '%Y-%m') AS month, adv, count(*) n FROM ue
  WHERE adv IS NOT NULL AND pid <> 0 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY pid, month ORDER BY n DESC, adv) = 1)"""
_BRANDED = f"""{_MODE}, p AS (SELECT ps.*, coalesce(adv, CASE WHEN month < '2000-01' THEN 'brand_a' ELSE 'Unknown' END) brand
  FROM ps LEFT JOIN mode_brand USING (pid, month) WHERE pid <> 0)"""


@report("att11_publisher_month_brand", f"WITH {_MODE} SELECT pid publisher_id, month, adv advertiser FROM mode_brand", "ue")
def _(spark, d):
    return bids.publisher_month_brand(frames.user_events(spark, d))


@report("bd4_coefficients_brand", f"""WITH {_BRANDED}, {_target('tg', 'p', 'fmt, brand')}, r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt, brand))
SELECT month, brand, deps deposits_reported, {_OUT} FROM r""", "ue ps")
def _(spark, d):
    return _shown(bids.coefficients_by_brand(frames.publisher_spend(spark, d), frames.user_events(spark, d), "2000-01", "brand_a"))


_SEEN = """seen AS (SELECT pid, count(*) n, count(*) FILTER (WHERE ts = f) ftd, count(*) FILTER (WHERE ts > f) rd
  FROM (SELECT *, min(ts) OVER (PARTITION BY uid) f FROM ue) WHERE strftime(ts, '%Y-%m') = '1997-11' GROUP BY pid)"""


def _month(spark, d):
    spend = frames.publisher_spend(spark, d).filter(F.col("month") == MONTH)
    return spend, dp.publisher_stats(frames.user_events(spark, d), "1997-11-01", "1997-11-30")


@report("bd5_coefficients_with_deposits", f"""WITH p AS (SELECT * FROM ps WHERE month = '{MONTH}'), {_target('tg', 'p')}, {_SEEN},
r AS (SELECT p.*, t, coalesce(n, 0) n, coalesce(ftd, 0) ftd, coalesce(rd, 0) rd, {_COEF} k
      FROM p LEFT JOIN tg USING (fmt) LEFT JOIN seen USING (pid) WHERE spend > 50 AND pid <> 0)
SELECT month, deps deposits_reported, n total_deps, ftd, rd, {_OUT} FROM r""", "ue ps")
def _(spark, d):
    return _shown(bids.coefficients_with_deposits(*_month(spark, d)))


@report("bd5_coefficients_spend_only", f"""WITH p AS (SELECT * FROM ps WHERE month = '{MONTH}' AND pid <> 0 AND spend > 50), {_target('tg', 'p')},
r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt)) SELECT month, deps deposits_reported, {_OUT} FROM r""", "ps")
def _(spark, d):
    return _shown(bids.coefficients(bids.period_spend(frames.publisher_spend(spark, d), "month", MONTH, MONTH, 50, above=True)))


_ROUNDED = f"""WITH p AS (SELECT * FROM ps WHERE month = '{MONTH}'), {_target('tg', 'p')}, {_SEEN},
j AS (SELECT pid, n, pname, coalesce(fmt, 'OTHER') fmt, coalesce(spend, 0) spend, coalesce(cpa, 0) cpa FROM seen LEFT JOIN p USING (pid)),
r AS (SELECT j.*, coalesce(CASE WHEN fmt <> 'OTHER' THEN t END, 0) t FROM j LEFT JOIN tg USING (fmt)),
c AS (SELECT *, round_even({_COEF}, 3) k FROM r),
sig AS (SELECT *, CASE WHEN k >= 1.3 THEN 'RAISE' WHEN k >= 1.1 THEN 'RAISE_SLIGHTLY' WHEN k >= 0.9 THEN 'KEEP' WHEN k >= 0.7 THEN 'LOWER_SLIGHTLY' ELSE 'LOWER' END act
        FROM c WHERE spend > 50 AND pid <> 0 AND fmt <> 'OTHER')"""


def _rounded(spark, d):
    return bids.rounded_coefficients(*_month(spark, d))


@report("bd6_free_reference", f"""WITH p AS (SELECT *, CASE WHEN pid = 7 THEN 0 ELSE spend END sp FROM ps),
m AS (SELECT fmt, month, sum(sp) / sum(deps) c FROM p WHERE NOT ({NO_MARKER}) GROUP BY ALL HAVING sum(deps) > 0),
e AS (SELECT fmt, month, CASE WHEN sum(deps) > 0 THEN sum(sp) / sum(deps) END c FROM p GROUP BY ALL)
SELECT fmt "format", e.month, {dec('0.7 * coalesce(m.c, e.c)')} target_cpa,
  CASE WHEN m.c IS NOT NULL THEN 'reference' WHEN e.c IS NOT NULL THEN 'all' ELSE 'none' END target_source
FROM e LEFT JOIN m USING (fmt, month)""", "ps")
def _(spark, d):
    """A marked publisher without spend keeps its group as the reference, with a target of zero."""
    spend = frames.publisher_spend(spark, d)
    free = spend.withColumn("spend", F.when(F.col("publisher_id") != 7, F.col("spend")).otherwise(F.lit(0).cast("decimal(15,2)")))
    return bids.target_cpa(free, ("format", "month"), keep_free_reference=True)


@report("bd6_rounded_coefficients", f"""{_ROUNDED}
SELECT fmt "format", pid publisher_id, n total_deps, pname publisher_name, {dbl('spend')} spend, {dbl('cpa')} current_cpa, {dec('t')} target_cpa_format,
  {dbl('k')} coefficient, {even('(k - 1) * 100', 1)} change_pct, CASE WHEN k >= 1.3 THEN 'RAISE' WHEN k >= 1.1 THEN 'RAISE_SLIGHTLY'
  WHEN k >= 0.9 THEN 'KEEP' WHEN k >= 0.7 THEN 'LOWER_SLIGHTLY' ELSE 'LOWER' END recommendation FROM c""", "ue ps")
def _(spark, d):
    return _rounded(spark, d)


@report("bd6_format_overview", f"""{_ROUNDED}, g AS (SELECT fmt, max(t) t, sum(spend) / sum(n) a, count(*) k, count(*) FILTER (WHERE act = 'RAISE') c1,
  count(*) FILTER (WHERE act = 'RAISE_SLIGHTLY') c2, count(*) FILTER (WHERE act = 'KEEP') c3, count(*) FILTER (WHERE act = 'LOWER_SLIGHTLY') c4,
  count(*) FILTER (WHERE act = 'LOWER') c5 FROM sig GROUP BY fmt)
SELECT fmt "format", {dec('t')} target_cpa, {dec('a')} avg_cpa, k publishers, c1 raise, c2 raise_slightly, c3 keep, c4 lower_slightly, c5 lower,
  {dec('(t / a - 1) * 100', 4)} change_pct FROM g""", "ue ps")
def _(spark, d):
    rows = bids.format_overview(bids.significant(_rounded(spark, d)))
    return rows.withColumn("change_pct", num.half_up(rows.change_pct, 4))


@report("bd6_format_extremes", f"""{_ROUNDED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY fmt ORDER BY k DESC, pid) hi,
  row_number() OVER (PARTITION BY fmt ORDER BY k, pid) lo FROM sig)
SELECT 'raise' side, fmt "format", hi "rank", pid publisher_id, pname publisher_name, {dbl('k')} coefficient, {even('(k - 1) * 100', 1)} change_pct
FROM ranked WHERE hi <= 5 AND k >= 1.1 UNION ALL
SELECT 'lower', fmt, lo, pid, pname, {dbl('k')}, {even('(k - 1) * 100', 1)} FROM ranked WHERE lo <= 5 AND k < 0.9""", "ue ps")
def _(spark, d):
    return bids.format_extremes(bids.significant(_rounded(spark, d)))


@report("bd7_coefficients_all_months", f"""WITH p AS (SELECT * FROM ps WHERE pid <> 0 AND spend >= 50), {_target('tg', 'p')},
r AS (SELECT *, {_COEF} k FROM p LEFT JOIN tg USING (fmt)) SELECT month, deps deposits_reported, {_OUT} FROM r""", "ps")
def _(spark, d):
    return _shown(bids.coefficients(bids.period_spend(frames.publisher_spend(spark, d), "month")))

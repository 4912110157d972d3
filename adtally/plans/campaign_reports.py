"""Campaign sheets with one-hour and 24-hour attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaigns as cm
from . import frames
from .registry import big, dbl, dec, report

_SUMS = f"""count(*) records_count, {big('sum(views)')} total_views, {big('sum(clicks)')} total_clicks, {dbl('sum(spend)')} total_spend,
  {big('sum(postview)')} total_postview, {big('sum(postclick)')} total_postclick"""
_MEANS = f"{dec('avg(cpa_pv)')} avg_cpa_pv, {dec('avg(cpa_pc)')} avg_cpa_pc"
_KEYS = 'fmt "format", cname campaign_name, cid campaignid, etype event_type'


@report("cm1_cleaned_numbers", f"""SELECT sheet source_sheet_id, attr attribution_type, cid campaignid, ts event_date, {dbl('spend')} spend, {dbl('cpa_pv')} cpa_pv,
  {dbl('cpa_pc')} cpa_pc, {dbl('tot')} total_spend, {dbl('tot')} total_cpa FROM cp""", "cp")
def _(spark, d):
    return cm.cleaned(frames.campaigns(spark, d)).select(
        "source_sheet_id", "attribution_type", "campaignid", "event_date", "spend", "cpa_pv", "cpa_pc", "total_spend", "total_cpa")


@report("cm2_daily_totals", f"""SELECT CAST(ts AS DATE) event_date, attr attribution_type, {_KEYS}, sheet source_sheet_id, {_SUMS}, {_MEANS}
FROM cp GROUP BY CAST(ts AS DATE), attr, fmt, cname, cid, etype, sheet""", "cp")
def _(spark, d):
    return cm.daily_totals(frames.campaigns(spark, d))


for _attr in cm.ATTRIBUTIONS:
    @report(f"cm2_daily_totals_{_attr}", f"""SELECT CAST(ts AS DATE) event_date, {_KEYS}, sheet source_sheet_id, {_SUMS}, {_MEANS}
FROM cp WHERE attr = '{_attr}' GROUP BY CAST(ts AS DATE), fmt, cname, cid, etype, sheet""", "cp")
    def _(spark, d, attr=_attr):
        return cm.daily_totals(frames.campaigns(spark, d), attr)


@report("cm3_attribution_comparison", f"""SELECT attr attribution_type, cname campaign_name, cid campaignid, fmt "format", {_SUMS}, {_MEANS},
  min(CAST(ts AS DATE)) min_date, max(CAST(ts AS DATE)) max_date FROM cp GROUP BY attr, cname, cid, fmt""", "cp")
def _(spark, d):
    return cm.attribution_comparison(frames.campaigns(spark, d))


def _per(total: str, column: str, factor: int = 1) -> str:
    return dec(f"sum({total}) * {factor} / nullif(sum({column}), 0)", 2)


@report("cm4_analysis", f"""SELECT CAST(ts AS DATE) event_date, attr attribution_type, {_KEYS}, sheet source_sheet_id, {_SUMS},
  {dec('avg(cpa_pv)', 2)} avg_cpa_pv, {dec('avg(cpa_pc)', 2)} avg_cpa_pc, {dbl('sum(coalesce(tot, 0))')} total_spend_aggregated, {dec('avg(tot)', 2)} avg_total_cpa,
  {_per('spend', 'clicks')} cpc, {_per('spend', 'views', 1000)} cpm, {_per('views', 'clicks')} views_per_click, {_per('views', 'clicks')} ctr_as_reported,
  {_per('spend', 'postview')} calculated_cpa_pv, {_per('spend', 'postclick')} calculated_cpa_pc
FROM cp GROUP BY CAST(ts AS DATE), attr, fmt, cname, cid, etype, sheet""", "cp")
def _(spark, d):
    return cm.analysis(frames.campaigns(spark, d))


@report("cm4_simple_analysis", f"""SELECT CAST(ts AS DATE) event_date, attr attribution_type, {_KEYS}, {_SUMS}, {_per('spend', 'clicks')} cpc,
  {_per('spend', 'views', 1000)} cpm, {_per('views', 'clicks')} views_per_click, {_per('views', 'clicks')} ctr_as_reported, {_per('spend', 'postview')} cpa_pv
FROM cp GROUP BY CAST(ts AS DATE), attr, fmt, cname, cid, etype""", "cp")
def _(spark, d):
    return cm.simple_analysis(frames.campaigns(spark, d))


@report("cm5_regrouped_metrics", f"""SELECT attr attribution_type, fmt "format", {dbl('sum(spend)')} total_spend, {big('sum(clicks)')} total_clicks,
  {big('sum(views)')} total_views, {big('sum(postview)')} total_postview, {big('sum(postclick)')} total_postclick,
  {dec('sum(spend) / sum(clicks)')} cpc, {dec('sum(spend) * 1000 / sum(views)')} cpm, {dec('sum(views) / sum(clicks)')} views_per_click,
  {dec('sum(spend) / sum(postview)')} cpa_postview, {dec('sum(spend) / sum(postclick)')} cpa_postclick FROM cp GROUP BY attr, fmt""", "cp")
def _(spark, d):
    names = [n for n in cm.metrics() if not n.startswith("avg_")]
    return cm.regroup(cm.daily_totals(frames.campaigns(spark, d)), ["attribution_type", "format"], names)


@report("cm5_mean_of_daily_means", f"""WITH t AS (SELECT attr, CAST(ts AS DATE) dd, fmt, cname, cid, etype, sheet, avg(cpa_pv) v, avg(cpa_pc) c FROM cp GROUP BY ALL)
SELECT attr attribution_type, {dec('avg(v)', 4)} avg_cpa_pv, {dec('avg(c)', 4)} avg_cpa_pc FROM t GROUP BY attr""", "cp")
def _(spark, d):
    rows = cm.regroup(cm.daily_totals(frames.campaigns(spark, d)), ["attribution_type"], ["avg_cpa_pv", "avg_cpa_pc"])
    return rows.select("attribution_type", *[F.round(c, 4).alias(c) for c in ("avg_cpa_pv", "avg_cpa_pc")])

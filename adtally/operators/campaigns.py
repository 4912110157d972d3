"""Campaign sheets with one-hour and 24-hour attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric as num

ATTRIBUTIONS = ["1_hour", "24_hours"]  # fixed values
DAILY_KEYS = ["attribution_type", "format", "campaign_name", "campaignid", "event_type", "source_sheet_id"]


def cleaned(campaigns: DataFrame, strict: bool = True) -> DataFrame:
    """Usable rows with their text numbers parsed: no spend is 0, no cost is NULL.

    ``strict`` raises on text that is no number; otherwise it counts as missing.
    """
    number = lambda name, **kw: num.text_number(F.col(name), strict=strict, **kw)
    rows = campaigns.filter(F.col("event_date").isNotNull() & F.col("campaign_name").isNotNull())
    return rows.withColumns({
        "spend": number("spend", blank=F.lit(0)),
        "cpa_pv": number("cpa_pv", infinite_as_null=True),
        "cpa_pc": number("cpa_pc", infinite_as_null=True),
        "total_spend": number("total_spend"),
        "total_cpa": number("total_cpa", infinite_as_null=not strict),
    })


def _total(column: str) -> Column:
    return F.sum(F.coalesce(column, F.lit(0)))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("records_count"), _total("views").alias("total_views"),
            _total("clicks").alias("total_clicks"), F.sum("spend").alias("total_spend"),
            _total("postview").alias("total_postview"), _total("postclick").alias("total_postclick")]


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(column), F.count(column)).cast(num.TEXT_NUMBER)


def daily_totals(campaigns: DataFrame, attribution: str | None = None, strict: bool = True) -> DataFrame:
    """Sums per day, campaign, format, event type and sheet, for one attribution or all."""
    rows, keys = cleaned(campaigns, strict), DAILY_KEYS
    if attribution is not None:
        rows, keys = rows.filter(F.col("attribution_type") == attribution), DAILY_KEYS[1:]
    return rows.groupBy(F.to_date("event_date").alias("event_date"), *keys).agg(
        *_sums(), _mean("cpa_pv").alias("avg_cpa_pv"), _mean("cpa_pc").alias("avg_cpa_pc"),
    ).orderBy(F.desc("event_date"), F.desc_nulls_last("total_spend"))


def attribution_comparison(campaigns: DataFrame, strict: bool = True) -> DataFrame:
    """One row per campaign and attribution over the whole time."""
    rows = cleaned(campaigns, strict).filter(F.col("attribution_type").isin(ATTRIBUTIONS))
    day = F.to_date("event_date")
    return rows.groupBy("attribution_type", "campaign_name", "campaignid", "format").agg(
        *_sums(), _mean("cpa_pv").alias("avg_cpa_pv"), _mean("cpa_pc").alias("avg_cpa_pc"),
        F.min(day).alias("min_date"), F.max(day).alias("max_date"),
    ).orderBy("attribution_type", F.desc_nulls_last("total_spend"))


def _per(column: str, factor: int = 1) -> Column:
    """Spend per unit of ``column`` times ``factor``, to cents; NULL without units."""
    exact = num.ratio(F.col("total_spend") * factor, F.col(column))
    return F.when(F.col(column) > 0, num.half_up(exact, 2))


def _views_per_click() -> Column:
    return F.when(F.col("total_clicks") > 0,
                  num.half_up(num.ratio(F.col("total_views"), F.col("total_clicks")), 2))


def analysis(campaigns: DataFrame, strict: bool = True) -> DataFrame:
    """Daily totals with cost per click, per thousand views and per conversion.

    ``views_per_click`` is also given as ``ctr_as_reported``: the reports call it CTR
    although a click-through rate is its inverse.
    """
    mean = lambda column, name: num.half_up(_mean(column), 2).alias(name)
    sums = cleaned(campaigns, strict).groupBy(F.to_date("event_date").alias("event_date"), *DAILY_KEYS).agg(
        *_sums(), mean("cpa_pv", "avg_cpa_pv"), mean("cpa_pc", "avg_cpa_pc"),
        F.sum(F.coalesce("total_spend", F.lit(0))).alias("total_spend_aggregated"), mean("total_cpa", "avg_total_cpa"))
    return sums.withColumns({
        "cpc": _per("total_clicks"), "cpm": _per("total_views", 1000),
        "views_per_click": _views_per_click(), "ctr_as_reported": _views_per_click(),
        "calculated_cpa_pv": _per("total_postview"), "calculated_cpa_pc": _per("total_postclick"),
    }).orderBy(F.desc("event_date"), "attribution_type", "format", "campaign_name")


def simple_analysis(campaigns: DataFrame, strict: bool = True) -> DataFrame:
    """Daily totals over all sheets with the main cost metrics."""
    keys = [k for k in DAILY_KEYS if k != "source_sheet_id"]
    sums = cleaned(campaigns, strict).groupBy(F.to_date("event_date").alias("event_date"), *keys).agg(*_sums())
    return sums.withColumns({
        "cpc": _per("total_clicks"), "cpm": _per("total_views", 1000),
        "views_per_click": _views_per_click(), "ctr_as_reported": _views_per_click(),
        "cpa_pv": _per("total_postview"),
    }).orderBy(F.desc("event_date"), F.desc_nulls_last("total_spend"))


def _safe(numerator: str, denominator: str, factor: int = 1) -> Column:
    return num.ratio(F.sum(numerator) * factor, F.sum(denominator))


def metrics() -> dict[str, Column]:
    """Metric expressions that stay right when daily totals are grouped again."""
    return {
        **{name: F.sum(name) for name in
           ("total_spend", "total_clicks", "total_views", "total_postview", "total_postclick")},
        "cpc": _safe("total_spend", "total_clicks"),
        "cpm": _safe("total_spend", "total_views", 1000),
        "views_per_click": _safe("total_views", "total_clicks"),
        "cpa_postview": _safe("total_spend", "total_postview"),
        "cpa_postclick": _safe("total_spend", "total_postclick"),
        "avg_cpa_pv": _mean("avg_cpa_pv"),
        "avg_cpa_pc": _mean("avg_cpa_pc"),
    }


def regroup(totals: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Group daily totals by fewer keys with the chosen metrics."""
    chosen = metrics()
    return totals.groupBy(*keys).agg(*[chosen[n].alias(n) for n in (names or chosen)])

"""Target cost per deposit, bid coefficients and recommendations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric as num
from ..functions.rules import steps
from ..functions.text import FORMATS, OTHER, is_reference_name
from .common import most_frequent, paid_only, top_k_per_group

# Share of the reference cost aimed at, and the limits of a coefficient.
TARGET_SHARE, LOWEST, HIGHEST = "0.7", "0.1", "3.0"

# Recommendation by the highest threshold reached.
SIX_LEVELS = [("1.3", "RAISE"), ("1.1", "RAISE_SLIGHTLY"), ("0.9", "KEEP"), ("0.7", "LOWER_SLIGHTLY"), ("0.4", "LOWER")]
BELOW_SIX = "DISABLE"
FIVE_LEVELS = SIX_LEVELS[:4]
BELOW_FIVE = "LOWER"
NO_DATA = "NO_DATA"


def period_spend(spend: DataFrame, period: str, start: str | None = None, end: str | None = None,
                 min_spend: float | None = 50, above: bool = False) -> DataFrame:
    """Paid spend rows of a period, from a minimum spend on (or strictly above it).

    ``period`` names the month (text) or date column; an omitted bound is open.
    """
    rows = paid_only(spend)
    if start is not None:
        rows = rows.filter(F.col(period) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(period) <= F.lit(end))
    if min_spend is not None:
        rows = rows.filter(F.col("spend") > min_spend if above else F.col("spend") >= min_spend)
    return rows


def _all(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def target_cpa(spend: DataFrame, keys: Sequence[str] = ("format",), markers: Sequence[str] = ("PLR", "NOR"),
               null_key_blocks: bool = False, keep_free_reference: bool = False) -> DataFrame:
    """Target cost per deposit by key, from the reference group or else from all publishers.

    One aggregation with conditional sums.  ``keep_free_reference`` lets a reference group with
    deposits but no spend stand, with a target of zero.  ``null_key_blocks`` repeats what a SQL
    ``NOT IN`` does with reference groups that lack part of their key: a key that agrees
    with one in the rest does not fall back to all publishers.
    """
    keys = list(keys)
    marked = is_reference_name(F.col("publisher_name"), markers)
    when = lambda column: F.sum(F.when(marked, F.col(column)))
    sums = spend.groupBy(*keys).agg(
        when("spend").alias("_rs"), when("deposits_reported").alias("_rd"),
        F.sum("spend").alias("_s"), F.sum("deposits_reported").alias("_d"))
    share = F.lit(TARGET_SHARE).cast("decimal(2,1)")
    aim = lambda cost, deposits: F.when(deposits > 0, num.ratio(cost * share, deposits))
    paid = F.col("_rs") if keep_free_reference else F.when(F.col("_rs") > 0, F.col("_rs"))
    sums = sums.withColumns({"_reference": aim(paid, F.col("_rd")), "_everyone": aim(F.col("_s"), F.col("_d"))})
    fallback = F.col("_everyone")
    if null_key_blocks:
        blocked = F.lit(False)
        references = sums.filter(F.col("_reference").isNotNull())
        for size in range(len(keys)):
            for known in combinations(keys, size):
                lacking = references.filter(_all(F.col(k).isNotNull() == (k in known) for k in keys))
                if not known:
                    blocked = blocked | lacking.agg((F.count(F.lit(1)) > 0).alias("b")).scalar()
                    continue
                flag = "_blocked_" + "_".join(known)
                sums = sums.join(lacking.select(*known).distinct().withColumn(flag, F.lit(True)), list(known), "left")
                blocked = blocked | F.coalesce(F.col(flag), F.lit(False))
        fallback = F.when(~blocked, fallback)
    target = F.coalesce(F.col("_reference"), fallback)
    source = F.when(F.col("_reference").isNotNull(), "reference").when(target.isNotNull(), "all")
    return sums.select(*keys, target.alias("target_cpa"), source.otherwise("none").alias("target_source"))


def _decide(rows: DataFrame) -> DataFrame:
    """Add coefficient, change and recommendation from target and current cost."""
    target, current = F.col("target_cpa_format"), F.col("current_cpa")
    known = (current > 0) & (target > 0)
    one = F.lit(1).cast("decimal(28,10)")
    coefficient = F.when(known, num.clamp(num.ratio(target, current), LOWEST, HIGHEST)).otherwise(one)
    rows = rows.withColumn("coefficient", coefficient)
    label = F.when(known, steps(F.col("coefficient"), SIX_LEVELS, BELOW_SIX)).otherwise(NO_DATA)
    change = ((F.col("coefficient") - 1) * 100).cast("decimal(18,8)")
    return rows.withColumns({"change_pct": change, "recommendation": label})


def coefficients(spend: DataFrame, keys: Sequence[str] = ("format",), null_key_blocks: bool = False) -> DataFrame:
    """Bid coefficient per spend row: target of its key over its own cost, within limits.

    Targets pool all rows given, whatever their day or month.
    """
    targets = target_cpa(spend, keys, null_key_blocks=null_key_blocks).drop("target_source")
    zero = F.lit(0).cast("decimal(28,10)")
    joined = spend.join(targets, list(keys), "left").withColumn("target_cpa_format", F.coalesce("target_cpa", zero))
    return _decide(joined.drop("target_cpa"))


def publisher_month_brand(events: DataFrame) -> DataFrame:
    """The most frequent brand of each publisher and month."""
    rows = paid_only(events).filter(F.col("advertiser").isNotNull())
    monthly = rows.select("publisher_id", F.date_format("event_date", "yyyy-MM").alias("month"), "advertiser")
    return most_frequent(monthly, ["publisher_id", "month"], "advertiser")


def with_brand(spend: DataFrame, events: DataFrame, before_month: str, default_brand: str,
               unknown: str = "Unknown") -> DataFrame:
    """Monthly paid spend with a brand: observed, else the default before ``before_month``."""
    fallback = F.when(F.col("month") < before_month, default_brand).otherwise(unknown)
    return (paid_only(spend).join(publisher_month_brand(events), ["publisher_id", "month"], "left")
            .withColumn("brand", F.coalesce("advertiser", fallback)).drop("advertiser"))


def coefficients_by_brand(spend: DataFrame, events: DataFrame, before_month: str, default_brand: str) -> DataFrame:
    """Coefficients by month, with targets per format and brand and no minimum spend."""
    return coefficients(with_brand(spend, events, before_month, default_brand), ("format", "brand"))


def coefficients_with_deposits(spend: DataFrame, stats: DataFrame, min_spend: float = 50) -> DataFrame:
    """One month of coefficients with the deposits seen in the events.

    Targets pool all rows of the month, also organic and small ones; only publishers
    above ``min_spend`` are listed, so the join needs to keep the spend side only.
    """
    targets = target_cpa(spend).drop("target_source")
    zero = F.lit(0).cast("decimal(28,10)")
    listed = paid_only(spend).filter(F.col("spend") > min_spend).withColumn("format", F.coalesce("format", F.lit(OTHER)))
    rows = (listed.join(stats.select("publisher_id", "total_deps", "ftd", "rd"), "publisher_id", "left")
            .na.fill(0, ["total_deps", "ftd", "rd"])
            .join(targets, "format", "left")
            .withColumn("current_cpa", F.coalesce("current_cpa", F.lit(0)))
            .withColumn("target_cpa_format", F.coalesce("target_cpa", zero)))
    return _decide(rows.drop("target_cpa"))


# --- the rounded variant over observed deposits ------------------------------


def rounded_coefficients(spend: DataFrame, stats: DataFrame, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Coefficients to three decimals with five labels, one row per publisher with deposits.

    Only the listed formats have a target.
    """
    targets = target_cpa(spend, keep_free_reference=True).filter(F.col("format").isin(*formats)).drop("target_source")
    zero = F.lit(0).cast("decimal(28,10)")
    month = spend.select("publisher_id", "publisher_name", "format", "spend", "current_cpa")
    rows = (
        stats.select("publisher_id", "total_deps").join(month, "publisher_id", "left")
        .withColumns({"format": F.coalesce("format", F.lit(OTHER)),
                      "spend": F.coalesce("spend", F.lit(0)), "current_cpa": F.coalesce("current_cpa", F.lit(0))})
        .join(targets, "format", "left")
        .withColumn("target_cpa_format", F.coalesce("target_cpa", zero)).drop("target_cpa"))
    target, current = F.col("target_cpa_format"), F.col("current_cpa")
    raw = F.when((current == 0) | (target == 0), F.lit(1).cast("decimal(28,10)")).otherwise(
        num.clamp(num.ratio(target, current), LOWEST, HIGHEST))
    rows = rows.withColumn("coefficient", num.half_even(raw, 3))
    coefficient = F.col("coefficient")
    return rows.withColumns({
        "change_pct": num.half_even((coefficient - 1) * 100, 1),
        "recommendation": steps(coefficient, FIVE_LEVELS, BELOW_FIVE)})


def significant(rows: DataFrame, min_spend: float = 50, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Paid publishers of the listed formats above a spend."""
    return paid_only(rows).filter((F.col("spend") > min_spend) & F.col("format").isin(*formats))


def format_overview(rows: DataFrame) -> DataFrame:
    """Target and average cost per format, the distance between them, and label counts."""
    labels = [label for _, label in FIVE_LEVELS] + [BELOW_FIVE]
    average = num.ratio_or_zero(F.sum("spend"), F.sum("total_deps"))
    sums = rows.groupBy("format").agg(
        F.max("target_cpa_format").alias("target_cpa"), average.alias("avg_cpa"),
        F.count(F.lit(1)).alias("publishers"),
        *[F.count_if(F.col("recommendation") == label).alias(label.lower()) for label in labels])
    off = num.percent(F.col("target_cpa"), F.col("avg_cpa")) - 100
    change = F.when(F.col("avg_cpa") > 0, off).otherwise(0).cast("decimal(28,8)")
    return sums.withColumn("change_pct", change).orderBy("format")


def format_extremes(rows: DataFrame, k: int = 5) -> DataFrame:
    """Up to ``k`` publishers per format worth a higher bid, and up to ``k`` worth a lower one."""
    columns = ["side", "format", "rank", "publisher_id", "publisher_name", "coefficient", "change_pct"]

    def side(name: str, order: Column, worth: Column) -> DataFrame:
        best = top_k_per_group(rows, ["format"], [order, F.col("publisher_id")], k)
        return best.filter(worth).withColumn("side", F.lit(name)).select(*columns)

    coefficient = F.col("coefficient")
    raised = side("raise", F.desc("coefficient"), coefficient >= F.lit("1.1").cast("decimal(2,1)"))
    lowered = side("lower", F.asc("coefficient"), coefficient < F.lit("0.9").cast("decimal(2,1)"))
    return raised.unionByName(lowered)

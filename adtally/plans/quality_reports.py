"""Data-quality checks, brand backfill and format checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import attribution as at, quality as dq
from . import frames
from .registry import big, dbl, dec, report


def _all_events(spark, d):
    return frames.behaviour_events(spark, d)


@report("dq1_overview", """SELECT 'overall' info_type, CAST(min(ts) AS DATE) min_date, CAST(max(ts) AS DATE) max_date, count(*) total_events,
  count(DISTINCT uid) unique_users, count(DISTINCT CAST(ts AS DATE)) unique_days FROM be""", "be")
def _(spark, d):
    return dq.overview(_all_events(spark, d))


@report("dq1_by_type", """SELECT 'by_type' info_type, event_type, CAST(min(ts) AS DATE) min_date, CAST(max(ts) AS DATE) max_date, count(*) total_events,
  count(DISTINCT uid) unique_users FROM be GROUP BY event_type""", "be")
def _(spark, d):
    return dq.by_type(_all_events(spark, d))


@report("dq1_by_month", """SELECT 'by_month' info_type, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) total_events, count(DISTINCT uid) unique_users
FROM ue GROUP BY 2""", "ue")
def _(spark, d):
    return dq.by_month(frames.user_events(spark, d))


@report("dq2_monthly_coverage", """SELECT strftime(ts, '%Y-%m') AS month, count(*) records, count(adv) with_advertiser, count(*) - count(adv) without_advertiser
FROM ue GROUP BY 1 ORDER BY 1 DESC LIMIT 12""", "ue")
def _(spark, d):
    return dq.monthly_brand_coverage(frames.user_events(spark, d))


@report("dq2_brand_coverage", """SELECT count(*) total, count(*) FILTER (WHERE adv = 'brand_a') brand_a, count(*) FILTER (WHERE adv = 'brand_b') brand_b,
  count(*) FILTER (WHERE adv IS NULL) without_advertiser FROM ue WHERE ts >= TIMESTAMP '1999-12-02' AND ts < TIMESTAMP '2000-03-09'""", "ue")
def _(spark, d):
    return dq.brand_coverage(frames.user_events(spark, d), frames.BRANDS, "1999-12-02", "2000-03-08")


@report("dq2_brand_gaps", """SELECT count(*) total, count(adv) with_advertiser, count(*) - count(adv) without_advertiser,
  count(*) FILTER (WHERE adv IS NULL AND ts < TIMESTAMP '1999-12-02') to_update_before,
  count(*) FILTER (WHERE adv IS NULL AND ts >= TIMESTAMP '1999-12-02') to_update_after FROM ue""", "ue")
def _(spark, d):
    return dq.brand_gaps(frames.user_events(spark, d), "1999-12-02")


@report("dq2_brand_counts", "SELECT adv advertiser, count(*) events, min(ts) min_date, max(ts) max_date FROM ue WHERE adv IS NOT NULL GROUP BY adv", "ue")
def _(spark, d):
    return dq.brand_counts(frames.user_events(spark, d))


@report("dq3_sheet_overview", """SELECT count(*) total_rows, count(DISTINCT sheet) unique_sheets, count(DISTINCT attr) attribution_types,
  TIMESTAMP '2024-02-01' first_load, TIMESTAMP '2024-02-01' last_load FROM cp""", "cp")
def _(spark, d):
    return dq.sheet_overview(frames.campaigns(spark, d))


@report("dq3_sheet_ranges", "SELECT sheet source_sheet_id, attr attribution_type, count(*) records, min(ts) min_date, max(ts) max_date FROM cp GROUP BY ALL", "cp")
def _(spark, d):
    return dq.sheet_ranges(frames.campaigns(spark, d))


@report("dq3_sheet_days", "SELECT CAST(ts AS DATE) AS date, count(*) records, count(DISTINCT sheet) sheets, count(DISTINCT attr) attr_types FROM cp GROUP BY 1", "cp")
def _(spark, d):
    return dq.sheet_days(frames.campaigns(spark, d))


@report("dq4_duplicates", """SELECT sheet source_sheet_id, attr attribution_type, CAST(ts AS DATE) event_day, cid campaignid, count(*) cnt FROM cp
GROUP BY ALL HAVING count(*) > 1""", "cp")
def _(spark, d):
    rows = frames.campaigns(spark, d).withColumn("event_day", F.to_date("event_date"))
    return dq.duplicates(rows, ["source_sheet_id", "attribution_type", "event_day", "campaignid"])


@report("dq4_missing_dates", """WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM ue)
SELECT CAST(date AS DATE) AS date FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) date FROM s)
WHERE CAST(date AS DATE) NOT IN (SELECT date FROM s)""", "ue")
def _(spark, d):
    return dq.missing_dates(frames.user_events(spark, d))


@report("dq5_key_overlap", """SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) left_keys, (SELECT count(DISTINCT l_orderkey) FROM lineitem) right_keys,
  (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) matching_keys""")
def _(spark, d):
    lines = frames.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"))
    return dq.key_overlap(frames.user_events(spark, d), lines, "event_id")


_LINK = "FROM ps JOIN ue ON ps.pid = ue.pid AND ps.month = strftime(ue.ts, '%Y-%m') WHERE ps.pid <> 0 AND adv IS NOT NULL"


@report("dq6_link_coverage", f"SELECT count(DISTINCT ps.pid) publishers, count(DISTINCT ps.month) AS months, count(DISTINCT adv) advertisers {_LINK}", "ue ps")
def _(spark, d):
    return dq.link_coverage(frames.publisher_spend(spark, d), frames.user_events(spark, d))


@report("dq6_link_by_brand", f"SELECT adv advertiser, count(DISTINCT ps.pid) publishers, count(*) events {_LINK} GROUP BY adv", "ue ps")
def _(spark, d):
    return dq.link_by_brand(frames.publisher_spend(spark, d), frames.user_events(spark, d))


@report("dq7_spend_load", f"""SELECT count(*) total_records, count(DISTINCT date) AS days, count(DISTINCT pid) publishers, min(date) min_date, max(date) max_date,
  {dbl('sum(spend)')} total_spend FROM pd WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-02-28'""", "pd")
def _(spark, d):
    return dq.spend_load_summary(frames.publisher_spend_daily(spark, d), "1998-01-01", "1998-02-28")


@report("dq7_spend_by_month", f"SELECT month, count(DISTINCT pid) publishers, {dbl('sum(spend)')} total_spend, {big('sum(deps)')} total_deposits FROM ps GROUP BY month", "ps")
def _(spark, d):
    return dq.spend_by_month(frames.publisher_spend(spark, d))


# --- attribution ------------------------------------------------------------


@report("att1_att2_names", """SELECT DISTINCT pname publisher_name, pid publisher_id, fmt "format", fmt legacy_format FROM ps""", "ps")
def _(spark, d):
    name = F.col("publisher_name")
    return frames.publisher_spend(spark, d).select(
        "publisher_name", text.publisher_id(name).alias("publisher_id"), text.ad_format(name).alias("format"),
        text.ad_format(name, "legacy").alias("legacy_format")).distinct()


_COUNTS = "count(*) events, count(DISTINCT uid) users"


def _by_brand(events):
    return events.groupBy("advertiser").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("external_user_id").alias("users"))


@report("att4_sub_id_format", """SELECT CASE o_orderkey % 5 WHEN 0 THEN 'POP' WHEN 1 THEN 'PUSH' WHEN 2 THEN 'VIDEO' ELSE 'OTHER' END "format", count(*) events FROM orders GROUP BY 1""")
def _(spark, d):
    return (frames.user_events(spark, d).groupBy(text.format_from_sub_id(F.col("sub_id")).alias("format"))
            .agg(F.count(F.lit(1)).alias("events")))


@report("att6_brand_ids", f"""SELECT CASE o_orderkey % 4 WHEN 1 THEN 'brand_a' WHEN 2 THEN 'brand_b' END advertiser, count(*) events, count(DISTINCT o_custkey) users FROM orders GROUP BY 1""")
def _(spark, d):
    ids = (F.col("event_id").cast("bigint") % 4).cast("string")
    return _by_brand(frames.user_events(spark, d).withColumn("advertiser", text.brand_from_id(ids, {1: "brand_a", 2: "brand_b"})))


@report("att7_fill_before", f"""SELECT coalesce(adv, CASE WHEN ts < TIMESTAMP '1999-12-02' THEN 'brand_a' END) advertiser, {_COUNTS} FROM ue GROUP BY 1""", "ue")
def _(spark, d):
    return _by_brand(at.fill_before(frames.user_events(spark, d), "1999-12-02", "brand_a"))


@report("att8_fill_from_website", f"""SELECT CASE WHEN adv IS NOT NULL THEN adv WHEN ts < TIMESTAMP '1999-12-02' THEN NULL WHEN website LIKE 'machinery%' OR website LIKE 'building%' THEN 'brand_b'
  ELSE 'brand_a' END advertiser, {_COUNTS} FROM ue GROUP BY 1""", "ue")
def _(spark, d):
    events = frames.user_events(spark, d, geography=True)
    return _by_brand(at.fill_from_website(events, frames.WEBSITES, "brand_a", "1999-12-02"))


def _mapping(spark, d, link, day=None):
    """A brand per link from the events that have none; several of them may name the same link."""
    source = frames.user_events(spark, d).filter(F.col("advertiser").isNull()).select(
        F.col(link).alias("k"), F.col("event_date").cast("string").alias("day"),
        F.when(F.col("publisher_id") % 2 == 0, " BRAND_a ").otherwise("Brand_B").alias("Advertiser"))
    return at.brand_mapping(source, "k", "Advertiser", day, frames.BRANDS)


def _map_sql(key: str, day: bool = False) -> str:
    extra = ", CAST(ts AS DATE) dd" if day else ""
    return f"mp AS (SELECT {key} k{extra}, max(CASE WHEN pid % 2 = 0 THEN 'brand_a' ELSE 'brand_b' END) b FROM ue WHERE adv IS NULL GROUP BY ALL)"


for _key, _link, _sql in [("event", "event_id", "event_id"), ("user", "external_user_id", "uid")]:
    @report(f"att9_map_by_{_key}", f"""WITH {_map_sql(_sql)} SELECT coalesce(b, adv) advertiser, {_COUNTS} FROM ue LEFT JOIN mp ON k = {_sql} GROUP BY 1""", "ue")
    def _(spark, d, link=_link):
        return _by_brand(at.fill_from_mapping(frames.user_events(spark, d), _mapping(spark, d, link), link))


@report("att9_map_by_network_id", """WITH w AS (SELECT o_custkey c, max(CASE WHEN o_orderkey % 41 % 2 = 0 THEN 'brand_a' ELSE 'brand_b' END) b FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT coalesce(b, CASE o_orderkey % 3 WHEN 1 THEN 'brand_a' WHEN 2 THEN 'brand_b' END) advertiser, count(*) events, count(DISTINCT o_custkey) users
FROM orders LEFT JOIN w ON c = o_custkey GROUP BY 1""")
def _(spark, d):
    link = "network_user_id"
    return _by_brand(at.fill_from_mapping(frames.user_events(spark, d), _mapping(spark, d, link), link))


@report("att9_map_by_user_day", f"""WITH {_map_sql('uid', True)}
SELECT coalesce(adv, CASE WHEN ts >= TIMESTAMP '1997-01-01' AND ts < TIMESTAMP '2000-01-01' THEN b END) advertiser, {_COUNTS}
FROM ue LEFT JOIN mp ON k = uid AND dd = CAST(ts AS DATE) GROUP BY 1""", "ue")
def _(spark, d):
    link = "external_user_id"
    return _by_brand(at.fill_from_mapping(frames.user_events(spark, d), _mapping(spark, d, link, "day"), link,
                                          replace=False, start="1997-01-01", end="1999-12-31"))


@report("att10_format_changes", """SELECT DISTINCT pid publisher_id, pname publisher_name, CASE WHEN pid % 3 = 0 THEN NULL WHEN pid % 3 = 1 THEN 'POP' ELSE fmt END old_format, fmt new_format
FROM ps WHERE CASE WHEN pid % 3 = 0 THEN NULL WHEN pid % 3 = 1 THEN 'POP' ELSE fmt END IS DISTINCT FROM fmt""", "ps")
def _(spark, d):
    kind = F.col("publisher_id") % 3
    stored = F.when(kind == 1, "POP").when(kind == 2, F.col("format"))
    return at.format_changes(frames.publisher_spend(spark, d).withColumn("format", stored))

"""The report tables, derived from a star schema of orders, line items and events.

Each frame has a SQL twin in ``SQL`` (common table expressions for the checks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import numeric as num, text

BRANDS = ["brand_a", "brand_b"]
# Website fragments that point to a brand, tried in this order.
WEBSITES = [("brand_b", ["machinery", "building"]), ("brand_a", ["auto", "house"])]

NAME_FORMATS = ["POP", "PUSH", "VIDEO", "BANNER", "NATIVE", ""]
SHEETS = ["sheet_x", "sheet_y", "sheet_z"]


# Declared, so that building a plan does not read file footers first.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(index, values):
    """Element of a short list by position, as a CASE expression."""
    chain = F
    for i, value in enumerate(values):
        chain = chain.when(index == i, F.lit(value))
    return chain


def user_events(spark: SparkSession, sf_dir: str, geography: bool = False) -> DataFrame:
    """Orders as deposits.  ``geography`` adds country and website from the customer."""
    rows = table(spark, sf_dir, "orders")
    if geography:
        people = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        rows = rows.join(people, F.col("o_custkey") == F.col("c_custkey")).withColumns({
            "country": F.col("n_name"), "website": F.concat(F.lower("c_mktsegment"), F.lit(".example"))})
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast(schemas.MONEY)
    rows = rows.withColumns({
        "event_id": key.cast("string"),
        "external_user_id": F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 12),
        "network_user_id": F.concat(F.lit("9000000000000000000"), F.col("o_custkey").cast("string")),
        "event_type": F.lit("deposit"),
        "event_date": F.col("o_orderdate").cast("timestamp"),
        "publisher_id": key % 41, "campaign_id": key % 13,
        "sub_id": F.coalesce(_pick(key % 5, ["src-POP", "src-PUSH", "src-VIDEO"]), F.lit("src")),
        "deposit_amount": amount, "currency": F.lit("USD"),
        "converted_amount": amount, "converted_currency": F.lit("USD"),
        "advertiser": _pick(key % 3, [None, "brand_a", "brand_b"]),
    })
    return schemas.conform(rows, schemas.USER_EVENTS)


def behaviour_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream, with sub-day times; purchases are deposits."""
    key = F.col("event_id")
    amount = F.when(F.col("event_type") == "purchase", F.col("value").cast(schemas.MONEY))
    rows = table(spark, sf_dir, "events").select(
        key.cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("external_user_id"),
        F.when(F.col("event_type") == "purchase", "deposit").otherwise(F.col("event_type")).alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_date"),
        (key % 7).alias("publisher_id"), (F.col("user_id") % 11).alias("campaign_id"),
        amount.alias("deposit_amount"), amount.alias("converted_amount"),
        _pick(key % 3, [None, "brand_a", "brand_b"]).alias("advertiser"))
    return schemas.conform(rows, schemas.USER_EVENTS)


def _spend(spark: SparkSession, sf_dir: str, period, name: str) -> DataFrame:
    pid = F.col("publisher_id")
    suffix = _pick(pid % 6, [f"-{f}" if f else "" for f in NAME_FORMATS])
    marker = F.when(pid % 7 == 0, "-PLR").otherwise("")
    label = F.concat(F.lit("("), pid.cast("string"), F.lit(") Net"), pid.cast("string"), marker, suffix)
    rows = (table(spark, sf_dir, "lineitem")
            .groupBy((F.col("l_suppkey") % 41).alias("publisher_id"), period.alias(name))
            .agg(F.count(F.lit(1)).alias("deposits_reported"),
                 F.sum(F.col("l_quantity").cast("bigint")).cast("decimal(15,2)").alias("spend"))
            .withColumn("publisher_name", label))
    cost = num.half_even(num.ratio_floor_one(F.col("spend"), F.col("deposits_reported")), 3)
    stored_format = _pick(pid % 6, [f or text.OTHER for f in NAME_FORMATS])
    return rows.withColumns({"format": stored_format, "current_cpa": cost})


def publisher_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spend(spark, sf_dir, F.date_format("l_shipdate", "yyyy-MM"), "month")
    return schemas.conform(rows, schemas.PUBLISHER_SPEND)


def publisher_spend_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spend(spark, sf_dir, F.to_date("l_shipdate"), "date")
    return schemas.conform(rows, schemas.PUBLISHER_SPEND_DAILY)


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as campaign sheets with numbers written as text."""
    key, user = F.col("event_id"), F.col("user_id")
    amount = F.col("value").cast("decimal(18,2)") + (key % 997).cast("decimal(10,0)") * F.lit("0.000001").cast("decimal(6,6)")
    written = F.replace(amount.cast("decimal(20,6)").cast("string"), F.lit("."), F.lit(","))
    rows = table(spark, sf_dir, "events").select(
        _pick(key % 3, SHEETS).alias("source_sheet_id"), _pick(key % 2, ["1_hour", "24_hours"]).alias("attribution_type"),
        F.col("ts").cast("timestamp").alias("event_date"), (user % 11).alias("campaignid"),
        F.concat(F.lit("campaign "), (user % 11).cast("string")).alias("campaign_name"),
        F.when(key % 4 == 0, "rd").otherwise("ftd").alias("event_type"), _pick(user % 2, ["banner", "push"]).alias("format"),
        (key % 1000).alias("views"), (key % 50).alias("clicks"), (key % 5).alias("postview"),
        F.when(key % 3 != 0, key % 3).alias("postclick"),
        F.when(key % 17 == 0, " ").otherwise(written).alias("spend"),
        F.when(key % 19 == 0, "inf").otherwise(written).alias("cpa_pv"),
        F.when(key % 23 == 0, "").otherwise(F.concat(F.lit("1 "), written)).alias("cpa_pc"),
        F.when(key % 2 == 0, written).alias("total_spend"), F.when(key % 2 == 0, written).alias("total_cpa"),
        F.lit("2024-02-01 00:00:00").alias("loaded_at"))
    return schemas.conform(rows, schemas.CAMPAIGNS)


# --- the same frames in SQL --------------------------------------------------

_USER_EVENTS = """ue AS (
  SELECT CAST(o_orderkey AS VARCHAR) event_id, substr(md5(CAST(o_custkey AS VARCHAR)), 1, 12) uid,
         'deposit' event_type, o_orderdate ts, o_orderkey % 41 pid, o_orderkey % 13 cid,
         CASE o_orderkey % 5 WHEN 0 THEN 'src-POP' WHEN 1 THEN 'src-PUSH' WHEN 2 THEN 'src-VIDEO' ELSE 'src' END sub_id,
         CAST(o_totalprice AS DECIMAL(18,4)) amt, n_name country, lower(c_mktsegment) || '.example' website,
         CASE o_orderkey % 3 WHEN 1 THEN 'brand_a' WHEN 2 THEN 'brand_b' END adv
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

_BEHAVIOUR = """be AS (
  SELECT CAST(event_id AS VARCHAR) event_id, CAST(user_id AS VARCHAR) uid,
         CASE event_type WHEN 'purchase' THEN 'deposit' ELSE event_type END event_type, ts,
         event_id % 7 pid, user_id % 11 cid,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,4)) END amt,
         CASE event_id % 3 WHEN 1 THEN 'brand_a' WHEN 2 THEN 'brand_b' END adv
  FROM events)"""


def _spend_sql(name: str, period: str, column: str) -> str:
    return f"""{name} AS (
  SELECT pid, {column}, n deps, CAST(q AS DECIMAL(15,2)) spend,
         '(' || pid || ') Net' || pid || CASE WHEN pid % 7 = 0 THEN '-PLR' ELSE '' END ||
           CASE pid % 6 WHEN 0 THEN '-POP' WHEN 1 THEN '-PUSH' WHEN 2 THEN '-VIDEO' WHEN 3 THEN '-BANNER'
                        WHEN 4 THEN '-NATIVE' ELSE '' END pname,
         CASE pid % 6 WHEN 0 THEN 'POP' WHEN 1 THEN 'PUSH' WHEN 2 THEN 'VIDEO' WHEN 3 THEN 'BANNER'
                      WHEN 4 THEN 'NATIVE' ELSE 'OTHER' END fmt,
         round_even(CAST(q / greatest(n, 1) AS DECIMAL(28,10)), 3) cpa
  FROM (SELECT l_suppkey % 41 pid, {period} AS {column}, count(*) n, sum(CAST(l_quantity AS BIGINT)) q
        FROM lineitem GROUP BY ALL))"""


_CAMPAIGNS = """cp AS (
  SELECT 'sheet_' || substr('xyz', CAST(event_id % 3 AS INTEGER) + 1, 1) sheet,
         CASE event_id % 2 WHEN 0 THEN '1_hour' ELSE '24_hours' END attr, ts, user_id % 11 cid,
         'campaign ' || (user_id % 11) cname, CASE WHEN event_id % 4 = 0 THEN 'rd' ELSE 'ftd' END etype,
         CASE user_id % 2 WHEN 0 THEN 'banner' ELSE 'push' END fmt, event_id % 1000 views, event_id % 50 clicks,
         event_id % 5 postview, CASE WHEN event_id % 3 <> 0 THEN event_id % 3 ELSE 0 END postclick,
         v,
         CASE WHEN event_id % 17 = 0 THEN 0 ELSE v END spend,
         CASE WHEN event_id % 19 <> 0 THEN v END cpa_pv,
         CASE WHEN event_id % 23 <> 0 THEN CAST('1' || CAST(v AS VARCHAR) AS DECIMAL(20,6)) END cpa_pc,
         CASE WHEN event_id % 2 = 0 THEN v END tot
  FROM (SELECT *, CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 997 AS DECIMAL(10,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(20,6)) v FROM events))"""

SQL = {
    "ue": _USER_EVENTS,
    "be": _BEHAVIOUR,
    "ps": _spend_sql("ps", "strftime(l_shipdate, '%Y-%m')", "month"),
    "pd": _spend_sql("pd", "CAST(l_shipdate AS DATE)", "date"),
    "cp": _CAMPAIGNS,
}

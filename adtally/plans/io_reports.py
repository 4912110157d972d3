"""Readers, writers and streams at work on files that Spark writes from the tables.

The files go to fresh folders below the shared scratch path; each report returns what
a reader of the final files or table sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators import arppu, quality as dq, reactivation as rx, split_test as st
from ..session import scratch_path
from ..sources import event_index as ix, readers as rd, views as vw, writers as wr
from ..streaming import ingest
from . import frames
from .registry import big, dbl, dec, report
from .reactivation_reports import _gaps_sql, _seg

IDS = {1: "brand_a", 2: "brand_b"}
_EVENT_COLS = ["event_id", "external_user_id", "network_user_id", "event_type", "event_date", "publisher_id",
               "campaign_id", "sub_id", "converted_amount", "currency", "advertiser"]
_EVENT_SQL = f"""event_id, uid external_user_id, '9000000000000000000' || CAST(o_custkey AS VARCHAR) network_user_id, event_type, ts event_date,
  pid publisher_id, cid campaign_id, sub_id, {dbl('amt')} converted_amount, 'USD' currency"""
_EVENTS_FROM = "FROM ue JOIN orders ON CAST(o_orderkey AS VARCHAR) = event_id"


def _event_files(spark, d, pixel: bool = False, name: str = "events-csv", events: DataFrame | None = None) -> str:
    """The orders, or other events, as an upper-case event export."""
    columns = rd.PIXEL_COLUMNS if pixel else rd.EVENT_COLUMNS
    events = frames.user_events(spark, d) if events is None else events
    written = F.concat(F.date_format("event_date", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    cells = {"event_date": F.when(~F.lit(pixel) | (F.col("campaign_id") != 3), written),
             "advertiser_id": F.when(F.col("advertiser") == "brand_a", 1).when(F.col("advertiser") == "brand_b", 2)}
    out = [cells.get(c, F.col(c) if c in events.columns else F.lit(None)).cast("string").alias(h) for h, c in columns.items()]
    # The pixel rows of one campaign have only their own event time.
    late = [F.when(F.col("campaign_id") == 3, written).otherwise(F.lit("not a time")).alias(rd.LATE_TIME)] if pixel else []
    path = scratch_path(spark, name)
    events.select(*out, *late).write.option("header", True).csv(path)
    return path


@report("src1_event_csv", f"SELECT {_EVENT_SQL}, CAST(NULL AS VARCHAR) advertiser {_EVENTS_FROM}", "ue")
def _(spark, d):
    return rd.event_csv(spark, _event_files(spark, d)).select(_EVENT_COLS)


@report("src1_mixed_headers", f"SELECT {_EVENT_SQL}, CAST(NULL AS VARCHAR) advertiser {_EVENTS_FROM}", "ue")
def _(spark, d):
    """Files of three layouts: as exported, backwards with a column more, and without the columns that are empty."""
    rows, path = spark.read.option("header", True).csv(_event_files(spark, d)), scratch_path(spark, "mixed-csv")
    third = F.col("ID").cast("bigint") % 3
    rows.filter(third == 0).write.option("header", True).csv(path)
    rows.filter(third == 1).withColumn("NOTE", F.lit("a, b")).select("NOTE", *reversed(rows.columns)).write.mode("append").option("header", True).csv(path)
    rows.filter(third == 2).drop("AFFILIATE_ID", "TRANSACTION_ID").write.mode("append").option("header", True).csv(path)
    return rd.event_csv(spark, path).select(_EVENT_COLS)


@report("src2_pixel_csv", f"SELECT {_EVENT_SQL}, adv advertiser {_EVENTS_FROM} WHERE ts < TIMESTAMP '2001-01-01'", "ue")
def _(spark, d):
    return rd.pixel_csv(spark, _event_files(spark, d, pixel=True), IDS, until="2000-12-31").select(_EVENT_COLS)


@report("src2_quoted_line_feeds", f"""SELECT {_EVENT_SQL.replace('sub_id,', "CASE WHEN cid = 3 THEN 'two' || chr(10) || 'lines, ' || chr(34) || pid || chr(34) ELSE sub_id END sub_id,")},
  adv advertiser {_EVENTS_FROM}""", "ue")
def _(spark, d):
    """One campaign's events have a line feed, a comma and quotes in a cell, in a folder of two layouts."""
    rows, path = spark.read.option("header", True).csv(_event_files(spark, d, pixel=True)), scratch_path(spark, "pixel-lines")
    third = F.col("EVENT_ID").cast("bigint") % 3
    told = F.when(F.col("CAMPAIGN_ID") == "3", F.concat(F.lit('two\nlines, "'), F.col("PUBLISHER_ID"), F.lit('"'))).otherwise(F.col("SUB_ID"))
    rows = rows.withColumn("SUB_ID", told)
    write = lambda df: df.write.mode("append").option("header", True).option("escape", '"').csv(path)
    write(rows.filter((third == 0) & (F.col("CAMPAIGN_ID") != "3")))  # files that stay divisible
    write(rows.filter((third == 0) & (F.col("CAMPAIGN_ID") == "3")))
    write(rows.filter(third > 0).select("TYPE", "PIXEL_TS", "SUB_ID", *[c for c in rows.columns if c not in ("TYPE", "PIXEL_TS", "SUB_ID")]))
    return rd.pixel_csv(spark, path, IDS).select(_EVENT_COLS)


def _spend_files(spark, d, folder, extra=None) -> str:
    """Monthly spend as one export per month, each with a preamble line and a header line.

    ``extra`` names a column more by the file.
    """
    spend = frames.publisher_spend(spark, d)
    more = [] if extra is None else [F.lit("more")]
    row = F.concat_ws(",", F.concat(F.lit('"'), F.col("publisher_name"), F.lit('"')), F.lit("7"), *more,
                      F.col("deposits_reported"), F.col("spend"))
    rows = spend.select(folder.alias("part"), F.lit(2).alias("place"), row.alias("value"))
    header = F.concat_ws(",", F.lit("Publisher,FTD"), *([] if extra is None else [extra(F.col("part"))]), F.lit("Deposit,Spend"))
    heads = spend.select(folder.alias("part")).distinct().select("part", F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.lit("Spend report").alias("value")),
        F.struct(F.lit(1).alias("place"), header.alias("value")))).alias("_l")
    ).select("part", "_l.place", "_l.value")
    path = scratch_path(spark, "spend-csv")
    (rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "place").drop("place")
     .write.partitionBy("part").text(path))
    return path


_SPEND_SQL = f"""pid publisher_id, pname publisher_name, fmt "format", deps deposits_reported, {dbl('spend')} spend, {dbl('cpa')} current_cpa"""


@report("src3_monthly_spend_csv", f"SELECT '1999' || substr(month, 5, 3) AS month, {_SPEND_SQL} FROM ps", "ps")
def _(spark, d):
    # File names carry the English month; the year is given.
    name = F.concat(F.lit("spend_"), F.date_format(F.to_date(F.concat("month", F.lit("-01"))), "MMMM_yyyy"))
    rows = rd.monthly_spend_csv(spark, _spend_files(spark, d, name), year=1999, glob="*.txt")
    return rows


@report("src4_daily_spend_csv", f"SELECT CAST(month || '-01' AS DATE) AS date, {_SPEND_SQL} FROM ps", "ps")
def _(spark, d):
    # Three ways to write the date, by publisher-independent month number.
    month = F.substring("month", 6, 2).cast("int")
    year, text_month = F.substring("month", 1, 4), F.substring("month", 6, 2)
    name = (F.when(month % 3 == 0, F.concat(F.lit("spend_"), year, F.lit("-"), text_month, F.lit("-01")))
            .when(month % 3 == 1, F.concat(F.lit("spend_"), year, text_month, F.lit("01")))
            .otherwise(F.concat(F.lit("spend_01-"), text_month, F.lit("-"), year)))
    return rd.daily_spend_csv(spark, _spend_files(spark, d, name), glob="*.txt")


@report("src3_many_layouts", f"SELECT '1999-01' AS month, {_SPEND_SQL} FROM ps", "ps")
def _(spark, d):
    """More than a hundred files, each with a header line of its own."""
    name = F.concat(F.lit("spend_"), F.col("publisher_id"), F.lit("_"), F.substring("month", 6, 2).cast("int") % 3)
    return rd.monthly_spend_csv(spark, _spend_files(spark, d, name, lambda part: F.concat(F.lit("Column "), part)), month="1999-01", glob="*.txt")


@report("src4_file_names_with_spaces", f"SELECT CAST(month || '-01' AS DATE) AS date, {_SPEND_SQL} FROM ps", "ps")
def _(spark, d):
    compact = F.replace(F.concat("month", F.lit("-01")), F.lit("-"), F.lit(""))
    name = F.when(F.substring("month", 6, 2).cast("int") % 2 == 0, F.concat(F.lit("export (1) + copy "), compact)).otherwise(
        F.concat(F.lit("spend of "), F.col("month"), F.lit("-01 100")))
    return rd.daily_spend_csv(spark, _spend_files(spark, d, name), glob="*.txt")


def _sheet_files(spark, d) -> tuple[str, list[tuple[str, str, str]]]:
    """Campaign rows exported per sheet and attribution with headers as people write them: the folder, and (file, sheet, attribution)."""
    rows, root = frames.campaigns(spark, d), scratch_path(spark, "sheet-csv")
    sheets = []
    for sheet in frames.SHEETS:
        for attribution in ("1_hour", "24_hours"):
            part = rows.filter((F.col("source_sheet_id") == sheet) & (F.col("attribution_type") == attribution))
            export = part.select(
                F.date_format("event_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Event-Date"), F.col("campaignid").alias("CampaignID"),
                F.col("campaign_name").alias("Campaign Name"), F.col("event_type").alias("Event Type"), F.col("format").alias("Format"),
                F.col("views").alias("Views"), F.col("clicks").alias("Clicks"), F.col("postview").alias("PostView"),
                F.col("postclick").alias("PostClick"), F.col("spend").alias("Spend"), F.col("cpa_pv").alias("CPA PV"), F.col("cpa_pc").alias("CPA PC"),
                *([F.col("total_spend").alias("Total Spend"), F.col("total_cpa").alias("Total CPA")] if attribution == "1_hour" else []))
            export.write.option("header", True).csv(f"{root}/{sheet}-{attribution}")
            sheets.append((f"{sheet}-{attribution}", sheet, attribution))
    return root, sheets


def _sheets(spark, d) -> DataFrame:
    root, sheets = _sheet_files(spark, d)
    return rd.combine_sheets([rd.campaign_sheet(spark, f"{root}/{name}", sheet, attribution, "2024-02-01 00:00:00") for name, sheet, attribution in sheets])


_SHEETS_SQL = f"""SELECT sheet source_sheet_id, attr attribution_type, ts event_date, cid campaignid, cname campaign_name, etype event_type, fmt "format",
  views, clicks, postview, nullif(postclick, 0) postclick, {dbl('spend')} spend, {dbl('cpa_pv')} cpa_pv, {dbl('cpa_pc')} cpa_pc, {dbl('tot')} total_spend FROM cp"""


@report("src5_campaign_sheets", _SHEETS_SQL, "cp")
def _(spark, d):
    from ..operators import campaigns as cm

    return cm.cleaned(rd.campaigns_from_sheets(_sheets(spark, d))).drop("total_cpa", "loaded_at")


@report("src5_sheets_in_one_scan", _SHEETS_SQL, "cp")
def _(spark, d):
    from ..operators import campaigns as cm

    root, sheets = _sheet_files(spark, d)
    listed = spark.createDataFrame(sheets, "file_name string, source_sheet_id string, attribution_type string")
    return cm.cleaned(rd.campaign_sheets(spark, root, listed, "2024-02-01 00:00:00")).drop("total_cpa", "loaded_at")


@report("src5_line_feeds_in_cells", _SHEETS_SQL.replace("cname campaign_name", "cname || chr(10) || 'of ' || sheet AS campaign_name"), "cp")
def _(spark, d):
    """Campaign names over two lines, all sheets in one scan."""
    from ..operators import campaigns as cm

    root, sheets = _sheet_files(spark, d)
    folder = scratch_path(spark, "sheet-lines")
    for name, sheet, _ in sheets:
        rows = spark.read.option("header", True).csv(f"{root}/{name}")
        rows = rows.withColumn("Campaign Name", F.concat("Campaign Name", F.lit(f"\nof {sheet}")))
        rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    listed = spark.createDataFrame(sheets, "file_name string, source_sheet_id string, attribution_type string")
    return cm.cleaned(rd.campaign_sheets(spark, folder, listed, "2024-02-01 00:00:00")).drop("total_cpa", "loaded_at")


_SHEET_TEXT = """raw AS (
  SELECT CAST(ts AS VARCHAR) event_date, CAST(user_id % 11 AS VARCHAR) campaignid, 'campaign ' || (user_id % 11) campaign_name,
         CASE WHEN event_id % 4 = 0 THEN 'rd' ELSE 'ftd' END event_type, CASE user_id % 2 WHEN 0 THEN 'banner' ELSE 'push' END "format",
         CAST(event_id % 1000 AS VARCHAR) views, CAST(event_id % 50 AS VARCHAR) clicks, CAST(event_id % 5 AS VARCHAR) postview,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 3 AS VARCHAR) END postclick,
         CASE WHEN event_id % 17 <> 0 THEN w END spend, CASE WHEN event_id % 19 = 0 THEN 'inf' ELSE w END cpa_pv,
         CASE WHEN event_id % 23 <> 0 THEN '1 ' || w END cpa_pc, CASE WHEN event_id % 2 = 0 THEN w END total_spend, CASE WHEN event_id % 2 = 0 THEN w END total_cpa,
         'sheet_x' source_sheet_id, '1_hour' attribution_type
  FROM (SELECT *, replace(CAST(CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 997 AS DECIMAL(10,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(20,6)) AS VARCHAR), '.', ',') w FROM events)),
cells AS (SELECT * FROM raw UNPIVOT INCLUDE NULLS (v FOR "column" IN (event_date, campaignid, campaign_name, event_type, "format", views, clicks, postview,
  postclick, spend, cpa_pv, cpa_pc, total_spend, total_cpa, source_sheet_id, attribution_type))),
fits AS (
  SELECT "column", count(*) n, count(v) filled, bool_and(v IS NULL OR TRY_CAST(v AS BIGINT) IS NOT NULL AND v NOT LIKE '%.%') whole,
         bool_and(v IS NULL OR TRY_CAST(v AS DECIMAL(38,10)) IS NOT NULL) fraction FROM cells GROUP BY 1)"""


@report("src6_observed_types", f"""WITH {_SHEET_TEXT}
SELECT "column", CASE WHEN filled > 0 AND whole THEN CASE WHEN filled = n THEN 'bigint' ELSE 'decimal(38,10)' END WHEN filled > 0 AND fraction THEN 'decimal(38,10)'
  WHEN "column" LIKE '%date%' OR "column" LIKE '%time%' THEN 'timestamp' ELSE 'string' END "type" FROM fits""")
def _(spark, d):
    types = rd.observed_types(_sheets(spark, d))
    return spark.createDataFrame([(c, t) for c, t in types.items()], "column string, type string")


@report("src7_parameterised_query", f"SELECT pid publisher_id, count(*) deposits, {dbl('sum(amt)')} revenue FROM ue WHERE ts >= TIMESTAMP '1998-01-01' AND amt >= 250000 GROUP BY pid", "ue")
def _(spark, d):
    sql = """SELECT publisher_id, count(*) AS deposits, sum(converted_amount) AS revenue FROM user_events
             WHERE event_date >= to_timestamp(:start) AND converted_amount >= :least GROUP BY publisher_id"""
    return rd.query(spark, sql, {"user_events": frames.user_events(spark, d)}, start="1998-01-01", least=250000)


@report("src8_copy_and_reconcile", "SELECT count(*) source_rows, count(*) target_rows, min(ts) min_date, max(ts) max_date, true \"matches\" FROM be", "be")
def _(spark, d):
    source = frames.behaviour_events(spark, d)
    return dq.reconcile(source, wr.copy_table(source, scratch_path(spark, "copy")))


@report("src8_resumed_copy", "SELECT count(*) source_rows, count(*) target_rows, min(ts) min_date, max(ts) max_date, true \"matches\", count(DISTINCT strftime(ts, '%Y-%m')) AS months, 0::BIGINT left_over FROM ue", "ue")
def _(spark, d):
    """A copy that is cut short after ten months and resumed; then nothing is left to do."""
    source, path = frames.user_events(spark, d), scratch_path(spark, "copy")
    first = wr.copy_ranges(source, path, at_once=4, most=10)
    second = wr.copy_ranges(source, path, at_once=40)
    third = wr.copy_ranges(source, path)
    return dq.reconcile(source, spark.read.parquet(path)).withColumns({
        "months": F.lit(len(set(first) | set(second))), "left_over": F.lit(len(third) + len(set(first) & set(second)))})


@report("src9_brand_csv", """SELECT event_id link, CASE WHEN pid % 2 = 0 THEN 'brand_a' ELSE 'brand_b' END brand FROM ue""", "ue")
def _(spark, d):
    path = scratch_path(spark, "brand-csv")
    label = F.when(F.col("publisher_id") % 2 == 0, " BRAND_A").otherwise("Brand_b ")
    rows = frames.user_events(spark, d).select("event_id", label.alias("Advertiser"))
    # Rows without a brand or a link are skipped; repeats collapse.
    gaps = rows.select("event_id", F.lit(None).cast("string").alias("Advertiser"))
    rows.unionAll(rows).unionAll(gaps).write.option("header", True).csv(path)
    return rd.brand_csv(spark, path, spellings=frames.BRANDS)


@report("src9_mixed_headers", """SELECT event_id link, CASE WHEN pid % 2 = 0 THEN 'brand_a' ELSE 'brand_b' END brand FROM ue""", "ue")
def _(spark, d):
    """Mapping files with their columns in different orders."""
    path, label = scratch_path(spark, "brand-csv"), F.when(F.col("publisher_id") % 2 == 0, "brand_a").otherwise("Brand_B")
    rows = frames.user_events(spark, d).select("event_id", label.alias("Advertiser"), F.col("publisher_id").alias("note"))
    for rest, columns in enumerate((["event_id", "Advertiser"], ["Advertiser", "event_id"], ["note", "Advertiser", "event_id"])):
        rows.filter(F.col("event_id").cast("bigint") % 3 == rest).select(columns).write.mode("append").option("header", True).csv(path)
    return rd.brand_csv(spark, path, spellings=frames.BRANDS)


@report("src10_mixed_headers", "SELECT count(DISTINCT o_custkey) depositors, count(*) deposits FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def _(spark, d):
    """List files with the id in different places and under both names."""
    path = scratch_path(spark, "users")
    people = frames.table(spark, d, "customer").filter(F.col("c_acctbal") > 0)
    rows = people.select(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 12).alias("id"), F.col("c_name").alias("name"), "c_custkey")
    for rest, columns in enumerate(([F.col("id").alias("user_id")], ["name", F.col("id").alias("external_user_id")], [F.col("id").alias("user_id"), "name"])):
        rows.filter(F.col("c_custkey") % 3 == rest).select(*columns).write.mode("append").option("header", True).csv(path)
    listed = rd.user_list(spark, path=path).withColumnRenamed("user_id", "external_user_id")
    return (frames.user_events(spark, d).join(listed, "external_user_id", "left_semi")
            .agg(F.countDistinct("external_user_id").alias("depositors"), F.count(F.lit(1)).alias("deposits")))


@report("src10_user_list", "SELECT count(DISTINCT o_custkey) depositors FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def _(spark, d):
    path = scratch_path(spark, "users")
    people = frames.table(spark, d, "customer").filter(F.col("c_acctbal") > 0)
    people.select(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 12).alias("external_user_id")).write.option("header", True).csv(path)
    listed = rd.user_list(spark, path=path).withColumnRenamed("user_id", "external_user_id")
    return (frames.user_events(spark, d).join(listed, "external_user_id", "left_semi")
            .agg(F.countDistinct("external_user_id").alias("depositors")))


# --- writers ----------------------------------------------------------------


@report("snk1_csv_results", f"""WITH {_gaps_sql('ue')}
SELECT {_seg('days')} inactivity_period, count(*) reactivations_count FROM gap WHERE days >= 7 GROUP BY 1""", "ue")
def _(spark, d):
    path = scratch_path(spark, "results-csv")
    counts = rx.gaps(frames.user_events(spark, d)).groupBy("inactivity_period").agg(F.count(F.lit(1)).alias("reactivations_count"))
    wr.csv_results(counts, path, single_file=True, byte_order_mark=True)
    back = spark.read.option("header", True).csv(path)
    return back.toDF(*[c.lstrip("\ufeff") for c in back.columns]).withColumn("reactivations_count", F.col("reactivations_count").cast("bigint"))


@report("snk2_append", f"SELECT strftime(date, '%Y-%m') AS month, 2 * count(*) AS n, {dbl('2 * sum(spend)')} spend FROM pd GROUP BY 1", "pd")
def _(spark, d):
    path, daily = scratch_path(spark, "append"), frames.publisher_spend_daily(spark, d)
    for _ in range(2):
        wr.append(daily.withColumn("month", F.date_format("date", "yyyy-MM")), path, ["month"])
    return wr.read_table(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("spend").alias("spend"))


@report("snk2_widened_column", f"SELECT strftime(date, '%Y') AS year, count(*) AS n, {dbl('sum(spend)')} spend, {dbl('sum(deps) + 0.75 * count(*)')} deposits FROM pd GROUP BY 1", "pd")
def _(spark, d):
    """Whole numbers of the first rows, fractions from the second on: the column becomes a decimal, and nothing is cut."""
    path, daily = scratch_path(spark, "widened"), frames.publisher_spend_daily(spark, d)
    half = F.col("publisher_id") % 2 == 0
    rows = daily.select(F.date_format("date", "yyyy").alias("year"), "publisher_id", "spend", F.col("deposits_reported").alias("deposits"))
    wr.append(rows.filter(half).withColumn("deposits", F.col("deposits").cast("int")), path, ["year"])
    wr.append(rows.filter(~half).withColumn("deposits", F.col("deposits") + F.lit("0.75").cast("decimal(5,2)")), path, ["year"])
    wr.append(rows.filter(half).limit(0).withColumn("deposits", F.col("deposits").cast("int")), path, ["year"])
    back = wr.read_table(spark, path)
    fraction = F.when(half, F.col("deposits") + F.lit("0.75").cast("decimal(5,2)")).otherwise(F.col("deposits"))
    return back.withColumn("deposits", fraction).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("spend").alias("spend"), F.sum("deposits").alias("deposits"))


@report("snk2_added_column", f"SELECT sheet source_sheet_id, count(*) AS records, count(CASE WHEN sheet <> 'sheet_x' THEN 1 END) named, CASE WHEN sheet <> 'sheet_x' THEN {dbl('sum(views)')} END views FROM cp GROUP BY sheet", "cp")
def _(spark, d):
    """A column that only later sheets have, and one that they have as text."""
    path, rows = scratch_path(spark, "added"), frames.campaigns(spark, d).select("source_sheet_id", "campaignid", "views")
    first = F.col("source_sheet_id") == "sheet_x"
    wr.replace_sheets(rows.filter(first).drop("views"), path)
    wr.replace_sheets(rows.filter(F.col("source_sheet_id") == "sheet_y").withColumn("owner", F.lit("a")), path)
    wr.replace_sheets(rows.filter(F.col("source_sheet_id") == "sheet_z").withColumns({"owner": F.lit("b"), "campaignid": F.col("campaignid").cast("string")}), path)
    back = wr.read_table(spark, path)
    return back.groupBy("source_sheet_id").agg(F.count("campaignid").alias("records"), F.count("owner").alias("named"), F.sum("views").cast("double").alias("views"))


def _replaced(spark, d, mode):
    """All days stored, then every other day of 1998 written anew with double spend."""
    path, daily = scratch_path(spark, "spend-table"), frames.publisher_spend_daily(spark, d)
    by_month = daily.withColumn("date", F.trunc("date", "month"))
    wr.replace_period(by_month, path, "date")
    odd = by_month.filter((F.year("date") == 1998) & (F.month("date") % 2 == 1))
    wr.replace_period(odd.withColumn("spend", F.col("spend") * 2), path, "date", mode)
    return wr.read_table(spark, path).groupBy("date").agg(F.sum("spend").alias("spend"))


_MONTHLY = "SELECT CAST(date_trunc('month', date) AS DATE) AS date, sum(spend) s FROM pd GROUP BY 1"


@report("snk3_replace_partitions", f"SELECT date, {dbl('CASE WHEN year(date) = 1998 AND month(date) % 2 = 1 THEN 2 * s ELSE s END')} spend FROM ({_MONTHLY})", "pd")
def _(spark, d):
    return _replaced(spark, d, "partition")


@report("snk3_replace_range", f"""SELECT date, {dbl('CASE WHEN year(date) = 1998 AND month(date) % 2 = 1 THEN 2 * s ELSE s END')} spend FROM ({_MONTHLY})
WHERE NOT (year(date) = 1998 AND month(date) % 2 = 0 AND month(date) < 12)""", "pd")
def _(spark, d):
    return _replaced(spark, d, "range")


@report("snk3_range_with_null_period", f"""SELECT date, {dbl('CASE WHEN year(date) = 1998 AND month(date) % 2 = 1 THEN 2 * s ELSE s END')} spend FROM ({_MONTHLY})
WHERE NOT (year(date) = 1998 AND month(date) % 2 = 0 AND month(date) < 12) UNION ALL SELECT NULL, {dbl('sum(spend)')} FROM pd""", "pd")
def _(spark, d):
    """Rows without a date among the new ones; later months stay."""
    path, daily = scratch_path(spark, "spend-table"), frames.publisher_spend_daily(spark, d)
    by_month = daily.withColumn("date", F.trunc("date", "month"))
    wr.replace_period(by_month, path, "date")
    odd = by_month.filter((F.year("date") == 1998) & (F.month("date") % 2 == 1)).withColumn("spend", F.col("spend") * 2)
    undated = daily.withColumn("date", F.lit(None).cast("date"))
    wr.replace_period(odd.unionByName(undated), path, "date", "range")
    return wr.read_table(spark, path).groupBy("date").agg(F.sum("spend").alias("spend"))


@report("snk4_replace_sheet", """SELECT sheet source_sheet_id, count(*) AS records FROM cp WHERE sheet <> 'sheet_y' OR attr = '1_hour' GROUP BY sheet""", "cp")
def _(spark, d):
    path, rows = scratch_path(spark, "sheets-table"), frames.campaigns(spark, d)
    wr.replace_sheets(rows, path)
    wr.replace_sheets(rows.filter((F.col("source_sheet_id") == "sheet_y") & (F.col("attribution_type") == "1_hour")), path)
    return wr.read_table(spark, path).groupBy("source_sheet_id").agg(F.count(F.lit(1)).alias("records"))


def _batches(spark, d):
    """Stored events, and a batch that corrects one brand's (with outdated repeats), moves one
    campaign's to another month, and adds those without a brand."""
    events = frames.user_events(spark, d)
    brand = F.col("advertiser")
    stored = events.filter(brand.isNotNull())
    later = F.when(F.col("campaign_id") == 2, F.col("event_date") + F.expr("INTERVAL '40' DAY")).otherwise(F.col("event_date"))
    changed = (events.filter(brand.isNull() | (brand == "brand_b"))
               .withColumns({"converted_amount": F.col("converted_amount") + 1, "event_date": later}))
    outdated = changed.withColumn("converted_amount", F.lit(5)).withColumn("event_date", F.col("event_date") - F.expr("INTERVAL '1' DAY"))
    return stored, changed.unionByName(outdated)


_CORRECTED = "(adv IS NULL OR adv = 'brand_b')"
_MERGED = f"""SELECT strftime(t, '%Y-%m') AS event_month, count(*) events, count(DISTINCT event_id) ids, {dbl('sum(a)')} revenue FROM (
  SELECT event_id, CASE WHEN cid = 2 AND {_CORRECTED} THEN ts + INTERVAL 40 DAY ELSE ts END t, CASE WHEN {_CORRECTED} THEN amt + 1 ELSE amt END a FROM ue) GROUP BY 1"""


def _by_month(table):
    return table.groupBy("event_month").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"),
                                            F.sum("converted_amount").alias("revenue"))


@report("snk5_upsert", _MERGED, "ue")
def _(spark, d):
    path = scratch_path(spark, "events-table")
    stored, batch = _batches(spark, d)
    wr.append(wr.with_month(stored), path, [wr.MONTH])
    wr.upsert_events(batch, path)
    wr.upsert_events(batch, path)  # the same batch again changes nothing
    return _by_month(wr.read_table(spark, path))


@report("snk5_indexed_upsert", _MERGED, "ue")
def _(spark, d):
    """The same upserts found by the index, which also takes up rows appended behind its back."""
    path = scratch_path(spark, "events-table")
    stored, batch = _batches(spark, d)
    early = F.col("event_date") < F.lit("1998-01-01").cast("timestamp")
    wr.append(wr.with_month(stored.filter(early)), path, [wr.MONTH])
    ix.update(spark, path)
    wr.append(wr.with_month(stored.filter(~early)), path, [wr.MONTH])
    wr.upsert_events(batch, path, indexed=True)
    wr.upsert_events(batch.filter(F.col("campaign_id") == 2), path, indexed=True)  # nothing new
    return _by_month(wr.read_table(spark, path))


@report("snk5_upsert_without_time", f"""SELECT CASE WHEN cid <> 4 THEN strftime(ts, '%Y-%m') END AS event_month, count(*) events,
  {dbl('sum(CASE WHEN cid IN (4, 5) AND pid % 2 = 0 THEN amt + 1 ELSE amt END)')} revenue FROM ue GROUP BY 1""", "ue")
def _(spark, d):
    """One campaign's events have no time in the table; the batch corrects half of them and gives another campaign its times back."""
    path, events = scratch_path(spark, "events-table"), frames.user_events(spark, d)
    untimed = lambda campaigns: F.when(~F.col("campaign_id").isin(campaigns), F.col("event_date"))
    wr.append(wr.with_month(events.withColumn("event_date", untimed([4, 5]))), path, [wr.MONTH])
    batch = events.filter(F.col("campaign_id").isin(4, 5))
    changed = batch.withColumns({"event_date": untimed([4]), "converted_amount": F.when(
        F.col("publisher_id") % 2 == 0, F.col("converted_amount") + 1).otherwise(F.col("converted_amount"))})
    wr.upsert_events(changed.filter((F.col("campaign_id") == 5) | (F.col("publisher_id") % 2 == 0)), path)
    return wr.read_table(spark, path).groupBy("event_month").agg(F.count(F.lit(1)).alias("events"), F.sum("converted_amount").alias("revenue"))


@report("snk6_insert_or_ignore", f"""SELECT strftime(t, '%Y-%m') AS event_month, count(*) events, {dbl('sum(a)')} revenue FROM (
  SELECT CASE WHEN cid = 2 AND adv IS NULL THEN ts + INTERVAL 40 DAY ELSE ts END t, CASE WHEN adv IS NULL THEN amt + 1 ELSE amt END a FROM ue) GROUP BY 1""", "ue")
def _(spark, d):
    path = scratch_path(spark, "events-table")
    stored, batch = _batches(spark, d)
    wr.append(wr.with_month(stored), path, [wr.MONTH])
    new = wr.insert_or_ignore(wr.read_table(spark, path), batch, [-F.unix_micros("event_date")])
    wr.append(wr.with_month(new), path, [wr.MONTH])
    return _by_month(wr.read_table(spark, path)).drop("ids")


@report("snk7_stored_reactivations", f"""WITH {_gaps_sql('ue')}
SELECT strftime(ts, '%Y-%m') AS month, {_seg('days')} inactivity_period, count(*) reactivations_count FROM gap WHERE days >= 7 GROUP BY 1, 2""", "ue")
def _(spark, d):
    path = scratch_path(spark, "reactivations")
    wr.store_reactivations(frames.user_events(spark, d), path)
    return wr.read_table(spark, path).groupBy("month", "inactivity_period").agg(F.count(F.lit(1)).alias("reactivations_count"))


def _late_batch(spark, d) -> tuple[DataFrame, DataFrame]:
    """Events stored first, and a batch of later ones and of one campaign's from all times."""
    events = frames.user_events(spark, d)
    late = (F.col("event_date") >= F.lit("2001-01-01").cast("timestamp")) | (F.col("campaign_id") == 5)
    return events.filter(~late), events.filter(late)


@report("snk7_refresh_after_late_events", f"""WITH {_gaps_sql('ue')}
SELECT strftime(ts, '%Y-%m') AS month, {_seg('days')} inactivity_period, count(*) reactivations_count, count(DISTINCT uid) users FROM gap WHERE days >= 7 GROUP BY 1, 2""", "ue")
def _(spark, d):
    """Reactivations stored, then brought up to date with new and late events, twice with the same batch."""
    path, (stored, batch) = scratch_path(spark, "reactivations"), _late_batch(spark, d)
    vw.build_reactivations(stored, path)
    for _ in range(2):
        vw.refresh_reactivations(batch, stored.unionAll(batch), path)
    return wr.read_table(spark, path).groupBy("month", "inactivity_period").agg(
        F.count(F.lit(1)).alias("reactivations_count"), F.countDistinct("user_id").alias("users"))


_COHORTS = f"""WITH p AS (SELECT uid, ts, amt, min(ts) OVER (PARTITION BY uid) f FROM ue)
SELECT CAST(date_trunc('month', f) AS DATE) cohort_start, count(DISTINCT uid) users_count, {dec('sum(amt) / count(DISTINCT uid)', 2)} arppu
FROM p WHERE f <= TIMESTAMP '2001-07-01' AND ts < f + INTERVAL 30 DAY GROUP BY 1"""


@report("snk8_refresh", _COHORTS, "ue")
def _(spark, d):
    """Cohorts stored per user, then brought up to date; late first deposits move users to earlier cohorts."""
    path, (stored, batch) = scratch_path(spark, "cohorts"), _late_batch(spark, d)
    vw.build_cohorts(stored, path)
    for _ in range(2):
        vw.refresh_cohorts(batch, stored.unionAll(batch), path)
    return vw.cohorts(spark, path, "2001-08-01").select("cohort_start", "users_count", F.round("arppu", 2).alias("arppu"))


@report("snk8_group_layers", f"""WITH g AS (SELECT CASE WHEN right(uid, 1) SIMILAR TO '[0-7]' THEN 'Control' ELSE 'Test' END test_group, uid, amt FROM ue)
SELECT test_group, count(DISTINCT uid) unique_users, count(*) total_deposits, {dbl('sum(amt)')} total_deposits_usd FROM g GROUP BY 1""", "ue")
def _(spark, d):
    """Split-test totals in layers by batch, one of them repeated, then all as one."""
    path, (stored, batch) = scratch_path(spark, "groups"), _late_batch(spark, d)
    for name, rows in (("1", stored), ("2", batch), ("2", batch)):
        vw.add_group_layer(rows, path, name)
    vw.compact_layers(spark, path)
    return st.compare_totals(vw.group_totals(spark, path)).select("test_group", "unique_users", "total_deposits", "total_deposits_usd")


@report("snk8_stored_groups", f"""SELECT CASE WHEN right(uid, 1) SIMILAR TO '[0-7]' THEN 'Control' ELSE 'Test' END test_group, count(*) deposits, {dbl('sum(amt)')} revenue FROM ue GROUP BY 1""", "ue")
def _(spark, d):
    path = scratch_path(spark, "groups")
    wr.store_report(st.assign(frames.user_events(spark, d)), path, ["test_group"])
    return wr.read_table(spark, path).groupBy("test_group").agg(F.count(F.lit(1)).alias("deposits"), F.sum("deposit_amount").alias("revenue"))


@report("snk8_stored_cohorts", _COHORTS, "ue")
def _(spark, d):
    path = scratch_path(spark, "cohorts")
    wr.store_report(arppu.first_period(frames.user_events(spark, d), "2001-08-01", "month"), path)
    return wr.read_table(spark, path).select("cohort_start", "users_count", F.round("arppu", 2).alias("arppu"))


@report("snk9_monthly_rollup", f"""SELECT pid publisher_id, pname publisher_name, fmt "format", strftime(date, '%Y-%m') AS month, {big('sum(deps)')} deposits_reported,
  {dbl('sum(spend)')} spend, {dec('sum(spend) / sum(deps)', 3)} current_cpa FROM pd WHERE pid <> 0 GROUP BY ALL""", "pd")
def _(spark, d):
    path = scratch_path(spark, "monthly-spend")
    wr.roll_up_spend(frames.publisher_spend_daily(spark, d), path)
    return wr.read_table(spark, path)


# --- streams ----------------------------------------------------------------


def _two_drops(spark, d) -> str:
    """Two drops of pixel files with one campaign in both."""
    path = scratch_path(spark, "landing")
    files = _event_files(spark, d, pixel=True, name="drop-source")
    rows = spark.read.option("header", True).csv(files)
    campaign = F.col("CAMPAIGN_ID").cast("bigint")
    for drop in (campaign <= 6, campaign >= 6):
        rows.filter(drop).write.mode("append").option("header", True).csv(path)
    return path


@report("str1_incremental_append", f"SELECT strftime(ts, '%Y-%m') AS event_month, {big('sum(CASE WHEN cid = 6 THEN 2 ELSE 1 END)')} events FROM ue GROUP BY 1", "ue")
def _(spark, d):
    landing, table, checkpoint = _two_drops(spark, d), scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest.append_stream(ingest.event_stream(spark, landing, IDS), table, checkpoint).awaitTermination()
    return wr.read_table(spark, table).groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


@report("str1_changing_layouts", f"SELECT strftime(ts, '%Y-%m') AS event_month, count(*) events, count(DISTINCT event_id) ids, {dbl('sum(amt)')} revenue, 2 bad_files FROM ue GROUP BY 1", "ue")
def _(spark, d):
    """Files of three layouts, one of them with cells over two lines, and two that cannot be read, in two drops."""
    landing, table, bad, checkpoint = (scratch_path(spark, n) for n in ("landing", "stream-table", "quarantine", "stream-checkpoint"))
    rows = spark.read.option("header", True).csv(_event_files(spark, d, pixel=True, name="drop-source"))
    third, kept = F.col("EVENT_ID").cast("bigint") % 3, [c for c in rows.columns if c != "SUB_ID"]
    drops = [rows.filter(third == 0), rows.filter(third == 1).select(F.lit("two\nlines").alias("NOTE"), *reversed(rows.columns)), rows.filter(third == 2).select(kept)]
    for number, drop in enumerate(drops):
        drop.write.mode("append").option("header", True).option("escape", '"').csv(landing)
        if number:
            torn = drop.limit(1).select(F.lit("EVENT_ID,TYPE,PIXEL_TS").alias("value") if number == 1 else F.lit("a,b,c").alias("value"))
            torn.unionAll(drop.limit(1).select(F.lit('1,"deposit,2001-01-01' if number == 1 else "1,2,3"))).coalesce(1).write.mode("append").text(landing)
            ingest.upsert_files(spark, landing, IDS, table, bad, checkpoint, files_per_trigger=5).awaitTermination()
    counts = wr.read_table(spark, table).groupBy("event_month").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"), F.sum("converted_amount").alias("revenue"))
    return counts.withColumn("bad_files", F.lit(spark.read.parquet(bad).count()))


@report("str2_bounded_dedup", """WITH t AS (SELECT ts FROM ue UNION ALL SELECT ts + INTERVAL 8000 DAY FROM ue UNION ALL SELECT TIMESTAMP '2012-01-01')
SELECT strftime(ts, '%Y-%m') AS event_month, count(*) events FROM t GROUP BY 1""", "ue")
def _(spark, d):
    """Repeats of all events within the horizon are dropped; when it has passed, an id counts anew."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "stream-table", "stream-checkpoint"))
    events = frames.user_events(spark, d)
    later = lambda days: events.withColumn("event_date", F.col("event_date") + F.make_dt_interval(F.lit(days)))
    marker = schemas.conform(spark.range(1).select(F.lit("marker").alias("event_id"), F.lit(1).alias("campaign_id"), F.lit("2012-01-01").cast("timestamp").alias("event_date")),
                             schemas.USER_EVENTS)
    for drop in (events, later(10), marker, later(8000)):
        files = spark.read.option("header", True).csv(_event_files(spark, d, pixel=True, name="drop-source", events=drop))
        files.write.mode("append").option("header", True).csv(landing)
        unique = ingest.without_repeats(ingest.event_stream(spark, landing, IDS), "365 days")
        ingest.append_stream(unique, table, checkpoint).awaitTermination()
    return wr.read_table(spark, table).groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


@report("str3_stream_upsert", "SELECT strftime(ts, '%Y-%m') AS event_month, count(*) events, count(DISTINCT event_id) ids FROM ue GROUP BY 1", "ue")
def _(spark, d):
    landing, table, checkpoint = _two_drops(spark, d), scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    stream = ingest.event_stream(spark, landing, IDS, files_per_trigger=8)
    ingest.upsert_stream(stream, table, checkpoint).awaitTermination()
    return wr.read_table(spark, table).groupBy("event_month").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"))

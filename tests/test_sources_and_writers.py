import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally import schemas
from adtally.operators import attribution as at, quality as dq
from adtally.session import scratch_path, shared_dir, size_for
from adtally.sources import readers as rd, writers as wr
from adtally.streaming import ingest

HEADER = "EVENT_ID,EXTERNAL_USER_ID,NETWORK_USER_ID,TYPE,PIXEL_TS,PUBLISHER_ID,CAMPAIGN_ID,SUB_ID,AFFILIATE_ID,DEPOSIT_AMOUNT,CURRENCY," \
         "CONVERTED_AMOUNT,CONVERTED_CURRENCY,WEBSITE,COUNTRY,TRANSACTION_ID,ADVERTISER_ID,EVENT_TS"


def pixel_line(event, ts="2025-11-01 10:00:00 UTC", user="u", publisher="5", amount="1.5", brand="1", late=""):
    return f"{event},{user},99999999999999999999,deposit,{ts},{publisher},7,s,,{amount},EUR,{amount},USD,w,c,t,{brand},{late}"


def write(path, *lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


# --- reading ----------------------------------------------------------------


def test_event_csv_coerces(spark, tmp_path):
    write(tmp_path / "e.csv", "ID,EXTERNAL_USER_ID,TYPE,PIXEL_TS,PUBLISHER_ID,CONVERTED_AMOUNT,EXTRA",
          "1,u,deposit,2025-11-01 10:00:00 UTC,5.0,2.5,x", "2,u,deposit,never,5,2,x", "3,u,view,2025-11-02 00:00:00 +0000,abc,x,x")
    got = rd.event_csv(spark, str(tmp_path)).orderBy("event_id").collect()
    assert [(r.event_id, str(r.event_date), r.publisher_id, r.converted_amount and float(r.converted_amount)) for r in got] == [
        ("1", "2025-11-01 10:00:00", 5, 2.5), ("3", "2025-11-02 00:00:00", None, None)]
    assert [f.name for f in rd.event_csv(spark, str(tmp_path)).schema.fields] == schemas.USER_EVENTS.fieldNames()


def test_pixel_csv(spark, tmp_path):
    write(tmp_path / "p.csv", HEADER, pixel_line("a"), pixel_line("b", ts="", late="2025-11-03 00:00:00 UTC", brand="2"),
          pixel_line("", brand="1"), pixel_line("c", ts="2025-11-05 00:00:01 UTC"), pixel_line("d", brand="9"))
    got = {r.event_id: (str(r.event_date), r.advertiser, r.network_user_id) for r in rd.pixel_csv(spark, str(tmp_path), {1: "x", 2: "y"}, until="2025-11-04").collect()}
    big = "9" * 20
    assert got == {"a": ("2025-11-01 10:00:00", "x", big), "b": ("2025-11-03 00:00:00", "y", big), "d": ("2025-11-01 10:00:00", None, big)}


def test_monthly_spend(spark, tmp_path):
    write(tmp_path / "november.csv", "Report of today", "Publisher,FTD,Deposit,Spend", '"(1) A, Inc-POP",1,4,10.50', "(2) B-PUSH,1,0,7", "No id,1,1,1", "(3) C,1,x,")
    got = {r.publisher_id: (r.publisher_name, r.format, r.month, r.deposits_reported, float(r.spend), float(r.current_cpa)) for r in
           rd.monthly_spend_csv(spark, str(tmp_path), year=2025).collect()}
    assert got == {1: ("(1) A, Inc-POP", "POP", "2025-11", 4, 10.5, 2.625), 2: ("(2) B-PUSH", "PUSH", "2025-11", 0, 7.0, 7.0),
                   3: ("(3) C", "OTHER", "2025-11", 0, 0.0, 0.0)}
    assert rd.monthly_spend_csv(spark, str(tmp_path), month="2024-01").first().month == "2024-01"
    with pytest.raises(ValueError):
        rd.monthly_spend_csv(spark, str(tmp_path))


def test_daily_spend_with_other_layouts_and_encodings(spark, tmp_path):
    write(tmp_path / "s_2025-11-01.csv", "x", "Publisher,FTD,Deposit,Spend", "(1) Café-POP,1,2,4")
    write(tmp_path / "s_20251102.csv", "x", "Spend,Publisher,Extra,Deposit", "6,(1) Café-POP,z,3", encoding="latin-1")
    write(tmp_path / "s_03-11-2025.csv", "x", "Publisher,FTD,Deposit,Spend", "(2) Z,1,1,1")
    write(tmp_path / "other.txt", "Publisher,FTD,Deposit,Spend", "(4) Z,1,1,1")
    got = sorted((str(r.date), r.publisher_name, r.deposits_reported, float(r.spend)) for r in rd.daily_spend_csv(spark, str(tmp_path)).collect())
    assert got == [("2025-11-01", "(1) Café-POP", 2, 4.0), ("2025-11-02", "(1) Café-POP", 3, 6.0), ("2025-11-03", "(2) Z", 1, 1.0)]
    write(tmp_path / "export (1) +2 20251104.csv", "x", "Publisher,FTD,Deposit,Spend", "(2) Z,1,1,1")
    assert rd.daily_spend_csv(spark, str(tmp_path)).filter("date = '2025-11-04'").count() == 1
    write(tmp_path / "un dated.csv", "x", "Publisher,FTD,Deposit,Spend", "(3) Z,1,1,1")
    assert rd.daily_spend_csv(spark, str(tmp_path), date="2024-01-01").count() == 5
    with pytest.raises(Exception, match="no date in the name of .*un dated.csv"):
        rd.daily_spend_csv(spark, str(tmp_path)).collect()
    assert rd.daily_spend_csv(spark, str(tmp_path), glob="other2*").count() == 0


def test_files_without_the_header_fail_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "Publisher,FTD,Deposit,Spend", "(1) A,1,2,4")
    write(tmp_path / "b.csv", "(2) B,1,2,4")
    with pytest.raises(Exception, match="no header line in .*b.csv"):
        rd.monthly_spend_csv(spark, str(tmp_path), month="2025-11").collect()
    assert rd.monthly_spend_csv(spark, str(tmp_path / "a.csv"), month="2025-11").count() == 1
    write(tmp_path / "e" / "x.csv", "ID,TYPE,OTHER", "1,deposit,2025-11-01")
    with pytest.raises(Exception, match="no header line in .*x.csv"):
        rd.event_csv(spark, str(tmp_path / "e")).collect()


def test_columns_follow_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", "ID,EXTERNAL_USER_ID,TYPE,PIXEL_TS,CONVERTED_AMOUNT", "1,u,deposit,2025-11-01 10:00:00 UTC,1.5")
    write(tmp_path / "b.csv", "PIXEL_TS,CONVERTED_AMOUNT,NOTE,TYPE,ID,EXTERNAL_USER_ID", '2025-11-02 10:00:00 UTC,2.5,"x, ""y""",deposit,2,v', "2025-11-03 10:00:00 UTC,3,,view,3,w")
    got = [(r.event_id, r.external_user_id, r.event_type, str(r.event_date), float(r.converted_amount)) for r in rd.event_csv(spark, str(tmp_path)).orderBy("event_id").collect()]
    assert got == [("1", "u", "deposit", "2025-11-01 10:00:00", 1.5), ("2", "v", "deposit", "2025-11-02 10:00:00", 2.5), ("3", "w", "view", "2025-11-03 10:00:00", 3.0)]


def test_pixel_headers_may_be_named(spark, tmp_path):
    write(tmp_path / "p.csv", HEADER.replace("NETWORK_USER_ID", "NET_ID"), pixel_line("a"))
    columns = {("NET_ID" if k == "NETWORK_USER_ID" else k): v for k, v in rd.PIXEL_COLUMNS.items()}
    assert rd.pixel_csv(spark, str(tmp_path), {1: "x"}).first().network_user_id is None
    assert rd.pixel_csv(spark, str(tmp_path), {1: "x"}, columns=columns).first().network_user_id == "9" * 20


def test_stream_refuses_another_header(spark, tmp_path):
    write(tmp_path / "in" / "p.csv", HEADER.replace("TYPE,PIXEL_TS", "PIXEL_TS,TYPE"), pixel_line("a"))
    stream = ingest.event_stream(spark, str(tmp_path / "in"), {1: "x"})
    query = ingest.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    with pytest.raises(Exception):
        query.awaitTermination()
    assert "CSV header does not conform to the schema" in str(query.exception()) or query.exception() is not None
    assert not list((tmp_path / "out").glob("event_month=*/part-*"))


def test_sheets_evolve(spark, tmp_path):
    write(tmp_path / "a" / "s.csv", "Event Date,CampaignID,Views,Active", "2024-01-01,1,5,true", "2024-01-02,2,6,false")
    write(tmp_path / "b" / "s.csv", "Event Date,CampaignID,New-Col!", "2024-01-03,3,1.5")
    sheets = rd.combine_sheets([rd.campaign_sheet(spark, str(tmp_path / "a"), "11", "1_hour"), rd.campaign_sheet(spark, str(tmp_path / "b"), "12", "24_hours", sheet_name="x")])
    types = rd.observed_types(sheets)
    assert (types["campaignid"], types["views"], types["active"], types["event_date"], types["new_col"]) == ("bigint", "decimal(38,10)", "string", "timestamp", "decimal(38,10)")
    assert rd.observed_types(rd.campaign_sheet(spark, str(tmp_path / "a"), "11", "1_hour"))["active"] == "boolean"
    typed = rd.cast_columns(sheets, types)
    assert dict(typed.dtypes)["event_date"] == "timestamp" and typed.count() == 3


def test_lists_and_mappings(spark, tmp_path):
    assert [r.user_id for r in rd.user_list(spark, "a, b ,,c").collect()] == ["a", "b", "c"]
    write(tmp_path / "u.csv", "external_user_id,x", "q,1")
    assert [r.user_id for r in rd.user_list(spark, path=str(tmp_path / "u.csv")).collect()] == ["q"]
    write(tmp_path / "bad.csv", "id", "q")
    with pytest.raises(ValueError):
        rd.user_list(spark, path=str(tmp_path / "bad.csv"))
    with pytest.raises(ValueError):
        rd.user_list(spark)
    write(tmp_path / "m.csv", "event_id,Advertiser", "1, brand_A ", "1,BRAND_A", "2,", "3,other")
    assert sorted((r.link, r.brand) for r in rd.brand_csv(spark, str(tmp_path / "m.csv"), spellings=["Brand_A"]).collect()) == [("1", "Brand_A"), ("3", "other")]


def test_cells_over_several_lines(spark, tmp_path):
    """A record is a record, wherever its line feeds are; files without any are read in lines, also beside such ones."""
    write(tmp_path / "a.csv", HEADER, pixel_line("a"), pixel_line("b", user='"u\n2, ""x"""'), pixel_line("c", amount="7"))
    write(tmp_path / "b.csv", HEADER, pixel_line("d", user='5" wide'), pixel_line("e"))
    (tmp_path / "c.csv").write_bytes(("\ufeff" + '"EVENT_ID",TYPE,PIXEL_TS,CONVERTED_AMOUNT,"EXTERNAL\nUSER",EXTERNAL_USER_ID\r\nf,deposit,2025-11-01 10:00:00 UTC,3,x,"Caf\u00e9\r\n\u20ac"\r\n').encode())
    (tmp_path / "d.csv").write_bytes('EVENT_ID,TYPE,PIXEL_TS,EXTERNAL_USER_ID\ng,deposit,2025-11-01 10:00:00 UTC,"Caf\u00e9\nx"\nh,deposit,2025-11-01 10:00:00 UTC,\u00fc\n'.encode("latin-1"))
    got = {r.event_id: (r.external_user_id, r.converted_amount and float(r.converted_amount), r.advertiser) for r in rd.pixel_csv(spark, str(tmp_path), {1: "x"}).collect()}
    assert got == {"a": ("u", 1.5, "x"), "b": ('u\n2, "x"', 1.5, "x"), "c": ("u", 7.0, "x"), "d": ('5" wide', 1.5, "x"), "e": ("u", 1.5, "x"),
                   "f": ("Caf\u00e9\n\u20ac", 3.0, None), "g": ("Caf\u00e9\nx", None, None), "h": ("\u00fc", None, None)}


def test_quotes_that_do_not_pair_up_fail_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, pixel_line("a"))
    write(tmp_path / "torn.csv", HEADER, pixel_line("b", user='"never closed'), pixel_line("c"))
    with pytest.raises(Exception, match="quotes do not pair up in .*torn.csv"):
        rd.pixel_csv(spark, str(tmp_path), {1: "x"}).collect()


def test_only_files_with_such_cells_are_read_whole(spark, tmp_path):
    write(tmp_path / "a.csv", "ID,TYPE,PIXEL_TS,NOTE", "1,deposit,2025-11-01 10:00:00 UTC,plain")
    clean = rd.event_csv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    write(tmp_path / "b.csv", "ID,TYPE,PIXEL_TS,NOTE", '2,deposit,2025-11-01 10:00:00 UTC,"two', 'lines"')
    mixed = rd.event_csv(spark, str(tmp_path))
    assert clean.count("Scan csv") < mixed._jdf.queryExecution().executedPlan().toString().count("Scan csv")
    assert sorted(r.event_id for r in mixed.collect()) == ["1", "2"]


def test_sheets_with_line_feeds_and_own_headers(spark, tmp_path):
    write(tmp_path / "s" / "a.csv", "Event Date,CampaignID,Campaign Name", '2024-01-01,1,"one', 'two"', "2024-01-02,2,x")
    write(tmp_path / "s" / "b.csv", "Campaign Name,Event-Date,Views", "y,2024-01-03,5")
    got = sorted((r.event_date, r.campaignid, r.campaign_name, r.views) for r in rd.campaign_sheet(spark, str(tmp_path / "s"), "1", "1_hour").collect())
    assert got == [("2024-01-01", "1", "one\ntwo", None), ("2024-01-02", "2", "x", None), ("2024-01-03", None, "y", "5")]


def test_mappings_and_lists_follow_each_files_header(spark, tmp_path):
    write(tmp_path / "m" / "1.csv", "event_id,Advertiser", "e1,brand_a")
    write(tmp_path / "m" / "2.csv", "Advertiser,event_id", "brand_b,e2", '"brand', '_b",e3')
    assert sorted((r.link, r.brand) for r in rd.brand_csv(spark, str(tmp_path / "m")).collect()) == [("e1", "brand_a"), ("e2", "brand_b"), ("e3", "brand\n_b")]
    write(tmp_path / "m" / "3.csv", "Brand,event_id", "brand_b,e3")
    with pytest.raises(Exception, match="no header line in .*3.csv"):
        rd.brand_csv(spark, str(tmp_path / "m")).collect()
    write(tmp_path / "u" / "1.csv", "user_id,x", "u1,7")
    write(tmp_path / "u" / "2.csv", "x,user_id", "7,u3")
    write(tmp_path / "u" / "3.csv", "x,external_user_id,y", "8,u4,9")
    assert sorted(r.user_id for r in rd.user_list(spark, path=str(tmp_path / "u")).collect()) == ["u1", "u3", "u4"]


def test_jdbc_reader_asks_for_a_driver(spark):
    with pytest.raises(Exception):
        rd.jdbc_table(spark, "jdbc:nosuchdb://x", "t", "id", "0", "10")


# --- brands -----------------------------------------------------------------


def test_backfill(spark, events):
    rows = [{"event_id": str(i), "external_user_id": u, "event_date": d, "website": w, "advertiser": a} for i, (u, d, w, a) in enumerate([
        ("u1", "2025-12-01 23:59:59", None, None), ("u1", "2025-12-02 00:00:00", "x.ANT.com", None), ("u2", "2025-12-03 12:00:00", None, "keep"), ("u2", "2025-12-09", None, None)])]
    df = events(rows)
    brand = lambda d: [r.advertiser for r in d.orderBy("event_id").collect()]
    assert brand(at.fill_before(df, "2025-12-02", "old")) == ["old", None, "keep", None]
    assert brand(at.fill_from_website(df, [("a", ["ant"])], "std", "2025-12-02")) == [None, "a", "keep", "std"]
    mapping = at.brand_mapping(spark.createDataFrame([("u1", "2025-12-02 05:00:00", "m1"), ("u2", "2025-12-03 01:00:00", "m2"), ("u2", "2025-12-09 01:00:00", "m3")],
                                                     "k string, day string, b string"), "k", "b", "day")
    kw = dict(link="external_user_id", start="2025-12-02", end="2025-12-08")
    assert brand(at.fill_from_mapping(df, mapping, replace=False, **kw)) == [None, "m1", "keep", None]
    assert brand(at.fill_from_mapping(df, mapping, replace=True, **kw)) == [None, "m1", "m2", None]
    by_event = at.brand_mapping(spark.createDataFrame([("0", "z")], "k string, b string"), "k", "b")
    assert brand(at.fill_from_mapping(df, by_event)) == ["z", None, "keep", None]


def test_format_changes(spend):
    df = spend([(1, "(1) A-POP", None, "m", 1, "1"), (2, "(2) B-PUSH", "POP", "m", 1, "1"), (3, "(3) C-POP", "POP", "m", 1, "1"), (4, None, "POP", "m", 1, "1")])
    assert [(r.publisher_id, r.old_format, r.new_format) for r in at.format_changes(df).collect()] == [(1, None, "POP"), (2, "POP", "PUSH")]
    assert [r.format for r in at.reclassify_formats(df).orderBy("publisher_id").collect()] == ["POP", "PUSH", "POP", "POP"]


def test_rolled_up_cost_of_nothing_is_zero(spark):
    day = spark.createDataFrame([(1, "n", "POP", dt.date(2024, 1, 1), 0, 5.0), (0, "o", "POP", dt.date(2024, 1, 1), 1, 5.0)],
                                "publisher_id bigint, publisher_name string, format string, date date, deposits_reported bigint, spend double")
    (row,) = at.monthly_from_daily(day.withColumn("spend", F.col("spend").cast("decimal(15,2)"))).collect()
    assert (row.publisher_id, row.month, float(row.current_cpa)) == (1, "2024-01", 0.0)


# --- quality ----------------------------------------------------------------


def test_holes_and_duplicates(spark, events):
    df = events([{"event_id": "1", "event_date": "2024-01-01"}, {"event_id": "1", "event_date": "2024-01-03"}, {"event_date": "2024-01-03"}, {"event_date": "2024-01-03"}])
    assert [str(r.date) for r in dq.missing_dates(df).collect()] == ["2024-01-02"]
    assert [(r.event_id, r.cnt) for r in dq.duplicates(df, ["event_id"]).collect()] == [("1", 2)]


def test_reconcile_sees_a_lost_row(events):
    df = events([{"event_id": str(i), "event_date": f"2024-01-0{i + 1}"} for i in range(4)])
    assert dq.reconcile(df, df).first().matches
    assert not dq.reconcile(df, df.filter("event_id <> '2'")).first().matches


# --- writing ----------------------------------------------------------------


def ids(spark, path):
    return sorted((r.event_id, r.event_month, float(r.converted_amount)) for r in wr.read_table(spark, path).collect())


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shuffle_partitions_follow_the_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size_for(spark, 192 << 30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1024"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_upsert(spark, events, tmp_path):
    path = str(tmp_path / "t")
    row = lambda i, d, a: {"event_id": i, "event_date": d, "converted_amount": a}
    wr.upsert_events(events([row("1", "2024-01-05", 1), row("2", "2024-02-05", 1), row("3", "2024-03-05", 1)]), path)
    # A repeat in the table, as older loads may have left.
    wr.append(wr.with_month(events([row("1", "2024-01-06", 2)])), path, [wr.MONTH])
    batch = events([row("2", "2024-04-05", 5), row("1", "2024-01-07", 7), row("1", "2024-01-01", 6), row("4", "2024-01-01", 9), row(None, "2024-01-01", 9)])
    for _ in range(2):
        wr.upsert_events(batch, path)
        assert ids(spark, path) == [("1", "2024-01", 7.0), ("2", "2024-04", 5.0), ("3", "2024-03", 1.0), ("4", "2024-01", 9.0)]
    wr.upsert_events(batch.limit(0), path)
    assert len(ids(spark, path)) == 4


def test_insert_or_ignore(spark, events):
    row = lambda i, a: {"event_id": i, "event_date": "2024-01-01", "converted_amount": a}
    new = wr.insert_or_ignore(events([row("1", 1), row(None, 1)]), events([row("1", 2), row("2", 4), row("2", 3), row(None, 5), row(None, 5)]), [F.col("converted_amount")])
    assert sorted((r.event_id or "", float(r.converted_amount)) for r in new.collect()) == [("", 5.0), ("", 5.0), ("2", 3.0)]


def test_replace_period(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "x int, month string")
    content = lambda p: sorted(map(tuple, wr.read_table(spark, p).select("month", "x").collect()))
    stored = [(1, "2024-01"), (2, "2024-02"), (3, "2024-03"), (4, "2024-04")]
    new = frame([(10, "2024-01"), (30, "2024-03")])
    for mode, left in [("partition", [("2024-02", 2)]), ("range", [])]:
        path = str(tmp_path / mode)
        wr.replace_period(frame(stored), path, "month", mode)
        wr.replace_period(new, path, "month", mode)
        assert content(path) == sorted([("2024-01", 10), ("2024-03", 30), ("2024-04", 4), *left])
    with pytest.raises(ValueError):
        wr.replace_period(new, str(tmp_path / "z"), "month", "all")


def test_replace_sheet_with_numeric_ids(spark, tmp_path):
    path = str(tmp_path / "sheets")
    frame = lambda rows: spark.createDataFrame(rows, "v int, source_sheet_id string")
    wr.replace_sheets(frame([(1, "007"), (2, "8")]), path)
    wr.replace_sheets(frame([(5, "007")]), path)
    got = wr.read_table(spark, path, like=frame([(1, "x")]))
    assert sorted((r.source_sheet_id, r.v) for r in got.collect()) == [("007", 5), ("8", 2)]


def test_types_follow_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    wr.append(spark.createDataFrame([(1,)], "x bigint"), path)
    wr.append(spark.createDataFrame([(2,)], "x int"), path)
    assert sorted(r.x for r in wr.read_table(spark, path).collect()) == [1, 2]
    wr.append(spark.createDataFrame([(3, "n")], "x bigint, extra string"), path)
    assert "extra" in wr.read_table(spark, path, merge_schema=True).columns


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "out"
    wr.csv_results(spark.createDataFrame([(1,)], "a int"), str(path), single_file=True, byte_order_mark=True)
    (part,) = path.glob("part-*.csv")
    assert part.read_bytes() == "\ufeffa\n1\n".encode()


# --- streams ----------------------------------------------------------------


def test_incremental_loads_survive_a_restart(spark, tmp_path):
    land, table, check = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "check")
    load = lambda: ingest.append_stream(ingest.event_stream(spark, str(land), {1: "x"}), table, check).awaitTermination()
    write(land / "1.csv", HEADER, pixel_line("a"), pixel_line("b"))
    load()
    load()
    assert wr.read_table(spark, table).count() == 2
    write(land / "2.csv", HEADER, pixel_line("c"))
    load()
    assert sorted(r.event_id for r in wr.read_table(spark, table).collect()) == ["a", "b", "c"]


def test_repeats_within_the_horizon(spark, tmp_path):
    land, table, check = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "check")
    load = lambda: ingest.append_stream(ingest.without_repeats(ingest.event_stream(spark, str(land), {}), "2 days"), table, check).awaitTermination()
    write(land / "1.csv", HEADER, pixel_line("a"), pixel_line("a"), pixel_line("b"))
    load()
    write(land / "2.csv", HEADER, pixel_line("a", ts="2025-11-01 12:00:00 UTC"), pixel_line("c"))
    load()
    assert sorted(r.event_id for r in wr.read_table(spark, table).collect()) == ["a", "b", "c"]


def test_stream_upsert(spark, tmp_path):
    land, table, check = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "check")
    load = lambda: ingest.upsert_stream(ingest.event_stream(spark, str(land), {1: "x"}), table, check).awaitTermination()
    write(land / "1.csv", HEADER, pixel_line("a", amount="1"), pixel_line("b", amount="1"))
    load()
    write(land / "2.csv", HEADER, pixel_line("a", ts="2025-12-01 10:00:00 UTC", amount="5"))
    load()
    load()
    assert ids(spark, table) == [("a", "2025-12", 5.0), ("b", "2025-11", 1.0)]


def test_rows_without_a_period_cost_no_others(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "date string, n int").withColumn("date", F.to_date("date"))
    wr.replace_period(rows(("2025-01-01", 1), ("2025-02-01", 2), ("2025-03-01", 3), ("2025-09-01", 9)), path, "date")
    wr.replace_period(rows(("2025-01-01", 10), ("2025-03-01", 30), (None, 5)), path, "date", "range")
    read = lambda: sorted((str(r.date), r.n) for r in spark.read.parquet(path).collect())
    assert read() == [("2025-01-01", 10), ("2025-03-01", 30), ("2025-09-01", 9), ("None", 5)]
    wr.replace_period(rows((None, 6)), path, "date", "range")
    wr.replace_period(rows((None, 6)).limit(0), path, "date", "range")
    assert read() == [("2025-01-01", 10), ("2025-03-01", 30), ("2025-09-01", 9), ("None", 6)]


def test_upsert_keeps_rows_without_a_time(spark, events, tmp_path):
    path = str(tmp_path / "t")
    wr.append(wr.with_month(events([{"event_id": "1"}, {"event_id": "2"}, {"event_id": "3", "event_date": "2025-01-01"}])), path, [wr.MONTH])
    batch = events([{"event_id": "2", "converted_amount": 5}, {"event_id": "4"}])
    for _ in range(2):
        wr.upsert_events(batch, path)
        got = sorted((r.event_id, r.event_month, r.converted_amount and float(r.converted_amount)) for r in spark.read.parquet(path).collect())
        assert got == [("1", None, None), ("2", None, 5.0), ("3", "2025-01", None), ("4", None, None)]
    wr.upsert_events(events([{"event_id": str(i), "event_date": "2025-02-01"} for i in (1, 2, 4)]), path)
    assert sorted((r.event_id, r.event_month) for r in spark.read.parquet(path).collect()) == [("1", "2025-02"), ("2", "2025-02"), ("3", "2025-01"), ("4", "2025-02")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # no staging left


def test_a_shared_folder_is_asked_for_off_one_machine(spark, monkeypatch):
    from adtally import session

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
        sparkContext = type("C", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError):
        session.shared_dir(Session())

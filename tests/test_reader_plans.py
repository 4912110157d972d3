from pyspark.sql import functions as F

from adtally.sources import readers as rd

VALUES = ["12", " 12 ", "+5", "-7", "12.5", "1e3", "5.", "1,5", "a", "", " ", "t", " yes\t", "NO", "Ts", "0", "inf", "NaN", "٣", "1 ", "9" * 40, "2024-01-01", "+", "1-2", "é", None]


def test_records_find_their_header_without_a_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,TYPE,PIXEL_TS\n1,deposit,2025-01-01 00:00:00 UTC\n2,"de,po,sit"\n')
    (tmp_path / "b.csv").write_bytes(b'\xef\xbb\xbf"PIXEL_TS","NOTE",TYPE,"ID"\n2025-01-02 00:00:00,"x, ""y""", caf\xe9 ,3\n\n , ,\n2025-01-03 00:00:00,n,caf\xc3\xa9,4\n')
    rows = rd.event_csv(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted((r["event_id"], r["event_type"], str(r["event_date"])) for r in rows.collect()) == [
        ("1", "deposit", "2025-01-01 00:00:00"), ("3", "café", "2025-01-02 00:00:00"), ("4", "café", "2025-01-03 00:00:00")]


def test_a_sheet_is_read_by_each_files_first_record_however_short(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,Spend\nx,\"1,5\"\ny\n")
    (tmp_path / "b.csv").write_text("Spend,More,Name\n2,m,z\n")
    rows = rd.campaign_sheet(spark, str(tmp_path), "s", "1_hour", "2025-01-01 00:00:00")
    assert sorted(map(tuple, rows.select("name", "spend", "more").collect()), key=str) == [("x", "1,5", None), ("y", None, None), ("z", "2", "m")]


def test_observed_types_are_those_of_the_casts(spark):
    for value in VALUES:
        df = spark.createDataFrame([(value,)], "v string")
        casts = df.select(*[F.col("v").try_cast(t).isNotNull().alias(t) for t in ("bigint", "decimal(38,10)", "boolean")]).first()
        kind = next((t for t in casts.asDict() if casts[t]), "string")
        assert rd.observed_types(df) == {"v": kind}, value

"""Stored tables that change: layouts, refreshed reports, the event index, resumed copies, streams of files."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from adtally.operators import arppu, insights as ins, reactivation as rx, sketches as sk, split_test as st
from adtally.sources import event_index as ix, layouts as ly, views as vw, writers as wr
from adtally.streaming import ingest


def files_of(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def random_events(seed, n, first="2025-01-01", days=300, users=12):
    r, start = random.Random(seed), dt.datetime.fromisoformat(first)
    return [{"event_id": f"{seed}-{i}", "external_user_id": f"u{r.randrange(users)}", "event_date": str(start + dt.timedelta(minutes=r.randrange(days * 1440))),
             "converted_amount": r.choice([0, 1.5, 20]), "event_type": r.choice(["deposit", "deposit", "view"])} for i in range(n)]


# --- layouts ----------------------------------------------------------------


@pytest.mark.parametrize("one, two, both", [
    ("int", "bigint", "bigint"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(10,4)", "decimal(12,1)", "decimal(15,4)"),
    ("decimal(38,0)", "decimal(10,5)", "string"), ("int", "double", "double"), ("bigint", "double", "string"), ("float", "double", "double"),
    ("boolean", "bigint", "string"), ("date", "timestamp", "timestamp"), ("string", "bigint", "string"), ("void", "bigint", "bigint"), ("bigint", "void", "bigint")])
def test_common_types_hold_both(spark, one, two, both):
    a, b, c = (T.NullType() if x == "void" else T._parse_datatype_string(x) for x in (one, two, both))
    assert ly.common_type(a, b) == c == ly.common_type(b, a)


def test_stored_columns_widen_and_new_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    wr.append(spark.createDataFrame([("007", 1, 2)], "sheet string, a int, b bigint"), path, ["sheet"])
    wr.append(spark.createDataFrame([("007", Decimal("1.75"), "new")], "sheet string, a decimal(4,2), c string"), path, ["sheet"])
    wr.append(spark.createDataFrame([("8", 5, "x")], "sheet string, a int, b string"), path, ["sheet"])
    got = wr.read_table(spark, path)
    assert dict(got.dtypes) == {"sheet": "string", "a": "decimal(12,2)", "b": "string", "c": "string"}
    assert sorted(map(tuple, got.select("sheet", "a", "b", "c").collect()), key=str) == sorted(
        [("007", Decimal("1.00"), "2", None), ("007", Decimal("1.75"), None, "new"), ("8", Decimal("5.00"), "x", None)], key=str)
    assert not list(tmp_path.glob("t.*")) and (tmp_path / "t" / "sheet=007").is_dir()


def test_tables_without_a_noted_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 10)], "month int, a int").write.partitionBy("month").parquet(path)
    wr.replace_partitions(spark.createDataFrame([("01", 1 << 40)], "month string, a bigint"), path, ["month"])
    got = wr.read_table(spark, path)
    assert sorted(map(tuple, got.select("month", "a").collect())) == [("01", 1 << 40), ("1", 10)]


def test_rows_made_from_the_table_itself(spark, tmp_path):
    """A wider column moves the table while its rows are still to be read."""
    path = str(tmp_path / "t")
    wr.append(spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int"), path, ["k"])
    wr.append(wr.read_table(spark, path).withColumn("a", F.col("a") + F.lit("0.5").cast("decimal(3,1)")), path, ["k"])
    assert sorted(float(r.a) for r in wr.read_table(spark, path).collect()) == [1.0, 1.5, 2.0, 2.5] and not list(tmp_path.glob("t.*"))


def test_unchanged_layouts_rewrite_nothing(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.createDataFrame([("x", 1)], "k string, a bigint")
    wr.append(rows, str(path), ["k"])
    before = files_of(path)
    wr.append(rows.withColumn("a", F.col("a").cast("int")), str(path), ["k"])
    assert before < files_of(path) and wr.read_table(spark, str(path)).count() == 2


# --- refreshed reports ------------------------------------------------------


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_reactivations_are_refreshed(spark, events, tmp_path):
    path = tmp_path / "r"
    stored = random_events(1, 150)
    batches = [random_events(2, 20, "2025-11-20", 30), random_events(3, 5, "2025-06-01", 3, 3), random_events(4, 10, "2025-11-20", 60, 30), []]
    vw.build_reactivations(events(stored), str(path))
    for batch in batches:
        stored = stored + batch
        new, whole = events(batch), events(stored)
        before = files_of(path)
        written = vw.refresh_reactivations(new, whole, str(path))
        got = wr.read_table(spark, str(path)).drop("month")
        assert rows_of(got.select(rx.gaps(whole).columns)) == rows_of(rx.gaps(whole))
        kept = {f for f in before if f.split("/")[0].removeprefix("month=") not in written}
        assert kept <= files_of(path)
        assert vw.refresh_reactivations(new, whole, str(path)) == set()  # again, nothing differs
    # A corrected history: one user's events are gone.
    left = [e for e in stored if e["external_user_id"] != "u1"]
    vw.refresh_reactivations(events([]), events(left), str(path), changed_users=spark.createDataFrame([("u1",)], "user_id string"))
    assert rows_of(wr.read_table(spark, str(path)).select(rx.gaps(whole).columns)) == rows_of(rx.gaps(events(left)))


def test_a_refresh_computes_its_rows_once(spark, events, tmp_path):
    path, stored, batch = str(tmp_path / "r"), random_events(1, 150), random_events(2, 30, "2025-06-01", 200)
    vw.build_reactivations(events(stored), path)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def counted(at):
        seen.add(1)
        return at

    history = events(stored + batch).withColumn("event_date", counted("event_date"))
    vw.refresh_reactivations(events(batch), history, path)
    assert 0 < seen.value <= len(stored + batch)
    assert rows_of(wr.read_table(spark, path).select(rx.gaps(history).columns)) == rows_of(rx.gaps(events(stored + batch)))


def test_exchanged_rows_are_counted(spark, tmp_path):
    """A partition with the same rows in other numbers is written, one with the same rows is not."""
    path, shape = tmp_path / "t", "k string, n int, month string"
    wr.append(spark.createDataFrame([("a", 1, "1"), ("a", 1, "1"), ("b", None, "2"), ("c", 3, "3"), ("d", 4, "4")], shape), str(path), ["month"])
    new = spark.createDataFrame([("a", 1, "1"), ("b", None, "2"), ("c", 5, None)], shape)
    gone = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    before = files_of(path)
    assert vw.exchange_rows(spark, str(path), "month", ["k"], gone, new) == {"1", "3", None}
    assert {f for f in before if f.startswith(("month=2/", "month=4/"))} <= files_of(path)
    got = sorted(map(str, map(tuple, wr.read_table(spark, str(path)).select("k", "n", "month").collect())))
    assert got == sorted(map(str, [("a", 1, "1"), ("b", None, "2"), ("c", 5, None), ("d", 4, "4")])) and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_in_order_batches_touch_only_new_months(spark, events, tmp_path):
    path = tmp_path / "r"
    stored = random_events(1, 150)
    vw.build_reactivations(events(stored), str(path))
    batch = random_events(2, 20, "2026-02-01", 20)
    assert vw.refresh_reactivations(events(batch), events(stored + batch), str(path)) <= {"2026-02"}


def test_cohorts_are_refreshed(spark, events, tmp_path):
    path = tmp_path / "c"
    stored = random_events(1, 120, users=40)
    vw.build_cohorts(events(stored), str(path))
    for batch in (random_events(2, 20, "2025-12-01", 30, 60), random_events(3, 4, "2024-12-01", 20, 40)):
        stored = stored + batch
        whole = events(stored)
        before, written = files_of(path), vw.refresh_cohorts(events(batch), whole, str(path))
        expected = arppu.first_period(whole, "2026-03-01", "month")
        assert rows_of(vw.cohorts(spark, str(path), "2026-03-01")) == rows_of(expected.select(vw.cohorts(spark, str(path), "2026-03-01").columns))
        assert {f for f in before if f.split("/")[0].removeprefix("cohort=") not in written} <= files_of(path)
        assert vw.refresh_cohorts(events(batch), whole, str(path)) == set()


def test_group_layers_add_up(spark, events, tmp_path):
    path = str(tmp_path / "g")
    one, two = random_events(1, 60), random_events(2, 40)
    for name, rows in (("a", one), ("b", two), ("b", two)):
        vw.add_group_layer(events(rows), path, name)
    expected = rows_of(st.compare(st.assign(events(one + two))))
    assert rows_of(st.compare_totals(vw.group_totals(spark, path))) == expected
    vw.compact_layers(spark, path)
    assert rows_of(st.compare_totals(vw.group_totals(spark, path))) == expected and len(list((tmp_path / "g").glob("layer=*"))) == 1


# --- the event index --------------------------------------------------------


def test_indexed_upsert_reads_only_candidates(spark, events, tmp_path):
    path = tmp_path / "e"
    stored = random_events(1, 200)
    wr.append(wr.with_month(events(stored)), str(path), [wr.MONTH])
    assert len(ix.update(spark, str(path))) > 8 and ix.update(spark, str(path)) == set()
    some = [e for e in stored if e["event_date"].startswith("2025-03")][:2]
    batch = events([{**e, "event_date": "2025-08-01 00:00:00", "converted_amount": 7} for e in some])
    assert ix.months_of(batch, str(path)) == {"2025-03"}
    plan = ix.lookup(batch, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part#" in plan.replace("isnotnull(part", "part#") or "part IN" in plan or "part#" in plan
    before = files_of(path)
    wr.upsert_events(batch, str(path), indexed=True)
    changed = {f.split("/")[0] for f in before ^ files_of(path)}
    assert changed == {"event_month=2025-03", "event_month=2025-08"}
    ids = {e["event_id"] for e in some}
    got = {r.event_id: str(r.event_date) for r in wr.read_table(spark, str(path)).collect()}
    assert len(got) == 200 and all(got[i] == "2025-08-01 00:00:00" for i in ids)
    assert ix.months_of(batch, str(path)) >= {"2025-08"} and ix.update(spark, str(path)) == set()
    ix.rebuild(spark, str(path))
    assert ix.months_of(batch, str(path)) == {"2025-08"}


def test_index_notices_writes_behind_its_back(spark, events, tmp_path):
    path = str(tmp_path / "e")
    wr.upsert_events(events(random_events(1, 30)), path, indexed=True)
    other = random_events(2, 10, "2025-05-01", 5)
    wr.append(wr.with_month(events(other)), path, [wr.MONTH])
    moved = [{**other[0], "event_date": None, "converted_amount": 9}]
    wr.upsert_events(events(moved), path, indexed=True)
    wr.upsert_events(events(moved), path, indexed=True)
    rows = wr.read_table(spark, path).filter(F.col("event_id") == other[0]["event_id"]).collect()
    assert len(rows) == 1 and rows[0].event_date is None and wr.read_table(spark, path).count() == 40


def test_upsert_keeps_columns_of_the_table(spark, events, tmp_path):
    path = str(tmp_path / "e")
    wr.append(wr.with_month(events(random_events(1, 5, days=3))).withColumn("note", F.lit("n")), path, [wr.MONTH])
    wr.upsert_events(events([{"event_id": "x", "event_date": "2025-01-01"}]), path)
    got = {r.event_id: r.note for r in wr.read_table(spark, path).collect()}
    assert len(got) == 6 and got.pop("x") is None and set(got.values()) == {"n"}


def test_upserts_leave_alone_what_does_not_change(spark, events, tmp_path):
    path = tmp_path / "e"
    stored = random_events(1, 60, days=120)
    wr.upsert_events(events(stored), str(path))
    before = files_of(path)
    wr.upsert_events(events(stored), str(path))
    assert files_of(path) == before  # the same rows again: no file is written
    march = next(e for e in stored if e["event_date"].startswith("2025-03"))
    batch = [{**march, "converted_amount": 7}, {"event_id": "new", "event_date": "2025-01-05", "converted_amount": 1}, stored[0]]
    wr.upsert_events(events(batch), str(path))
    after = files_of(path)
    assert {f.split("/")[0] for f in before - after} == {"event_month=2025-03"}  # the one month with a row replaced
    assert {f.split("/")[0] for f in after - before} == {"event_month=2025-01", "event_month=2025-03"}
    expected = {e["event_id"]: e for e in [*stored, *batch]}
    table = lambda: rows_of(wr.read_table(spark, str(path)).select(wr.with_month(events([])).columns))
    assert table() == rows_of(wr.with_month(events(list(expected.values()))))
    # Rows equal to the new one but stored twice, and equal but for a value that is missing, do change.
    wr.append(wr.with_month(events([march | {"converted_amount": 7}])), str(path), [wr.MONTH])
    lost = next(e for e in stored if e["event_date"].startswith("2025-02"))
    wr.upsert_events(events([march | {"converted_amount": 7}, lost | {"external_user_id": None}]), str(path))
    expected[lost["event_id"]] = lost | {"external_user_id": None}
    assert table() == rows_of(wr.with_month(events(list(expected.values())))) and [p.name for p in tmp_path.iterdir()] == ["e"]


def test_upsert_into_a_narrower_table(spark, events, tmp_path):
    path = str(tmp_path / "e")
    stored = random_events(1, 20, days=60)
    wr.append(wr.with_month(events(stored)).withColumn("publisher_id", F.lit(1).cast("int")), path, [wr.MONTH])
    moved = {**stored[0], "event_date": "2026-01-01", "publisher_id": 1 << 40}
    wr.upsert_events(events([moved, {"event_id": "x", "event_date": "2025-01-01", "publisher_id": 5}]), path)
    got = {r.event_id: (r.publisher_id, r.event_month) for r in wr.read_table(spark, path).collect()}
    assert len(got) == 21 and got[stored[0]["event_id"]] == (1 << 40, "2026-01") and got["x"] == (5, "2025-01")
    assert dict(wr.read_table(spark, path).dtypes)["publisher_id"] == "bigint" and [p.name for p in tmp_path.iterdir()] == ["e"]


# --- resumed copies ---------------------------------------------------------


def test_copy_goes_on_where_it_ended(spark, events, tmp_path):
    path = tmp_path / "c"
    rows = random_events(1, 120) + [{"event_id": "t", "event_date": None}]
    source = events(rows)
    first = wr.copy_ranges(source, str(path), at_once=2, most=5)
    assert len(first) == 5
    # A run that died left rows of the next month behind, which are not in its list.
    month = sorted({e["event_date"][:7] for e in rows if e["event_date"]})[5]
    wr.with_month(source).filter(F.col(wr.MONTH) == month).limit(1).write.mode("append").partitionBy(wr.MONTH).parquet(str(path))
    second = wr.copy_ranges(source, str(path))
    assert not set(first) & set(second) and None in second and wr.copy_ranges(source, str(path)) == []
    assert rows_of(spark.read.schema(wr.with_month(source).schema).parquet(str(path))) == rows_of(wr.with_month(source))
    changed = events([{**e, "converted_amount": 3} if e["event_id"] == "1-0" else e for e in rows])
    assert wr.copy_ranges(changed, str(path)) == [rows[0]["event_date"][:7]]
    assert wr.copy_ranges(changed, str(path)) == []


# --- streams of files -------------------------------------------------------


def test_files_of_any_layout(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    run = lambda: ingest.upsert_files(spark, str(folder), {1: "x"}, str(tmp_path / "t"), str(tmp_path / "q"), str(tmp_path / "cp")).awaitTermination()
    (folder / "a b+c.csv").write_text("EVENT_ID,TYPE,PIXEL_TS,ADVERTISER_ID\n1,deposit,2025-11-01 10:00:00 UTC,1\n")
    (folder / "b.csv").write_text('PIXEL_TS,TYPE,EVENT_ID,SUB_ID\n2025-11-02 10:00:00 UTC,deposit,2,"s\nt"\n')
    (folder / "bad.csv").write_text("x,y\n1,2\n")
    (folder / "empty.csv").write_text("")
    (folder / "torn.csv").write_text('EVENT_ID,TYPE,PIXEL_TS\n7,"deposit,2025-11-02 10:00:00 UTC\n')
    run()
    (folder / "c.csv").write_text("TYPE,EVENT_ID,PIXEL_TS\nview,1,2025-12-01 10:00:00 UTC\n")
    run()
    got = {r.event_id: (r.event_type, str(r.event_date), r.advertiser, r.sub_id) for r in wr.read_table(spark, str(tmp_path / "t")).collect()}
    assert got == {"1": ("view", "2025-12-01 10:00:00", None, None), "2": ("deposit", "2025-11-02 10:00:00", None, "s\nt")}
    bad = {r.file_path.rsplit("/", 1)[1]: r.reason for r in spark.read.parquet(str(tmp_path / "q")).collect()}
    assert bad == {"bad.csv": "no header line", "torn.csv": "quotes do not pair up"}


# --- funnels, attribution, sketches -----------------------------------------


def test_ordered_funnel_against_brute_force(events):
    r = random.Random(4)
    start = dt.datetime(2025, 1, 1)
    rows = [{"event_id": str(i), "external_user_id": r.choice(["a", "b", "c", None]), "event_type": r.choice(["view", "click", "deposit", "error"]),
             "event_date": str(start + dt.timedelta(minutes=10 * r.randrange(600)))} for i in range(250)]
    rows += [rows[3]] * 3
    for hours, slot in ((24, 6), (1, 6), (0, 1), (7.5, 48)):
        counted = {"view": [e for e in rows if e["event_type"] == "view" and e["external_user_id"]]}
        for before, stage in (("view", "click"), ("click", "deposit")):
            at = lambda e: dt.datetime.fromisoformat(e["event_date"])
            near = lambda e: any(p["external_user_id"] == e["external_user_id"] and 0 <= (at(e) - at(p)).total_seconds() <= hours * 3600 for p in counted[before])
            counted[stage] = [e for e in rows if e["event_type"] == stage and e["external_user_id"] and near(e)]
        got = ins.ordered_funnel(events(rows), within_hours=hours, slot_hours=slot).first()
        for stage, found in counted.items():
            assert (got[f"{stage}_events"], got[f"{stage}_users"]) == (len(found), len({e["external_user_id"] for e in found}))
    empty = ins.ordered_funnel(events([])).first()
    assert empty.view_events == 0 and empty.deposit_users == 0


def test_deposits_go_to_the_last_click(events):
    e = lambda kind, at, campaign, user="a": {"event_id": at + kind, "external_user_id": user, "event_type": kind, "event_date": f"2025-01-01 {at}" if len(at) == 8 else at,
                                              "campaign_id": campaign, "converted_amount": 10}
    rows = [e("click", "10:00:00", 1), e("deposit", "10:30:00", 9), e("click", "10:45:00", 2), e("deposit", "12:00:00", 9), e("deposit", "2025-01-02 10:45:00", 9),
            e("deposit", "2025-01-02 10:45:01", 9), e("deposit", "09:00:00", 9), e("deposit", "10:50:00", 9, "b"), e("click", "11:00:00", None, "b"), e("deposit", "11:10:00", 9, "b")]
    got = {(r.attribution_type, r.campaign_id, str(r.date)): r.attributed for r in ins.attributed_deposits(events(rows), ins.ATTRIBUTIONS).collect()}
    assert got == {("1_hour", 1, "2025-01-01"): 1, ("24_hours", 1, "2025-01-01"): 1, ("24_hours", 2, "2025-01-01"): 1, ("24_hours", 2, "2025-01-02"): 1}


def test_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 7).alias("day"), F.lit("g").alias("g"), (F.col("id") % 9000).cast("string").alias("user"), (F.col("id") % 1000).alias("v"))
    about = sk.distinct_estimate(sk.distinct_sketches(rows, ["day", "g"], "user"), ["g"]).first()
    assert abs(about.distinct_values - 9000) < 4 * 0.0163 * 9000
    marks = sk.quantile_estimate(sk.quantile_sketches(rows.unionAll(rows.limit(1).withColumn("v", F.lit(None))), ["day", "g"], "v"), ["g"], (0.1, 0.9)).first()
    assert marks.n_values == 20_000 and abs(marks.p10 - 100) <= 15 and abs(marks.p90 - 900) <= 15
    assert sk.distinct_estimate(sk.distinct_sketches(rows.limit(0), ["g"], "user"), ["g"]).collect() == []

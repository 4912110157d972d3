import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from adtally.operators import arppu, campaigns as cm, insights as ins, ranking, split_test as st


# --- ranks ------------------------------------------------------------------


def test_counts_below_by_brute_force(spark):
    rng = random.Random(11)
    rows = [(g, rng.choice([rng.randrange(-50, 50), rng.randrange(-2**62, 2**62), 7, rng.randrange(2**17)])) for g in "ab" for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v bigint").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r.g, r.v): (r.n_below, r.n_total) for r in ranking.counts_below(df, ["g"], "v", "n").collect()}
    for (g, v), pair in got.items():
        mine = [x for h, x in rows if h == g]
        assert pair == (sum(x < v for x in mine), len(mine))
    assert len(got) == len(set(rows))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentiles_by_brute_force(spark, p):
    rng = random.Random(12)
    rows = [(g, rng.randrange(-1000, 1000000)) for g in "abc" for _ in range({"a": 1, "b": 2, "c": 301}[g])] + [("a", None)]
    got = {r.g: r.q for r in ranking.exact_percentile(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", p, "q").collect()}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile([v for h, v in rows if h == g and v is not None], p))


# --- split test -------------------------------------------------------------


def users(counts):
    """(user id, amounts) pairs as events."""
    return [{"external_user_id": u, "event_date": "2024-03-01", "converted_amount": a} for u, amounts in counts for a in amounts]


@pytest.mark.parametrize("top, bottom", [(0, 0), (10, 0), (0, 10), (20, 20), (50, 0)])
def test_trimming_is_percent_rank(spark, events, top, bottom):
    rng = random.Random(13)
    rows = users([(f"{i:04d}{rng.choice('0189az')}", [rng.randrange(1, 9) for _ in range(rng.randrange(1, 4))]) for i in range(150)])
    grouped = st.assign(events(rows))
    per_user = st.user_totals(grouped)
    rank = F.percent_rank().over(Window.partitionBy("test_group").orderBy("total_usd"))
    kept = per_user.withColumn("k", rank).filter((F.col("k") <= 1 - top / 100) & (F.col("k") >= bottom / 100))
    expected = kept.groupBy("test_group").agg(F.count("*").alias("u"), F.sum("deposit_count").alias("n"), F.sum("total_usd").alias("s"))
    got = st.compare(grouped, top, bottom).select("test_group", "unique_users", "total_deposits", "total_deposits_usd")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_a_lone_user_has_rank_zero(events):
    rows = users([("x1", [5]), ("x9", [1]), ("y9", [1]), ("z9", [2]), ("w9", [3])])
    got = {r.test_group: r.unique_users for r in st.compare(st.assign(events(rows)), 10, 0).collect()}
    assert got == {"Control": 1, "Test": 3}
    assert {r.test_group for r in st.compare(st.assign(events(rows)), 0, 10).collect()} == {"Test"}


def test_positions_and_short_ids(events):
    rows = users([("ab1", [1]), ("A9", [1]), ("7", [1]), ("x-_", [1])])
    group = lambda k: {r.user_id: r.test_group for r in st.assign(events(rows), position=k).collect()}
    assert group(1) == {"ab1": "Control", "A9": "Test", "7": "Control", "x-_": "Unknown"}
    assert group(2) == {"ab1": "Test", "A9": "Test", "x-_": "Unknown"}


def test_comparison_without_a_group(events):
    rows = st.with_comparison(st.compare(st.assign(events(users([("x1", [5, 5])]))))).collect()
    assert [r.test_group for r in rows] == ["Control", "Comparison %", "Comparison Abs"]
    assert rows[1].unique_users is None


def test_mean_of_user_means_differs(events):
    grouped = st.assign(events(users([("a1", [1, 1, 1, 1]), ("b1", [9])])))
    assert float(st.rounded(st.compare(grouped)).first().avg_deposit) == 2.6
    assert float(st.compare_user_means(grouped).first().avg_deposit) == 5.0


def test_hash_groups(events):
    df = events(users([(f"user{i}", [1]) for i in range(400)]))
    for method in ("xxhash64", "md5"):
        shares = {r.test_group: r.unique_users for r in st.compare(st.assign(df, st.hash_group(F.col("external_user_id"), method=method))).collect()}
        assert sum(shares.values()) == 400 and 60 < shares["Control"] < 140
    with pytest.raises(ValueError):
        st.id_hash(F.lit("x"), "crc")


def test_samples_repeat(events):
    df = events(users([(f"user{i}", [1]) for i in range(50)]))
    pick = lambda seed: [r.external_user_id for r in st.sample_users(df, 10, seed).collect()]
    assert pick(1) == pick(1) != pick(2)


# --- revenue ----------------------------------------------------------------

WEB = [("b", ["crow"]), ("a", ["ant"])]


def test_attribute_splits_equal_six_queries(spark, events, spend):
    rng = random.Random(14)
    rows = [{"external_user_id": "hot" if rng.random() < 0.4 else f"u{rng.randrange(20)}", "event_date": dt.datetime(2024, 3, 1 + rng.randrange(28)),
             "publisher_id": rng.choice([None, 0, 1, 2, 3]), "campaign_id": rng.choice([None, 0, 5, 6]), "website": rng.choice([None, "ant.example", "Crow.example", "z"]),
             "country": rng.choice([None, "X", "Y"]), "sub_id": rng.choice([None, "s-pop", "push_1"]), "advertiser": rng.choice([None, "a", "b"]),
             "converted_amount": rng.choice([0, 5, 7.25])} for _ in range(300)]
    df = events(rows)
    money = spend([(1, "", "POP", "m1", 1, "1"), (1, "", "PUSH", "m2", 1, "1"), (2, "", "VIDEO", "m1", 1, "1"), (2, "", "VIDEO", "m2", 1, "1"), (2, "", "POP", "m3", 1, "1")])
    got = sorted((r.breakdown_type, r.brand, r.breakdown_value or r.format, r.paying_users, r.total_deposits, float(r.total_revenue_usd))
                 for r in arppu.by_attributes(df, money, WEB).collect())
    expected = []
    formats = {1: "POP", 2: "VIDEO"}  # a tie takes the smallest
    sub = {None: "OTHER", "s-pop": "POP", "push_1": "PUSH"}
    web = {None: "Unknown", "z": "Unknown", "ant.example": "a", "Crow.example": "b"}
    live = [dict(r, brand=r["advertiser"] or web[r["website"]], format=formats.get(r["publisher_id"]) or sub[r["sub_id"]]) for r in rows if r["converted_amount"]]
    for name, column in [*arppu.BREAKDOWNS, (arppu.ALL_USERS, None)]:
        groups = {}
        for r in live:
            value = r[column] if column else "All"
            if value is None or (column in ("publisher_id", "campaign_id") and value == 0):
                continue
            groups.setdefault((name, r["brand"], str(value)), []).append(r)
        expected += [(*k, len({r["external_user_id"] for r in v}), len(v), sum(r["converted_amount"] for r in v)) for k, v in groups.items()]
    assert got == sorted(expected)


@pytest.mark.parametrize("grain, days", [("week", 7), ("month", 30)])
def test_first_period_by_brute_force(events, grain, days):
    rng = random.Random(15)
    rows = [{"external_user_id": "hot" if rng.random() < 0.4 else f"u{rng.randrange(30)}", "converted_amount": rng.choice([0, 1, 2.5]),
             "event_date": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(150 * 86400))} for _ in range(300)]
    got = {str(r.cohort_start): (r.users_count, r.total_deposits, float(r.total_revenue))
           for r in arppu.first_period(events(rows), "2024-05-31", grain).collect()}
    expected = {}
    live = [r for r in rows if r["converted_amount"]]
    for user in {r["external_user_id"] for r in live}:
        mine = [r for r in live if r["external_user_id"] == user]
        first = min(r["event_date"] for r in mine)
        if first > dt.datetime(2024, 4, 30):
            continue
        day = first.date()
        cohort = day - dt.timedelta(days=day.weekday()) if grain == "week" else day.replace(day=1)
        inside = [r for r in mine if r["event_date"] < first + dt.timedelta(days=days)]
        u, n, s = expected.get(str(cohort), (0, 0, 0.0))
        expected[str(cohort)] = (u + 1, n + len(inside), s + sum(r["converted_amount"] for r in inside))
    assert got == expected


def test_month_before():
    assert str(arppu.month_before("2024-03-31")) == "2024-02-29"
    assert str(arppu.month_before("2024-01-15")) == "2023-12-15"


def test_cohorts_left_out(events):
    rows = [{"external_user_id": u, "converted_amount": 1, "event_date": d} for u, d in [("a", "2024-01-03"), ("b", "2024-01-10")]]
    got = arppu.first_period(events(rows), "2024-05-01", exclude_cohorts=["2024-01-01"]).collect()
    assert [str(r.cohort_start) for r in got] == ["2024-01-08"]


def test_retention_by_brute_force(events):
    rng = random.Random(16)
    rows = [{"external_user_id": f"u{rng.randrange(6)}", "event_date": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(12 * 86400))} for _ in range(150)]
    first = {}
    for r in rows:
        u = r["external_user_id"]
        first[u] = min(first.get(u, r["event_date"]), r["event_date"])
    seen = {}
    for r in rows:
        seen.setdefault((r["event_date"] - first[r["external_user_id"]]).days, set()).add(r["external_user_id"])
    got = {r.days_since_first: r.returning_users for r in ins.retention(events(rows)).collect()}
    assert got == {k: len(v) for k, v in seen.items() if k}


def test_cohort_months_do_not_wrap(events):
    rows = [{"external_user_id": "a", "event_date": d, "converted_amount": 1} for d in ("2022-11-30", "2024-01-01")]
    assert [r.period_number for r in ins.cohort_activity(events(rows)).collect()] == [0, 14]


def test_spend_months_do_not_multiply_deposits(events, spend):
    df = events([{"external_user_id": "a", "publisher_id": 1, "event_date": "2024-01-01", "converted_amount": a, "advertiser": "x"} for a in (1, 2, 9)])
    money = spend([(1, "", "POP", f"m{i}", 1, "1") for i in range(5)])
    row = ins.deposit_size(df, money).first()
    assert (row.deposits_count, row.median_deposit_amount, row.format) == (3, 2.0, "POP")
    assert ins.by_format(df, money).first().deposits == 3


# --- campaigns --------------------------------------------------------------


def sheet(spark, rows):
    cols = ("campaign_name", "event_date", "views", "clicks", "postview", "postclick", "spend", "cpa_pv", "cpa_pc", "total_spend", "total_cpa")
    types = "campaign_name string, event_date string, views bigint, clicks bigint, postview bigint, postclick bigint, spend string, cpa_pv string, cpa_pc string, total_spend string, total_cpa string"
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], types)
    return df.withColumns({"event_date": F.col("event_date").cast("timestamp"), "source_sheet_id": F.lit("s"), "attribution_type": F.lit("1_hour"),
                           "format": F.lit("push"), "campaignid": F.lit(1).cast("bigint"), "event_type": F.lit("ftd")})


def test_text_money_is_summed(spark):
    rows = [{"campaign_name": "c", "event_date": "2024-01-01", "views": 100, "clicks": 4, "spend": s, "cpa_pv": c}
            for s, c in [("1,5", "inf"), (" ", "2"), (None, ""), ("1 000,25", "4,0")]]
    rows += [{"campaign_name": None, "event_date": "2024-01-01", "spend": "9"}, {"campaign_name": "c", "event_date": None, "spend": "9"}]
    row = cm.analysis(sheet(spark, rows)).first()
    assert (float(row.total_spend), float(row.avg_cpa_pv), row.records_count) == (1001.75, 3.0, 4)
    assert (float(row.views_per_click), float(row.ctr_as_reported), row.calculated_cpa_pv) == (25.0, 25.0, None)


def test_strict_and_lenient(spark):
    bad = sheet(spark, [{"campaign_name": "c", "event_date": "2024-01-01", "spend": "abc", "clicks": 1}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cm.daily_totals(bad).collect()
    assert cm.daily_totals(bad, strict=False).first().total_spend is None

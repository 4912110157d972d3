import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adtally.functions import time as tm
from adtally.operators import reactivation as rx

START = dt.datetime(2024, 3, 1)


def random_events(seed=1, users=12, rows=600, hot_share=0.4):
    """Deposits over 200 days with sub-day times; one user holds a large share, and rows repeat."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        user = "hot" if rng.random() < hot_share else f"u{rng.randrange(users)}"
        ts = START - dt.timedelta(days=150) + dt.timedelta(seconds=rng.randrange(200 * 86400))
        if rng.random() < 0.1:
            ts = ts.replace(hour=0, minute=0, second=0)
        out.append({"external_user_id": user, "event_date": ts, "publisher_id": rng.randrange(4)})
    return out + out[:50]


def collected(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def brute_previous(rows, user, ts):
    before = [r["event_date"] for r in rows if r["external_user_id"] == user and r["event_date"] < ts]
    return max(before) if before else None


def test_boundaries_of_a_gap(events):
    gaps = [6.99, 7, 13.99, 14, 29.99, 30, 89.99, 90]
    rows = []
    for g in gaps:
        rows += [{"external_user_id": f"g{g}", "event_date": START - dt.timedelta(days=g)},
                 {"external_user_id": f"g{g}", "event_date": START}]
    got = dict(collected(rx.first_in_period(events(rows), "2024-03-01", "2024-03-01"), "user_id", "inactivity_period"))
    assert got == {"g7": "7-14 days", "g13.99": "7-14 days", "g14": "14-30 days", "g29.99": "14-30 days",
                   "g30": "30-90 days", "g89.99": "30-90 days", "g90": "90+ days"}


def test_first_in_period_is_the_literal_self_join(spark, events):
    df = events(random_events())
    df.createOrReplaceTempView("rx_events")
    literal = spark.sql("""
        SELECT o.user_id, o.f AS first_deposit, max(e.event_date) AS prev_deposit_date
        FROM (SELECT external_user_id AS user_id, min(event_date) AS f FROM rx_events
              WHERE event_date >= timestamp'2024-03-01' AND event_date < timestamp'2024-03-16' GROUP BY 1) o
        JOIN rx_events e ON e.external_user_id = o.user_id AND e.event_date < o.f GROUP BY 1, 2""")
    mine = rx.depositors_in_period(df, "2024-03-01", "2024-03-15").filter("prev_deposit_date IS NOT NULL")
    columns = ("user_id", "first_deposit", "prev_deposit_date")
    assert collected(mine, *columns) == collected(literal, *columns)
    assert mine.count() > 5


@pytest.mark.parametrize("least", [1, 2.5, 7])
def test_gaps_are_those_of_lag(spark, events, least):
    df = events(random_events(users=40, rows=500))
    df.createOrReplaceTempView("rx_events")
    literal = spark.sql(f"""SELECT * FROM (SELECT external_user_id AS user_id, event_date AS first_deposit,
        lag(event_date) OVER (PARTITION BY external_user_id ORDER BY event_date) AS prev_deposit_date FROM rx_events)
        WHERE (unix_micros(first_deposit) - unix_micros(prev_deposit_date)) / 86400e6 >= {least}""")
    columns = ("user_id", "first_deposit", "prev_deposit_date")
    got = collected(rx.gaps(df, least), *columns)
    assert got == collected(literal, *columns) and got


def test_gap_limit():
    with pytest.raises(ValueError):
        rx.gaps(None, 0.5)


def test_missing_user_ids(events):
    rows = [{"event_date": START - dt.timedelta(days=40)}, {"event_date": START}, {"external_user_id": "a", "event_date": START}]
    df = events(rows)
    assert rx.gaps(df).count() == 0
    assert rx.gaps(df, null_users=True).count() == 1  # as one user
    totals = lambda **kw: rx.period_totals(df, "2024-03-01", "2024-03-01", **kw).first().asDict()
    assert totals() == {"depositors": 1, "reactivations": 0, "new_users": 1}
    assert totals(null_users=True) == {"depositors": 2, "reactivations": 0, "new_users": 2}


def test_short_gaps_stay_in_the_denominators(events):
    rows = []
    for user, gap in [("short", 2), ("week", 8), ("month", 40), ("new", None)]:
        rows.append({"external_user_id": user, "event_date": START})
        if gap:
            rows.append({"external_user_id": user, "event_date": START - dt.timedelta(days=gap)})
    got = rx.summary(events(rows), "2024-03-01", "2024-03-01").collect()
    assert [(r.inactivity_period, float(r.percentage_of_reactivations), float(r.percentage_of_all_users)) for r in got] == [
        ("7-14 days", 33.3, 25.0), ("30-90 days", 33.3, 25.0)]


def test_period_report_uses_whole_days(events):
    rows = [{"external_user_id": "a", "event_date": START - dt.timedelta(days=6.9)}, {"external_user_id": "a", "event_date": START}]
    (row,) = rx.period_report(events(rows), "2024-03-01", "2024-03-01").collect()
    assert (row.period, row["count"], float(row.avg_days), float(row.percentage)) == ("0-7 days", 1, 6.0, 100.0)


def test_list_report_averages_fractions(spark, events):
    rows = [{"external_user_id": "a", "event_date": START - dt.timedelta(days=6.9)}, {"external_user_id": "a", "event_date": START},
            {"external_user_id": "b", "event_date": START}]
    users = spark.createDataFrame([("a",), ("c",)], "user_id string")
    (row,) = rx.list_report(events(rows), users, "2024-03-01", "2024-03-01").collect()
    assert (row.period, float(row.avg_days)) == ("0-7 days", 6.9)
    totals = rx.list_totals(events(rows), users, "2024-03-01", "2024-03-01").first()
    assert (totals.users_in_list, totals.reactivations, totals.new_users, float(totals.reactivation_pct)) == (2, 1, 1, 50.0)


def test_publisher_segments_by_brute_force(events):
    rows = random_events(seed=5)
    lo, hi = START, START + dt.timedelta(days=20)
    expected = []
    firsts = {}
    for r in rows:
        if lo <= r["event_date"] < hi:
            key = (r["publisher_id"], r["external_user_id"])
            firsts[key] = min(firsts.get(key, r["event_date"]), r["event_date"])
    for (publisher, user), first in firsts.items():
        before = brute_previous(rows, user, first)
        if before is not None:
            expected.append((publisher, user, first, (first - before).days))
    got = rx._publisher_segments(events(rows), "2024-03-01", "2024-03-20", tm.END_OF_DAY)
    assert collected(got, "publisher_id", "user_id", "first_deposit", "days_inactive") == sorted(expected)


def test_profile_shares(events):
    profile = rx.publisher_profile(events(random_events(seed=6)), "2024-03-01", "2024-03-20")
    for row in profile.collect():
        shares = [float(row[f"{s}_pct"]) for s in rx.SEGMENTS]
        assert abs(sum(shares) - 100) < 0.5
        assert sum(row[s] for s in rx.SEGMENTS) == row.total


def test_periods_in_one_pass_equal_single_reports(events):
    df = events(random_events(seed=7, users=60))
    controls = {"jan": ("2024-01-01", "2024-01-20"), "feb": ("2024-02-01", "2024-02-20")}
    target = {"mar": ("2024-03-01", "2024-03-20")}
    table = {r.period: r for r in rx.compare_periods(df, controls, target).collect()}
    for name, period in {**controls, **target}.items():
        single = {r.period: r["count"] for r in rx.period_report(df, *period).collect()}
        assert {p: r[f"{name}_count"] for p, r in table.items() if p != "TOTAL" and r[f"{name}_count"]} == single
        assert table["TOTAL"][f"{name}_count"] == sum(single.values())


def test_segment_changes(spark):
    row = [("90+ days", 10, 20, 30, 50, 20.0, 30.0)]
    cols = "period string, a_count bigint, b_count bigint, c_count bigint, t_count bigint, control_avg_count double, diff_vs_avg double"
    df = spark.createDataFrame(row, cols).withColumns({f"diff_vs_{n}": F.col("t_count") - F.col(f"{n}_count") for n in "abc"})
    got = rx.segment_changes(df, list("abc")).first()
    assert (float(got.pct_change), float(got.cv_pct), got.all_positive, got.pattern) == (150.0, 50.0, True, "GROWTH")

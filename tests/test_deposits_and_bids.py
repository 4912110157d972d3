import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adtally.operators import bids, deposit_types as dp

DAY = dt.datetime(2024, 3, 5, 10)


def test_ties_and_missing_users(events):
    rows = [{"event_id": "1", "external_user_id": "a", "publisher_id": 1, "event_date": DAY},
            {"event_id": "2", "external_user_id": "a", "publisher_id": 2, "event_date": DAY},
            {"event_id": "3", "external_user_id": "a", "publisher_id": 1, "event_date": DAY + dt.timedelta(hours=1)},
            {"event_id": "4", "publisher_id": 1, "event_date": DAY}]
    df = events(rows)
    kinds = lambda **kw: {r.event_id: r.deposit_type for r in dp.deposit_types(df, "2024-03-01", "2024-03-31", **kw).collect()}
    assert kinds() == {"1": "FTD", "2": "FTD", "3": "RD", "4": "RD"}
    assert kinds(null_user_type=None)["4"] is None
    stats = lambda **kw: {r.publisher_id: (r.total_deps, r.ftd, r.rd) for r in dp.publisher_stats(df, "2024-03-01", "2024-03-31", **kw).collect()}
    assert stats() == {1: (3, 1, 1), 2: (1, 1, 0)}  # neither FTD nor RD
    assert stats(null_users_are_rd=True) == {1: (3, 1, 2), 2: (1, 1, 0)}


def test_first_deposit_before_the_period_is_no_ftd(events):
    rows = [{"external_user_id": "a", "publisher_id": 1, "event_date": DAY - dt.timedelta(days=30)},
            {"external_user_id": "a", "publisher_id": 1, "event_date": DAY}]
    assert dp.publisher_stats(events(rows), "2024-03-01", "2024-03-31").first()[1:4] == (1, 0, 1)


def test_types_and_counts_agree_with_a_hot_user(events):
    rng = random.Random(3)
    rows = [{"external_user_id": "hot" if rng.random() < 0.4 else f"u{rng.randrange(50)}", "publisher_id": rng.choice([None, 0, 1, 2]),
             "event_date": DAY + dt.timedelta(minutes=rng.randrange(100000))} for _ in range(400)]
    df = events(rows)
    typed = dp.deposit_types(df, "2024-03-01", "2024-12-31").groupBy("publisher_id").agg(
        F.count_if(F.col("deposit_type") == "FTD").alias("f"), F.count_if(F.col("deposit_type") == "RD").alias("r"))
    stats = dp.publisher_stats(df, "2024-03-01", "2024-12-31")
    as_set = lambda d: {tuple(r) for r in d.collect()}
    assert as_set(typed) == as_set(stats.select("publisher_id", "ftd", "rd"))
    assert all(r.ftd + r.rd == r.total_deps for r in stats.collect())


def test_month_comparison_fills_missing_publishers(events):
    old = dp.publisher_stats(events([{"external_user_id": "a", "publisher_id": 1, "event_date": "2024-02-02"}]), "2024-02-01", "2024-02-29")
    new = dp.publisher_stats(events([{"external_user_id": "b", "publisher_id": 2, "event_date": "2024-03-02"}] * 3), "2024-03-01", "2024-03-31")
    got = {r.publisher_id: (r.total_deps_old, r.total_deps_new, r.deps_change, float(r.deps_change_pct)) for r in dp.compare_months(old, new).collect()}
    assert got == {1: (1, 0, -1, -100.0), 2: (0, 3, 3, 200.0)}


def test_months_meet_without_a_publisher(events):
    stats = lambda day: dp.publisher_stats(events([{"external_user_id": day, "event_date": day}]), day, day)
    (row,) = dp.compare_months(stats("2024-02-02"), stats("2024-03-02")).collect()
    assert (row.publisher_id, row.total_deps_old, row.total_deps_new, row.deps_change) == (None, 1, 1, 0)


def test_cost_of_nothing_is_the_whole_spend(events, spend):
    stats = dp.publisher_stats(events([{"external_user_id": "a", "publisher_id": 1, "event_date": "2024-03-02"}]), "2024-03-01", "2024-03-31")
    row = dp.with_cost(stats, spend([(1, "(1) A-POP", "POP", "2024-03", 5, "80.50")])).first()
    assert (row.ftd_cpa, row.rd_cpa, row.total_cpa) == (Decimal("80.50"), Decimal("80.5000"), Decimal("80.500"))


def targets(df, **kw):
    return {r.format: (None if r.target_cpa is None else float(r.target_cpa), r.target_source) for r in bids.target_cpa(df, **kw).collect()}


def test_target_falls_back_to_the_whole_format(spend):
    df = spend([(1, "(1) A-PLR-POP", "POP", "m", 10, "100"), (2, "(2) B-POP", "POP", "m", 1, "100"),
                (3, "(3) C-PUSH", "PUSH", "m", 4, "100"), (4, "(4) nor-VIDEO", "VIDEO", "m", 0, "100"), (5, "(5) E-VIDEO", "VIDEO", "m", 50, "100"),
                (6, "(6) F-NATIVE", "NATIVE", "m", 0, "100"), (7, "(7) G-PLR", None, "m", 10, "50")])
    assert targets(df) == {"POP": (7.0, "reference"), "PUSH": (17.5, "all"), "VIDEO": (2.8, "all"), "NATIVE": (None, "none"), None: (3.5, "reference")}
    # As SQL NOT IN has it, a nameless reference group leaves the others without a target.
    strict = targets(df, null_key_blocks=True)
    assert strict["POP"] == (7.0, "reference") and strict["PUSH"] == (None, "none")
    without = df.filter("publisher_id <> 7")
    assert targets(without, null_key_blocks=True) == targets(without)


@pytest.mark.parametrize("cpa, coefficient, label", [
    ("0", 1.0, "NO_DATA"), ("140", 0.1, "DISABLE"), ("20", 0.35, "DISABLE"), ("17.5", 0.4, "LOWER"), ("10", 0.7, "LOWER_SLIGHTLY"),
    ("7.778", 0.899974, "LOWER_SLIGHTLY"), ("7", 1.0, "KEEP"), ("6.364", 1.099937, "KEEP"), ("6.3636", 1.099937, "KEEP"), ("5", 1.4, "RAISE"),
    ("6", 1.166667, "RAISE_SLIGHTLY"), ("2", 3.0, "RAISE"), ("1", 3.0, "RAISE")])
def test_coefficient_edges(spend, cpa, coefficient, label):
    df = spend([(1, "(1) A-PLR-POP", "POP", "m", 10, "100"), (2, "(2) B-POP", "POP", "m", 1, "100")])
    df = df.withColumn("current_cpa", F.when(F.col("publisher_id") == 2, F.lit(cpa)).otherwise("10").cast("decimal(10,3)"))
    row = bids.coefficients(df).filter("publisher_id = 2").first()
    assert (round(float(row.coefficient), 6), row.recommendation) == (coefficient, label)
    assert 0.1 <= float(row.coefficient) <= 3.0
    assert float(row.change_pct) == pytest.approx((float(row.coefficient) - 1) * 100, abs=1e-6)


def test_brand_tie_takes_the_smallest_name(events, spend):
    rows = [{"publisher_id": 1, "advertiser": b, "event_date": "2024-03-02"} for b in ("b", "a", "b", "a")]
    df = bids.with_brand(spend([(1, "(1) A-POP", "POP", "2024-03", 1, "1"), (2, "(2) B", "POP", "2024-03", 1, "1"),
                                (2, "(2) B", "POP", "2023-03", 1, "1")]), events(rows), "2024-01", "main")
    assert {(r.publisher_id, r.month): r.brand for r in df.collect()} == {(1, "2024-03"): "a", (2, "2024-03"): "Unknown", (2, "2023-03"): "main"}


def test_spend_thresholds(spend):
    df = spend([(i, f"({i}) A-POP", "POP", "2024-03", 1, s) for i, s in enumerate(["99", "49.99", "50", "50.01"])])
    ids = lambda d: sorted(r.publisher_id for r in d.collect())
    assert ids(bids.period_spend(df, "month")) == [2, 3]
    assert ids(bids.period_spend(df, "month", above=True)) == [3]
    assert ids(bids.period_spend(df, "month", min_spend=None)) == [1, 2, 3]


def test_five_levels_have_no_disable(events, spend):
    df = spend([(1, "(1) A-PLR-POP", "POP", "m", 10, "100"), (2, "(2) B-POP", "POP", "m", 1, "100")])
    stats = dp.publisher_stats(events([{"external_user_id": "a", "publisher_id": p, "event_date": "2024-03-02"} for p in (2, 3)]), "2024-03-01", "2024-03-31")
    got = {r.publisher_id: (r.format, float(r.coefficient), r.recommendation) for r in bids.rounded_coefficients(df, stats).collect()}
    assert got == {2: ("POP", 0.1, "LOWER"), 3: ("OTHER", 1.0, "KEEP")}


def test_free_reference_group(spend):
    """A marked group with deposits but no spend keeps its target of zero where that is asked for."""
    from adtally.operators import bids

    rows = spend([(1, "(1) A-PLR-POP", "POP", "m", 4, "0"), (2, "(2) B-POP", "POP", "m", 4, "20")])
    got = lambda **kw: [(float(r.target_cpa), r.target_source) for r in bids.target_cpa(rows, **kw).collect()]
    assert got() == [(3.5 / 2, "all")]
    assert got(keep_free_reference=True) == [(0.0, "reference")]


def test_null_in_a_two_part_key_blocks_what_agrees_with_the_rest(spark):
    from adtally.operators import bids

    rows = [("POP", "z", "B", 2, 10), (None, "a", "A-PLR", 2, 10), ("POP", "a", "C", 2, 10), ("PUSH", None, "D", 2, 10)]
    df = spark.createDataFrame(rows, "format string, brand string, publisher_name string, deposits_reported long, spend long")
    got = {(r.format, r.brand): r.target_source for r in bids.target_cpa(df, ("format", "brand"), null_key_blocks=True).collect()}
    assert got == {("POP", "z"): "all", (None, "a"): "reference", ("POP", "a"): "none", ("PUSH", None): "all"}


def test_two_months_read_the_events_twice(spark, events):
    """One scan for first instants, one for the rows of both months."""
    import re

    from adtally.operators import deposit_types as dp

    path = __import__("tempfile").mkdtemp()
    events([{"event_id": str(i), "external_user_id": f"u{i % 3}", "publisher_id": i % 2, "event_date": f"2025-1{i % 2}-0{1 + i % 5} 10:00:00",
             "converted_amount": 1} for i in range(12)]).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    both = dp.compare_months(dp.stats_by_period(stored, {dp.OLD: ("2025-10-01", "2025-10-31"), dp.NEW: ("2025-11-01", "2025-11-30")}))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    apart = dp.compare_months(dp.publisher_stats(stored, "2025-10-01", "2025-10-31"), dp.publisher_stats(stored, "2025-11-01", "2025-11-30"))
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))

"""Control and test groups by user id, outlier trimming, and group comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import numeric as num, time as tm
from ..functions.text import char_set
from .common import paying_deposits
from .ranking import counts_below, percent_rank

USER, TS, AMOUNT = "external_user_id", "event_date", "converted_amount"
CONTROL, TEST, NEITHER = "Control", "Test", "Unknown"

# The default split by the last character of the id.
CONTROL_CHARS, TEST_CHARS = "0-7", "8-9a-z"


def char_from_end(user_id: Column, position: int = 1) -> Column:
    """Lower-case character at ``position`` from the end (1 = last); NULL for shorter ids."""
    return F.when(F.length(user_id) >= position, F.lower(F.substring(user_id, -position, 1)))


def char_group(char: Column, control: str = CONTROL_CHARS, test: str = TEST_CHARS) -> Column:
    """Group of a character; both sets accept lists and ranges such as ``8-9a-z``."""
    return (F.when(char.isin(char_set(control)), CONTROL)
            .when(char.isin(char_set(test)), TEST).otherwise(NEITHER))


def id_hash(user_id: Column, method: str = "xxhash64") -> Column:
    """A non-negative hash of the id; ``md5`` uses its first eight hex digits."""
    if method == "xxhash64":
        return F.pmod(F.xxhash64(user_id), F.lit(2**62))
    if method == "md5":
        return F.conv(F.substring(F.md5(user_id), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash {method!r}")


def hash_group(user_id: Column, buckets: int = 4, control: int = 1, method: str = "xxhash64") -> Column:
    """The first ``control`` of ``buckets`` hash buckets are Control, the others Test."""
    return F.when(id_hash(user_id, method) % buckets < control, CONTROL).otherwise(TEST)


def assign(events: DataFrame, group: Column | None = None, position: int = 1,
           control: str = CONTROL_CHARS, test: str = TEST_CHARS,
           start: tm.Day | None = None, end: tm.Day | None = None) -> DataFrame:
    """Paying deposits with their test group; the rows of the stored group table."""
    rows = (paying_deposits(events).filter(F.length(USER) >= position)
            .filter(tm.within(F.col(TS), start, end)))
    label = group if group is not None else char_group(char_from_end(F.col(USER), position), control, test)
    return rows.select(F.col(USER).alias("user_id"), TS, F.col(AMOUNT).alias("deposit_amount"),
                       "advertiser", label.alias("test_group"))


def user_totals(grouped: DataFrame) -> DataFrame:
    """Deposits, revenue and date range of each user in either group."""
    return (grouped.filter(F.col("test_group").isin(CONTROL, TEST))
            .groupBy("user_id", "test_group")
            .agg(F.count(F.lit(1)).alias("deposit_count"), F.sum("deposit_amount").alias("total_usd"),
                 F.min(TS).alias("first_date"), F.max(TS).alias("last_date")))


def compare(grouped: DataFrame, exclude_top_pct: float = 0, exclude_bottom_pct: float = 0) -> DataFrame:
    """Group metrics after dropping the users with the most and the least revenue.

    Users with equal revenue share a rank, so they are kept or dropped together and are
    reduced to one row per (group, revenue) before the exact ranks are taken.
    """
    return compare_totals(user_totals(grouped), exclude_top_pct, exclude_bottom_pct)


def compare_totals(per_user: DataFrame, exclude_top_pct: float = 0, exclude_bottom_pct: float = 0) -> DataFrame:
    """:func:`compare` from the rows of :func:`user_totals`, such as stored ones."""
    sums = lambda users, deposits, usd: [
        users.alias("unique_users"), F.sum(deposits).alias("total_deposits"), F.sum(usd).alias("_usd"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")]
    if exclude_top_pct or exclude_bottom_pct:
        units = (F.col("total_usd") * 10_000).cast("bigint")
        per_revenue = per_user.groupBy("test_group", units.alias("_units")).agg(
            *sums(F.count(F.lit(1)), "deposit_count", "total_usd"))
        ranked = counts_below(per_revenue, ["test_group"], "_units", "unique_users")
        rank = percent_rank(F.col("n_below"), F.col("n_total"))
        kept = ranked.filter((rank <= 1 - exclude_top_pct / 100) & (rank >= exclude_bottom_pct / 100))
        groups = kept.groupBy("test_group").agg(*sums(F.sum("unique_users"), "total_deposits", "_usd"))
    else:
        groups = per_user.groupBy("test_group").agg(*sums(F.count(F.lit(1)), "deposit_count", "total_usd"))
    return groups.select(
        "test_group", "unique_users", "total_deposits", F.col("_usd").alias("total_deposits_usd"),
        num.ratio(F.col("_usd"), F.col("total_deposits")).alias("avg_deposit"),
        num.ratio(F.col("total_deposits"), F.col("unique_users")).alias("avg_deposits_per_user"),
        num.ratio(F.col("_usd"), F.col("unique_users")).alias("avg_total_per_user"),
        "first_date", "last_date")


_METRICS = ["unique_users", "total_deposits", "total_deposits_usd", "avg_deposit",
            "avg_deposits_per_user", "avg_total_per_user"]


def rounded(groups: DataFrame) -> DataFrame:
    """Group metrics as reported: money and averages to two decimals."""
    return groups.select(
        "test_group", *_METRICS[:2], *[num.half_up(F.col(m), 2).alias(m) for m in _METRICS[2:]],
        "first_date", "last_date").orderBy("test_group")


def with_comparison(groups: DataFrame) -> DataFrame:
    """The two groups, Control as percent of Test, and Control minus Test, in that order."""
    of = lambda group, column: F.max(F.when(F.col("test_group") == group, F.col(column)))
    columns = _METRICS + ["first_date", "last_date"]
    wide = groups.agg(*[of(g, c).alias(f"_{g}_{c}") for g in (CONTROL, TEST) for c in columns])

    def line(position: int, label: str, cells, dates) -> Column:
        values = [num.half_up(cells(m), 2).cast("decimal(28,2)").alias(m) for m in _METRICS]
        return F.struct(F.lit(position).alias("_position"), F.lit(label).alias("test_group"), *values,
                        *[dates(d).cast("timestamp").alias(d) for d in ("first_date", "last_date")])

    cell = lambda group: lambda column: F.col(f"_{group}_{column}")
    control, test = cell(CONTROL), cell(TEST)
    no_date = lambda _: F.lit(None)
    lines = F.array(
        line(1, CONTROL, control, control), line(2, TEST, test, test),
        line(3, "Comparison %", lambda m: num.percent(control(m), test(m)), no_date),
        line(4, "Comparison Abs", lambda m: control(m).cast("decimal(28,10)") - test(m).cast("decimal(28,10)"), no_date))
    rows = wide.select(F.explode(lines).alias("_r")).select("_r.*")
    missing = (F.col("_position") <= 2) & F.col("unique_users").isNull()
    return rows.filter(~missing).orderBy("_position").drop("_position")


def compare_user_means(grouped: DataFrame) -> DataFrame:
    """Group metrics where every user weighs the same: the mean of the users' mean deposits."""
    per_user = user_totals(grouped)
    mean = num.ratio(F.col("total_usd"), F.col("deposit_count"))
    groups = per_user.groupBy("test_group").agg(
        F.count(F.lit(1)).alias("unique_users"), F.sum("deposit_count").alias("total_deposits"),
        F.sum("total_usd").alias("total_deposits_usd"), F.avg(mean).alias("avg_deposit"),
        num.ratio(F.sum("deposit_count"), F.count(F.lit(1))).alias("avg_deposits_per_user"),
        num.ratio(F.sum("total_usd"), F.count(F.lit(1))).alias("avg_total_per_user"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    return rounded(groups)


# --- balance of the split ---------------------------------------------------


def _per_char(events: DataFrame, position: int, start, end) -> DataFrame:
    """Users and deposits by id character: each user is counted once, without a distinct."""
    rows = (paying_deposits(events).filter(F.length(USER) >= position)
            .filter(tm.within(F.col(TS), start, end)))
    per_user = rows.groupBy(USER).agg(F.count(F.lit(1)).alias("_n"))
    char = char_from_end(F.col(USER), position).alias("last_char")
    return per_user.groupBy(char).agg(F.count(F.lit(1)).alias("unique_users"), F.sum("_n").alias("total_deposits"))


def _share(rows: DataFrame) -> DataFrame:
    # One row per character or group: the window is tiny.
    whole = F.sum("unique_users").over(Window.partitionBy())
    return rows.withColumn("user_percentage", num.half_up(num.percent(F.col("unique_users"), whole), 2))


def char_distribution(events: DataFrame, position: int = 1, start: tm.Day | None = None,
                      end: tm.Day | None = None) -> DataFrame:
    """Users and deposits per id character."""
    return _share(_per_char(events, position, start, end)).orderBy("last_char")


def group_distribution(events: DataFrame, position: int = 1, control: str = CONTROL_CHARS,
                       test: str = TEST_CHARS, start: tm.Day | None = None,
                       end: tm.Day | None = None) -> DataFrame:
    """Users and deposits per group, with the characters found in it."""
    per_char = _per_char(events, position, start, end)
    label = char_group(F.col("last_char"), control, test).alias("test_group")
    groups = per_char.groupBy(label).agg(
        F.sum("unique_users").alias("unique_users"), F.sum("total_deposits").alias("total_deposits"),
        F.expr("listagg(DISTINCT last_char, ', ') WITHIN GROUP (ORDER BY last_char)").alias("sample_chars"))
    return _share(groups).orderBy("test_group")


def sample_users(events: DataFrame, n: int = 20, seed: int = 0, control: str = CONTROL_CHARS,
                 test: str = TEST_CHARS, start: tm.Day | None = None, end: tm.Day | None = None,
                 tails: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """A repeatable random sample of ``n`` user ids with their last characters and group."""
    ids = (paying_deposits(events).filter(F.length(USER) >= 1).filter(tm.within(F.col(TS), start, end))
           .select(USER).distinct())
    order = F.md5(F.concat(F.col(USER), F.lit(f"#{seed}")))
    tail = lambda k: F.lower(F.substring(F.col(USER), -k, k)).alias(f"last_{k}_chars" if k > 1 else "last_char")
    return ids.orderBy(order, USER).limit(n).select(
        USER, F.length(USER).alias("id_length"), *[tail(k) for k in tails],
        char_group(char_from_end(F.col(USER)), control, test).alias("test_group"))

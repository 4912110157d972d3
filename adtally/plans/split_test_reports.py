"""Control and test groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split_test as st
from . import frames
from .registry import big, dbl, dec, report


def _grouped(chars: str = "right(uid, 1)", control: str = "[0-7]", test: str = "[89a-z]", where: str = "true") -> str:
    return f"""g AS (SELECT uid, ts, amt, adv, CASE WHEN lower({chars}) SIMILAR TO '{control}' THEN 'Control'
    WHEN lower({chars}) SIMILAR TO '{test}' THEN 'Test' ELSE 'Unknown' END grp FROM ue WHERE amt > 0 AND {where})"""


_HASHED = """g AS (SELECT uid, ts, amt, adv, CASE WHEN CAST('0x' || substr(md5(uid), 1, 8) AS BIGINT) % 4 < 1 THEN 'Control' ELSE 'Test' END grp
  FROM ue WHERE amt > 0)"""


def _metrics(src: str = "g") -> str:
    return f"""m AS (SELECT grp, count(DISTINCT uid) u, count(*) n, sum(amt) s, min(ts) a, max(ts) b FROM {src}
  WHERE grp IN ('Control', 'Test') GROUP BY grp)"""


_OUT = f"""SELECT grp test_group, u unique_users, n total_deposits, {dec('s', 2)} total_deposits_usd, {dec('s / n', 2)} avg_deposit,
  {dec('n / u', 2)} avg_deposits_per_user, {dec('s / u', 2)} avg_total_per_user, a first_date, b last_date FROM m"""


@report("sp1_group_rows", f"""WITH {_grouped()}
SELECT uid user_id, ts event_date, {dbl('amt')} deposit_amount, adv advertiser, grp test_group FROM g""", "ue")
def _(spark, d):
    return st.assign(frames.user_events(spark, d))


@report("sp1_last_char", f"WITH {_grouped()}, {_metrics()}\n{_OUT}", "ue")
def _(spark, d):
    return st.rounded(st.compare(st.assign(frames.user_events(spark, d))))


# The documented variants: position from the end, control and test characters.
for _i, (_pos, _control, _test, _c_sql, _t_sql) in enumerate([
        (2, "0-3", "4-9a-z", "[0-3]", "[4-9a-z]"), (3, "0,2,4,6,8", "1,3,5,7,9,a-z", "[02468]", "[13579a-z]"),
        (1, "0-4", "5-9a-z", "[0-4]", "[5-9a-z]"), (2, "0-7", "8-9a-z", "[0-7]", "[89a-z]")], 1):
    @report(f"sp2_variant_{_i}", f"WITH {_grouped(f'substr(uid, length(uid) - {_pos - 1}, 1)', _c_sql, _t_sql)}, {_metrics()}\n{_OUT}", "ue")
    def _(spark, d, pos=_pos, control=_control, test=_test):
        return st.rounded(st.compare(st.assign(frames.user_events(spark, d), position=pos, control=control, test=test)))


@report("sp3_hash_md5", f"WITH {_HASHED}, {_metrics()}\n{_OUT}", "ue")
def _(spark, d):
    group = st.hash_group(F.col("external_user_id"), method="md5")
    return st.rounded(st.compare(st.assign(frames.user_events(spark, d), group)))


@report("sp3_hash_native", """SELECT count(DISTINCT uid) users, count(*) deposits, 0 users_in_both, true share_as_asked, true same_again FROM ue""", "ue")
def _(spark, d):
    """The native hash has no SQL twin; its properties have: every user in one group, one in four in control, the same again."""
    events, group = frames.user_events(spark, d), st.hash_group(F.col("external_user_id"))
    again = st.hash_group(F.substring(F.concat(F.lit("-"), "user_id"), 2, 99))
    users = (st.assign(events, group).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("test_group").alias("least"), F.max("test_group").alias("most"))
        .withColumn("same", F.col("least") == again))
    share = F.avg((F.col("least") == st.CONTROL).cast("int"))
    return users.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("deposits"), F.count_if(F.col("least") != F.col("most")).alias("users_in_both"),
                     (F.abs(share - 0.25) * F.sqrt(F.count(F.lit(1))) < 2.5).alias("share_as_asked"), F.bool_and("same").alias("same_again"))


def _trimmed(top: float, bottom: float) -> str:
    return f"""pr AS (SELECT uid, grp, percent_rank() OVER (PARTITION BY grp ORDER BY t) k
    FROM (SELECT uid, grp, sum(amt) t FROM g WHERE grp <> 'Unknown' GROUP BY ALL)),
kept AS (SELECT g.* FROM g JOIN pr USING (uid, grp) WHERE k <= {1 - top / 100} AND k >= {bottom / 100})"""


@report("sp4_trimmed", f"WITH {_grouped()}, {_trimmed(5, 5)}, {_metrics('kept')}\n{_OUT}", "ue")
def _(spark, d):
    return st.rounded(st.compare(st.assign(frames.user_events(spark, d)), 5, 5))


@report("sp4_trimmed_top", f"WITH {_grouped()}, {_trimmed(12.5, 0)}, {_metrics('kept')}\n{_OUT}", "ue")
def _(spark, d):
    return st.rounded(st.compare(st.assign(frames.user_events(spark, d)), 12.5))


def _compared() -> str:
    cols = {"unique_users": "u", "total_deposits": "n", "total_deposits_usd": "s", "avg_deposit": "s / n",
            "avg_deposits_per_user": "n / u", "avg_total_per_user": "s / u"}
    side = lambda grp: f"SELECT {', '.join(f'{e} {n}' for n, e in cols.items())} FROM m WHERE grp = '{grp}'"
    one = lambda pick: ", ".join(f"{dec(pick(c), 2)} {c}" for c in cols)
    return f"""c AS ({side('Control')}), t AS ({side('Test')})
SELECT grp test_group, {', '.join(f'{dec(e, 2)} {n}' for n, e in cols.items())}, a first_date, b last_date FROM m
UNION ALL SELECT 'Comparison %', {one(lambda x: f'c.{x} * 100.0 / t.{x}')}, NULL, NULL FROM c, t
UNION ALL SELECT 'Comparison Abs', {one(lambda x: f'c.{x} - t.{x}')}, NULL, NULL FROM c, t"""


@report("sp5_comparison_rows", f"WITH {_grouped()}, {_metrics()}, {_compared()}", "ue")
def _(spark, d):
    return st.with_comparison(st.compare(st.assign(frames.user_events(spark, d))))


@report("sp5_comparison_rows_trimmed", f"WITH {_grouped()}, {_trimmed(5, 5)}, {_metrics('kept')}, {_compared()}", "ue")
def _(spark, d):
    return st.with_comparison(st.compare(st.assign(frames.user_events(spark, d)), 5, 5))


@report("sp6_user_means", f"""WITH {_grouped(where="ts >= TIMESTAMP '2001-02-02'")},
p AS (SELECT grp, uid, count(*) n, sum(amt) s, min(ts) a, max(ts) b FROM g WHERE grp <> 'Unknown' GROUP BY ALL)
SELECT grp test_group, count(*) unique_users, {big('sum(n)')} total_deposits, {dec('sum(s)', 2)} total_deposits_usd, {dec('avg(s / n)', 2)} avg_deposit,
  {dec('avg(n)', 2)} avg_deposits_per_user, {dec('avg(s)', 2)} avg_total_per_user, min(a) first_date, max(b) last_date FROM p GROUP BY grp""", "ue")
def _(spark, d):
    return st.compare_user_means(st.assign(frames.user_events(spark, d), start="2001-02-02"))


@report("sp7_char_distribution", f"""SELECT lower(right(uid, 1)) last_char, count(DISTINCT uid) unique_users, count(*) total_deposits,
  {dec('count(DISTINCT uid) * 100.0 / sum(count(DISTINCT uid)) OVER ()', 2)} user_percentage FROM ue WHERE amt > 0 GROUP BY 1""", "ue")
def _(spark, d):
    return st.char_distribution(frames.user_events(spark, d))


@report("sp7_group_distribution", f"""WITH {_grouped()}
SELECT grp test_group, count(DISTINCT uid) unique_users, count(*) total_deposits, string_agg(DISTINCT right(uid, 1), ', ' ORDER BY right(uid, 1)) sample_chars,
  {dec('count(DISTINCT uid) * 100.0 / sum(count(DISTINCT uid)) OVER ()', 2)} user_percentage FROM g GROUP BY grp""", "ue")
def _(spark, d):
    return st.group_distribution(frames.user_events(spark, d))


@report("sp7_sample_users", """SELECT uid external_user_id, length(uid) id_length, right(uid, 1) last_char, right(uid, 2) last_2_chars, right(uid, 3) last_3_chars,
  CASE WHEN right(uid, 1) SIMILAR TO '[0-7]' THEN 'Control' ELSE 'Test' END test_group
FROM (SELECT DISTINCT uid FROM ue WHERE amt > 0) ORDER BY md5(uid || '#0'), uid LIMIT 100""", "ue")
def _(spark, d):
    return st.sample_users(frames.user_events(spark, d), 100)

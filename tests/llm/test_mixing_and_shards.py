import random
import struct
import zlib
from collections import Counter
from math import log

import pytest
import xxhash
from pyspark.sql import functions as F

from adtally.llm import mixing as mx, shards as sh

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


# --- shards -----------------------------------------------------------------


def spark_hash(key, shard):
    seed = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<i", shard), seed=seed).intdigest()


def test_shards_follow_the_rendezvous_rule(spark):
    weights = [1.0, 2.0, 4.0, 1.0]
    best = lambda k, w: max((log(((spark_hash(k, s) >> 11) + 0.5) / 2 ** 53) / w[s], s) for s in range(len(w)))[1]
    got = {r.id: (r.a, r.b) for r in spark.range(400).select("id", sh.best_shard([F.col("id")], 4, weights).alias("a"), sh.best_shard([F.col("id")], 3).alias("b")).collect()}
    assert got == {k: (best(k, weights), best(k, [1.0] * 3)) for k in range(400)}
    with pytest.raises(ValueError):
        sh.best_shard([F.col("id")], 2, [1.0, 0.0])


def test_more_shards_only_take(spark):
    rows = spark.range(5000).select("id", *[sh.best_shard([F.col("id")], n, [1.0] * (n - 1) + [3.0] if n == 9 else None).alias(f"s{n}") for n in (8, 9)]).collect()
    assert all(r.s8 == r.s9 or r.s9 == 8 for r in rows)
    assert 0.2 < sum(r.s9 == 8 for r in rows) / 5000 < 0.35  # weight 3 of 11
    assert all(500 < n < 760 for n in Counter(r.s8 for r in rows).values())


def test_shard_documents(spark):
    rows = [(i, words(i % 5), "a") for i in range(300)] + [(7, words(2), "a")] * 5 + [(None, None, "a"), (None, "", None), (1, "é" * 70000, "x")]
    df = docs(spark, rows).withColumns({"shard": F.lit("own"), "slot": F.lit(1), "_n": F.lit(1), "size": F.lit("z")})
    got = sh.shard_documents(df, 6).collect()
    assert len(got) == len(rows)
    expected = Counter((i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    for s in range(6):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({r.shard for r in got if r.doc_id == 7}) == 1 and all(r.grown_shard in (r.shard, 6) for r in got)
    assert sh.shard_documents(df.limit(0), 6).count() == 0
    plan = sh.shard_documents(df, 6)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_assign_replaces_a_column_of_its_name(spark):
    got = sh.assign(docs(spark, [(1, "a", "s"), (None, "b", "s")]).withColumn("shard", F.lit("x")), "doc_id", 3)
    assert dict(got.dtypes)["shard"] == "int" and got.count() == 2


# --- mixing -----------------------------------------------------------------


def highest_quotients(weights, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        best = max((w / (2 * n + 1), -i) for i, (w, n) in enumerate(zip(weights, won)) if w > 0)
        won[-best[1]] += 1
    return won


def test_sainte_lague(spark):
    random.seed(5)
    cases = [([5, 3, 1], 9), ([100, 1, 1, 1, 1, 1, 1, 1], 5), ([2, 2, 2], 2), ([0, 7, 0.5], 11), ([0, 0], 0)]
    cases += [([random.choice([1, 2, 50, 1000]) * random.random() for _ in range(random.randint(1, 30))], random.randint(0, 200)) for _ in range(20)]
    rows = [(g, i, float(w), s) for g, (ws, s) in enumerate(cases) for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "g int, i int, w double, s long")
    got = {(r.g, r.i): r.q for r in mx.sainte_lague(df, ["g"], ["i"], "w", "s", "q").collect()}
    for g, (ws, s) in enumerate(cases):
        assert [got[g, i] for i in range(len(ws))] == highest_quotients(ws, s), (ws, s)


def water_level(sizes, weights, share, cap):
    """Targets by handing the excess round until none is above its cap."""
    target, capped, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in capped]
        rest = left - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] for s in capped} | {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(spark):
    random.seed(1)
    rows = [(i, words(random.randint(0, 60), i), random.choice(["b", "a", "c", None, "é"])) for i in range(400)]
    rows += [(999, words(3000), "hot")] + [(i, words(9), "hot") for i in range(1000, 1500)] + [(5, None, "b"), (5, "", "tiny"), (None, words(4), "tiny"), (6, words(8), "tiny")]
    rows += [(7, words(11), "a")] * 3
    got = mx.mix(docs(spark, rows).withColumns({"size": F.lit("x"), "name": F.lit(1), "target": F.lit(2)}), shard_words=400, shard_rows=100, block_words=32).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = water_level(sizes, weights, 1.5, 2)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert sum((b.stop - b.start) * b.copies for b in r.blocks) == r.taken and all(0 <= b.start < b.stop <= r.size for b in r.blocks)
    assert len(got) == len(rows) and sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)
    assert all(abs(taken[s] - target[s]) <= max(40, 0.05 * target[s]) for s in sizes)
    again = mx.mix(docs(spark, rows[::-1]).repartition(5), shard_words=400, shard_rows=100, block_words=32).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in got)
    assert mx.mix(docs(spark, [])).count() == 0 and mx.mix(docs(spark, [(1, None, None)])).first().taken == 0


def test_taken_texts(spark):
    text = "  a\tb c\n d e  f g h i j k l m n o p q r s t u v w x y z "
    rows = [(i, f"{i} " + text, "s") for i in range(40)] + [(50, words(500), "t"), (51, None, "t")]
    df = docs(spark, rows)
    mixed = {(r.doc_id): r for r in mx.mix(df, block_words=4).collect()}
    out = mx.taken_texts(df, block_words=4).collect()
    original = {i: t for i, t, _ in rows}
    count = Counter()
    for r in out:
        count[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
        assert r.text == original[r.doc_id] or all(p in original[r.doc_id] for p in r.text.split("\n") if p.strip())
    assert {k: v for k, v in count.items()} == {k: r.taken for k, r in mixed.items() if r.taken} and mx.taken_texts(df).columns == df.columns


def test_texts_of_any_number_of_passes(spark):
    """What the texts hold is what the mix takes, also beyond two passes."""
    rows = docs(spark, [(i, words(60 + i, 100 * i), "abc"[i % 3]) for i in range(30)] + [(5, words(50), "a"), (None, words(40), None)])
    for cap, share in ((4, 3.0), (1, 0.7), (3, 2.5)):
        taken = {}
        for r in mx.mix(rows, cap=cap, share=share).collect():
            taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
            assert r.taken <= cap * r.size
        held = {}
        for r in mx.taken_texts(rows, cap=cap, share=share).collect():
            held[r.doc_id] = held.get(r.doc_id, 0) + len(r.text.split())
        assert held == {k: n for k, n in taken.items() if n}


def test_texts_that_share_a_key_are_spread(spark):
    rows = docs(spark, [(1, words(40, 50 * i), "a") for i in range(200)])
    mx.mix(rows, shard_rows=20).collect()
    plan = mx.mix(rows, shard_rows=20)._jdf.queryExecution().executedPlan().toString()
    assert "print" in plan and sum(r.taken for r in mx.mix(rows, shard_rows=20).collect()) > 8000

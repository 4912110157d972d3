import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import negatives as ng

KIND = "vec_id long, embedding array<double>, label int, n string, row string, limits int, anchor string"


def expected(rows, is_anchor, scale=256, positives=5, negatives=5, low=80, high=100):
    limit = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    used = []
    for key, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in vector):
            used.append((key, [limit(math.floor(x * scale)) for x in vector], label))
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1])
    for i, (key, vector, label) in enumerate(used):
        if not is_anchor(key):
            continue
        scored = [(limit(sum(a * b for a, b in zip(vector, v))), k, l) for j, (k, v, l) in enumerate(used) if j != i and len(v) == len(vector)]
        best = sorted([s for s in scored if s[2] == label], key=order)[:positives]
        for p, pk, _ in best:
            hard = sorted([s for s in scored if s[2] != label and low * p <= high * s[0] <= high * p], key=order)[:negatives]
            out += [(key, pk, n, nk, p, s) for n, (s, nk, _) in enumerate(hard, 1)]
    return sorted(out, key=repr)


def found(spark, rows, is_anchor=None, **settings):
    df = spark.createDataFrame([(k, v, l, "n", "r", 1, "a") for k, v, l in rows], KIND).repartition(4)
    got = ng.hard_negatives(df, F.col("vec_id") % 10 == 0 if is_anchor is None else is_anchor, **settings)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted([tuple(r) for r in got.collect()], key=repr)


def tenth(key):
    return key is not None and key % 10 == 0


@pytest.mark.parametrize("width", [1, 5, 64])
def test_against_brute_force(spark, width):
    random.seed(width)
    draw = lambda: [random.choice([random.gauss(0.2, 0.2), round(random.gauss(0.2, 0.1), 1)]) for _ in range(width)]
    rows = [(i, draw(), random.randrange(4)) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 2) for i in range(30)]
    got = found(spark, rows)
    assert got == expected(rows, tenth) and len(got) > 100
    assert found(spark, rows, positives=2, negatives=7, low=30, high=90, scale=10) == expected(rows, tenth, 10, 2, 7, 30, 90)


def test_odd_rows(spark):
    random.seed(3)
    rows = [(i, [random.random() for _ in range(3)], i % 3) for i in range(60)]
    rows += [(60, None, 1), (61, [0.5, None, 0.5], 1), (62, [math.nan, 1.0, 1.0], 1), (63, [math.inf, 1.0, 1.0], 0), (64, [1e307, 1.0, 1.0], 0),
             (65, [0.5, 0.5, 0.5], None), (None, [0.9, 0.9, 0.9], 0), (None, [0.9, 0.9, 0.9], 1), (70, [0.7, 0.7], 0), (80, [0.7, 0.8], 0), (81, [0.7, 0.75], 1),
             (90, [], 0), (91, [], 0), (92, [], 1), (-10, [0.3, 0.4, 0.5], 2), (100, [-1.0, -1.0, -1.0], 1), (110, [0.0, 0.0, 0.0], 7)]
    rows += [(10, [0.5, 0.6, 0.7], 1)] * 9 + [(11, [0.6, 0.6, 0.7], 2)] * 8 + [(11, [0.2, 0.9, 0.7], 2), (10, [0.9, 0.1, 0.1], 1)]
    got = found(spark, rows)
    assert got == expected(rows, tenth)
    assert any(r[3] is None or r[1] is None for r in got) and any(r[0] == 90 for r in got)
    assert found(spark, []) == [] and found(spark, [(1, [0.5], 1)]) == [] and found(spark, rows, F.lit(False)) == []


def test_wide_numbers(spark):
    rows = [(i, [1e15 * (i + 1), -3e15 + i, 2.0 ** 50], i % 2) for i in range(30)]
    rows += [(40, [2.0 ** 60, 1e300, 4.0], 1), (50, [1.0, 2.0 ** 70, -5.0], 0)]
    assert found(spark, rows) == expected(rows, tenth)
    narrow = [(i, [3e5 + i, -1e6 * i, 7.25], i % 2) for i in range(30)]
    assert found(spark, narrow) == expected(narrow, tenth)


def test_packed_products_are_exact():
    random = np.random.default_rng(1)
    for top, kind in ((5, 4), (3000, 4), (1 << 24, 8), (1 << 40, 0)):
        rows, anchor = random.integers(-top, top + 1, (70, 33)), random.integers(-top, top + 1, 33).tolist()
        packed = ng.Packed(rows, min(anchor), max(anchor))
        wanted = [max(min(sum(int(a) * int(b) for a, b in zip(anchor, row)), ng.LONG), -ng.LONG - 1) for row in rows]
        assert packed.products(anchor).tolist() == wanted and (packed.bytes == kind or not kind and packed.bytes > 8)


def test_small_blocks_give_the_same(spark, monkeypatch):
    random.seed(9)
    rows = [(i, [random.gauss(0.2, 0.3) for _ in range(6)], random.randrange(3)) for i in range(200)]
    for name, value in (("PACKED", 7), ("ANCHORS", 3), ("CANDIDATES", 40)):
        monkeypatch.setattr(ng, name, value)
    assert found(spark, rows) == expected(rows, tenth)

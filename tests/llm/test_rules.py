import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from adtally.llm import queries, rules as R

SF = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, hit, seen, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        hit |= set(range(i, i + 8)) if times[w] > 1 else set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)]


def test_statistics_against_brute_force(monkeypatch):
    random.seed(1)
    texts = ["", " \n\t", "   x", "a" * 3000, "x y " * 500]
    for _ in range(400):
        parts = [random.choice(["a", "bé", "#x", "<日>"][:random.randint(1, 4)]) + random.choice([" ", " ", "\n", "\x0b", " \r\n"]) for _ in range(random.randint(0, 60))]
        texts.append("".join(parts) + random.choice(["", "\n\n a\n a\n", "|"]))
    texts += [r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()[:200]]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(R, "PIECE", piece)
        for text in texts if piece > 1 else texts[:150]:
            counts = R.statistics(text.encode())
            assert counts[:5] == brute(text)
            words = text.encode().split()
            assert counts[R.COUNTS.index("n_distinct")] == len(set(words)) and counts[R.COUNTS.index("n_again")] == sum(a == b for a, b in zip(words, words[1:]))


def walk(forest, x):
    """One row's score, tree by tree and node by node."""
    total = forest.start
    for root in forest.roots:
        at = root
        while forest.left[at] != at:
            at = forest.left[at] if x[forest.feature[at]] <= forest.split[at] else forest.right[at]
        total += forest.value[at]
    return 1 / (1 + np.exp(-total))


def test_forest_learns_walks_and_keeps_its_directions():
    draw = np.random.default_rng(5)
    x = draw.random((3000, 4))
    y = ((x[:, 0] < 0.4) & (x[:, 1] + 0.1 * draw.standard_normal(3000) > 0.3)).astype(float)
    directions = np.array([-1, 1, 0, -1])
    forest = R.fit(x, y, np.ones(3000), directions)
    scores = forest.score(x)
    assert ((scores > 0.5) == (y == 1)).mean() > 0.93
    assert np.allclose(scores[:50], [walk(forest, row) for row in x[:50]])
    for f, way in enumerate(directions):
        if way:
            moved = np.repeat(x[:200, None], 40, axis=1)
            moved[:, :, f] = np.linspace(-0.2, 1.2, 40)
            steps = np.diff(forest.score(moved.reshape(-1, 4)).reshape(200, 40), axis=1) * way
            assert steps.min() >= -1e-12
    # Noise that pulls the other way is not followed.
    against = R.fit(x, (x[:, 3] > 0.5).astype(float), np.ones(3000), directions)
    assert (against.feature[against.left != np.arange(len(against.left))] != 3).all()


def test_one_label_and_none():
    x = np.random.default_rng(1).random((30, len(R.FEATURES)))
    assert R.fit(x, np.ones(30), np.ones(30)).score(x).min() > 0.99
    assert np.allclose(R.fit(x[:0], np.empty(0), np.empty(0)).score(x), 0.5)
    judge = R.fit_judge(np.zeros((0, len(R.COUNTS)), np.int64), np.empty(0), np.empty(0))
    assert judge.least == 0.5 and judge.score(np.ones((2, len(R.COUNTS)), np.int64)).shape == (2,)


def test_query_on_held_out_documents(spark):
    got = queries.QUERIES["op11_quality_rules"](spark, SF)
    assert got.dtypes[:8] == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                              ("base_failed", "boolean"), ("kept", "boolean")]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == brute(docs[r.doc_id] or "")
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
    assert sorted(map(tuple, queries.QUERIES["op11_quality_rules"](spark, SF).collect())) == sorted(map(tuple, rows))


def test_accuracy_on_held_out_documents(spark):
    tenth = SF.replace("0.01", "0.1")
    got = queries.QUERIES["op11_quality_rules"](spark, tenth)
    labels = spark.read.parquet(f"{tenth}/labels.parquet").filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    held = got.join(labels, "doc_id").filter("NOT base_failed").select("quality", "kept").collect()
    good, bad = [r.kept for r in held if r.quality == 1], [r.kept for r in held if r.quality == 0]
    assert len(good) > 500 and len(bad) > 50 and np.mean(good) > 0.99 and np.mean(bad) < 0.03


def test_odd_rows(spark):
    texts = [None, "", " \n", "one", "word " * 30, " ".join(f"w{i}" for i in range(50)) + ".", "x" * 400_000, "a b " * 100_000]
    rows = [(i, t, "s", 1, True) for i, t in enumerate(texts)] + [(None, texts[5], None, 1, None)] * 2 + [(5, texts[5], "z", 3, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n_words int, kept boolean").repartition(3)
    labels = spark.createDataFrame([(5, 1), (5, 0), (4, 0), (3, None), (None, 1), (7, 0), (6, 1)], "doc_id long, quality int")
    judge = R.train(docs, labels)
    got = R.score(docs, judge).collect()
    assert len(got) == len(rows) and [r.base_failed for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))][:5] == [True] * 5
    assert len({r.score for r in got if r.n_words == 50}) == 1
    assert R.score(docs.limit(0), R.train(docs.limit(0), labels.limit(0))).collect() == []
    assert R.score(docs, R.train(docs.limit(0), labels)).count() == len(rows)


def test_sample_is_bounded_and_repeats(spark):
    docs = spark.createDataFrame([(i % 400, f"{'word ' * (20 + i % 7)}{'# ' * (i % 3)}") for i in range(900)], "doc_id long, text string")
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("quality"))
    one, two = (R.train(d, labels, sample=50) for d in (docs, docs.repartition(7)))
    assert all(np.array_equal(a, b) for a, b in zip(one.forest, two.forest)) and one.least == two.least

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import chains, decontaminate as dc, neighbours as nb, quality as ql
from adtally.llm.words import Hasher

DOCS = "doc_id long, text string"


# --- decontamination --------------------------------------------------------


def brute(docs, items, width=13):
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for item, x in items:
            p = split(x)
            n = min(width, len(p))
            for k in range(len(p) - n + 1 if p else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == p[k:k + n]:
                        hit.update(range(j, j + n))
                        found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_windows", [1 << 20, 30, 1])
def test_decontamination(spark, slice_windows):
    r = random.Random(8)
    text = lambda n: " ".join(r.choices(["a", "B", "c-d", "É", "x9", "."], k=n))
    items = [(i, text(n)) for i, n in enumerate([40, 13, 12, 3, 1, 20])] + [(7, None), (8, "?!"), (9, "only here in the end"), (10, "only here in the end")]
    docs = [(i, text(r.choice([0, 1, 5, 60, 400]))) for i in range(25)] + [(i, text(30) + " " + items[i % 6][1].upper() + "," + text(5)) for i in range(12)]
    docs += [(1, None), (2, "Only here -- in the END"), (2, "Only here -- in the END")]
    bench = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, key int")
    df = spark.createDataFrame([(*x, 0) for x in docs], DOCS + ", key int")
    got = sorted([(x.doc_id, x.n_words, x.n_hit, list(x["items"]), x.contaminated) for x in
                  dc.contamination(df, bench, slice_windows=slice_windows).collect()], key=str)
    assert got == brute(docs, items)
    whole = dc.contamination(df, bench, slice_windows=slice_windows, whole=True)
    assert whole.columns == [*df.columns, "n_words", "n_hit", "items", "contaminated"]
    assert sorted([(x.doc_id, x.n_words, x.n_hit, list(x["items"]), x.contaminated) for x in whole.collect()], key=str) == got
    empty = dc.contamination(df, bench.limit(0)).collect()
    assert len(empty) == len(docs) and not any(x.n_hit or x.contaminated for x in empty) and any(x.n_words for x in empty)
    assert dc.contamination(df.limit(0), bench).count() == 0


def test_searcher_skips_by_its_shift_table():
    random_ = np.random.default_rng(2)
    windows = np.unique(random_.integers(1, 9, (40, 5)), axis=0)
    words = random_.integers(0, 9, 6000)
    searcher = dc.Searcher(windows)
    starts, numbers = searcher.find(words)
    expected = sorted((i, k) for i in range(len(words) - 4) for k, w in enumerate(windows) if (words[i:i + 5] == w).all())
    assert sorted(zip(starts.tolist(), numbers.tolist())) == expected
    assert searcher.shift.max() == 4 and searcher.shift.min() == 0


# --- neighbours -------------------------------------------------------------


def test_neighbours(spark):
    random_ = np.random.default_rng(3)
    centres = random_.standard_normal((12, 10))
    x = (centres[random_.integers(0, 12, 900)] + 0.4 * random_.standard_normal((900, 10))).astype(np.float32).astype(float)
    x[300:600] = x[7]  # a third are copies
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1020, [0.0] * 10, 1), (1040, [float("nan")] + [1.0] * 9, 1), (1060, [None] + [1.0] * 9, 1), (1080, [1.0], 1),
           (1100, [float("inf")] * 10, 1), (None, (0.001 * x[0]).tolist(), 1), (1120, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, leaf int").repartition(5)
    got = nb.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), 20, sample=400, leaf=20).collect()
    hits = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -scores))[:20]
        hits += len(set(best.tolist()) & {r.vec_id for r in mine})
        assert all(r.score == pytest.approx(scores[r.vec_id], abs=1e-12) and r.vec_id != q for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        if 300 <= q < 600:
            equal = [r.vec_id for r in mine if r.score == mine[0].score]
            assert equal == sorted(equal) and all(r.vec_id < 340 for r in mine if (x[r.vec_id] == x[7]).all())
    assert hits / 45 / 20 >= 0.9 and {r.query_id for r in got} == set(range(0, 900, 20))
    few = nb.nearest_neighbours(df.filter("vec_id < 3"), df.filter("vec_id = 0")).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert nb.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0


def test_every_row_but_the_query_is_a_candidate(spark):
    """Repeated ids, repeated rows, null ids and other lengths, against brute force; small enough that every leaf is visited."""
    r = random.Random(6)
    vector = lambda: [round(r.gauss(0, 1), 1) for _ in range(3)]
    rows = [(r.randrange(40) if r.random() < 0.9 else None, vector()) for _ in range(150)]
    rows += [rows[0]] * 3 + [(0, [0.9, 0.0, 0.0]), (0, [0.1, 0.5, 0.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (7, [3.0, 1.0]), (0, [0.9, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = nb.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), 20, recall=1.0).collect()
    expected = []
    for i, (q, v) in enumerate(rows):
        if q is not None and q % 20 == 0:
            others = [(sum(a * b for a, b in zip(v, w)), k) for j, (k, w) in enumerate(rows) if j != i and len(w) == len(v)]
            others.sort(key=lambda o: (-o[0], o[1] is None, o[1]))
            expected += [(q, n, k, round(s, 9)) for n, (s, k) in enumerate(others[:20], 1)]
    assert sorted([(x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in got], key=str) == sorted(expected, key=str)


def test_wider_visits_find_more():
    random_ = np.random.default_rng(5)
    x = random_.standard_normal((600, 16))
    tree = nb.Tree(x, leaf=20)
    assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves)) and np.bincount(tree.place(x), minlength=tree.leaves).min() > 0
    assert nb.calibrated(tree, x, 10, 0.5) < nb.calibrated(tree, x, 10, 0.95) <= tree.leaves
    assert nb.calibrated(tree, x, 10, 1.0) <= tree.leaves


# --- models -----------------------------------------------------------------


def labelled(n=700, seed=9):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, rude = r.random() < 0.3, r.random() < 0.25
        w = [r.choice("the of and thing other more when".split()) + r.choice(["", "s", "ed"]) for _ in range(r.randint(20, 300))]
        if rude:
            w.insert(r.randrange(len(w)), r.choice(["nasty", "Vile!", "grossly"]))
        if bad:
            w = [x + r.choice(["%%%", "###"]) for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(rude)))
    return rows, labels


def test_chain(spark):
    rows, labels = labelled()
    df = spark.createDataFrame([(*x, 1) for x in rows], DOCS + ", key int")
    known = spark.createDataFrame(labels + [labels[0], (None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    models = chains.train(df, known.select("doc_id", (1 - F.col("quality")).alias("unfit"), "toxic"), ["unfit", "toxic"])
    assert len(models) == 2 and len(models[1].earlier) == 1
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "x " * 300_000 + "vile", 1), (3, "nasty vile grossly", 1), (3, "nasty vile grossly", 1)], DOCS + ", key int")
    got = {r.doc_id: r for r in chains.score(df, models, ["unfit", "toxic"]).collect()}
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i].toxic >= 0.5) == t for i, t in held]) > 0.97
    extra = chains.score(odd, models, ["unfit", "toxic"]).collect()
    assert len(extra) == 5 and [r.toxic >= 0.5 for r in extra] == [False, False, True, True, True]
    again = chains.train(df.repartition(7), known.select("doc_id", (1 - F.col("quality")).alias("unfit"), "toxic"), ["unfit", "toxic"])
    assert all((a.weights == b.weights).all() and a.bias == b.bias for a, b in zip(models, again))
    none = chains.train(df, known.limit(0).withColumn("unfit", F.col("quality")), ["unfit", "toxic"])
    assert chains.score(df.limit(1), none, ["unfit", "toxic"]).first().toxic < 0.01
    assert chains.score(df.limit(0), models, ["unfit", "toxic"]).count() == 0


def test_scores_of_the_chain_by_hand(spark):
    """Every model's sum over the words of a text, worked out word by word."""
    rows, labels = labelled(300)
    known = spark.createDataFrame([(i, 1 - q, t) for i, q, t in labels], "doc_id long, unfit int, toxic int")
    df = spark.createDataFrame(rows, DOCS)
    models = chains.train(df, known, ["unfit", "toxic"])
    hasher, got = Hasher(), {r.doc_id: r for r in chains.score(df, models, ["unfit", "toxic"]).collect()}
    for i, text in rows[:40]:
        found, earlier = {}, []
        for word in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()):
            data = word.encode()
            for part in [data, *[data[:n] for n in chains.BEGINNINGS if len(data) > n]]:
                name = int(hasher.text(word, chains.ALNUM)[0]) if part is data else int(hasher.with_beginnings(word, chains.ALNUM, (len(part),))[1])
                found[name] = found.get(name, 0) + 1
        names = set(found) | {(n + k) % (1 << 64) for n, times in found.items() for k in chains.OFTEN if times >= k}
        for model, name in zip(models, ("unfit", "toxic")):
            weights = dict(zip(model.names.tolist(), model.weights.tolist()))
            value = sum(weights.get(n, 0.0) for n in names) + sum(a * b for a, b in zip(model.earlier, earlier)) + model.bias
            p = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
            assert got[i][name] == pytest.approx(p, abs=1e-9)
            earlier.append(float(chains.log_odds(np.array([p]))[0]))
    assert all(0.05 <= m.bound <= 0.95 for m in models)


def test_scores_of_the_network_by_hand(spark):
    """Every filter at every place of every chunk, in plain loops."""
    rows, labels = labelled(300)
    df = spark.createDataFrame(rows + [(900, ""), (901, "word " * 300)], DOCS)
    net = ql.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in ql.score(df, net).collect()}
    for i, text in [*rows[:3], (900, ""), (901, "word " * 300)]:
        data, step = text.encode(), ql.CHUNK - ql.OVERLAP
        tops = []
        for start in range(0, max(len(data) - ql.OVERLAP, 1), step):
            chunk = data[start:start + ql.CHUNK].ljust(ql.CHUNK, b"\0")
            seen = [np.concatenate([net.bytes[b] for b in chunk[p:p + ql.WIDTH]]) for p in range(0, ql.CHUNK - ql.WIDTH + 1, ql.STRIDE)]
            tops.append([max(0.0, max(float(s @ net.filters[:, f]) for s in seen) + float(net.offset[f])) for f in range(ql.FILTERS)])
        described = np.concatenate([np.max(tops, axis=0), np.mean(tops, axis=0)])
        inner = [max(0.0, float(described @ net.hidden[:, h]) + float(net.hidden_offset[h])) for h in range(ql.HIDDEN)]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(np.dot(inner, net.out) + float(net.out_offset)))), abs=1e-4)


def test_later_models_learn_from_out_of_fold_results():
    """A second category that equals the first is read off the chain, where features alone say nothing new."""
    rows, labels = labelled(300)
    hasher = Hasher()
    docs = [chains.features(hasher, t) for _, t in rows]
    y = np.array([[1.0 - q, 1.0 - q] for _, q, _ in labels])
    models = chains.fit_chain(docs, y, np.ones(len(docs)))
    assert models[1].earlier[0] > 0.05


def test_network(spark):
    rows, labels = labelled()
    df = spark.createDataFrame([(*x, 1) for x in rows], DOCS + ", score int")
    known = spark.createDataFrame(labels + [labels[0], (None, 1, 1), (5001, None, 0)], "doc_id long, quality int, toxic int")
    net = ql.train(df, known)
    got = {r.doc_id: r for r in ql.score(df, net).collect()}
    held = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == q for i, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "the thing " * 100_000 + "%%% " * 50, 1), (3, "a", 1), (3, "a", 1)], DOCS + ", score int")
    assert ql.score(odd, net).count() == 5 and ql.score(odd.limit(0), net).count() == 0
    empty = ql.train(df, known.limit(0))
    assert ql.score(df.limit(2), empty).count() == 2


def test_chunks_cover_every_byte():
    for n in (0, 1, 64, 511, 512, 513, 959, 960, 961, 5000):
        data = bytes(i % 251 + 1 for i in range(n))
        rows = ql.chunks(data)
        step = ql.CHUNK - ql.OVERLAP
        back = np.zeros(step * (len(rows) - 1) + ql.CHUNK, np.uint8)
        for i, row in enumerate(rows):
            back[i * step:i * step + ql.CHUNK] = row
        assert bytes(back[:n]) == data and not back[n:].any()


def test_gradients_agree_with_differences():
    random_ = np.random.default_rng(0)
    views = [random_.integers(0, 256, (k, ql.CHUNK)).astype(np.uint8) for k in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0], np.float32)
    net = ql.fit(views, y, steps=2)
    net = ql.Network(*[np.asarray(x, np.float64) for x in net])
    slopes = ql._slopes(net, views, y)

    def loss(n):
        total = 0.0
        for v, t in zip(views, y):
            top = ql.responses(n, v)
            p = ql.probability(n, np.concatenate([top.max(axis=0), top.mean(axis=0)])[None])[0]
            total -= np.log(p if t else 1 - p) / len(y)
        return total + 5e-5 * ((n.filters ** 2).sum() + (n.hidden ** 2).sum())

    for field, place in (("filters", (5, 3)), ("hidden", (2, 4)), ("out", (3,)), ("offset", (3,))):
        i = ql.Network._fields.index(field)
        up, down = (getattr(net, field).copy() for _ in range(2))
        up[place] += 1e-4
        down[place] -= 1e-4
        numeric = (loss(net._replace(**{field: up})) - loss(net._replace(**{field: down}))) / 2e-4
        assert slopes[i][place] == pytest.approx(numeric, rel=0.05, abs=2e-4)

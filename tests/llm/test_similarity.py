import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import graph, jaccard as jc, passages as ps
from adtally.llm.words import ALNUM, SPACED, Hasher, pieces, shingles

DOCS = "doc_id long, text string"


def vocabulary(n=4000):
    return [f"w{i}" for i in range(n)]


def text(random_, n):
    return " ".join(random_.choices(vocabulary(), k=n))


def changed(random_, text_, times):
    w = text_.split()
    for _ in range(times):
        w[random_.randrange(len(w))] = f"x{random_.random()}"
    return " ".join(w)


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# --- words ------------------------------------------------------------------


def test_words_agree_with_patterns():
    import re

    sample = "ÀB İK Ab\x0bc\x00d_e9  x y-Z\x7f!é" * 3
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sample)
    for table, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (SPACED, r"[^\x20\x09-\x0D]+")):
        expected = re.findall(pattern, lower)
        for size in (1, 5, 1 << 20):
            assert [w.decode() for p in pieces(sample, table, size) for w in p] == expected
            got = Hasher().text(sample, table, size)
            assert len(got) == len(expected) and len(set(got.tolist())) == len(set(expected))
            assert dict(zip(expected, got)) == dict(zip(expected, Hasher().text(sample, table)))
    assert len(shingles(np.arange(3, dtype=np.uint64), 5)) == 1 and len(shingles(np.arange(9, dtype=np.uint64), 5)) == 5


# --- components -------------------------------------------------------------


def test_components(spark):
    random.seed(2)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots(nodes, [x for x in links if x[0] != x[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram Jaccard ---------------------------------------------------------


def near_documents(seed):
    r = random.Random(seed)
    rows = []
    for size in (3, 5, 9, 14, 25, 40, 90, 200, 700):
        base = text(r, size)
        rows += [base, base.upper(), *[changed(r, base, t) for t in (1, 1, 2, 3, 5) for _ in range(2)], base + " " + text(r, max(1, size // 9))]
    chain = text(r, 150)
    for _ in range(8):
        chain = changed(r, chain, 2)
        rows.append(chain)
    common = text(r, 30)
    rows += [text(r, 20) + " " + common + " " + text(r, 30) for _ in range(20)]
    rows += [None, "", "  \n", "a", "A", "one two", "same " * 300, "same " * 500]
    r.shuffle(rows)
    return list(enumerate(rows))


def brute_jaccard(rows, n=4):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets.setdefault(i, []).append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    flat = [(i, s) for i, ss in sets.items() for s in ss if s]
    links = [(a, b) for x, (a, s) in enumerate(flat) for b, t in flat[:x] if 100 * len(s & t) >= 85 * len(s | t)]
    return sets, roots(sets, links)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed):
    rows = near_documents(seed)
    rows += [(3, "another text of a repeated id"), rows[0]]
    sets, expected = brute_jaccard(rows)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", fp int, k int").repartition(4)
    got = jc.linked_documents(df).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == expected
    assert sorted((r.doc_id, r.n_shingles) for r in got) == sorted((i, len(s)) for i, ss in sets.items() for s in ss)


def test_jaccard_edges(spark):
    assert jc.linked_documents(spark.createDataFrame([], DOCS)).count() == 0
    got = jc.linked_documents(spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (None, "z"), (6, None)], DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 1, 0), (0, 2, 4), (4, 2, 4), (6, 0, 6)]


def test_every_similar_pair_shares_a_key():
    """The pigeonhole argument, for all grids the allocation may choose."""
    rule, random_ = jc.Rule(), np.random.default_rng(4)
    kinds = set()
    for size in [1, 2, 3, 6, 7, 8, 12, 13, 20, 33, 50, 75, 120, 300, 900, 4000]:
        for records in (1, 10 ** 4, 10 ** 9):
            for _ in range(30 if size < 1000 else 5):
                tokens = random_.integers(1, 1 << 63, 3 * size + 8).astype(np.uint64)
                one = tokens[:size]
                # Drop and add as much as the rule allows.
                drop = int(random_.integers(0, size * 15 // 100 + 1))
                add = max(0, (100 * (size - drop) - 85 * size) // 85)
                two = np.concatenate([one[drop:], tokens[size:size + int(random_.integers(0, add + 1))]])
                both = len(one) - drop
                if not len(two) or 100 * both < 85 * (len(one) + len(two) - both):
                    continue
                bands = sorted((rule.band(len(one)), rule.band(len(two))))
                assert bands[1] - bands[0] <= 1
                grid = jc.allocate(rule, bands[0], records)
                kinds.add((grid.deletions, grid.small > 0))
                a, b = (set(jc.segment_keys(np.unique(x), grid, bands[0]).tolist()) for x in (one, two))
                assert a & b, (size, len(two), grid)
    assert {k[0] for k in kinds} == {False, True}


# --- passages ---------------------------------------------------------------


def test_compact_windows_are_the_minima_of_their_subsequences():
    random_ = np.random.default_rng(1)
    tokens = random_.integers(0, 40, 160).astype(np.uint64)
    first, last, length = np.array([0, 60, 61, 100]), np.array([59, 60, 99, 159]), 9
    values = ps.hashed(tokens, 0)
    place = {}
    for low, mid, high in zip(*ps.compact_windows(values, first, last, length)):
        for a in range(low, mid + 1):
            for b in range(max(mid, a + length - 1), high + 1):
                assert (a, b) not in place
                place[a, b] = mid
    every = [(a, b) for f, l in zip(first, last) for a in range(f, l + 1) for b in range(a + length - 1, l + 1)]
    assert set(place) == set(every) and all(place[a, b] == a + int(values[a:b + 1].argmin()) for a, b in every)
    begin, at = ps.tiling(tokens, first, last, length, 0)
    starts = [a for f, l in zip(first, last) for a in range(f, l - length + 2)]
    assert [at[np.searchsorted(begin, a, side="right") - 1] for a in starts] == [place[a, a + length - 1] for a in starts]


def test_tiling_of_texts_longer_than_a_place(monkeypatch):
    for name, value in (("STRETCH", 128), ("_PLACE", np.uint64(255)), ("_SPREAD", np.uint64(0x79)), ("_BACK", np.uint64(pow(0x79, -1, 256)))):
        monkeypatch.setattr(ps, name, value)
    tokens = np.random.default_rng(9).integers(0, 1 << 62, 3000).astype(np.uint64)
    first, last, length = np.array([0, 40, 45, 1500]), np.array([39, 44, 1499, 2999]), 9
    values = ps.hashed(tokens, 0)
    begin, at = ps.tiling(tokens, first, last, length, 0)
    starts = [a for f, l in zip(first, last) for a in range(f, l - length + 2)]
    assert [at[np.searchsorted(begin, a, side="right") - 1] for a in starts] == [a + int(values[a:a + length].argmin()) for a in starts]


def test_near_repeats_share_a_signature():
    """Planted passages of one length at a similarity of 0.80 to 0.85: brute force finds all, signatures 95 % at least."""
    random_, met, times = np.random.default_rng(8), 0, 1200
    new = lambda n: random_.integers(1, 1 << 62, n).astype(np.uint64)
    for i in range(times):
        passage = new(46)
        other, edit = passage.copy(), 4 + i % 2
        at = int(random_.integers(0, 47 - edit))
        other[at:at + edit] = new(edit)
        both = len(np.intersect1d(passage, other))
        assert 0.80 <= both / (92 - both) <= 0.85
        one, two = (np.concatenate([new(30), x, new(30)]) for x in (passage, other))
        met += len(np.intersect1d(*[ps.signatures(x, np.array([0]), np.array([len(x) - 1]), 46)[0] for x in (one, two)])) > 0
    assert met >= 0.95 * times


def test_passages(spark):
    r = random.Random(6)
    passage, near = text(r, 51), text(r, 120)
    once = lambda: text(r, r.randint(60, 300))
    rows = [once() for _ in range(40)]
    shared = [f"{once()} {passage.title() if i % 2 else passage} {once()}" for i in range(12)]
    close = [f"{once()} {changed(r, near, 1)} {once()}" for i in range(2)]
    line = text(r, 30)
    lined = [f"{once()} {line} {once()}" for _ in range(15)]
    copies, small = [once()] * 3, [text(r, 40)] * 2
    rows = rows + shared + close + lined + copies + small + [None, "", "again " * 400, "again " * 300, "other " * 500]
    ids = list(range(len(rows)))
    got = {x.doc_id: x for x in ps.repeated_passages(spark.createDataFrame([(i, t, 1) for i, t in zip(ids, rows)], DOCS + ", n int").repartition(3)).collect()}
    assert len(got) == len(rows)
    seen = defaultdict(set)
    for i, t in zip(ids, rows):
        w = (t or "").lower().split()
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].add(i)
    exact = roots(ids, [(min(v), x) for v in seen.values() for x in v])
    assert all(got[i].class_id == got[exact[i]].class_id for i in ids)
    assert got[53].class_id == 52  # near
    linked = {i for i in ids if exact[i] != i or i in exact.values() and sum(x == i for x in exact.values()) > 1} | {52, 53}
    assert all(got[i].class_id == i and got[i].n_repeated == 0 for i in ids if i not in linked)
    for i in range(40, 52):
        (span,) = got[i].spans
        assert passage.lower() in " ".join(rows[i].lower().split()[span.start:span.stop]) and 51 <= span.stop - span.start <= 60
    assert [got[i].n_repeated for i in ids if rows[i] == copies[0]] == [len(copies[0].split())] * 3
    assert ps.repeated_passages(spark.createDataFrame([], DOCS)).count() == 0


def test_near_repeats_around_a_common_line(spark):
    """Pairs of near repeats whose signatures are mostly those of a line that many texts hold."""
    r = random.Random(12)
    line, rows = text(r, 43), []  # 39 tokens; 41 of 46 make a near repeat
    pairs = 60
    for _ in range(pairs):
        one, two = text(r, 2), text(r, 4)
        rows += [f"{text(r, 40)} {line} {one} x{edit} {two} {text(r, 40)}" for edit in (0, 1)]
    rows += [f"{text(r, 60)} {line} {text(r, 60)}" for _ in range(60)]
    got = {x.doc_id: x for x in ps.repeated_passages(spark.createDataFrame(list(enumerate(rows)), DOCS).repartition(3)).collect()}
    assert all(x.class_id in (x.doc_id, x.doc_id // 2 * 2) and (x.doc_id < 2 * pairs or not x.spans) for x in got.values())
    met = sum(got[2 * i + 1].class_id == 2 * i for i in range(pairs))
    assert met >= 0.97 * pairs and sum(x.n_links for x in got.values()) == 2 * met


@pytest.mark.parametrize("kinds", [30, 4000])
def test_counts_of_common_tokens(kinds, monkeypatch):
    monkeypatch.setattr(ps, "COMMON", 5)
    random_ = np.random.default_rng(kinds)
    covers = [random_.integers(0, kinds, int(random_.integers(46, 62))).astype(np.uint64) for _ in range(300)]
    first, second = np.arange(270), np.arange(270, 300)
    times = [np.bincount(x.astype(np.int64), minlength=kinds) for x in covers]
    for rows, counts in ps._counted(covers, first, second):
        assert counts.tolist() == [[int(np.minimum(times[i], times[j]).sum()) for j in second] for i in rows]


def test_similar_windows_connect_all_that_are_similar():
    random_ = np.random.default_rng(2)
    new = lambda n: random_.integers(1, 1 << 62, n).astype(np.uint64)
    bases = [new(55) for _ in range(6)]
    covers, kind = [], []
    for i in range(120):
        x = bases[i % 6].copy()
        x[:int(random_.integers(0, 8))] = 3
        covers.append(x)
        kind.append(i % 6)
    names, blocks = np.arange(120), (np.arange(120) >= 60).astype(np.int64)
    links = [p for low, high in ((0, 0), (0, 1), (1, 1)) for at in [np.isin(blocks, (low, high))]
             for p in zip(*ps.similar_windows(names[at], names[at], np.ones(at.sum(), bool), blocks[at], [c for c, m in zip(covers, at) if m], 46))]
    assert len(links) <= 3 * 120 and roots(range(120), links) == {i: i % 6 for i in range(120)}
    one = np.zeros(120, np.int64)
    a, b = ps.similar_windows(names, one, names == 7, 0 * blocks, covers, 46)
    assert len(a) == 1 and 7 in (a[0], b[0])


def test_shared_passages_of_repetitive_texts():
    words = np.arange(5000, dtype=np.uint64) * np.uint64(7919)
    same = np.full(3000, 5, np.uint64)
    one, two = ps.shared_passages(same, same[:2000], 46)
    assert one.all() and two.all()
    one, two = ps.shared_passages(words[:300], np.concatenate([words[1000:1100], words[100:160], words[2000:2100]]), 46)
    assert np.flatnonzero(one).tolist() == list(range(100, 160)) and np.flatnonzero(two).tolist() == list(range(100, 160))
    assert not ps.shared_passages(words[:300], words[260:700], 46)[0].any()  # 40 in common


def test_shared_passages_that_stand_twice_in_one_text():
    random_ = np.random.default_rng(3)
    new = lambda n: random_.integers(1, 1 << 62, n).astype(np.uint64)
    passage = new(60)
    close = passage.copy()
    close[20:25] = new(5)
    one, two = np.concatenate([new(80), close, new(70)]), np.concatenate([passage, new(200), passage])
    for a, b in ((one, two), (two, one)):
        left, right = ps.shared_passages(a, b, 46)
        single, double = (left, right) if a is one else (right, left)
        assert single[80:140].all() and double[:60].all() and double[260:].all()
    one, two = np.concatenate([new(80), passage, new(70)]), np.concatenate([passage, new(200), close])  # one of them exact
    for a, b in ((one, two), (two, one)):
        double = ps.shared_passages(a, b, 46)[a is one]
        assert double[:60].all() and double[260:].all()
    # A token counts as often as both have it: one place in the right is no partner of 46 in the left.
    assert not ps.shared_passages(np.full(200, 5, np.uint64), np.concatenate([new(100), np.full(1, 5, np.uint64), new(100)]), 46)[0].any()


def test_distances_are_compared_together(monkeypatch):
    """A pair that agrees at very many distances: one sum, or a few, not one for each distance."""
    random_, calls = np.random.default_rng(17), []
    new = lambda n: random_.integers(1, 1 << 62, n).astype(np.uint64)
    for name in ("_commons", "_close_starts"):
        real = getattr(ps, name)
        monkeypatch.setattr(ps, name, lambda *a, real=real, **k: calls.append(1) or real(*a, **k))
    passage = new(60)
    bits = [passage[i:i + 6] for i in range(0, 60, 6)]
    moved = np.concatenate([x for i in range(40) for x in (bits[(7 * i) % 10] if i < 10 else new(6), new(2))])
    near = np.concatenate([passage[:30], new(3), passage[33:]])
    for left, right, times in ((np.concatenate([new(50), passage, new(50)]), np.concatenate([moved, near, moved[80:]]), 1),
                               (np.concatenate([passage, new(9), passage[:46], new(9), passage]), np.concatenate([moved, near]), 3)):
        calls.clear()
        one, two = ps.shared_passages(left, right, 46)
        assert len(calls) <= times and two[len(moved):len(moved) + 60].all() and not two[:len(moved) - 46].any()
        assert one[50:110].all() if times == 1 else one[:60].all() and one[-60:].all()


def test_close_starts_against_brute_force(monkeypatch):
    random_ = np.random.default_rng(6)
    for expanded in (1 << 18, 50):  # all distances at once, or some at a time
        monkeypatch.setattr(ps, "EXPANDED", expanded)
        for _ in range(30):
            n, m, length, need = 80, 70, 12, 5
            left = np.sort(random_.permutation(n)[:50])
            right = random_.permutation(m)[:50]
            right[10:30] = right[10] + np.arange(20) if right[10] < 50 and len(set(right[10] + np.arange(20)) & set(np.delete(right, range(10, 30)))) == 0 else right[10:30]
            shifts = np.arange(length - n, m - length + 1)
            got = {(int(shifts[i]), s) for rows in ps._close_starts(left, right, shifts, (n, m), length, need)
                   for i, low, high in zip(*rows) for s in range(low, high)}
            want = {(int(d), s) for d in shifts for s in range(max(0, -d), min(n, m - d) - length + 1)
                    if sum(s <= x < s + length and s + d <= y < s + d + length for x, y in zip(left, right)) >= need}
            assert got == want


def test_groups_of_two_and_more_are_ranked(spark, tmp_path):
    rows = [(1, 5), (1, 6), (2, 6), (2, 7), (2, 5), (3, 8), (4, 7), (4, 6)]
    got = graph.ranked(spark.createDataFrame(rows, "k long, node long").repartition(3), graph.Scratch(spark)).collect()
    assert {(r.k, r.node, r["rank"], r.lead) for r in got} == {(1, 6, 1, 6), (1, 5, 2, 6), (2, 6, 1, 6), (2, 5, 2, 6), (2, 7, 3, 6), (4, 6, 1, 6), (4, 7, 2, 6)}


def test_votes_and_common_tokens_against_brute_force():
    random_ = np.random.default_rng(5)
    for n, m, kinds in ((60, 50, 12), (3000, 2500, 9), (40, 40, 1)):
        left, right = random_.integers(0, kinds, n), random_.integers(0, kinds, m)
        sort = lambda x: (np.sort(x, kind="stable"), np.argsort(x, kind="stable"))
        votes = ps._votes(sort(left), sort(right), (n, m))
        for shift in (-n + 1, -7, 0, 3, m - 1):
            low, high = max(0, -shift), min(n, m - shift)
            assert votes[shift + n] == (left[low:high] == right[low + shift:high + shift]).sum()
            if high - low >= 9:
                got = ps._common(sort(left), sort(right), shift, low, high - 9, 9)
                count = lambda x: np.bincount(x, minlength=kinds)
                assert got.tolist() == [np.minimum(count(left[s:s + 9]), count(right[s + shift:s + shift + 9])).sum() for s in range(low, high - 8)]


def test_merged_spans(spark):
    rows = [([(5, 9), (1, 3), (2, 4), (9, 12)],), ([],), ([(4, 5)],)]
    got = spark.createDataFrame(rows, "s array<struct<start:long,stop:long>>").select(ps.merged(F.col("s")).alias("m")).collect()
    assert [[tuple(x) for x in r.m] for r in got] == [[(1, 4), (5, 12)], [], [(4, 5)]]

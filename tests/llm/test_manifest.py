import hashlib
import random

import pytest
from pyspark.sql import functions as F

from adtally.llm import manifest as mf

KIND = "doc_id long, source string, lang string, n_chars long, text string, place int, nodes string, digest int, tree int, c0 int"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(digests, fanout):
    """The root and, per digest, its (left, right) siblings on each level."""
    paths, own, now = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(now) > 1:
        above, owners = [], []
        for i in range(0, len(now), fanout):
            run = now[i:i + fanout]
            for j in range(len(run)):
                for k in own[i + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(sha("".join(run)))
            owners.append([k for o in own[i:i + fanout] for k in o])
        now, own = above, owners
    return now[0], paths


def expected(rows, changed, fanout=8):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    parts = []
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        parts.append(tree_of([leaf_of(r) for r in trees[name]], fanout))
    root, upper = tree_of([p[0] for p in parts], fanout)
    out = []
    for name, (subroot, paths), top in zip(names, parts, upper):
        for row, path in zip(trees[name], paths):
            back = leaf_of(changed(row))
            for left, right in path + top:
                back = sha(left + back + right)
            out.append((row[0], leaf_of(row), subroot, root, sha("".join(a + b for a, b in path + top)), back, back == root))
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], KIND)


@pytest.mark.parametrize("fanout", [8, 2, 3])
def test_manifest_against_brute_force(spark, fanout):
    random.seed(fanout)
    rows = [(i if i % 9 else None, random.choice(["a", None]), random.choice(["en", "en", "en", "de", None, "é", "z" * 3]), random.choice([None, 7]),
             random.choice([None, "", "Äb C", "x" * 5000, "same text"])) for i in range(300)]
    rows += [(5, "a", "en", 1, "Copy")] * 40 + [(6, None, "lone", None, None)] + [(8, "a", "dé", 2, "b")] * 9
    random.shuffle(rows)
    lowered = F.when(F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False)), F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    hit = lambda r: (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None and r[0] is not None and r[0] % 2 else r[4])
    got = mf.manifest(frame(spark, rows).repartition(5), changed={"text": lowered}, fanout=fanout)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found(got) == expected(rows, hit, fanout)


def test_small_trees(spark):
    same = lambda r: r
    for rows in ([(1, "a", "en", 1, "t")], [(1, "a", "en", 1, "t"), (2, "a", None, 1, "t")], [(i, "a", "en", 1, "t") for i in range(8)],
                 [(i, "a", "en", 1, "t") for i in range(9)], [(i, "a", f"l{i}", 1, "t") for i in range(9)]):
        assert found(mf.manifest(frame(spark, rows))) == expected(rows, same)
    lone = mf.manifest(frame(spark, [(None, None, None, None, None)])).collect()[0]
    assert lone.leaf == lone.subroot == lone.root == sha("-----") and lone.proof_sha256 == sha("") and lone.verified
    assert mf.manifest(frame(spark, []).limit(0)).collect() == []
    with pytest.raises(ValueError):
        mf.merkle(frame(spark, []), "lang", ["doc_id"], "text", 1)


def test_copies_are_numbered_in_parts(spark):
    rows = spark.range(25).select(F.lit("t").alias("g"), F.when(F.col("id") < 20, 3).otherwise(F.col("id") - 19).alias("v"))
    got = [tuple(r) for r in mf.placed(rows, "g", ["v"], copies=6).select("v", "place", "nodes").collect()]
    assert sorted(p for _, p, _ in got) == list(range(25)) and {n for _, _, n in got} == {25}
    assert [v for v, p, _ in sorted(got, key=lambda r: r[1])] == sorted([3] * 20 + [1, 2, 3, 4, 5])


def test_no_python_on_the_way(spark):
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    plan = mf.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan

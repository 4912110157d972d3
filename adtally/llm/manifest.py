"""A Merkle manifest of a dataset: a digest per row, tree and whole, with a proof for every row.

The rows of each tree (of one language, say) are its leaves, in the order of a key.  Every
eight consecutive nodes become one, the digest of theirs, until one is left; the trees'
roots are the leaves of the last tree.  A level is one aggregation: the children of a
parent are spread by conditional aggregates into a column per slot.  All columns
concatenated and hashed are the parent; without the column of the own slot they are a
child's siblings, so proofs come from the same rows, from the root downwards, and no
level is joined with one larger than itself.

Only Spark expressions are used.  The text of a row is read once; all that is shuffled is
narrow.  Leaves are numbered in ranges of the key, each from the count of those before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .graph import fixed

FANOUT = 8
COPIES = 1 << 12  # copies of one row that are numbered and spread as one
PATH = "array<struct<left:string,right:string>>"


def digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of values: ``-`` for null, else the number of UTF-8 bytes, a colon and the text."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[told(v) for v in values]), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda mine, p: F.sha2(F.concat(p["left"], mine, p["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def placed(rows: DataFrame, within: str, order: Sequence[str], copies: int = COPIES) -> DataFrame:
    """``rows`` with their place (from 0) in the group ``within`` by ``order``, and the group's ``nodes``.

    ``within`` holds no nulls.  Equal rows are counted on the map side and numbered together,
    some ``copies`` at a time; the rest are sorted in ranges, so that a large group, or a key
    that holds a third of it, is spread over many tasks.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / copies))))
    parts = parts.withColumn("_n", F.least(F.lit(copies).cast("bigint"), F.col("_n") - F.col("_part") * copies))
    sort = [within, *order, *[c for c in names if c != within and c not in order], "_part"]
    # Written, so that the ranges stand once and for all.
    ranged = fixed(parts.repartitionByRange(*sort).withColumn("_chunk", F.spark_partition_id()), "manifest-rows")
    totals = ranged.groupBy(within, "_chunk").agg(F.sum("_n").alias("_t"))
    group = Window.partitionBy(within)
    before = group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(within, "_chunk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"),
                           F.sum("_t").over(group).alias("nodes"))
    inside = Window.partitionBy(within, "_chunk").orderBy(*sort[1:]).rowsBetween(Window.unboundedPreceding, -1)
    first = ranged.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, [within, "_chunk"])
    spread = first.withColumn("_first", F.col("_start") + F.col("_first")).repartition(within, "_first")
    return spread.select(*names, "nodes", F.explode(F.expr("sequence(_first, _first + _n - 1)")).alias("place"))


def _of(slot: int) -> str:
    return f"coalesce(c{slot}.digest, '')"


def _pivot(nodes: DataFrame, carry: Sequence[str], fanout: int) -> DataFrame:
    """(tree, place, nodes, c0 ..., digest) of the parents: a column per slot holds the child's digest and what it carries."""
    child = f"struct({', '.join(['digest', *carry])})"
    spread = [F.expr(f"max(CASE WHEN place % {fanout} = {k} THEN {child} END)").alias(f"c{k}") for k in range(fanout)]
    parents = (nodes.filter("nodes > 1").groupBy("tree", F.expr(f"place div {fanout}").alias("place"))
               .agg(F.expr(f"(max(nodes) + {fanout - 1}) div {fanout}").alias("nodes"), *spread))
    return parents.withColumn("digest", F.expr(f"sha2(concat({', '.join(map(_of, range(fanout)))}), 256)"))


def _children(parents: DataFrame, carry: Sequence[str], known: Sequence[str], fanout: int) -> DataFrame:
    """The children of parents with a ``path``, each with its own path, what it carries and ``known`` columns of the parent."""
    joined = lambda slots: f"concat('', {', '.join(map(_of, slots))})" if slots else "''"
    one = lambda k: (f"struct(place * {fanout} + {k} AS place, c{k} AS child, "
                     f"struct({joined(range(k))} AS left, {joined(range(k + 1, fanout))} AS right) AS beside)")
    each = parents.selectExpr("tree", "path", *known, f"explode(array({', '.join(map(one, range(fanout)))})) AS e")
    return each.filter("e.child IS NOT NULL").selectExpr(
        "tree", "e.place AS place", "e.child.digest AS digest", *[f"e.child.{c} AS {c}" for c in carry],
        "concat(array(e.beside), path) AS path", *known)


def _levels(leaves: DataFrame, carry: Sequence[str], fanout: int) -> list[DataFrame]:
    """The leaves and, from one level to the next, their parents, each written; the last has one node of each tree left."""
    levels = [leaves]
    most = leaves.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        levels.append(fixed(_pivot(levels[-1], carry if len(levels) == 1 else [], fanout), "manifest-level"))
        most = -(-most // fanout)
    return levels


def _down(levels: Sequence[DataFrame], tops: DataFrame, carry: Sequence[str], known: Sequence[str], fanout: int) -> DataFrame:
    """The leaves with their path to the root, from the paths of the trees' roots ``tops`` (tree, path, ``known``)."""
    paths = None
    for i in reversed(range(len(levels))):
        # Trees whose last node is on this level begin here; their rows are few, one per tree.
        mine = carry if i == 0 else []
        ended = levels[i].filter("nodes = 1").select("tree", "place", "digest", *mine).join(tops, "tree")
        ended = ended.select("tree", "place", "digest", *mine, "path", *known)
        paths = ended if paths is None else ended.unionByName(paths)
        if i:
            above = paths.select("tree", "place", "path", *known)
            slots = levels[i].select("tree", "place", *[f"c{k}" for k in range(fanout)])
            paths = _children(slots.join(above, ["tree", "place"]), carry if i == 1 else [], known, fanout)
    return paths


def merkle(rows: DataFrame, tree: str, order: Sequence[str], leaf: str, fanout: int = FANOUT) -> DataFrame:
    """``rows`` with subroot, root and ``path`` (the siblings left and right of it on every level, up to the root).

    The leaves of each value of ``tree`` ascend by ``order``, nulls first, then by their other
    columns; repeated rows are a leaf each.  Trees ascend by their value, null first, strings
    by their UTF-8 bytes.  A tree of one leaf is that leaf.  No rows give no rows.
    """
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    names = rows.columns
    mine = [f"v{i}" for i in range(len(names))]
    at = dict(zip(names, mine))
    title = F.coalesce(F.concat(F.lit("s"), F.col(f"`{tree}`").cast("string")), F.lit("null"))  # joins null, too
    plain = rows.select(title.alias("tree"), F.col(f"`{leaf}`").alias("digest"), *[F.col(f"`{c}`").alias(at[c]) for c in names])
    leaves = fixed(placed(plain, "tree", [at[c] for c in order]), "manifest-leaves")
    levels = _levels(leaves, mine, fanout)
    value = leaves.filter("place = 0").select("tree", F.col(at[tree]).alias("value"))
    ends = reduce(DataFrame.unionByName, [level.filter("nodes = 1").select("tree", "digest") for level in levels])
    roots = placed(ends.join(value, "tree").select(F.lit("all").alias("tree"), F.col("tree").alias("title"), "value", "digest"),
                   "tree", ["value", "title"])
    upper = _levels(fixed(roots.drop("value"), "manifest-roots"), ["title"], fanout)
    whole = reduce(DataFrame.unionByName, [level.filter("nodes = 1").select("tree", F.col("digest").alias("root")) for level in upper])
    start = whole.select("tree", "root", F.array().cast(PATH).alias("path"))
    tops = _down(upper, start, ["title"], ["root"], fanout)
    tops = tops.select(F.col("title").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    proved = _down(levels, tops, mine, ["subroot", "root"], fanout)
    return proved.select(*[F.col(at[c]).alias(c) for c in names], "subroot", "root", "path")


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id",
             tree: str = "lang", changed: Mapping[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """A digest, its place in the whole and a check of every row.

    ``changed`` gives, for some columns, the values of a dataset to check against the
    manifest; without it the rows are checked against themselves.  Returns key, leaf,
    subroot, root, proof_sha256, folded_root (from the changed row and the original
    siblings) and verified.

    Nulls differ from all texts.  Repeated keys are leaves each, in the order of their digests;
    null keys and trees come first; other columns are ignored.  No rows give no rows.
    """
    now = dict(changed or {})
    leaf = digest([F.col(f"`{c}`") for c in columns])
    seen = digest([now.get(c, F.col(f"`{c}`")) for c in columns]) if now else leaf
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{tree}`").alias("group"), leaf.alias("leaf"),
                       F.nullif(seen, leaf).alias("seen"))
    proved = merkle(rows, "group", ["key", "leaf"], "leaf", fanout)
    back = folded(F.col("path"), F.coalesce("seen", "leaf"))
    done = proved.select(F.col("key").alias(key), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
                         back.alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))

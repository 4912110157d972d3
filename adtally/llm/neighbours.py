"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is then put into the leaf it reaches
by nearest centroids.  A query walks the tree best bin first: a priority queue holds the
branches not taken, by an upper bound of the inner product with what lies in their ball.
How many leaves it visits is widened on sample queries until their recall against brute
force over the sample reaches the target, with something to spare, as the sample is
thinner than the whole.

Leaves next to each other form a region.  Vectors and queries meet by region; a region is
split into blocks by its size, and its queries into parts by their number, so that a task
holds a bounded matrix of each.  Of equal vectors only the k + 1 with smallest ids can be
among the k nearest of anything, so the others need not be searched; equal queries are
searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .graph import fixed

SAMPLE = 20_000
LEAF = 80  # sample vectors
BRANCHES = 8
REGION = 8  # leaves
BLOCK = 16_384  # vectors
PART = 8_192  # queries


class Tree:
    """A k-means tree in arrays; children of a node are numbered together, leaves are numbered in order."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, branches: int = BRANCHES, seed: int = 7) -> None:
        self._random = np.random.default_rng(seed)
        self.centres, self.radius, self.children, self.leaf = [], [], [], []
        self.leaves = 0
        self._add(vectors, vectors, leaf, branches)
        self._fill(vectors, 0, leaf, branches)
        self.centres = np.array(self.centres)
        self.radius = np.array(self.radius)

    def _add(self, centre_of: np.ndarray, members: np.ndarray, *_: int) -> int:
        centre = centre_of.mean(axis=0) if len(centre_of) else np.zeros(members.shape[1])
        self.centres.append(centre)
        self.radius.append(float(np.sqrt(((members - centre) ** 2).sum(axis=1).max())) if len(members) else 0.0)
        self.children.append(None)
        self.leaf.append(-1)
        return len(self.children) - 1

    def _fill(self, members: np.ndarray, node: int, leaf: int, branches: int) -> None:
        groups = self._split(members, branches) if len(members) > leaf else []
        if len(groups) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return
        self.children[node] = [self._add(g, g) for g in groups]
        for child, g in zip(self.children[node], groups):
            self._fill(g, child, leaf, branches)

    def _split(self, members: np.ndarray, branches: int) -> list[np.ndarray]:
        """Up to ``branches`` k-means clusters; fewer where vectors are equal."""
        distinct = np.unique(members, axis=0)
        centres = distinct[self._random.permutation(len(distinct))[:branches]]
        for _ in range(8):
            near = nearest(members, centres)
            centres = np.array([members[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
        near = nearest(members, centres)
        return [members[near == i] for i in range(len(centres)) if (near == i).any()]

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.empty(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf[node]
                continue
            near = nearest(vectors[rows], self.centres[self.children[node]])
            todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        bound = self.centres @ query + self.radius * float(np.sqrt(query @ query)) * SPREAD
        queue, found = [(-bound[0], 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            while self.children[node] is not None:
                best, *others = sorted(self.children[node], key=lambda c: -bound[c])
                for other in others:
                    heapq.heappush(queue, (-bound[other], other))
                node = best
            found.append(self.leaf[node])
        return found


SPREAD = 0.3  # share of a ball's radius that counts for the bound; its rim is all but empty in many dimensions


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def calibrated(tree: Tree, sample: np.ndarray, k: int, recall: float, queries: int = 200) -> int:
    """The number of leaves to visit for ``recall`` of the k nearest on sample queries."""
    chosen = sample[:queries]
    leaf = tree.place(sample)
    scores = chosen @ sample.T
    scores[np.arange(len(chosen)), np.arange(len(chosen))] = -np.inf
    kth = np.sort(scores, axis=1)[:, -min(k, scores.shape[1])]
    order = [tree.visit(q, tree.leaves) for q in chosen]
    rank = np.empty((len(chosen), tree.leaves), np.int64)
    for i, o in enumerate(order):
        rank[i, o] = np.arange(len(o))
    reached = [rank[i][leaf[scores[i] >= kth[i]]] for i in range(len(chosen))]
    visits = 1
    while visits < tree.leaves and np.mean([np.mean(r < visits) for r in reached]) < recall:
        visits += max(1, visits // 8)
    return min(visits, tree.leaves)


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order, so that equal vectors tie."""
    return (vectors * query).sum(axis=1)


def best(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, scores) of the k best vectors of each query, ties by id; ``allowed`` says which it may see."""
    rough = np.where(allowed, queries @ vectors.T, -np.inf)
    out = []
    for i, query in enumerate(queries):
        row = rough[i]
        floor = np.partition(row, -k)[-k] if len(row) > k else -np.inf
        near = np.flatnonzero((row >= floor - 1e-9 * max(1.0, abs(floor))) & allowed[i]) if np.isfinite(floor) else np.flatnonzero(allowed[i])
        scores = exact_scores(query, vectors[near])
        order = np.lexsort((ids[near], -scores))[:k]
        out.append((near[order], scores[order]))
    return out


LAST = (1 << 63) - 1  # stands for a null id


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
                       recall: float = 0.97, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id and score, ties to the smaller id, a null one
    last.  Every row of ``vectors`` is a candidate, also those that repeat an id or a whole
    row, but one with the query's own id and vector, which is the query's own.  Queries
    that repeat are answered each.  Null vectors, zero ones, empty ones and those with null
    or non-finite components take no part; vectors are only compared with those of their
    length.  With fewer than k others, all are returned.  Other columns are ignored;
    without vectors there are no rows.
    """
    usable = (F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))

    def clean(df: DataFrame) -> DataFrame:
        """Equal rows are one with a count, summed on the map side."""
        rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(usable)
        return rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))

    spark = vectors.sparkSession
    rows = fixed(clean(vectors), "vectors-rows")
    asked = fixed(clean(queries).withColumn("q", F.monotonically_increasing_id()), "queries")
    # As many searches as there are lengths, mostly one.
    lengths = lambda df: df.select(F.size("v").alias("size")).distinct()
    sizes = sorted(r["size"] for r in lengths(asked).join(lengths(rows), "size").collect())
    found = [_searched(rows.filter(F.size("v") == n), asked.filter(F.size("v") == n), k, recall, sample, leaf) for n in sizes]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    top = reduce(DataFrame.unionAll, found).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    lists = top.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", F.col("id").alias("vec_id"), "score", "n"))).alias("found"))
    # Copies of a row follow each other; no more than k of them can be an answer.
    each = F.slice(F.flatten(F.transform("found", lambda x: F.array_repeat(x, F.least(x["n"], F.lit(k)).cast("int")))), 1, k)
    again = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / PART)))
    names = asked.select("q", F.col("id").alias("query_id"), "n", again.alias("part"))
    names = names.select("q", "query_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(PART).cast("bigint"), F.col("n") - F.col("part") * PART))))
    return (names.join(lists, "q").select("query_id", F.posexplode(each).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))


def _searched(rows: DataFrame, asked: DataFrame, k: int, recall: float, sample: int, leaf: int) -> DataFrame:
    """(q, id, score, n): the best k rows (id, v, n) of each region for queries (q, id, v), all of one length."""
    spark = rows.sparkSession
    # A bounded sample by a hash of the row.
    taken = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(sample).toArrow().column("v").combine_chunks()
    fitted = _matrix(taken)
    tree = Tree(fitted, leaf)
    visits = calibrated(tree, fitted, k, recall)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(tree.place(_matrix(batch.column(1)))), *batch.columns], names=["leaf", "id", "v", "n"])

    # Rows of one vector beyond the k + 1 smallest ids can be no answer; they are left out where a task sees them, before the shuffle.
    copies = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(copies)).filter(F.col("place") <= k + 1).drop("place")
    index = fixed(few.select("id", "v", "n").mapInArrow(placed, "leaf bigint, id bigint, v array<double>, n bigint"), "vectors")

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, row, leaves = [], [], []
            for i, query in enumerate(_matrix(batch.column(1)) if batch.num_rows else []):
                seen: dict[int, list[int]] = {}
                for x in tree.visit(query, visits):
                    seen.setdefault(x // REGION, []).append(x % REGION)
                region += seen
                row += [i] * len(seen)
                leaves += [sum(1 << x for x in xs) for xs in seen.values()]
            yield pa.RecordBatch.from_arrays([pa.array(region, pa.int64()), pa.array(leaves, pa.int64()),
                                              *batch.take(pa.array(row, pa.int64())).columns], names=["region", "leaves", "q", "v", "id"])

    routes = fixed(asked.select("q", "v", "id").mapInArrow(routed, "region bigint, leaves bigint, q bigint, v array<double>, id bigint"), "routes")
    # As many counts as there are regions, which the sample bounds.
    blocks = {r["region"]: -(-r["count"] // BLOCK) for r in index.groupBy((F.col("leaf").cast("bigint") / REGION).cast("bigint").alias("region")).count().collect()}
    parts = {r["region"]: -(-r["count"] // PART) for r in routes.groupBy("region").count().collect()}

    def of(counts: dict[int, int], region):
        listed = F.create_map(*[F.lit(x) for item in counts.items() for x in item]) if counts else F.create_map(F.lit(0), F.lit(1))
        return F.coalesce(F.element_at(listed, region.cast("int")), F.lit(1)).cast("int")

    region = F.floor(F.col("leaf") / REGION).alias("region")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (routes.withColumn("block", numbers(of(blocks, F.col("region"))))
            .withColumn("part", F.pmod(F.xxhash64("q"), of(parts, F.col("region"))).cast("int")))
    right_ = (index.select(region, "leaf", "id", "v", "n").withColumn("part", numbers(of(parts, F.col("region"))))
              .withColumn("block", F.pmod(F.xxhash64("id", "v"), of(blocks, F.col("region"))).cast("int")))

    def search(asked_: pa.Table, here: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if asked_.num_rows and here.num_rows:
            nulls = here.column("id").is_null().to_numpy()
            ids = np.where(nulls, LAST, here.column("id").fill_null(0).to_numpy())
            copies, own = here.column("n").to_numpy(), asked_.column("id").fill_null(LAST).to_numpy()
            all_vectors, leaf_bit = _matrix(here.column("v")), 1 << (here.column("leaf").to_numpy() % REGION)
            names, masks, wanted = asked_.column("q").to_numpy(), asked_.column("leaves").to_numpy(), _matrix(asked_.column("v"))
            for i in range(0, len(names), 256):
                allowed = (masks[i:i + 256, None] & leaf_bit[None, :]) != 0
                for j, (at, scores) in enumerate(best(wanted[i:i + 256], ids, all_vectors, allowed, k + 1)):
                    mine = (ids[at] == own[i + j]) & (all_vectors[at] == wanted[i + j]).all(axis=1)
                    left = copies[at] - mine
                    for part, values in zip(out, (np.full(len(at), names[i + j]), ids[at], scores, left)):
                        part.append(values[left > 0])
        q, id_, score, n = (np.concatenate(x) if x else np.empty(0) for x in out)
        id_ = id_.astype(np.int64)
        return pa.table({"q": pa.array(q.astype(np.int64)), "id": pa.array(id_, mask=id_ == LAST), "score": pa.array(score.astype(np.float64)), "n": pa.array(n.astype(np.int64))})

    return (left.groupBy("region", "block", "part").cogroup(right_.groupBy("region", "block", "part"))
            .applyInArrow(search, "q bigint, id bigint, score double, n bigint"))

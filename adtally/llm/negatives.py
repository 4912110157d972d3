"""Hard negatives of anchor vectors, by exact integer products of Kronecker-packed candidates.

Components become integers.  For every component, those of a block of candidates are raised
by a bias, so that none is negative, and packed into separate fields of one wide integer,
each field as wide as the largest sum it may hold.  An anchor's component is multiplied
with it once, for all candidates together; the sum over the components holds one product
per field, from which the bias is taken again.  Nothing is rounded.

Anchors and candidates are dealt to blocks, and each pair of blocks is one stream in one
task: the anchors first, then the candidates some thousands at a time, while every anchor
keeps its best few.  Two rounds are needed, since which negatives are hard depends on the
scores of an anchor's positives among all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .graph import fixed

ANCHORS = 4096  # held by a task
CANDIDATES = 1 << 20  # streamed by a task
PACKED = 4096  # in one wide integer
LONG = (1 << 63) - 1


class Packed:
    """Candidates (one row of integers each) packed for products with anchors of components from ``low`` to ``high``."""

    def __init__(self, rows: np.ndarray, low: int, high: int) -> None:
        self.count, self.size = rows.shape
        self.low, self.bias = low, int(rows.min(initial=0))
        span = (int(rows.max(initial=0)) - self.bias) * (high - low) * max(self.size, 1)
        self.bytes = next((n for n in (4, 8) if span < 1 << (8 * n)), -(-span.bit_length() // 8))
        most = max(abs(low), abs(high), 1) * max(abs(self.bias), int(rows.max(initial=0)), 1) * max(self.size, 1)
        self.narrow = self.bytes <= 8 and 4 * most <= LONG
        if self.narrow:
            raised = (rows - self.bias).astype(f"<u{self.bytes}")
            self.wide = [int.from_bytes(raised[:, j].tobytes(), "little") for j in range(self.size)]
            self.sums = rows.sum(axis=1) * low
        else:
            field = lambda x: (int(x) - self.bias).to_bytes(self.bytes, "little")
            self.wide = [int.from_bytes(b"".join(map(field, rows[:, j])), "little") for j in range(self.size)]
            self.sums = [sum(map(int, row)) * low for row in rows]

    def products(self, anchor: Sequence[int]) -> np.ndarray:
        """The product of an anchor with each candidate; what no long can hold stays at its limits."""
        total = sum(((a - self.low) * w for a, w in zip(anchor, self.wide)), 0).to_bytes(self.count * self.bytes, "little")
        back = self.bias * (sum(anchor) - self.size * self.low)
        if self.narrow:
            return np.frombuffer(total, f"<u{self.bytes}").astype(np.int64) + (self.sums + back)
        fields = (int.from_bytes(total[i:i + self.bytes], "little") for i in range(0, len(total), self.bytes))
        return np.array([min(max(f + s + back, -LONG - 1), LONG) for f, s in zip(fields, self.sums)], np.int64)


class Best:
    """The first ``most`` of what is offered, by score downwards and then by id."""

    def __init__(self, most: int) -> None:
        self.most, self.kept = most, []

    def offer(self, scores: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        if len(self.kept) == self.most and len(scores):
            better = scores >= self.kept[-1][0]
            scores, ids, copies = scores[better], ids[better], copies[better]
        if not len(scores):
            return
        if len(scores) > self.most:
            near = scores >= np.partition(scores, -self.most)[-self.most]
            scores, ids, copies = scores[near], ids[near], copies[near]
        for i in np.lexsort((ids, ~scores))[:self.most].tolist():  # ~ turns the order of longs round without overflow
            self.kept += [(int(scores[i]), int(ids[i]))] * min(int(copies[i]), self.most)
        self.kept = sorted(self.kept, key=lambda x: (-x[0], x[1]))[:self.most]


def _least(limit: int, low: int, high: int) -> int:
    """The smallest score n with low * limit <= high * n."""
    return -(-low * limit // high)


class _Group:
    """Anchors of one stream, and what they have found."""

    def __init__(self, most: int, low: int, high: int) -> None:
        self.most, self.low, self.high = most, low, high
        self.rows: dict[int, list] = {}  # by length: (row, label, limits, components)
        self.found: dict[tuple[int, int | None], Best] = {}
        self.spans: dict[int, tuple[int, int]] = {}

    def add(self, row: int, label: int, limits: list[int], vector: list[int]) -> None:
        self.rows.setdefault(len(vector), []).append((row, label, limits, vector))
        low, high = self.spans.get(len(vector), (0, 0))
        self.spans[len(vector)] = min([low, *vector]), max([high, *vector])

    def meet(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> None:
        if (size := vectors.shape[1]) not in self.rows:
            return
        packed = Packed(vectors, *self.spans[size])
        for row, label, limits, vector in self.rows[size]:
            scores = packed.products(vector)
            if limits is None:
                mine = np.flatnonzero(labels == label)
                left = copies[mine] - (rows[mine] == row)  # a row is not its own positive, but its copies are
                mine, left = mine[left > 0], left[left > 0]
                self._best(row, None).offer(scores[mine], ids[mine], left)
                continue
            near = np.flatnonzero((labels != label) & (scores <= max(limits)) & (scores >= min(_least(p, self.low, self.high) for p in limits)))
            for p in limits if len(near) else []:
                mine = near[(scores[near] <= p) & (scores[near] >= _least(p, self.low, self.high))]
                self._best(row, p).offer(scores[mine], ids[mine], copies[mine])

    def _best(self, row: int, limit: int | None) -> Best:
        return self.found.setdefault((row, limit), Best(self.most))

    def told(self) -> pa.RecordBatch:
        out = [(a, p, score, None if id_ == LONG else id_) for (a, p), best in self.found.items() for score, id_ in best.kept]
        kinds = [pa.int64()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)],
                                          names=["anchor", "limit", "score", "id"])


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _searched(rows: DataFrame, asked: DataFrame, counts: tuple[int, int], most: int, low: int, high: int) -> DataFrame:
    """(anchor, limit, score, id): the best rows each anchor met in each stream.

    ``asked`` are anchors (row, label, limits, v): without limits they look for rows of their
    own label, else for those of others with high * score from low * limit to high * limit.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-counts[1] // ANCHORS))
    blocks = max(1, -(-counts[0] // CANDIDATES), min(-(-counts[0] // PACKED), -(-width // parts)))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    anchors = asked.select(dealt(parts).alias("part"), numbers(blocks).alias("block"), F.lit(0).alias("side"), F.size("v").alias("size"),
                           "row", F.lit(None).cast("bigint").alias("id"), "label", F.lit(1).cast("bigint").alias("n"), "limits", "v")
    others = rows.select(numbers(parts).alias("part"), dealt(blocks).alias("block"), F.lit(1).alias("side"), F.size("v").alias("size"),
                         "row", "id", "label", "n", F.lit(None).cast("array<bigint>").alias("limits"), "v")
    group = ["part", "block", "side", "size"]
    stream = anchors.unionByName(others).repartition(max(width, parts * blocks), "part", "block").sortWithinPartitions(*group)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)
            edges = [0, *(np.flatnonzero((np.diff(marks, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(edges, edges[1:]):
                part, block, side, size = marks[start].tolist()
                if (part, block) != key:
                    if state is not None:
                        yield state.told()
                    key, state = (part, block), _Group(most, low, high)
                if side == 0:
                    mine = batch.slice(start, stop - start).select(["row", "label", "limits", "v"]).to_pylist()
                    for r in mine:
                        state.add(r["row"], r["label"], r["limits"], r["v"])
                    continue
                for at in range(start, stop, PACKED):
                    some = batch.slice(at, min(PACKED, stop - at))
                    numbers_ = [some.column(c).fill_null(LONG).to_numpy() for c in ("row", "id", "label", "n")]
                    state.meet(*numbers_, _vectors(some.column("v"), size))
        if state is not None:
            yield state.told()

    return stream.mapInArrow(search, "anchor bigint, limit bigint, score bigint, id bigint")


def hard_negatives(rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For every anchor and each of its best ``positives``, the best ``negatives`` that score nearly as high.

    Components are floor(``scale`` * x), x as double.  Positives are an anchor's highest
    scoring other rows of its label, negatives those rows of other labels with low *
    positive_score <= high * negative_score <= high * positive_score.  ``anchor`` is a
    condition on the columns of ``rows``, ``label`` one of them or an expression.  Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; ties
    go to the smaller id, null ids last.

    Rows with a null label or vector, or a component that is null, not finite or not so
    after scaling, take no part.  Vectors of another length are not compared; empty ones
    have the product 0.  Repeated rows are rows of their own, as anchors too.  An anchor
    without positives, and a positive without negatives, has no rows.  Components and
    scores beyond a long stay at its limits.  Other columns are ignored.
    """
    chosen = F.col(label) if isinstance(label, str) else label
    known = rows.select(F.col(key).cast("bigint").alias("id"), chosen.cast("bigint").alias("label"),
                        F.col(vector).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    scaled = known.withColumn("v", F.transform("v", lambda x: x * F.lit(float(scale))))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = scaled.filter(usable).withColumn("v", F.transform("v", lambda x: F.floor(x)))
    # Equal rows are one with a count, summed on the map side; written, so that row numbers stand.
    stored = fixed(whole.groupBy("id", "label", "v", "anchor").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("row", F.monotonically_increasing_id()), "negative-rows")
    counts = stored.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    asked = stored.filter("anchor")
    candidates = stored.select("row", "id", "label", "n", "v")

    first = lambda by: Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    met = _searched(candidates, asked.select("row", "label", F.lit(None).cast("array<bigint>").alias("limits"), "v"), counts, positives, low, high)
    best = met.withColumn("place", F.row_number().over(first(["anchor"]))).filter(F.col("place") <= positives)
    best = fixed(best.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("limit")), "positives")
    limits = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("limit").alias("limits"))  # as many as there are positives
    again = asked.join(limits, "row").select("row", "label", "limits", "v")
    met = _searched(candidates, again, counts, negatives, low, high)
    hard = met.withColumn("rank", F.row_number().over(first(["anchor", "limit"]))).filter(F.col("rank") <= negatives)
    hard = hard.select("anchor", "limit", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / PACKED)))
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "n", copies.alias("part"))
    names = names.withColumn("n", F.least(F.lit(PACKED), F.col("n") - F.col("part") * PACKED))
    told = best.join(hard, ["anchor", "limit"]).join(names, "anchor").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return told.select("anchor_id", "positive_id", "rank", "negative_id", F.col("limit").alias("positive_score"), "negative_score")

"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import forget_shuffles, remove, scratch_path


class Scratch:
    """Tables written to the shared folder on the way to a result, and removed when it no longer needs them."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._paths = spark, []

    def fixed(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again, which cuts its lineage."""
        path = scratch_path(self._spark, name)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.parquet(path)

    def clear(self) -> None:
        """Remove the tables; what was read from them must be written by now."""
        remove(self._spark, self._paths)
        forget_shuffles(self._spark)
        self._paths = []


def fixed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again; the table stays, for a result that reads it."""
    return Scratch(df.sparkSession).fixed(df, name)


def _rewired(links: DataFrame, both_ways: bool) -> DataFrame:
    """One step of the alternating star algorithm over links (a, b), a > b.

    Both ways (large star): every node links its larger neighbours to the smallest of its
    neighbours and itself.  One way (small star): every node links its smaller neighbours
    and itself to the smallest of them.  Minima are combined on the map side; the join back
    has an exchange on both sides, so that adaptive execution can split a node of very
    many links.
    """
    if both_ways:
        around = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    smallest = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(smallest.hint("rebalance"), "a")
    if both_ways:
        new = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            smallest.select("a", F.col("m").alias("b")))
    return new.filter(F.col("a") != F.col("b")).distinct()


def _unfinished(links: DataFrame) -> bool:
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("links"), F.lit(0).alias("linked")).unionAll(
        links.select(F.col("b").alias("x"), F.lit(0).alias("links"), F.lit(1).alias("linked")))
    nodes = ends.groupBy("x").agg(F.sum("links").alias("links"), F.max("linked").alias("linked"))
    return bool(nodes.filter((F.col("links") > 1) | (F.col("links") == 1) & (F.col("linked") == 1)).limit(1).count())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node it is linked to.

    Links may repeat and go either way; those of a node to itself count for nothing.  Large
    and small stars take turns until every node links to one other at most and none that is
    linked to links on; each state is written to the shared folder, so a lost executor costs
    one step.
    """
    steps = Scratch(links.sparkSession)
    now = steps.fixed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter(F.col("a") != F.col("b")).distinct(), "links")
    while _unfinished(now):
        before, steps = steps, Scratch(links.sparkSession)
        now = steps.fixed(_rewired(_rewired(now, True), False), "links")
        before.clear()
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def shared(rows: DataFrame) -> DataFrame:
    """The rows (k, node, ...) of the groups k with at least two different nodes, each once.

    A group is streamed by the window, in the order of the sort that the shuffle needs anyway.
    """
    group = Window.partitionBy("k")
    ends = rows.withColumns({"_lo": F.min("node").over(group), "_hi": F.max("node").over(group)})
    return ends.filter("_lo < _hi").drop("_lo", "_hi").distinct()


def ranked(rows: DataFrame, steps: Scratch) -> DataFrame:
    """The rows (k, node), each given once, of groups of two and more, with their ``rank`` in the group and its first node, ``lead``.

    The node that meets others under most keys comes first.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy("k"))
    rows = steps.fixed(rows.withColumn("_size", size).filter("_size > 1").select("k", "node"), "groups")
    meets = rows.groupBy("node").agg(F.count(F.lit(1)).alias("_meets"))
    order = Window.partitionBy("k").orderBy(F.desc("_meets"), "node")
    return rows.join(meets, "node").select("k", "node", F.row_number().over(order).alias("rank"), F.first("node").over(order).alias("lead"))

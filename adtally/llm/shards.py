"""Sharding by rendezvous hashing: a record goes to the shard that scores highest for its key.

The score of a shard depends on the key, the shard's number and its weight alone, so with
one shard more only those records move that the new shard wins, about its share of all.
Only Spark expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNKS = 64


def best_shard(keys: Sequence[Column], shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard (int, from 0) of a record with these keys; null keys hash alike.

    A uniform u in (0, 1) is drawn from each (keys, shard); the largest ln(u) / weight
    wins, which gives each shard records in proportion to its weight.  Equal scores go to
    the larger shard number.
    """
    if shards < 1 or (weights is not None and (len(weights) != shards or min(weights) <= 0)):
        raise ValueError("give one shard at least, and a positive weight for each or none")

    def scored(shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*keys, shard), 11)
        score = F.log((bits + 0.5) / F.lit(float(1 << 53)))
        if weights is not None:
            score = score / F.array(*[F.lit(float(w)) for w in weights])[shard]
        return F.struct(score.alias("score"), shard.alias("shard"))

    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), scored))["shard"]


def assign(rows: DataFrame, key: str, shards: int, weights: Sequence[float] | None = None,
           column: str = "shard") -> DataFrame:
    """``rows`` with their shard in ``column``, which replaces a column of that name.

    No shuffle.  Equal keys, null among them, share a shard; no rows give no rows.
    """
    return rows.withColumn(column, best_shard([F.col(key)], shards, weights))


def numbered(rows: DataFrame, shard: str, order: Sequence[str], slot: str = "slot", chunks: int = CHUNKS) -> DataFrame:
    """``rows`` with a gapless number from 0 within their shard.

    Equal rows are counted first and numbered together, and a shard is numbered in
    ``chunks`` by a hash of ``order``, each from the sum of those before it: neither a large
    shard nor a row with very many copies is sorted in one task.  ``rows`` should be narrow.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_chunk", F.pmod(F.xxhash64(*[F.col(c) for c in order], F.lit("chunk")), F.lit(chunks)))
    totals = counted.groupBy(shard, "_chunk").agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(shard).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(shard, "_chunk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"))
    within = (Window.partitionBy(shard, "_chunk").orderBy(*order, *[c for c in names if c not in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("_start") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    placed = counted.join(starts, [shard, "_chunk"]).withColumn("_first", first)
    return placed.select(*names, F.explode(F.expr("sequence(_first, _first + _n - 1)")).alias(slot))


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                    weights: Sequence[float] | None = None, weights_grown: Sequence[float] | None = None) -> DataFrame:
    """Shard, slot and size of every document, and its shard if there were one more.

    Returns key, size (UTF-8 bytes and 16), text_crc32, law, shard, slot, grown_shard.  A
    null text has no bytes; empty texts, repeated rows and null keys are documents like
    others.  Other columns are ignored.
    """
    narrow = docs.select(
        F.col(key), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    keys = [F.col(key)]
    placed = narrow.withColumns({"law": F.lit("key"), "shard": best_shard(keys, shards, weights),
                                 "grown_shard": best_shard(keys, shards + 1, weights_grown)})
    return numbered(placed, "shard", [key, "size", "text_crc32"]).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")

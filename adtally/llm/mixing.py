"""Mixing sources to target weights by Sainte-Lague apportionment of equal-word blocks.

Targets in words are set per source.  Blocks of the same number of words are dealt to the
sources by highest quotients target / (2k + 1), and each source's blocks in the same way to
its shards, which hold its documents in a seeded order.  In a shard of B blocks with quota
q, block b is taken floor(((b + 1) q + o) / B) - floor((b q + o) / B) times with a seeded
offset o: exactly q in all, evenly spread, and none more than c times while q <= c B.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.common import salted_join
from .graph import fixed

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 256
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 18
CAP = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: ``share`` of all words by weight.

    Sources take the weights in turn, in code point order, null last.  No target is over
    ``cap`` times its source; the excess goes to the others by weight.  Sources are ordered
    by the level at which they fill up; those below the common level are full.  One row per
    source: the windows see no documents.
    """
    everything = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int")))
    full = F.col("source_size") * F.lit(float(cap))
    rows = rows.withColumns({"full": full, "level": full / F.col("weight"),
                             "wanted": F.sum("source_size").over(everything) * F.lit(float(share))})
    by_level = everything.orderBy("level", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("capped", F.col("level") <= (F.col("wanted") - before) / left)
    rest = F.col("wanted") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("full"))).over(everything), F.lit(0.0))
    open_ = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    return rows.select(*sizes.columns, F.when(F.col("capped"), F.col("full"))
                       .otherwise(rest / open_ * F.col("weight")).alias("target"))


def sainte_lague(rows: DataFrame, within: Sequence[str], order: Sequence[str], weight: str, seats: str,
                 quota: str) -> DataFrame:
    """Deal ``seats`` (one number per ``within`` group) to the rows by highest quotients.

    The quotients of a row are weight / 1, weight / 3, weight / 5 ...; ties go by ``order``.
    A divisor that surely gives too few seats fixes what every row has for certain, one that
    surely gives too many bounds it, and only the quotients between them, about two per
    row, are ranked.  Rows without weight get none.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    total, n = F.sum(weight).over(group), F.count(F.lit(1)).over(group)
    rows = rows.withColumns({"_total": total, "_n": n})
    rounded = lambda seat_count: F.floor(F.when(F.col("_total") > 0, F.col(weight) * seat_count / F.col("_total")).otherwise(0) + 0.5)
    sure = F.greatest(F.lit(0), rounded(F.greatest(F.col(seats) - F.col("_n") / 2.0 - 1, F.lit(0.0))))
    rows = rows.withColumn("_sure", F.when(F.col(weight) > 0, sure).otherwise(0).cast("bigint"))
    most = F.when(F.col(weight) > 0, rounded(F.col(seats) + F.col("_n") / 2.0 + 1)).otherwise(0).cast("bigint")
    rows = rows.withColumns({"_most": F.greatest(most, F.col("_sure")), "_left": F.col(seats) - F.sum("_sure").over(group)})
    open_ = F.when(F.col("_most") > F.col("_sure"), F.sequence("_sure", F.col("_most") - 1)).otherwise(F.array().cast("array<bigint>"))
    bids = rows.select(*within, *order, F.col(weight).alias("_w"), "_left", F.explode(open_).alias("_k"))
    bids = bids.withColumn("_q", F.col("_w") / (2 * F.col("_k") + 1))
    rank = F.row_number().over(group.orderBy(F.desc("_q"), *[F.col(c).asc_nulls_last() for c in order]))
    won = (bids.withColumn("_r", rank).filter(F.col("_r") <= F.col("_left")).groupBy(*within, *order)
           .agg(F.count(F.lit(1)).alias("_won")))
    keys = list(dict.fromkeys([*within, *order]))
    return (rows.join(won, keys, "left").withColumn(quota, F.col("_sure") + F.coalesce("_won", F.lit(0)))
            .drop("_total", "_n", "_sure", "_most", "_left", "_won"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = CAP, key: str = "doc_id",
        text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        shard_rows: int = SHARD_ROWS, seed: int = 7, carry: bool = False) -> DataFrame:
    """What the mix takes of every document.

    Returns key, size (words), source, source_size, target (of its source, in words), taken
    (words, repeats counted) and ``blocks``: the parts taken, as array<struct<start, stop,
    copies>> in words of the document.  ``carry`` adds the document as struct ``row``.

    Blocks have ``block_words`` words, or a 200th of the smallest positive target if that
    is less, so that rounding to whole blocks stays small for each source.  The order in a
    shard, and so the choice, comes from hashes of seed and key; ties go by size, and rows
    that repeat a key are documents of their own.  A null text has no words and is
    taken 0 times; a null source is a source.  No rows give no rows.
    """
    if len(weights) < 1 or min(weights) <= 0 or share > cap:
        raise ValueError("weights must be positive, and share at most cap")
    name = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null"))  # joins null, too
    columns = [F.col(key).alias("key"), F.col(source).alias("source"), name.alias("name"), word_count(F.col(text)).alias("size"),
               F.xxhash64(F.col(text)).alias("print")]
    rows = fixed(docs.select(*columns), "mix-sizes")
    sums = rows.groupBy("name", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.coalesce(F.floor(smallest / 200), F.lit(1)))).cast("bigint")
    plan = targets(sums, weights, share, cap).withColumn("block", block)
    plan = plan.withColumns({
        "all_seats": F.round(F.sum("target").over(everything) / F.col("block")).cast("bigint"),
        "shards": F.greatest(F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("n") / shard_rows)).cast("bigint")})
    plan = sainte_lague(plan, [], ["name"], "target", "all_seats", "seats")
    # Written, so that Spark knows its size: a short list is broadcast, else a large source is dealt to several tasks.
    plan = fixed(plan.select("name", "source_size", "target", "block", "shards", "seats"), "mix-plan")
    spread = lambda df: salted_join(df, plan, ["name"], "inner").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "key", "print"), "shards"))

    rows = spread(rows)
    shards = (rows.groupBy("name", "shard").agg(F.sum("size").alias("words"), F.first("block").alias("block"),
                                                 F.first("seats").alias("seats")))
    shards = sainte_lague(shards, ["name"], ["shard"], "words", "seats", "quota")
    n_blocks = F.ceil(F.col("words") / F.col("block")).cast("bigint")
    shards = shards.select("name", "shard", n_blocks.alias("n_blocks"), F.least("quota", cap * n_blocks).alias("quota"),
                           F.pmod(F.xxhash64(F.lit(seed), "name", "shard"), F.greatest(n_blocks, F.lit(1))).alias("offset"))
    inside = (Window.partitionBy("name", "shard").orderBy(F.xxhash64("key", "print", F.lit(seed)), "key", "size", "print")
              .rowsBetween(Window.unboundedPreceding, -1))
    if carry:
        rows = spread(docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    # Dealt by shard: else the exchange of the join by source would do, with a large source in one task.
    rows = rows.repartition("name", "shard")
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(shards, ["name", "shard"])

    upto = lambda b: F.floor((b * F.col("quota") + F.col("offset")) / F.col("n_blocks"))
    size, block, start = F.col("size"), F.col("block"), F.col("start")
    part = lambda b: F.struct(F.greatest(b * block - start, F.lit(0)).alias("start"),
                              F.least((b + 1) * block - start, size).alias("stop"), (upto(b + 1) - upto(b)).alias("copies"))
    numbers = F.sequence(F.floor(start / block), F.floor((start + size - 1) / block))
    parts = F.when(size > 0, F.filter(F.transform(numbers, part), lambda p: p["copies"] > 0)).otherwise(
        F.array().cast("array<struct<start:bigint,stop:bigint,copies:bigint>>"))
    rows = rows.withColumn("blocks", parts)
    taken = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda a, p: a + (p["stop"] - p["start"]) * p["copies"])
    return rows.select(F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target",
                       taken.alias("taken"), "blocks", *(["row"] if carry else []))


def taken_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", **settings) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row per document and pass that takes some of it.

    The first pass has the blocks taken at all, the second those taken twice, and so on up to ``cap``.  A text taken
    whole is left as it is; else it is the taken words with the white space between them,
    blocks that do not touch being put apart by a line feed.  ``chars`` is counted anew.
    """
    rows = mix(docs, key=key, text=text, carry=True, **settings)
    passes = rows.select("row", "size", "blocks", F.explode(F.sequence(F.lit(1), F.lit(int(settings.get("cap", CAP))))).alias("pass"))
    passes = passes.withColumn("blocks", F.filter("blocks", lambda b: b["copies"] >= F.col("pass"))).filter(F.size("blocks") > 0)
    names = docs.columns
    flat = passes.select(*[F.col("row")[c].alias(c) for c in names], "size", F.col("blocks.start").alias("starts"),
                         F.col("blocks.stop").alias("stops"))
    whole = F.aggregate(F.zip_with("stops", "starts", lambda a, b: a - b), F.lit(0).cast("bigint"), lambda t, x: t + x) == F.col("size")
    # Every word with the white space before it, so that a run of words is a run of pieces.
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    spans = F.zip_with("starts", "stops", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    runs = F.aggregate(spans, F.array().cast("array<struct<a:bigint,b:bigint>>"), lambda t, s: F.when(
        F.try_element_at(t, F.lit(-1))["b"] == s["a"], F.concat(F.slice(t, 1, F.size(t) - 1), F.array(F.struct(
            F.try_element_at(t, F.lit(-1))["a"].alias("a"), s["b"].alias("b"))))).otherwise(F.concat(t, F.array(s))))
    flat = flat.withColumns({"_p": F.when(~whole, pieces), "_r": F.when(~whole, runs)})
    cut = F.array_join(F.transform("_r", lambda r: F.ltrim(F.array_join(F.slice(F.col("_p"), (r["a"] + 1).cast("int"), (r["b"] - r["a"]).cast("int")), ""))), "\n")
    done = F.when(whole, F.col(text)).otherwise(cut)
    kind = docs.schema[chars].dataType if chars in names else None
    return flat.withColumn("_t", done).select(*[
        F.col("_t").alias(c) if c == text else F.length("_t").cast(kind).alias(c) if c == chars else F.col(c) for c in names])

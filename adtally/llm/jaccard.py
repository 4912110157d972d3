"""Exact set similarity join of documents on word shingles, by partitions of the universe.

Two sets of sizes s <= t with 100 * intersection >= 85 * union differ in at most
H = 3 (s + t) / 37 shingles.  Sizes fall into bands such that a partner is in the same band
or the next; each band has a grid for pairs whose smaller set is in it.  A grid hashes the
universe of shingles into m segments.  By the pigeonhole principle similar sets agree in
a segment if m > H, or nearly agree (one shingle more or less) if 2 m > H; so records
that share the key of a segment's subset, or of such a subset with one shingle deleted,
are the candidates, and all of them are verified on the full sets.

The cost of both ways is estimated for each grid from the number of records in it, and
from how often segments are small, since small subsets are shared by chance.  A record
leaves out its small segments while enough others remain for the principle to hold; m
is chosen such that nearly all records can.

Records are sets, not documents: documents with equal sets, by a 128-bit fingerprint, are one record.  In a
key group, the member that meets most others, over all its keys, is paired with the rest
first.  Groups whose members then still lie in several components are compared in full,
block by block, on parity sketches: each shingle flips one bit, so two sets whose sketches
differ in more than H bits are not similar, and only the other pairs are verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.common import salted_join
from .graph import Scratch, components, fixed, shared
from .words import SPACED, Hasher, mixed, shingles

WORDS = 4
BLOCK = 4096  # members of a group compared by one task
COMMON = 0.1  # share of a document taken to stand in many others, for the cost of chance candidates
SEEN = 1 << 18


class Rule(NamedTuple):
    """Similar: whole * intersection >= part ... of the union, as 100 * i >= least * u."""

    words: int = WORDS
    least: int = 85

    def floor(self, band: int) -> int:
        """The smallest size in a band."""
        return _floors(self.least)[band]

    def band(self, size: int) -> int:
        return int(np.searchsorted(_floors(self.least), size, side="right")) - 1

    def largest_difference(self, band: int) -> int:
        """H for pairs whose smaller set is in the band."""
        small = self.floor(band + 1) - 1
        large = small * 100 // self.least
        return (100 - self.least) * (small + large) // (100 + self.least)


def _floors(least: int, _kept: dict = {}) -> list[int]:  # noqa: B006  filled once per rule
    if least not in _kept:
        sizes = [1]
        while sizes[-1] < 1 << 40:
            sizes.append(sizes[-1] * 100 // least + 1)
        _kept[least] = sizes
    return _kept[least]


class Grid(NamedTuple):
    segments: int
    deletions: bool
    small: int  # segments with fewer shingles are small
    slack: int  # a record leaves its small segments out if it has no more than so many


def _poisson(mean: float, k: int) -> float:
    return math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else float(k == 0)


def allocate(rule: Rule, band: int, records: int) -> Grid:
    """The cheapest grid for a band that ``records`` sets use."""
    size, need = rule.floor(band), rule.largest_difference(band) + 1
    best = None
    for deletions in (False, True):
        least = -(-need // 2) if deletions else need
        for small in (0, 2, 3, 4):
            slack = 0
            for _ in range(20):  # more segments are smaller, so both are settled step by step
                share = sum(_poisson(size / (least + slack), k) for k in range(small))
                mean = (least + slack) * share
                wanted = math.ceil(mean + 4 * math.sqrt(mean * (1 - share))) if small else 0
                if wanted <= slack:
                    break
                slack = wanted
            else:
                continue
            segments = least + slack
            mean = size / segments
            keys = (size if deletions else 0) + segments * (1 - sum(_poisson(mean, k) for k in range(small)))
            low = max(small - 1, 0) if deletions else small
            # A subset of k shingles meets an unrelated one if all of them stand in many documents.
            chance = sum(_poisson(mean, k) * COMMON ** (2 * max(k - deletions, 0)) * (1 + k * deletions) for k in range(low, low + 12))
            cost = keys + records * segments * chance * 0.01
            if best is None or cost < best[0]:
                best = (cost, Grid(segments, deletions, small, slack))
    return best[1]


def segment_keys(tokens: np.ndarray, grid: Grid, number: int) -> np.ndarray:
    """The keys of a set (distinct 64-bit shingles) in a grid."""
    salt = mixed(np.array([number], np.uint64) + np.uint64(0xD1B54A32D192ED03))[0]
    spread = mixed(tokens ^ salt)
    part = (spread % np.uint64(grid.segments)).astype(np.int64)
    value = mixed(spread)
    sums, counts = np.zeros(grid.segments, np.uint64), np.bincount(part, minlength=grid.segments)
    np.add.at(sums, part, value)
    own = mixed(np.arange(grid.segments, dtype=np.uint64) + salt)
    low = max(grid.small - 1, 0) if grid.deletions else grid.small
    if (counts < grid.small).sum() > grid.slack:
        low = 0
    used = counts >= low
    keys = mixed(sums[used] + own[used])
    if grid.deletions:
        mine = used[part]
        keys = np.concatenate([keys, mixed(sums[part[mine]] - value[mine] + own[part[mine]])])
    return keys


def shingle_set(hasher: Hasher, text: str | None, words: int) -> np.ndarray:
    return np.unique(shingles(hasher.text(text, SPACED), words))


def fingerprints(tokens: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums over a set."""
    with np.errstate(over="ignore"):
        a = mixed(tokens).sum(dtype=np.uint64)
        b = mixed(tokens ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """The rows (text, ...) with n, fp and fp2 (size and fingerprints of their set) in place of the text."""
    rest = [c for c in docs.columns if c != "text"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            n, fp, fp2 = [], [], []
            for text in batch.column("text"):
                s = shingle_set(hasher, text.as_py(), rule.words)
                a, b = fingerprints(s)
                n.append(len(s))
                fp.append(a)
                fp2.append(b)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *[pa.array(x, pa.int64()) for x in (n, fp, fp2)]],
                                             names=[*rest, "n", "fp", "fp2"])

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in rest)
    return docs.mapInArrow(measure, f"{kinds}n bigint, fp bigint, fp2 bigint")


def _distinct(docs: DataFrame, rule: Rule) -> DataFrame:
    """(fp, fp2, n, text) of every set that is not empty, once.  Copies that one task sees are left out before the shuffle."""
    def first_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            kept, rows = [], []
            for i, text in enumerate(batch.column(0)):
                s = shingle_set(hasher, text.as_py(), rule.words)
                mark = fingerprints(s)
                if len(s) and mark not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(mark)
                    kept.append(i)
                    rows.append((*mark, len(s)))
            numbers = [pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [[]] * 3)]
            yield pa.RecordBatch.from_arrays([*numbers, batch.column(0).take(pa.array(kept, pa.int64()))], names=["fp", "fp2", "n", "text"])

    met = docs.select("text").mapInArrow(first_met, "fp bigint, fp2 bigint, n bigint, text string")
    return met.groupBy("fp", "fp2").agg(F.min("n").alias("n"), F.min("text").alias("text"))


def _keys(sets: DataFrame, rule: Rule, grids: Mapping[int, Grid]) -> DataFrame:
    """(k, node, n) for every key of every set (node, text)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            found, sizes, rows, start = [], [], [], 0
            for i in range(batch.num_rows):
                s = shingle_set(hasher, batch.column(1)[i].as_py(), rule.words)
                band = rule.band(len(s))
                found.append(np.concatenate([segment_keys(s, grids[g], g) for g in (band, band - 1) if g in grids]))
                sizes.append(len(s))
                rows.append(len(found[-1]))
                if sum(rows) >= 1 << 19 or i == batch.num_rows - 1:
                    nodes = batch.column(0).to_numpy()[start:i + 1]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(nodes, rows)),
                                                      pa.array(np.repeat(np.array(sizes, np.int64), rows))], names=["k", "node", "n"])
                    found, sizes, rows, start = [], [], [], i + 1

    return sets.select("node", "text").mapInArrow(emit, "k bigint, node bigint, n bigint")


def sketch(tokens: np.ndarray, rule: Rule) -> bytes:
    """A parity bit for each of some buckets of shingles, 16 to 32 times as many as H, a power of two."""
    words = max(1, rule.largest_difference(rule.band(len(tokens))) // 4)
    bits = 64 << (words - 1).bit_length()
    return np.packbits(np.bincount((mixed(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def _contents(sets: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """(node, tokens, bits) of the sets (node, text) that are ``wanted`` (node)."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                found = [shingle_set(hasher, text.as_py(), rule.words) for text in batch.column(1)[i:i + 200]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:i + 200], pa.array([s.tobytes() for s in found], pa.binary()),
                                                  pa.array([sketch(s, rule) for s in found], pa.binary())], names=["node", "tokens", "bits"])

    return sets.join(wanted, "node", "left_semi").select("node", "text").mapInArrow(fetch, "node bigint, tokens binary, bits binary")


def near_pairs(names: np.ndarray, sizes: np.ndarray, labels: np.ndarray, blocks: np.ndarray, bits: list[bytes],
               rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels that sizes and sketches allow to be similar; of two blocks, one member of each."""
    width = min(map(len, bits))
    rows = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in bits]  # buckets of a wider sketch fold onto a narrower
    table = np.array([np.bitwise_xor.reduce(x, axis=0) for x in rows])
    table = table.view(np.uint64)
    one, two = [], []
    first, second = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
    for at in range(0, len(first), 32):
        part = first[at:at + 32]
        differ = np.bitwise_count(table[part, None] ^ table[None, second]).sum(axis=2, dtype=np.int64)
        total = sizes[part, None] + sizes[None, second]
        close = differ * (100 + rule.least) <= (100 - rule.least) * total
        close &= np.maximum(sizes[part, None], sizes[None, second]) * rule.least <= np.minimum(sizes[part, None], sizes[None, second]) * 100
        close &= labels[part, None] != labels[None, second]
        i, j = np.nonzero(close)
        a, b = names[part[i]], names[second[j]]
        one.append(np.minimum(a, b))
        two.append(np.maximum(a, b))
    return np.concatenate(one), np.concatenate(two)


def _compared(led: DataFrame, labels: DataFrame, contents: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b), as :func:`near_pairs` allows them, of groups whose members lie in several components.

    Groups are (k, node, n, lead); the lead has been verified with all others and is left
    out.  A task streams sorted blocks and holds two of one group at most.
    """
    state = led.filter("node != lead").join(labels, "node", "left").withColumn("c", F.coalesce("component", "node")).select("k", "node", "n", "c")
    open_ = state.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo < hi")
    rows = state.join(open_.select("k", "size"), "k")
    place = (F.row_number().over(Window.partitionBy("k").orderBy("node")) - 1) / BLOCK
    rows = rows.withColumn("block", F.floor(place)).join(contents.select("node", "bits"), "node")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / BLOCK))))
    group = ["k", "low", "high"]
    rows = rows.select("k", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "n", "c", "block", "bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[list]) -> tuple[np.ndarray, np.ndarray]:
            a, b = near_pairs(*[np.concatenate(x) for x in list(zip(*parts))[:4]], [y for x in parts for y in x[4]], rule)
            return a[a != b], b[a != b]

        open_parts, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = [batch.column(i).to_numpy() for i in range(7)]
            bits, out = batch.column(7).to_pylist(), []
            change = (np.diff(table[0]) != 0) | (np.diff(table[1]) != 0) | (np.diff(table[2]) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for start, stop in zip(edges, edges[1:]):
                mine = tuple(int(table[i][start]) for i in range(3))
                if mine != key and open_parts:
                    out.append(found(open_parts))
                    open_parts = []
                key = mine
                open_parts.append([*[table[i][start:stop] for i in range(3, 7)], bits[start:stop]])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["a", "b"])
        if open_parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found(open_parts)], names=["a", "b"])

    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, contents: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) that are similar, each set taken whole."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, last, left = [], None, None
            for i in range(batch.num_rows):
                if (a := batch.column(0)[i].as_py()) != last:
                    last, left = a, np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                right = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                both = int((left[at] == right).sum())
                if 100 * both >= rule.least * (len(left) + len(right) - both):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    one = contents.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    two = contents.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint")


def _components(narrow: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The rows (text, ...) as :func:`_sets` has them, and (fp, fp2, component) of the sets that are not empty.

    A set goes by the number under which it was written, so no two are taken for one.
    """
    steps = Scratch(narrow.sparkSession)
    rows = fixed(_sets(narrow, rule), "shingle-sets")
    sets = steps.fixed(_distinct(narrow, rule).withColumn("node", F.monotonically_increasing_id()), "shingle-texts")
    names = fixed(sets.select("node", "fp", "fp2"), "shingle-names")
    band = F.expr(f"CAST({_band_sql(rule, 'n')} AS INT)").alias("band")
    bands = {r["band"]: r["count"] for r in sets.groupBy(band).count().collect()}  # some 150 at most
    grids = {b: allocate(rule, b, bands.get(b, 0) + bands.get(b + 1, 0)) for b in {*bands, *(b - 1 for b in bands)} if b >= 0}

    members = steps.fixed(shared(_keys(sets, rule, grids)), "shingle-members")
    meets = members.groupBy("node").agg(F.count(F.lit(1)).alias("meets"))
    contents = steps.fixed(_contents(sets, rule, meets.select("node")), "shingle-contents")

    # First each group's best-met member with the others.
    by_meets = Window.partitionBy("k").orderBy(F.desc("meets"), "node")
    led = members.join(meets, "node").select("k", "node", "n", F.first("node").over(by_meets).alias("lead"), F.first("n").over(by_meets).alias("lead_n"))
    led = steps.fixed(led, "shingle-groups")
    near = F.greatest("n", "lead_n") * rule.least <= F.least("n", "lead_n") * 100
    pairs = led.filter((F.col("node") != F.col("lead")) & near).select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    links = steps.fixed(_verified(pairs, contents, rule), "shingle-links")
    labels = components(links)
    more = steps.fixed(_verified(_compared(led, labels, contents, rule), contents, rule), "shingle-links")
    labels = components(links.unionAll(more))
    steps.clear()
    return rows, names.join(labels, "node", "left").select("fp", "fp2", F.coalesce("component", "node").alias("component"))


def _band_sql(rule: Rule, size: str) -> str:
    """The number of the band of a size from 1 on."""
    floors = ", ".join(f"{x}L" for x in _floors(rule.least))
    return f"size(filter(array({floors}), x -> x <= {size})) - 1"


def linked_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Per document: key, n_shingles, component_id (smallest key reachable by links, or its own).

    A document's set holds its distinct shingles of ``rule.words`` words (lower-cased A-Z,
    split at white space); fewer words are one shingle.  Documents link when 100 *
    intersection >= least * union.  Without words or text a document has no shingles and
    links with nothing.  Repeated keys are one document for linking, with a row for each of
    its rows; rows with a null key have no component of their own and get the smallest key
    they are equal or linked to, if any.  Other columns are ignored.
    """
    narrow = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    rows, labels = _components(narrow, rule)
    named = rows.filter("n > 0").join(labels, ["fp", "fp2"]).select("key", "n", "component")
    least = named.groupBy("component").agg(F.min("key").alias("least"))
    placed = salted_join(named, least, ["component"]).select("key", "n", "least")
    alone = rows.filter("n = 0").select("key", "n", F.col("key").alias("least"))
    return placed.unionAll(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """The documents without near duplicates: of each component of :func:`linked_documents` one row stays.

    It is the row of the smallest key, a null key being the largest; of several, that of the
    smallest hash of all values.  Rows without words or text link with nothing and all
    stay.  Rows are told apart by two hashes of all their columns, which alone go through the
    search; whole rows are fetched by them in the end, and of equal rows one.
    """
    values = [F.col(f"`{c}`") for c in docs.columns]
    values += [F.isnull(v) for v in values]  # the hash passes over nulls
    marks = {"_m1": F.xxhash64(*values), "_m2": F.xxhash64(F.lit("again"), *values)}
    worded = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    narrow = docs.filter(worded).withColumns(marks).select(
        F.col(key).cast("bigint").alias("key"), "_m1", "_m2", F.col(text).cast("string").alias("text"))
    rows, labels = _components(narrow, rule)
    counted = (rows.join(labels, ["fp", "fp2"]).groupBy("component", "key", "_m1", "_m2").agg(F.count(F.lit(1)).alias("copies")))
    best = counted.groupBy("component").agg(F.min(F.struct(F.isnull("key"), "key", "_m1", "_m2", "copies")).alias("best"))
    best = fixed(best.select("best._m1", "best._m2", "best.copies"), "shingle-kept")
    whole = docs.filter(worded).withColumns(marks)
    once = whole.join(best.filter("copies = 1").drop("copies"), ["_m1", "_m2"], "left_semi").select(docs.columns)
    again = whole.join(best.filter("copies > 1").drop("copies"), ["_m1", "_m2"], "left_semi")
    # Equal rows are reduced where they are before one of them is shuffled.
    again = again.groupBy(F.struct("_m1", "_m2")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row")).select("_row.*")
    return once.unionAll(again).unionAll(docs.filter(~worded))

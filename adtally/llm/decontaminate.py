"""Benchmark decontamination by Wu-Manber search for many word windows at once.

The strings searched for are the windows of the test items, over words as symbols.  For
windows of one length a shift table says, for the hash of each block of words, how far the
search may move on without missing a window; where it says 0, the windows that end in this
block are found in a bucket by the hash of that suffix and compared word by word.  Many
positions are searched side by side, one in each short lane of the text, as numpy arrays.

Documents are neither shuffled nor grouped.  The tables of a slice of the benchmark, whose
size is bounded by ``slice_windows``, go to the tasks with the function.  For a larger
benchmark the documents are read once per slice; the few rows with hits are written, known
by two hashes of their columns, and put together when all slices are done, so neither the
driver nor a task ever holds more than a slice.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import fixed
from .passages import merged
from .words import ALNUM, pieces

WINDOW = 13
# A word, after lower-casing A-Z.
WORD = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_WINDOWS = 1 << 20
LANE = 256
GROUP_CHARS = 1 << 22
_BITS = 18


class Searcher:
    """All occurrences of windows of one length in a sequence of word numbers.

    Word numbers are 0 for a word in no window and positive otherwise.
    """

    def __init__(self, windows: np.ndarray) -> None:
        self.windows = windows
        self.width = windows.shape[1]
        self.block = min(2, self.width)
        self.reach = self.width - self.block + 1
        self.shift = np.full(1 << _BITS, self.reach, np.int32)
        for end in range(self.block, self.width + 1):  # a later block leaves a smaller shift
            self.shift[self._hash(windows[:, end - self.block:end])] = self.width - end
        suffix = self._hash(windows[:, -self.block:])
        self.order = np.argsort(suffix, kind="stable")
        sorted_ = suffix[self.order]
        self.first = np.searchsorted(sorted_, np.arange(1 << _BITS))
        self.last = np.searchsorted(sorted_, np.arange(1 << _BITS), side="right")

    def _hash(self, block: np.ndarray) -> np.ndarray:
        value = np.zeros(len(block), np.uint64)
        for i in range(self.block):
            value = value * np.uint64(0x9E3779B97F4A7C15) + block[:, i].astype(np.uint64)
        return ((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start positions and window numbers of all occurrences."""
        n = len(words)
        starts, numbers = [], []
        if n < self.width:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # Position: where a window would end (exclusive).  A lane owns LANE of them.
        at = np.arange(self.width, n + 1, LANE)
        stop = np.minimum(at + LANE, n + 1)
        back = np.arange(-self.block, 0)
        while len(at):
            key = self._hash(words[at[:, None] + back])
            shift = self.shift[key]
            hit = shift == 0
            if hit.any():
                ends, bucket = at[hit], key[hit]
                low, size = self.first[bucket], self.last[bucket] - self.first[bucket]
                for k in range(int(size.max())):
                    ends, low, size = ends[size > k], low[size > k], size[size > k]
                    window = self.order[low + k]
                    same = np.ones(len(ends), bool)
                    for j in range(self.width):  # compare, dropping out as soon as a word differs
                        live = np.flatnonzero(same)
                        if not len(live):
                            break
                        same[live] = words[ends[live] - self.width + j] == self.windows[window[live], j]
                    starts.append(ends[same] - self.width)
                    numbers.append(window[same])
            at = at + np.maximum(shift, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(numbers)


class Benchmark:
    """The search tables of some items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for p in pieces(text or "", ALNUM) for w in p]
            size = min(width, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                own = owners.setdefault(size, {}).setdefault(tuple(words[i:i + size]), set())
                if item is not None:
                    own.add(item)
        self.searchers = [(Searcher(np.array(sorted(w), np.int64).reshape(len(w), size)), [sorted(w[k]) for k in sorted(w)])
                          for size, w in sorted(owners.items())]

    def numbered(self, text: str | None) -> np.ndarray:
        found = [np.fromiter(map(self.numbers.get, p, [0] * len(p)), np.int64, len(p)) for p in pieces(text or "", ALNUM)]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def search(self, words: np.ndarray, first: np.ndarray, change: np.ndarray, items: list[set[str]]) -> None:
        """Search several documents laid end to end with a 0 behind each.

        ``first`` has their first positions.  Hits are added to ``change`` (+1 where a window
        starts, -1 behind it), item ids to the documents' ``items``.
        """
        for searcher, owners in self.searchers:
            starts, numbers = searcher.find(words)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + searcher.width, -1)
            at = np.searchsorted(first, starts, side="right") - 1
            for d, k in np.unique(np.stack([at, numbers], 1), axis=0).tolist():
                items[d].update(owners[k])


def _slices(benchmark: DataFrame, item: str, text: str, width: int, slice_windows: int) -> Iterator[Benchmark]:
    """Search tables for some ``slice_windows`` words each, one after the other; items are dealt by their hash."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")).distinct()
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    words = F.sum(F.regexp_count(lowered, F.lit(WORD))).alias("words")
    total = rows.agg(words).first()["words"] or 0
    count = max(1, -(-total // slice_windows))
    for number in range(count):
        mine = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number)
        yield Benchmark(sorted((tuple(r) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1] or "")), width)


def _judged(texts: list[str | None], table: Benchmark) -> tuple[list[int], np.ndarray, np.ndarray, list[set[str]]]:
    """(words of each text, first places, whether each place is hit, items of each text); texts lie end to end, a place apart."""
    numbered = [table.numbered(x) for x in texts]
    counts = np.array([len(w) for w in numbered])
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    change, items = np.zeros(first[-1] + 1, np.int64), [set() for _ in texts]
    table.search(np.concatenate([x for w in numbered for x in (w, np.zeros(1, np.int64))]), first[:-1], change, items)
    return counts.tolist(), first, np.cumsum(change[:-1]) > 0, items


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) for some texts at a time."""
    start = 0
    while start < len(column):
        texts, size = [], 0
        while start + len(texts) < len(column) and (not texts or size < GROUP_CHARS):
            texts.append(column[start + len(texts)].as_py())
            size += len(texts[-1] or "")
        yield start, texts
        start += len(texts)


_SPANS = "array<struct<start:bigint,stop:bigint>>"


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = WINDOW, share: int = 20,
                  slice_windows: int = SLICE_WINDOWS, whole: bool = False) -> DataFrame:
    """How much of every document lies in windows of the benchmark.

    Returns key, n_words, n_hit (words in any occurrence of a window), items (sorted ids with
    occurring windows) and contaminated (n_hit > 0 and share * n_hit >= n_words).  Words are
    lower-cased runs of letters and digits; an item shorter than ``width`` words is one
    window, one without words is none.  A null text has no words.  The windows of an item
    with a null id hit words but are no item; items that repeat an id are one.  Repeated
    documents are judged one by one.  Other columns are ignored, or, if ``whole``, the
    documents are returned with the figures, which replace columns of their names.
    """
    figures = ("n_words", "n_hit", "items", "contaminated")
    kept = [c for c in docs.columns if c not in figures] if whole else [key]
    slices = _slices(benchmark, item, item_text, width, slice_windows)
    table, more = next(slices), next(slices, None)
    if more is None:
        judged = _in_one(docs, kept, text, table)
    else:
        judged = _in_slices(docs, kept, text, itertools.chain([table, more], slices))
    contaminated = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "n_words", "n_hit", "items", contaminated.alias("contaminated"))


def _in_one(docs: DataFrame, kept: list[str], text: str, table: Benchmark) -> DataFrame:
    """The columns ``kept`` (c0 ...) with n_words, n_hit and items."""
    inside = text in kept

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _groups(batch.column(kept.index(text) if inside else batch.num_columns - 1)):
                counts, first, hit, items = _judged(texts, table)
                covered = np.concatenate([[0], np.cumsum(hit)])
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(start, len(texts)) for c in batch.columns[:len(kept)]], pa.array(counts, pa.int64()),
                     pa.array(covered[first[1:]] - covered[first[:-1]], pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=[*[f"c{i}" for i in range(len(kept))], "n_words", "n_hit", "items"])

    # A text that is returned is not sent twice.
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], *([] if inside else [F.col(f"`{text}`").cast("string").alias("text")]))
    kinds = ", ".join(f"c{i} {rows.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept)))
    return rows.mapInArrow(judge, f"{kinds}, n_words bigint, n_hit bigint, items array<string>")


def _in_slices(docs: DataFrame, kept: list[str], text: str, tables: Iterator[Benchmark]) -> DataFrame:
    """Like :func:`_in_one`, a pass over the documents for each slice and one more for the figures."""
    values = [F.col(f"`{c}`") for c in dict.fromkeys([*kept, text])]
    values += [F.isnull(v) for v in values]  # the hash passes over nulls
    marks = [F.xxhash64(*values).alias("m1"), F.xxhash64(F.lit("again"), *values).alias("m2")]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").cast("string").alias("text"), *marks)

    def hits(table: Benchmark) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, texts in _groups(batch.column(2)):
                    _, first, hit, items = _judged(texts, table)
                    found, spans = [], []
                    for i in range(len(texts)):
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[first[i]:first[i + 1]].astype(np.int8), [0]])))
                        if len(edges):
                            found.append(start + i)
                            spans.append([{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).take(pa.array(found, pa.int64())) for c in (0, 1)],
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                         pa.array([sorted(items[i - start]) for i in found], pa.list_(pa.string()))], names=["m1", "m2", "spans", "items"])

        some = rows.select("m1", "m2", "text").mapInArrow(find, f"m1 bigint, m2 bigint, spans {_SPANS}, items array<string>")
        # Equal rows have equal hits.
        return fixed(some.groupBy("m1", "m2").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "benchmark-hits")

    all_hits = reduce(DataFrame.unionAll, [hits(table) for table in tables])
    one = all_hits.groupBy("m1", "m2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    length = F.aggregate(merged("spans"), F.lit(0).cast("bigint"), lambda t, s: t + s["stop"] - s["start"])
    one = one.select("m1", "m2", length.alias("n_hit"), "items")
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    counted = rows.withColumn("n_words", F.regexp_count(lowered, F.lit(WORD)).cast("bigint"))
    return counted.join(one, ["m1", "m2"], "left").withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")), "items": F.coalesce("items", F.array().cast("array<string>"))})


def items_digest(items):
    return F.sha2(F.array_join(items, ","), 256)

"""Quality rules learned by gradient-boosted trees over statistics of whole documents.

Fixed rules come first: too few words, or too many of them in repeated windows.  The verdict
on the rest is that of small regression trees, fitted one after the other to the gradients
of the log loss on a bounded sample of labelled documents.  For chosen statistics, such as
the share of symbols, a tree may split only so that more of it never scores higher; both
children then stay on their sides of the value between them.  Fitted trees are flattened
into arrays of nodes, and a batch of documents goes down all trees at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 6_000
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent
TREES, DEPTH, RATE, BINS, FOLDS = 60, 3, 0.2, 64, 3
BOUNDS = np.linspace(0.05, 0.95, 91)  # of the verdict, to choose from
PIECE = 1 << 20

#: Long columns of every document, the first five as they are, the others as shares in FEATURES.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_distinct",
          "n_again", "n_short", "n_ended", "n_top", "n_digits", "n_upper", "n_marks", "longest")
#: (share, of what, direction): -1 never raises the score, 0 is free.
FEATURES = (("n_symbols", "word_chars", -1), ("n_dup_lines", "n_lines", -1), ("n_repeat_words", "n_words", -1), ("n_again", "n_words", -1),
            ("word_chars", "n_words", 0), ("n_words", "n_lines", 0), ("n_ended_lines", "n_lines", 0), ("n_distinct", "n_words", 0),
            ("n_short", "n_words", 0), ("n_ended", "n_words", 0), ("n_top", "n_words", 0), ("n_digits", "word_chars", 0),
            ("n_upper", "word_chars", 0), ("n_marks", "word_chars", 0), ("longest", "word_chars", 0), ("n_words", None, 0))


def _among(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(characters, np.uint8))


_BREAK = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = _among(b" \t\n\x0b\x0c\r")
_POINT = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a code point
_CLASSES = {"word_chars": _POINT & ~_SPACE, "n_symbols": _among(b"#*$%&|<>"), "n_digits": _among(b"0123456789"),
            "n_upper": _among(bytes(range(65, 91))), "n_marks": _among(bytes(b for b in range(33, 127) if not chr(b).isalnum()))}


def word_numbers(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word's number (equal words, equal numbers), its bytes, and whether it ends a clause; a piece of text at a time."""
    numbers: dict[bytes, int] = {}
    ids, sizes, ends, start = [], [], [], 0
    while start < len(data):
        stop = min(start + PIECE, len(data))
        if stop < len(data):
            space = _BREAK.search(data, stop)
            stop = space.start() if space else len(data)
        words = data[start:stop].split()
        ids.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, len(words)))
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        ends.append(np.fromiter([w[-1] in b".,;:!?" for w in words], bool, len(words)))
        start = stop
    whole = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return whole(ids, np.int64), whole(sizes, np.int64), whole(ends, bool)


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words in windows of ``width`` that stand twice or more in the text."""
    count = len(ids) - width + 1
    if count < 2:
        return 0
    # Windows can only be equal where every word occurs again.
    often = np.concatenate([[0], np.cumsum(np.bincount(ids)[ids] > 1)])
    if not (often[width:] - often[:-width] == width).any():
        return 0
    # Numbers of longer and longer windows: those of two halves, ranked.
    names, size = ids, 1
    while size < width:
        step = min(size, width - size)
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        names, size = np.unique(pairs, return_inverse=True)[1], size + step
    again = np.flatnonzero(np.bincount(names)[names] > 1)
    change = np.zeros(len(ids) + 1, np.int64)
    change[again] += 1
    change[again + width] -= 1
    return int((np.cumsum(change[:-1]) > 0).sum())


def statistics(data: bytes) -> list[int]:
    """The COUNTS of a text in UTF-8."""
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    of = {name: int(bytes_[which].sum()) for name, which in _CLASSES.items()}
    ids, sizes, ends = word_numbers(data)
    seen: set[bytes] = set()
    for name in ("n_dup_lines", "n_lines", "n_ended_lines"):
        of[name] = 0
    for line in data.split(b"\n"):
        if bare := line.strip():
            of["n_lines"] += 1
            of["n_ended_lines"] += bare[-1] in b".!?"
            of["n_dup_lines"] += line in seen
            seen.add(line)
    times = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    of |= {"n_words": len(ids), "n_repeat_words": repeated_words(ids), "n_distinct": int((times > 0).sum()), "n_top": int(times.max()),
           "n_again": int((ids[1:] == ids[:-1]).sum()), "n_short": int((sizes <= 3).sum()), "n_ended": int(ends.sum()),
           "longest": int(sizes.max(initial=0))}
    return [of[name] for name in COUNTS]


def features(counts: np.ndarray) -> np.ndarray:
    """FEATURES of rows of COUNTS."""
    column = lambda name: counts[:, COUNTS.index(name)].astype(np.float64)
    return np.stack([column(a) / np.maximum(column(b), 1) if b else np.log1p(column(a)) for a, b, _ in FEATURES], 1) if len(counts) else np.empty((0, len(FEATURES)))


def failed(counts: np.ndarray) -> np.ndarray:
    """The fixed rules on rows of COUNTS."""
    words, repeated = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


class Forest(NamedTuple):
    """Nodes of all trees: at a node, rows with x[feature] <= split go left, others right; a leaf leads to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.split[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-np.clip(self.start + self.value[at].sum(axis=1), -30, 30)))


class _Grower:
    """Grows the trees of one forest over binned features."""

    def __init__(self, x: np.ndarray, directions: np.ndarray, bins: int, penalty: float = 4.0, least: float = 8.0) -> None:
        quantiles = np.linspace(0, 1, bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, quantiles, method="lower")) for c in x.T]
        self.binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)
        self.directions, self.penalty, self.least = directions, penalty, least
        self.nodes: list[list] = []

    def _split(self, rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, low: float, high: float):
        """The best (gain, feature, bin, left value, right value) that keeps the directions and the bounds."""
        best = (1e-6, None, None, 0.0, 0.0)
        whole_g, whole_h = slope[rows].sum(), curve[rows].sum()
        cost = lambda g, h, v: g * v + 0.5 * (h + self.penalty) * v * v
        stay = cost(whole_g, whole_h, np.clip(-whole_g / (whole_h + self.penalty), low, high))
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            part = self.binned[rows, f]
            g = np.cumsum(np.bincount(part, weights=slope[rows], minlength=len(edges) + 1))[:-1]
            h = np.cumsum(np.bincount(part, weights=curve[rows], minlength=len(edges) + 1))[:-1]
            n = np.cumsum(np.bincount(part, minlength=len(edges) + 1))[:-1]
            one = np.clip(-g / (h + self.penalty), low, high)
            two = np.clip(-(whole_g - g) / (whole_h - h + self.penalty), low, high)
            gain = stay - cost(g, h, one) - cost(whole_g - g, whole_h - h, two)
            allowed = (n >= self.least) & (len(rows) - n >= self.least) & ((two - one) * self.directions[f] >= 0)
            gain[~allowed] = -np.inf
            if gain[k := int(gain.argmax())] > best[0]:
                best = (float(gain[k]), f, k, float(one[k]), float(two[k]))
        return best

    def grow(self, slope: np.ndarray, curve: np.ndarray, depth: int, rate: float) -> tuple[int, np.ndarray]:
        """One tree's root, and its value for every row."""
        out = np.zeros(len(slope))

        def node(rows: np.ndarray, level: int, low: float, high: float) -> int:
            me = len(self.nodes)
            value = float(np.clip(-slope[rows].sum() / (curve[rows].sum() + self.penalty), low, high))
            self.nodes.append([0, np.inf, me, me, rate * value])
            gain, f, k, one, two = self._split(rows, slope, curve, low, high) if level < depth else (0, None, None, 0, 0)
            if f is None:
                out[rows] = rate * value
                return me
            between, way = (one + two) / 2, self.directions[f]
            mine = self.binned[rows, f] <= k
            left = node(rows[mine], level + 1, between if way < 0 else low, between if way > 0 else high)
            right = node(rows[~mine], level + 1, between if way > 0 else low, between if way < 0 else high)
            self.nodes[me] = [f, self.edges[f][k], left, right, 0.0]
            return me

        return node(np.arange(len(slope)), 0, -np.inf, np.inf), out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, directions: np.ndarray | None = None, trees: int = TREES, depth: int = DEPTH,
        rate: float = RATE) -> Forest:
    """A forest for labels 0 and 1; with one label only, its share and no tree."""
    directions = np.array([d for _, _, d in FEATURES]) if directions is None else directions
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start, roots, nodes = float(np.log(share / (1 - share))), [], []
    if len(y) and 0 < y.sum() < len(y):
        grower, value, scaled = _Grower(x, directions, BINS), np.full(len(y), start), weight / weight.mean()
        for _ in range(trees):
            p = 1 / (1 + np.exp(-value))
            root, step = grower.grow(scaled * (p - y), scaled * p * (1 - p), depth, rate)
            roots.append(root)
            value += step
        nodes = grower.nodes
    table = np.array(nodes, np.float64).reshape(len(nodes), 5)
    whole = lambda i: table[:, i].astype(np.int64)
    return Forest(whole(0), table[:, 1], whole(2), whole(3), table[:, 4], np.array(roots, np.int64), depth, start)


class Judge(NamedTuple):
    forest: Forest
    least: float  # the smallest score that is kept

    def score(self, counts: np.ndarray) -> np.ndarray:
        return self.forest.score(features(counts))


def parting(scores: np.ndarray, y: np.ndarray) -> float:
    """The bound that parts scores of labels 0 and 1 best, each label counting as a half; of several, the middle one."""
    if not len(y) or not 0 < y.sum() < len(y):
        return 0.5
    below = lambda some: (some[None] < BOUNDS[:, None]).mean(axis=1)
    parted = below(scores[y == 0]) - below(scores[y == 1])
    best = np.flatnonzero(parted >= parted.max() - 1e-9)
    return float(BOUNDS[best[len(best) // 2]])


def fit_judge(counts: np.ndarray, y: np.ndarray, weight: np.ndarray, folds: int = FOLDS) -> Judge:
    """A forest, and the verdict's bound, from scores of forests that did not see the document."""
    x, fold = features(counts), np.arange(len(y)) % folds
    apart = np.full(len(y), 0.5)
    for f in range(folds):
        if (fold != f).any():
            apart[fold == f] = fit(x[fold != f], y[fold != f], weight[fold != f]).score(x[fold == f])
    return Judge(fit(x, y, weight), parting(apart, y))


def _measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, counts) of every document."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [statistics(t.as_py() or b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int64()))], names=["key", "counts"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(measure, f"key {rows.schema['key'].dataType.simpleString()}, counts array<bigint>")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Judge:
    """A judge from at most ``sample`` labelled documents, half of each label where there are so many.

    They are chosen by a hash of the key from those with crc32(key as text) mod 5 <> 0; weights
    undo the choice.  A key with several labels counts once, by the smallest, and so does a
    key with several documents, by the smallest counts: the driver gets a row of numbers
    per sampled key.  Null keys and labels are left out.
    """
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key"))
             .agg(F.min(F.col(label).cast("int")).alias("y")))
    known = known.filter(F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0)
    part = lambda y: known.filter(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(sample // 2)
    chosen = part(0).unionAll(part(1))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # The sample's size is bounded by the parameter, so its keys may be broadcast.
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key", "left_semi")
    counts = _measured(texts, "key", "text").groupBy("key").agg(F.min("counts").alias("counts"))
    rows = counts.join(F.broadcast(chosen), "key").orderBy(F.xxhash64("key"), "key").toArrow()
    y = rows.column("y").to_numpy().astype(np.float64)
    table = np.array(rows.column("counts").to_pylist(), np.int64).reshape(len(y), len(COUNTS))
    weight = np.where(y == 1, totals.get(1, 0) / max(y.sum(), 1), totals.get(0, 0) / max((1 - y).sum(), 1))
    return fit_judge(table, y, weight)


def score(docs: DataFrame, judge: Judge, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, the COUNTS over its whole text, base_failed, score and kept.

    A null text has no words, and without words the fixed rules fail.  Repeated rows are
    judged one by one; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([statistics(t.as_py() or b"") for t in batch.column(1)], np.int64).reshape(batch.num_rows, len(COUNTS))
            bad, scores = failed(counts), judge.score(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in counts.T], pa.array(bad), pa.array(scores), pa.array(~bad & (scores >= judge.least))],
                names=["key", *COUNTS, "base_failed", "score", "kept"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    columns = ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(run, f"key {kind}, {columns}, base_failed boolean, score double, kept boolean").withColumnRenamed("key", key)

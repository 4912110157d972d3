"""Toxicity by a classifier chain: one linear model per category, each seeing the earlier ones' results.

The models are logistic regressions on the presence and frequency of words and word beginnings,
fitted in numpy on a bounded sample of labelled documents.  Spark counts in how many of
them, of each label, a feature stands; only the telling ones go to the driver.  A later category gets the earlier
probabilities as inputs; while fitting, these come from models that did not see the
document (out of fold), as they will not have seen the documents scored later.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .graph import Scratch
from .rules import parting
from .words import ALNUM, Hasher

SAMPLE = 6_000
FEATURES = 3_000
FOLDS = 3
TOLD = 4  # times FEATURES: what a category's models choose from
BEGINNINGS = (5, 6, 7)  # bytes
OFTEN = (2, 3, 5)


def features(hasher: Hasher, text: str | None) -> np.ndarray:
    """The distinct hashes of a text's words and their beginnings, and of those that occur more often."""
    found, times = np.unique(hasher.with_beginnings(text, ALNUM, BEGINNINGS), return_counts=True)
    return np.sort(np.concatenate([found, *[found[times >= n] + np.uint64(n) for n in OFTEN]]))


class Linear(NamedTuple):
    """Weights of features (sorted hashes), of earlier categories' log odds, and of nothing."""

    names: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    bound: float = 0.5  # parts the labels best in out-of-fold scores

    def score(self, found: np.ndarray, earlier: Sequence[float]) -> float:
        at = np.minimum(np.searchsorted(self.names, found), max(len(self.names) - 1, 0))
        sum_ = float(self.weights[at][self.names[at] == found].sum()) if len(self.names) else 0.0
        value = sum_ + float(np.dot(self.earlier, earlier)) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(value, -30, 30)))


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def select(docs: Sequence[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The features whose presence differs most between the classes, in standard errors."""
    if not len(docs) or not y.any() or y.all():
        return np.empty(0, np.uint64)
    names, which = np.unique(np.concatenate(docs), return_inverse=True)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    ones = np.bincount(which, weights=y[row], minlength=len(names))
    zeros = np.bincount(which, weights=1.0 - y[row], minlength=len(names))
    n1, n0 = y.sum(), len(y) - y.sum()
    p, q = (ones + 0.5) / (n1 + 1), (zeros + 0.5) / (n0 + 1)
    z = np.abs(p - q) / np.sqrt(p * (1 - p) / n1 + q * (1 - q) / n0)
    z[ones + zeros < 3] = 0
    kept = np.argsort(-z, kind="stable")[:most]
    return names[np.sort(kept[z[kept] > 2.5])]


def fit(docs: Sequence[np.ndarray], earlier: np.ndarray, y: np.ndarray, weight: np.ndarray, most: int = FEATURES,
        steps: int = 120, penalty: float = 1e-3) -> Linear:
    """Weighted logistic regression by Adam steps over all documents."""
    names = select(docs, y, most)
    rows, columns = [], []
    for i, d in enumerate(docs):
        if len(names):
            at = np.minimum(np.searchsorted(names, d), len(names) - 1)
            at = at[names[at] == d]
            rows.append(np.full(len(at), i))
            columns.append(at)
    rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
    columns = np.concatenate(columns) if columns else np.empty(0, np.int64)
    k = len(names)
    share = weight / weight.sum()
    w = np.zeros(k + earlier.shape[1] + 1)
    w[-1] = log_odds(np.array([np.clip((share * y).sum(), 1e-3, 1 - 1e-3)]))[0]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        value = np.bincount(rows, weights=w[columns], minlength=len(docs)) + earlier @ w[k:-1] + w[-1]
        error = share * (1 / (1 + np.exp(-np.clip(value, -30, 30))) - y)
        slope = np.concatenate([np.bincount(columns, weights=error[rows], minlength=k) if k else np.empty(0), earlier.T @ error, [error.sum()]])
        slope[:-1] += penalty * w[:-1] / max(k, 1) ** 0.5
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return Linear(names, w[:k], w[k:-1], float(w[-1]))


def fit_chain(docs: Sequence[np.ndarray], labels: np.ndarray, weight: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per column of ``labels`` (NaN: unknown), in order."""
    fold = np.arange(len(docs)) % folds
    earlier, models = np.zeros((len(docs), 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c]
        known = ~np.isnan(y)

        def part(rows: np.ndarray) -> Linear:
            return fit([docs[i] for i in np.flatnonzero(rows)], earlier[rows], y[rows], weight[rows])

        if not known.any():
            models.append(Linear(np.empty(0, np.uint64), np.empty(0), np.zeros(earlier.shape[1]), -30.0))
        else:
            models.append(part(known))
        out = np.zeros(len(docs))
        for f in range(folds if known.any() else 0):
            model = part(known & (fold != f)) if (known & (fold != f)).any() else models[-1]
            for i in np.flatnonzero(fold == f):
                out[i] = model.score(docs[i], earlier[i])
        models[-1] = models[-1]._replace(bound=parting(out[known], y[known]))
        earlier = np.column_stack([earlier, log_odds(out)])
    return models


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str], key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> list[Linear]:
    """Models from at most ``sample`` labelled documents, half of them of the last category where there are so many.

    Rows are chosen by a hash of their key from those with crc32(key as text) mod 5 <> 0; the
    others are held out.  Class weights undo the choice.  Repeated labels of a key count
    once, by their smallest values, and so do repeated documents, by the smallest features;
    a null label is unknown.
    """
    last = F.col(categories[-1])
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key")).agg(
        *[F.min(F.col(c).cast("double")).alias(c) for c in categories])
    known = known.filter(F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0)
    order = [F.xxhash64("key"), F.col("key")]
    ones = known.filter(last == 1).orderBy(*order).limit(sample // 2)
    zeros = known.filter((last != 1) | last.isNull()).orderBy(*order).limit(sample // 2)
    totals = {bool(r[0]): r[1] for r in known.groupBy(F.coalesce(last == 1, F.lit(False))).count().collect()}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                found = [features(hasher, t.as_py()).view(np.int64) for t in batch.column(1)[i:i + 100]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:i + 100], pa.array(found, pa.list_(pa.int64()))], names=["key", "found"])

    chosen = ones.unionAll(zeros)
    steps = Scratch(docs.sparkSession)
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    # The sample's size is bounded by the parameter, so its keys may be broadcast.
    found = texts.join(F.broadcast(chosen.select("key")), "key", "left_semi").mapInArrow(extract, "key bigint, found array<bigint>")
    found = steps.fixed(found.groupBy("key").agg(F.min("found").alias("found")).join(F.broadcast(chosen), "key"), "chain-sample")
    told = np.unique(np.array([x for c in categories for x in _telling(found, c, TOLD * FEATURES)], np.int64)).tolist()

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.array(told, pa.int64())
        for batch in batches:
            lists = [np.sort(row.values.filter(pc.is_in(row.values, kept)).to_numpy().view(np.uint64)).tobytes() for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary()), *batch.columns[2:]], names=batch.schema.names)

    kinds = "".join(f", {c} double" for c in categories)
    rows = found.mapInArrow(restrict, f"key bigint, found binary{kinds}").orderBy("key").toArrow().to_pydict()
    steps.clear()
    data = [np.frombuffer(b, np.uint64) for b in rows["found"]]
    y = np.array([[np.nan if v is None else v for v in rows[c]] for c in categories]).T.reshape(len(data), len(categories))
    one = y[:, -1] == 1
    weight = np.where(one, totals.get(True, 0) / max(one.sum(), 1), totals.get(False, 0) / max((~one).sum(), 1))
    return fit_chain(data, y, weight) if data else fit_chain([], y, weight)


def _telling(found: DataFrame, category: str, most: int) -> list[int]:
    """The features of (found, labels) whose presence differs most between the labels of a category, in standard errors."""
    known = found.filter(F.col(category).isNotNull())
    n1, n0 = (float(x or 0) for x in known.agg(F.sum(category), F.sum(1 - F.col(category))).first())
    if not n1 or not n0:
        return []
    ones, zeros = F.sum(category).alias("ones"), F.sum(1 - F.col(category)).alias("zeros")
    counts = known.select(F.explode("found").alias("f"), category).groupBy("f").agg(ones, zeros).filter("ones + zeros >= 3")
    p, q = (F.col("ones") + 0.5) / (n1 + 1), (F.col("zeros") + 0.5) / (n0 + 1)
    z = F.abs(p - q) / F.sqrt(p * (1 - p) / n1 + q * (1 - q) / n0)
    return [r[0] for r in counts.orderBy(z.desc(), "f").limit(most).select("f").collect()]


def score(docs: DataFrame, models: Sequence[Linear], categories: Sequence[str], key: str = "doc_id", text: str = "text",
          whole: bool = False) -> DataFrame:
    """Per document: key and the probability of each category, over the whole text.

    A null or empty text has no features and gets what the models say without any.
    Repeated rows are scored one by one.  Other columns are ignored, or, if ``whole``, the
    documents are returned with the probabilities, which replace columns of their names.
    """
    kept = [c for c in docs.columns if c not in categories] if whole else [key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            out = [[] for _ in models]
            for value in batch.column(batch.num_columns - 1 if not whole else kept.index(text)):
                found, earlier = features(hasher, value.as_py()), []
                for model, column in zip(models, out):
                    p = model.score(found, earlier)
                    column.append(float(p))
                    earlier.append(float(log_odds(np.array([p]))[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *[pa.array(c, pa.float64()) for c in out]],
                                             names=[f"c{i}" for i in range(len(kept))] + [f"p{i}" for i in range(len(models))])

    # A text that is returned is not sent twice.
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], *([] if whole else [F.col(f"`{text}`").cast("string").alias("text")]))
    kinds = [f"c{i} {rows.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept))] + [f"p{i} double" for i in range(len(models))]
    scored = rows.mapInArrow(run, ", ".join(kinds))
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *[F.col(f"p{i}").alias(c) for i, c in enumerate(categories)])

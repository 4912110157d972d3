"""Quality of documents by a byte-level convolutional network in numpy.

The bytes of a whole document are cut into overlapping chunks.  Each byte has a learned
vector, filters look at eight bytes at every second place, and a chunk is described by each
filter's largest response.  A document is described by the largest and the mean of these
over all its chunks, which one hidden layer combines into a probability.  The network is
fitted by Adam steps on all chunks of a bounded sample of labelled documents; gradients flow
through the places of the largest responses only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 4_000
LONGEST = 1 << 17  # bytes of a text that may be in the sample
CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 2
VECTOR, FILTERS, HIDDEN = 6, 24, 16
STEPS, BATCH = 420, 48
AT_ONCE = 128  # chunks


class Network(NamedTuple):
    bytes: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # WIDTH * VECTOR x FILTERS
    offset: np.ndarray
    hidden: np.ndarray  # 2 * FILTERS x HIDDEN
    hidden_offset: np.ndarray
    out: np.ndarray
    out_offset: np.ndarray


def chunks(data: bytes, size: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """The overlapping chunks that cover all of ``data`` as rows of bytes, the last padded with 0; one at least."""
    step = size - overlap
    count = max(1, -(-(len(data) - overlap) // step))
    padded = np.zeros(step * (count - 1) + size, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::step]


def _windows(net: Network, rows: np.ndarray) -> np.ndarray:
    """(chunk, place, WIDTH * VECTOR) of the byte vectors that the filters see."""
    seen = net.bytes[rows]
    view = np.lib.stride_tricks.sliding_window_view(seen.reshape(len(rows), -1), WIDTH * VECTOR, axis=1)
    return view[:, ::STRIDE * VECTOR]


def responses(net: Network, rows: np.ndarray) -> np.ndarray:
    """The largest response of each filter in each chunk."""
    windows = _windows(net, rows)
    flat = np.ascontiguousarray(windows).reshape(-1, WIDTH * VECTOR) @ net.filters
    return np.maximum(flat.reshape(len(rows), -1, net.filters.shape[1]).max(axis=1) + net.offset, 0)


def probability(net: Network, described: np.ndarray) -> np.ndarray:
    inner = np.maximum(described @ net.hidden + net.hidden_offset, 0)
    return 1 / (1 + np.exp(-np.clip(inner @ net.out + net.out_offset, -30, 30)))


def score_text(net: Network, text: str | None) -> float:
    """The probability for a whole text, some chunks at a time."""
    rows = chunks((text or "").encode("utf-8", "surrogatepass"))
    most, sums = np.zeros(net.filters.shape[1], np.float32), np.zeros(net.filters.shape[1])
    for i in range(0, len(rows), AT_ONCE):
        found = responses(net, rows[i:i + AT_ONCE])
        most = np.maximum(most, found.max(axis=0))
        sums += found.sum(axis=0, dtype=np.float64)
    described = np.concatenate([most, sums / len(rows)]).astype(np.float32)
    return float(probability(net, described[None])[0])


def fit(views: list[np.ndarray], y: np.ndarray, steps: int = STEPS, seed: int = 7) -> Network:
    """A network for labels 0 and 1, each class seen equally often; scores are put right for that at the end."""
    random = np.random.default_rng(seed)
    normal = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
    net = [normal(256, VECTOR, scale=1.0), normal(WIDTH * VECTOR, FILTERS, scale=(2 / (WIDTH * VECTOR)) ** 0.5), np.zeros(FILTERS, np.float32),
           normal(2 * FILTERS, HIDDEN, scale=(1 / FILTERS) ** 0.5), np.zeros(HIDDEN, np.float32), normal(HIDDEN, scale=HIDDEN ** -0.5),
           np.zeros((), np.float32)]
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    if not len(y) or not 0 < y.sum() < len(y):
        net[5] *= 0
        net[6] = np.float32(np.log(share / (1 - share)))
        return Network(*net)
    m, v = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net]
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        picked = np.concatenate([random.choice(c, BATCH // 2) for c in classes])
        slopes = _slopes(Network(*net), [views[i] for i in picked], y[picked])
        rate = 0.004 * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, g in enumerate(slopes):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            net[i] = (net[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    net[6] = np.float32(net[6] + np.log(share / (1 - share)))
    return Network(*net)


def _slopes(net: Network, views: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss."""
    rows, owner = np.concatenate(views), np.repeat(np.arange(len(views)), [len(x) for x in views])
    count = np.bincount(owner)
    windows = _windows(net, rows)
    flat = np.ascontiguousarray(windows).reshape(-1, WIDTH * VECTOR) @ net.filters
    values = flat.reshape(len(rows), -1, FILTERS)
    place = values.argmax(axis=1)
    top = np.maximum(np.take_along_axis(values, place[:, None], 1)[:, 0] + net.offset, 0)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    most = np.maximum.reduceat(top, first)
    described = np.concatenate([most, np.add.reduceat(top, first) / count[:, None]], 1)
    before = described @ net.hidden + net.hidden_offset
    inner = np.maximum(before, 0)
    error = ((1 / (1 + np.exp(-np.clip(inner @ net.out + net.out_offset, -30, 30))) - y) / len(y)).astype(np.float32)
    back = error[:, None] * net.out * (before > 0)
    to = back @ net.hidden.T
    is_most = (top == most[owner]).astype(np.float32)
    ties = np.add.reduceat(is_most, first)
    slope = (to[owner, :FILTERS] * is_most / ties[owner] + to[owner, FILTERS:] / count[owner][:, None]) * (top > 0)
    chunk, number = np.nonzero(slope)
    weight = slope[chunk, number].astype(np.float32)
    seen = windows[chunk, place[chunk, number]]  # what each filter saw where it was largest
    filters = np.zeros_like(net.filters)
    for f in range(FILTERS):
        mine = number == f
        filters[:, f] = weight[mine] @ seen[mine]
    table = np.zeros_like(net.bytes)
    codes = rows[chunk[:, None], place[chunk, number][:, None] * STRIDE + np.arange(WIDTH)]
    np.add.at(table, codes, (weight[:, None] * net.filters.T[number]).reshape(len(weight), WIDTH, VECTOR))
    decay = 1e-4
    return [table, filters + decay * net.filters, slope.sum(axis=0), described.T @ back + decay * net.hidden, back.sum(axis=0),
            inner.T @ error, error.sum()]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, longest: int = LONGEST, seed: int = 7) -> Network:
    """A network from at most ``sample`` labelled documents, half of each label where there are so many.

    They are chosen by a hash of the key from those with crc32(key as text) mod 5 <> 0, and
    seen whole; texts of more than ``longest`` bytes are no part of the sample.  A key with
    several labels counts once, by the smallest, and so does one with several documents, by
    the smallest text; null keys and labels are left out.
    """
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key"))
             .agg(F.min(F.col(label).cast("int")).alias("y")))
    known = known.filter(F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0)
    part = lambda y: known.filter(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(sample // 2)
    chosen = part(0).unionAll(part(1))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}

    # The sample's size is bounded by the parameters, so its keys may be broadcast and its texts collected.
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    seen = texts.filter(F.octet_length("text") <= longest).join(F.broadcast(chosen.select("key")), "key", "left_semi")
    rows = seen.groupBy("key").agg(F.min("text").alias("text")).join(F.broadcast(chosen), "key").orderBy("key").toArrow().to_pydict()
    views = [np.ascontiguousarray(chunks(b)) for b in rows["text"]]
    y = np.array(rows["y"], np.float32)
    net = fit(views, y, seed=seed)
    if 0 < y.sum() < len(y):  # the choice of the sample is undone, too
        mine, real = y.sum() / (len(y) - y.sum()), totals.get(1, 0) / max(totals.get(0, 0), 1)
        net = net._replace(out_offset=np.float32(net.out_offset + np.log(max(real, 1e-3) / mine)))
    return net


def score(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per document: key, score (the probability of label 1) and predicted.

    A null or empty text is one chunk of zeros.  Repeated rows are scored one by one; other
    columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_text(net, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

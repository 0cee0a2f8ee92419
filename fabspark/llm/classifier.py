"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Two streams are read from a text: its words, and their shapes (runs of small
letters, capitals and digits as one sign each, other characters as they are; a
word that repeats the one before it has a shape of its own). Both are hashed into
buckets. A bucket has a sparse random index vector; its word vector is the sum of
the index vectors met within two places of it anywhere in the corpus, so words
used alike get like vectors. A text is the mean of its vectors, per stream. A
network of two layers maps that to a quality, trained on labelled documents, and
its temperature is set on some of them kept aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.sample import by_hash
from fabspark.llm.text import Texts, Words, mix, span_hashes, texts

BUCKETS = 1 << 13
DIMENSION = 32
NONZEROS = 2
REACH = 2
SAMPLE = 20_000  # labelled documents to learn from, at most
HIDDEN = 24
EPOCHS = 40
FOLD = 5
THRESHOLD = 0.3

_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[ord("a"):ord("z") + 1] = ord("a")
_SIGN[128:] = ord("a")
_SIGN[ord("A"):ord("Z") + 1] = ord("A")
_SIGN[ord("0"):ord("9") + 1] = ord("0")
_SALT = mix(np.array([3, 5], np.uint64))


def streams(t: Texts, w: Words) -> list[np.ndarray]:
    """Buckets of the words and of their shapes."""
    if not len(w.hashes):
        return [np.zeros(0, np.int64)] * 2
    sign = _SIGN[t.data]
    keep = np.ones(len(sign), bool)
    keep[1:] = sign[1:] != sign[:-1]
    keep[w.starts] = True
    at = np.zeros(len(sign) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    # A mark after the last sign of a word stays outside, as kept signs are counted up to its end.
    signs = sign[keep]
    shape = _shapes(signs, at[w.starts], at[w.ends])
    same = np.zeros(len(w.hashes), bool)
    doc = w.doc
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (doc[1:] == doc[:-1])
    shape = np.where(same, _SALT[0], shape)
    return [(x % np.uint64(BUCKETS)).astype(np.int64) for x in (w.hashes, mix(shape ^ _SALT[1]))]


def _shapes(signs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the shapes, in steps as words are hashed."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        a, b = starts[lo], ends[hi - 1]
        out[lo:hi] = span_hashes(signs[a:b], starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzeros of each bucket's random index vector."""
    h = mix(np.arange(BUCKETS * NONZEROS, dtype=np.uint64) + _SALT[0]).reshape(BUCKETS, NONZEROS)
    return (h % np.uint64(DIMENSION)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def _add(total: np.ndarray, buckets: np.ndarray, doc: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add to each bucket the index vectors around its words."""
    at, value = [], []
    for d in range(1, REACH + 1):
        same = doc[d:] == doc[:-d]
        left, right = buckets[:-d][same], buckets[d:][same]
        for a, b in ((left, right), (right, left)):
            at.append((a[:, None] * DIMENSION + place[b]).ravel())
            value.append(sign[b].ravel())
    total += np.bincount(np.concatenate(at), np.concatenate(value), len(total))


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, from every text of the corpus.

    A task adds up its buckets first; what moves is one row per bucket and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(BUCKETS * DIMENSION)
        for batch in batches:
            for t in texts(batch.column(0)):
                w = t.words()
                for s in streams(t, w):
                    if len(s) > 1:
                        _add(total, s, w.doc, place, sign)
        rows = total.reshape(BUCKETS, DIMENSION)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.array(rows[some, i].astype(np.int64)) for i in range(DIMENSION))], names)

    names = ["bucket"] + [f"x{i}" for i in range(DIMENSION)]
    rows = docs.select(F.col(f"`{text}`")).mapInArrow(run, "bucket int, " + ", ".join(f"{x} long" for x in names[1:])) \
        .groupBy("bucket").agg(*(F.sum(x).alias(x) for x in names[1:])).toArrow()
    out = np.zeros((BUCKETS, DIMENSION))
    out[rows["bucket"].to_numpy()] = np.stack([rows[x].to_numpy() for x in names[1:]], axis=1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-12)).astype(np.float32)


def pooled(t: Texts, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector and mean shape vector of each text; zeros without words."""
    w = t.words()
    n = np.diff(w.first)
    out = np.zeros((len(t), 2 * DIMENSION), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        for k, s in enumerate(streams(t, w)):
            part = slice(k * DIMENSION, (k + 1) * DIMENSION)
            out[some, part] = np.add.reduceat(vectors[s], w.first[:-1][some], axis=0) / n[some, None]
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Fit by Adam on nine tenths of the rows, set the temperature on the rest. Without rows every score is 0.5."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    x = x.astype(np.float64)
    net = Network(x.mean(0) if len(x) else np.zeros(d), x.std(0) + 1e-3 if len(x) else np.ones(d),
                  rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if not len(x):
        return net
    order = rng.permutation(len(x))
    aside, used = order[:len(x) // 10], order[len(x) // 10:]
    moments: dict[str, list] = {}
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for lo in range(0, len(used), 256):
            some = used[lo:lo + 256]
            z = (x[some] - net.mean) / net.scale
            h = np.tanh(z @ net.w1 + net.b1)
            err = (_sigmoid(h @ net.w2 + net.b2) - y[some]) / len(some)
            back = err[:, None] * net.w2 * (1 - h * h)
            step += 1
            for name, g in (("w1", z.T @ back + 1e-4 * net.w1), ("b1", back.sum(0)), ("w2", h.T @ err + 1e-4 * net.w2),
                            ("b2", err.sum())):
                m = moments.setdefault(name, [0.0, 0.0])
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                move = 0.01 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, name, getattr(net, name) - move)
    if len(aside):
        z = net.logits(x[aside])
        goal = (y[aside] * len(aside) + 1) / (len(aside) + 2)  # no certainty that this many rows cannot give
        grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 60))
        net.temperature = float(grid[np.argmin([
            (goal * np.logaddexp(0, -z / g) + (1 - goal) * np.logaddexp(0, z / g)).mean() for g in grid])])
    return net


def held_out(key: str = "doc_id", fold: int = FOLD) -> Column:
    """Documents that are not learnt from; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % fold == 0


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample: int = SAMPLE, fold: int = FOLD) -> tuple[np.ndarray, Network]:
    """Word vectors of all documents, and the network from at most ``sample`` labelled ones.

    Of more labelled documents that are not held out, those of smallest hash are
    used: their keys are broadcast and their vectors, 256 bytes each, collected.
    """
    vectors = word_vectors(docs, text)
    chosen = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("double").alias("_y")) \
        .where("_key IS NOT NULL AND _y IS NOT NULL").where(~held_out("_key", fold)).distinct()
    chosen = by_hash(chosen, "_key", sample)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")) \
        .join(F.broadcast(chosen), "_key").select("_y", "_text")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                x = pooled(t, shared.value)
                bounds = pa.array((np.arange(len(t) + 1) * x.shape[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.at, len(t)), pa.ListArray.from_arrays(
                    bounds, pa.array(x.ravel()))], ["y", "x"])

    found = rows.mapInArrow(run, "y double, x array<float>").toArrow()
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, -1) \
        if found.num_rows else np.zeros((0, 2 * DIMENSION))
    y = found["y"].to_numpy()
    order = np.lexsort((*x.T, y)) if len(y) else np.zeros(0, np.int64)  # partitions may arrive in any order
    return vectors, train(x[order], y[order])


def predict(docs: DataFrame, vectors: np.ndarray, net: Network, *, text: str = "text", key: str = "doc_id",
            fold: int = FOLD, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= ``threshold``).

    A text that is null, empty or white space gets the score of a zero vector;
    repeated rows and null keys are scored each; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in batches:
            for t in texts(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(t.at, len(t)) for i in range(2)), pa.array(net.scores(pooled(t, vectors)))],
                    [key, "held_out", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), held_out(key, fold).alias("held_out"), F.col(f"`{text}`").alias("_text")) \
        .mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text. Words are counted over all
training texts. The model predicts one of ``OUTPUTS`` units: the end, the most
frequent words, or a class of all other words (by their last two bytes); within
a class a word has its smoothed share of the class's count. So the probabilities
of all words and one unseen word a class add up to one. The prediction is the
softmax of a bilinear form in the three units before, computed for thousands of
tokens at a time by matrix products.

Training goes over all training texts in ``ROUNDS`` rounds: each task starts from
the common parameters, learns from its own texts, and the parameters are averaged
by tokens. Scores need a word's count: the most frequent words, at most ``HEAD``, are
sent to all tasks (16 bytes each), the others are joined by shuffle, counted per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.sample import head as frequent
from fabspark.llm.text import Texts, Words, texts
from fabspark.session import settled

TOP = 191
CLASSES = 128
OUTPUTS = 1 + TOP + CLASSES  # unit 0 is the end, also what stands before a text
DIMENSION = 16
CONTEXT = 3
NOISE = 64  # noise words of a batch
BATCH = 2048
SCORED = 512  # tokens scored at a time, so that a block of the softmax stays in cache
RATE = 0.1
ROUNDS = 2
HEAD = 1 << 18
FLUSH = 1 << 20  # distinct words a task holds before it passes on its counts

ADD = 0.1  # smoothing of counts


def suffix_class(t: Texts, w: Words) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = t.data[w.ends - 1].astype(np.int64)
    before = np.where(w.ends - w.starts > 1, t.data[np.maximum(w.ends - 2, 0)], 0).astype(np.int64)
    return (before * 31 + last * 7) % CLASSES


def find(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each value in a sorted array, and whether it is there."""
    if not len(sorted_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


@dataclass
class Units:
    """Which words are units of their own: hashes in order, with their unit."""

    hashes: np.ndarray
    units: np.ndarray

    def sequence(self, t: Texts, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of all tokens, ends included, text of each token, and where each word stands."""
        n = len(w.first) - 1
        at, known = find(self.hashes, w.hashes)
        doc = w.doc
        place = np.arange(len(w.hashes)) + doc
        seq = np.zeros(len(w.hashes) + n, np.int64)
        seq[place] = np.where(known, self.units[at] if len(self.units) else 0, 1 + TOP + suffix_class(t, w))
        return seq, np.repeat(np.arange(n), np.diff(w.first) + 1), place


def before(seq: np.ndarray, doc: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The units before tokens ``lo`` to ``hi``, nearest first; 0 before a text."""
    out = np.zeros((hi - lo, CONTEXT), np.int64)
    for j in range(1, CONTEXT + 1):
        p = np.arange(lo, hi) - j
        ok = (p >= 0) & (doc[np.maximum(p, 0)] == doc[lo:hi])
        out[ok, j - 1] = seq[p[ok]]
    return out


class Model:
    """Parameters: context vectors, target vectors, biases, and a weight for each place and dimension."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        k = OUTPUTS * DIMENSION
        self.context = flat[:k].reshape(OUTPUTS, DIMENSION)
        self.target = flat[k:2 * k].reshape(OUTPUTS, DIMENSION)
        self.bias = flat[2 * k:2 * k + OUTPUTS]
        self.place = flat[2 * k + OUTPUTS:].reshape(CONTEXT, DIMENSION)

    SIZE = 2 * OUTPUTS * DIMENSION + OUTPUTS + CONTEXT * DIMENSION

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 11) -> Model:
        m = cls(np.zeros(cls.SIZE, np.float32))
        m.context[:] = np.random.default_rng(seed).normal(0, 1.0, m.context.shape)
        m.bias[:] = np.log((counts + 1.0) / (counts + 1.0).sum())
        m.place[:] = 1.0 / CONTEXT
        return m

    def predicted(self, ctx: np.ndarray) -> np.ndarray:
        """Predicted target vectors."""
        out = self.context[ctx[:, 0]] * self.place[0]
        for j in range(1, CONTEXT):
            out += self.context[ctx[:, j]] * self.place[j]
        return out

    def log10(self, seq: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every token's unit."""
        out = np.empty(len(seq))
        for lo in range(0, len(seq), SCORED):
            hi = min(lo + SCORED, len(seq))
            s = self.predicted(before(seq, doc, lo, hi)) @ self.target.T
            s += self.bias
            s -= s.max(axis=1, keepdims=True)
            own = s[np.arange(hi - lo), seq[lo:hi]].astype(np.float64)
            out[lo:hi] = own - np.log(np.exp(s, out=s) @ np.ones(OUTPUTS, np.float32))
        return out / np.log(10.0)


def _summed(units: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each unit."""
    at = (units[:, None] * DIMENSION + np.arange(DIMENSION)).ravel()
    return np.bincount(at, rows.ravel(), OUTPUTS * DIMENSION).reshape(OUTPUTS, DIMENSION)


class Trainer:
    """Noise-contrastive steps with AdaGrad; the noise is drawn from the units' shares, once a batch."""

    def __init__(self, model: Model, counts: np.ndarray, seed: int):
        self.m = Model(model.flat.copy())
        self.grads = Model(np.zeros_like(model.flat))
        self.squares = np.full_like(model.flat, 1e-3)
        share = (counts + 1.0) / (counts + 1.0).sum()
        self.cum = np.cumsum(share)
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def step(self, ctx: np.ndarray, unit: np.ndarray) -> None:
        m, g = self.m, self.grads
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE)), OUTPUTS - 1)
        pred = m.predicted(ctx)
        own, other = m.target[unit], m.target[noise]
        good = (pred * own).sum(1) + m.bias[unit] - self.log_noise[unit]
        bad = pred @ other.T + (m.bias[noise] - self.log_noise[noise])
        d_good = (1.0 / (1.0 + np.exp(np.clip(good, -30, 30)))) / len(unit)  # how far from certain
        d_bad = (-1.0 / (1.0 + np.exp(np.clip(-bad, -30, 30)))) / len(unit)
        d_pred = own * d_good[:, None] + d_bad @ other
        units = np.concatenate([unit, noise])
        g.target[:] = _summed(units, np.concatenate([pred * d_good[:, None], d_bad.T @ pred]))
        g.bias[:] = np.bincount(units, np.concatenate([d_good, d_bad.sum(0)]), OUTPUTS)
        g.context[:] = _summed(ctx.T.ravel(), np.concatenate([d_pred * m.place[j] for j in range(CONTEXT)]))
        for j in range(CONTEXT):
            g.place[j] = (d_pred * m.context[ctx[:, j]]).sum(0)
        self.squares += g.flat * g.flat
        m.flat += RATE * g.flat / np.sqrt(self.squares)
        self.tokens += len(unit)

    def learn(self, seq: np.ndarray, doc: np.ndarray, use: np.ndarray) -> None:
        """All tokens of the texts to use, in batches."""
        at = np.flatnonzero(use[doc])
        if not len(at):
            return
        ctx = before(seq, doc, 0, len(seq))
        for lo in range(0, len(at), BATCH):
            some = at[lo:lo + BATCH]
            self.step(ctx[some], seq[some])


def _marked(docs: DataFrame, text: str, key: str, fold: int) -> DataFrame:
    """Key, text, and whether the text is held out of training; a null key counts as empty text."""
    held = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % fold == 0
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"), held.alias("_held"))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def word_counts(marked: DataFrame) -> DataFrame:
    """(hash, class, c) of all words of training texts; the end has hash null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = ends = 0

        def merged() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            h, k, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
            return [(h[order][new], k[order][new], np.add.reduceat(n[order], new))]

        def out() -> pa.RecordBatch:
            h, k, n = held[0]
            return pa.RecordBatch.from_arrays([_long(h), pa.array(k.astype(np.int32)), pa.array(n)], ["hash", "class", "c"])

        for batch in batches:
            use = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            ends += int(use.sum())
            for t in texts(batch.column(0)):
                t = t.lowered()
                w = t.words()
                some = use[t.at:t.at + len(t)][w.doc]
                if not some.any():
                    continue
                h, first, n = np.unique(w.hashes[some], return_index=True, return_counts=True)
                held.append((h, suffix_class(t, w)[some][first], n.astype(np.int64)))
                size += len(h)
                if size > FLUSH:
                    held[:] = merged()
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield out()
                        held.clear()
                        size = 0
        if held:
            held[:] = merged()
            yield out()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int32()),
                                              pa.array([ends], pa.int64())], ["hash", "class", "c"])

    return marked.select("_text", "_held").mapInArrow(run, "hash long, class int, c long") \
        .groupBy("hash").agg(F.min("class").alias("class"), F.sum("c").alias("c"))


def _train(marked: DataFrame, units: Units, model: Model, counts: np.ndarray) -> Model:
    """One round: every task learns from its texts, then parameters are averaged by tokens."""
    shared = marked.sparkSession.sparkContext.broadcast((units, model.flat, counts))
    width = 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, flat, counts = shared.value
        trainer = Trainer(Model(flat), counts, 1 + TaskContext.get().partitionId())
        for batch in batches:
            use = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for t in texts(batch.column(0)):
                t = t.lowered()
                seq, doc, _ = units.sequence(t, t.words())
                trainer.learn(seq, doc, use[t.at:t.at + len(t)])
        if trainer.tokens:
            padded = np.zeros(-(-Model.SIZE // width) * width)
            padded[:Model.SIZE] = trainer.m.flat
            rows = len(padded) // width
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows, dtype=np.int32)), pa.array(np.full(rows, float(trainer.tokens))),
                 pa.ListArray.from_arrays(pa.array((np.arange(rows + 1) * width).astype(np.int32)), pa.array(padded))],
                ["part", "tokens", "x"])

    parts = marked.select("_text", "_held").mapInArrow(run, "part int, tokens double, x array<double>")
    total = parts.select("part", "tokens", F.posexplode("x").alias("i", "v")).groupBy("part", "i") \
        .agg((F.sum(F.col("tokens") * F.col("v")) / F.sum("tokens")).alias("v")).toArrow()
    if not total.num_rows:
        return model
    flat = np.zeros(-(-Model.SIZE // width) * width, np.float32)
    flat[total["part"].to_numpy().astype(np.int64) * width + total["i"].to_numpy()] = total["v"].to_numpy()
    return Model(flat[:Model.SIZE].copy())


def score(docs: DataFrame, *, text: str = "text", key: str = "doc_id", fold: int = 10, rounds: int = ROUNDS,
          head: int = HEAD) -> DataFrame:
    """One row per document with its unigram and model scores.

    Learns from documents whose crc32 of the key as text is not divisible by
    ``fold``. Returns ``key``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (sum of
    log10 of smoothed unigram shares) and ``score`` (the model's log10 probability
    of the text). A null text is empty and has one token; a null key counts as
    empty text for the fold; repeated rows are scored and learnt from each; an
    empty table gives no rows. Other columns are dropped.
    """
    spark = docs.sparkSession
    marked = _marked(docs, text, key, fold)
    counts = settled(word_counts(marked), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = counts.where("hash IS NULL").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    best = frequent(counts.where("hash IS NOT NULL"), "c", head).toArrow()
    best = best.take(np.lexsort((best["hash"].to_numpy(), -best["c"].to_numpy())))
    hashes = best["hash"].to_numpy().astype(np.int64).view(np.uint64)
    c = best["c"].to_numpy().astype(np.float64)
    order = np.argsort(hashes)
    top = np.argsort(hashes[:TOP])
    units = Units(hashes[:TOP][top], 1 + top)
    sums = counts.where("hash IS NOT NULL").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).toArrow()
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    mass[sums["class"].to_numpy()], kinds[sums["class"].to_numpy()] = sums["c"].to_numpy(), sums["n"].to_numpy()
    own = best["class"].to_numpy()[:TOP]
    mass -= np.bincount(own, c[:TOP], CLASSES)
    kinds -= np.bincount(own, minlength=CLASSES)
    unit_counts = np.concatenate([[ends], np.zeros(TOP), mass])
    unit_counts[1:1 + len(c[:TOP])] = c[:TOP]
    share = np.log10(mass + ADD * kinds + ADD)  # of one unseen word as well
    model = Model.start(unit_counts)
    for _ in range(rounds if n else 0):
        model = _train(marked, units, model, unit_counts)
    shared = spark.sparkContext.broadcast((units, model.flat, hashes[order], np.log10(c + ADD)[order], share))
    end = float(np.log10(ends + ADD))
    seen_end = int(ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, flat, hashes, logs, share = shared.value
        model = Model(flat)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for t in texts(batch.column(1)):
                part = slice(t.at, t.at + len(t))
                t = t.lowered()
                w = t.words()
                seq, doc, place = units.sequence(t, w)
                k = len(t)
                at, known = find(hashes, w.hashes)
                lg = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
                rest = seq[place] > TOP  # words that are not units of their own
                base = np.bincount(w.doc, lg, k) + end
                model_score = np.bincount(doc, model.log10(seq, doc), k) + np.bincount(
                    w.doc[rest], lg[rest] - share[seq[place][rest] - 1 - TOP], k)
                ids = row + np.arange(k)
                row += k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), *(batch.column(i).slice(part.start, k) for i in (0, 2)), pa.array(np.diff(w.first) + 1),
                     pa.array(np.bincount(w.doc[known], minlength=k) + seen_end), pa.array(base), pa.array(model_score),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
                d, h = w.doc[~known], w.hashes[~known]
                if len(d):
                    order = np.lexsort((h, d))
                    d, h = d[order], h[order]
                    new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
                    m = len(new)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[d[new]]), pa.nulls(m, kind), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()),
                         pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), _long(h[new]),
                         pa.array(np.diff(np.r_[new, len(d)]).astype(np.int64))], names)

    from pyspark.sql.pandas.types import to_arrow_type

    field = marked.schema["_key"].dataType
    kind = to_arrow_type(field)
    names = ["row", "key", "held_out", "n_tokens", "n_known", "base", "model", "hash", "times"]
    found = settled(marked.select("_key", "_text", "_held").mapInArrow(
        run, f"row long, key {field.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, "
             "model double, hash long, times long"), "scores")
    rare = found.where("hash IS NOT NULL").select("row", "hash", "times") \
        .join(counts.where("hash IS NOT NULL").select("hash", "c"), "hash", "left") \
        .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("more"),
                            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("seen"))
    more = F.coalesce("more", F.lit(0.0))
    size = float(np.log10(n + ADD * (v + 1)))
    return found.where("n_tokens IS NOT NULL").drop("hash", "times").join(rare, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("model") + more).alias("score"))

"""Quality rules: counts over whole texts and a hashed n-gram likelihood ratio.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials
over the buckets, of trusted documents and of the whole corpus, give each n-gram
a log-likelihood ratio; a document's score is their mean over all its n-grams.
Markup, shouting, tables and repetition are rare among trusted documents and
pull the mean down, whatever the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.sample import by_hash
from fabspark.llm.text import Texts, Words, distinct, mix, span_hashes, texts

BUCKETS = 1 << 13
TRUSTED_DOCS = 20_000  # bound of the trusted sample; every row counts for the corpus
SMOOTHING = 8.0  # n-grams a bucket
THRESHOLD = -0.055  # natural logs per n-gram

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PAIR = np.uint64(0xD6E8FEB86659FD93)  # fixed values: odd multipliers
_TRIPLE = np.uint64(0xA0761D6478BD642F)


def word_pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each two neighbouring words."""
    doc = w.doc
    same = doc[1:] == doc[:-1]
    return doc[:-1][same], mix(w.hashes[:-1] * _PAIR + w.hashes[1:])[same]


def grams(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of all words and word pairs."""
    doc, pair = word_pairs(w)
    return (np.concatenate([w.doc, doc]),
            (np.concatenate([w.hashes, pair]) % np.uint64(buckets)).astype(np.int64))


def repeated_words(w: Words) -> np.ndarray:
    """Words of each text in three-word windows that occur twice or more in it."""
    n = len(w.first) - 1
    if len(w.hashes) < 3:
        return np.zeros(n, np.int64)
    doc, h = w.doc, w.hashes
    at = np.flatnonzero(doc[2:] == doc[:-2])
    window = mix(mix(h[at] * _PAIR + h[at + 1]) * _TRIPLE + h[at + 2])
    order = np.argsort(window, kind="stable")
    order = order[np.argsort(doc[at][order], kind="stable")]
    d, v = doc[at][order], window[order]
    same = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    again = np.zeros(len(at), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[at[again] + k] = True
    return np.bincount(doc[covered], minlength=n)


def repeated_lines(t: Texts, starts: np.ndarray) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line of it."""
    ends = np.flatnonzero(t.data == 10)
    ends = np.unique(np.concatenate([ends, t.offsets[1:][np.diff(t.offsets) > 0]]))  # a text's end ends a line
    if not len(ends):
        return np.zeros(len(t), np.int64)
    doc = np.minimum(np.searchsorted(t.offsets, ends, "right") - 1, len(t) - 1)
    # A position that is both a newline of one text and the end of the one before it ends two lines; the empty
    # one in front of the newline has no word, so one entry is enough.
    begins = np.concatenate([[0], ends[:-1] + (t.data[ends[:-1]] == 10)])
    begins = np.minimum(begins, ends)
    doc = np.searchsorted(t.offsets, begins, "right") - 1
    filled = np.searchsorted(starts, ends) > np.searchsorted(starts, begins)
    begins, ends, doc = begins[filled], ends[filled], doc[filled]
    if not len(ends):
        return np.zeros(len(t), np.int64)
    base = int(begins[0])
    hashes = span_hashes(t.data[base:int(ends[-1])], begins - base, ends - base)
    once, _ = distinct(doc, hashes)
    return np.bincount(doc, minlength=len(t)) - np.bincount(once, minlength=len(t))


@dataclass
class Ratio:
    """Log-likelihood ratio of each bucket, trusted over corpus."""

    weights: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Mean over a text's n-grams; 0 without any."""
        n = len(w.first) - 1
        doc, bucket = grams(w, len(self.weights))
        total = np.bincount(doc, self.weights[bucket], n)
        return total / np.maximum(np.bincount(doc, minlength=n), 1)


def fit(docs: DataFrame, trusted: DataFrame, *, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS,
        trusted_docs: int = TRUSTED_DOCS, smoothing: float = SMOOTHING) -> Ratio:
    """Counts of all n-grams of the corpus and of trusted documents.

    ``trusted`` has the keys of trusted documents; of more than ``trusted_docs``
    the ones of smallest hash are used, so the broadcast list has a fixed bound.
    Every document counts for the corpus. Tasks add up their buckets before the
    shuffle: what moves is ``buckets`` rows a task. With no documents or none
    trusted, all ratios are 0.
    """
    sample = by_hash(trusted.select(F.col(f"`{key}`").alias("_key")).where("_key IS NOT NULL").distinct(), "_key", trusted_docs)
    marked = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")) \
        .join(F.broadcast(sample.withColumn("_trusted", F.lit(True))), "_key", "left") \
        .select("_text", F.coalesce("_trusted", F.lit(False)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for t in texts(batch.column(0)):
                doc, bucket = grams(t.words(), buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[flags[t.at:t.at + len(t)][doc]], minlength=buckets)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(x[some]) for x in total)],
                                         ["bucket", "corpus", "trusted"])

    rows = marked.mapInArrow(count, "bucket int, corpus long, trusted long") \
        .groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted")).toArrow()
    total = np.zeros((2, buckets))
    total[:, rows["bucket"].to_numpy()] = rows["corpus"].to_numpy(), rows["trusted"].to_numpy()
    return Ratio(ratios(total[0], total[1], smoothing))


def ratios(corpus: np.ndarray, trusted: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of trusted over corpus share; ``smoothing`` n-grams a bucket are added to the trusted ones as the
    corpus has them, so few trusted n-grams give ratios near 0. 0 where the corpus has none."""
    if not corpus.any():
        return np.zeros(len(corpus))
    share = corpus / corpus.sum()
    prior = smoothing * len(corpus)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(share > 0, np.log((trusted + prior * share) / (trusted.sum() + prior) / share), 0.0)


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def judge(docs: DataFrame, ratio: Ratio, *, text: str = "text", key: str = "doc_id",
          keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with its counts, ratio score and verdict.

    Returns ``key`` and the columns ``keep`` as they are, ``n_words``, ``word_chars`` (code points in words),
    ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines``, ``n_repeat_words``, ``score``,
    ``base_failed`` (under 50 words, or over half of them in repeated three-word
    windows) and ``kept``: the base rules hold and the score is at least
    ``threshold``. A null text has no words and fails; repeated rows are judged
    each; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratio.weights)
    keep = [key] + [c for c in keep or [] if c != key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ratio(shared.value)
        for batch in batches:
            for t in texts(batch.column(len(keep))):
                w = t.words()
                inside = np.zeros(len(t.data) + 1, np.int8)
                np.add.at(inside, w.starts, 1)
                np.add.at(inside, w.ends, -1)
                inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
                out = [np.diff(w.first), t.per_text(inside & ((t.data & 0xC0) != 0x80)), t.per_text(_SYMBOL[t.data]),
                       repeated_lines(t, w.starts), repeated_words(w)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(t.at, len(t)) for i in range(len(keep))),
                     *(pa.array(x.astype(np.int64)) for x in out), pa.array(model.scores(w))], names)

    names = keep + [c.split()[0] for c in COUNTS.split(", ")]
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("_text")) \
        .mapInArrow(run, f"{kept}, {COUNTS}") \
        .withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))

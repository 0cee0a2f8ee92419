"""Packing: ids as the tokenizers library gives them, windows by exhaustive search, no gaps and no padding."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from fabspark.llm import packing
from llm_cases import edge, edge_rows, none
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = packing.read_vocabulary(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_library(own):
    code = packing.encoder(VOCABULARY, P.PATTERN)
    random.seed(3)
    some = ["".join(random.choice("aab cd  e\n\t'sré日🙂​\x1c\x85\xa0　.,!12\x00<|") for _ in range(random.randint(0, 50)))
            for _ in range(4000)]
    some += ["a" * 20000, " " * 5000 + "x", "日本" * 2000, "don't we'll I'M", "<|endoftext|> a", ""]
    for t in some:
        assert [*code.encode_ordinary(t), 1] == own(t)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.encoder(packing.read_vocabulary(P.path("word_bpe_49k.json")), P.PATTERN)


def test_fill_comes_as_close_as_any_multiset():
    random.seed(1)
    for _ in range(400):
        items = [random.randint(1, 40) for _ in range(random.randint(0, 9))]
        room = random.randint(0, 90)
        best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= room)
        counts = Counter(items)
        got, chosen = packing.fill(counts, sorted(counts, reverse=True), room)
        assert got == best == sum(n * c for n, c in chosen)
        assert all(c <= counts[n] for n, c in chosen)


def test_windows_use_every_piece_once_and_leave_no_full_window():
    random.seed(2)
    for size in (8, 64, 2048):
        for _ in range(30):
            counts = Counter(random.randint(1, size) for _ in range(random.randint(0, 300)))
            counts.update({random.randint(1, size): random.choice([5, 1000, 10 ** 12])})
            made, aside = packing.windows(dict(counts), size)
            used = Counter(aside)
            for times, window in made:
                assert sum(n * c for n, c in window) == size
                used.update({n: c * times for n, c in window})
            assert used == counts
            if len(aside) < 8:  # no multiset with the longest of those set aside is a window: the sums say so
                small = [n for n, c in aside.items() for _ in range(min(c, size // n))][:12]
                assert size not in {sum(c) for k in range(1, len(small) + 1) for c in combinations(small, k)} or size > 64


def verify(rows, size):
    """Sequences without gaps, documents whole; returns padding."""
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    pad = 0
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= size
        pad += 0 if at & (at - 1) == 0 else size - at
    return pad, docs


@pytest.mark.parametrize("size", [16, 2048])
def test_pack_against_the_library(spark, own, size):
    rows = [(k, t) for k, t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10 ** 6 + i, t) for i, (_, t, *_) in enumerate(edge_rows()) if t is None or len(t) < 300_000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = packing.pack(df, VOCABULARY, P.PATTERN, size=size, ids=True)
    got = out.collect()
    pad, docs = verify(got, size)
    assert pad == 0
    assert set(docs) == {k for k, _ in rows}
    for k, t in rows:
        ids, at = np.array(own(t), "<u4"), 0
        for r in sorted(docs[k], key=lambda r: r.start):
            part = ids[at:at + r.length].tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(part), part)
            at += r.length
        assert at == len(ids)
    plain = packing.pack(df, VOCABULARY, P.PATTERN, size=size)
    assert plain.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = packing.sequences(out).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in got)
    assert all(len(r.ids) == 4 * r.length for r in whole)


def test_a_hot_length_is_cut_without_padding(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b " * 700).alias("text"))
    pad, docs = verify(packing.pack(df.repartition(7), VOCABULARY, P.PATTERN).collect(), 2048)
    assert pad == 0 and len(docs) == 3000


def test_odd_rows(spark):
    out = packing.pack(edge(spark), VOCABULARY, P.PATTERN)
    got = out.collect()
    assert sum(r.start == 0 for r in got) == len(edge_rows())
    assert verify(got, 2048)[0] == 0
    assert packing.pack(none(spark), VOCABULARY, P.PATTERN).collect() == []
    assert all(r.length == r.doc_tokens == 1 for r in got if r.doc_id in (0, 1))

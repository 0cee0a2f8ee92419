"""The pipeline's stages, each against a plain version over what it was given."""

import hashlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
import pytest
from fabspark.llm import pii
from fabspark.llm.bpe import Coder, read_ranks
from fabspark.session import settled
from llm_cases import near_groups, personal, quality, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    df, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        new = settled(stage(spark, df, SF), "test")
        out.append((name, df, new))
        df = new
    return {name: (a.collect(), b.collect()) for name, a, b in out}


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality rules", "minhash near-dedup", "pii", "source mix", "byte-level bpe"]
    for name, (_, out) in stages.items():
        if name != "byte-level bpe":
            assert list(out[0].asDict()) == P.COLUMNS


def test_quality_stage(spark, stages):
    given, left = stages["quality rules"]
    kept = {r.doc_id for r in left}
    for r in given:
        n = quality(r.text)
        if n[0] < 50 or 100 * n[4] > 50 * n[0]:
            assert r.doc_id not in kept
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    fine = [r.doc_id for r in given if r.doc_id in good and quality(r.text)[0] >= 50 and 2 * quality(r.text)[4] <= quality(r.text)[0]]
    assert np.mean([d in kept for d in fine]) >= 0.95


def test_duplicates_stage(stages):
    given, left = stages["minhash near-dedup"]
    groups = near_groups([(r.doc_id, r.text) for r in given])
    assert sorted(r.doc_id for r in left) == sorted({c for _, c in groups.values()})


def test_privacy_stage(stages):
    given, left = stages["pii"]
    out = {r.doc_id: r for r in left}
    assert len(out) == len(given)
    for r in given:
        t, spans, end = "", personal(r.text), 0
        for s, k, e in spans:
            if s >= end:
                t += r.text[end:s] + pii.MARKS[k]
            end = max(end, e)
        t += r.text[end:]
        assert out[r.doc_id].n_chars == len(out[r.doc_id].text)
        if not any(c.isdigit() or c == "@" for c in t):
            assert out[r.doc_id].text == t
        assert not personal(out[r.doc_id].text)


def test_mixing_stage(stages):
    given, left = stages["source mix"]
    size = {r.doc_id: len(words(r.text)) for r in given}
    times = Counter(r.doc_id for r in left)
    assert set(times) <= set(size) and max(times.values()) <= 3
    total = sum(size.values())
    assert abs(sum(size[d] * n for d, n in times.items()) - total) <= 0.15 * total


def test_token_stage(stages):
    given, out = stages["byte-level bpe"]
    coder = Coder(read_ranks(P.VOCABULARY), P.public_tokenizers.PATTERN)
    ids = {r.doc_id: coder.encode(r.text) for r in given}
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in given)
    for r in out:
        assert bytes(r.ids) == ids[r.doc_id]
        assert r.ids_sha256 == hashlib.sha256(ids[r.doc_id]).hexdigest()

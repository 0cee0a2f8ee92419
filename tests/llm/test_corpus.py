"""Operators over the whole corpus, against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from fabspark.llm import classifier, components, flatgraph, lbl, minhash, mixing
from fabspark.llm.registry import table
from fabspark.session import settled
from llm_cases import LOWER, crc, edge, edge_rows, near_groups, none, words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def copies(seed, n):
    """Random texts and near copies of some of them."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(random.choice(vocabulary) for _ in range(random.randint(30, 80))) for _ in range(n)]
    for i in range(n):
        if i % 3 == 1:
            w = texts[i - 1].split()
            for _ in range(random.randint(0, 6)):
                w[random.randrange(len(w))] = random.choice(vocabulary).upper()
            texts[i] = " ".join(w)
    return texts


def test_components(spark):
    random.seed(1)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(120)]
    links += [(i, i + 1) for i in range(300, 380)] + [(None, 3), (4, 4)]  # a long path, a null, a loop
    df = spark.createDataFrame(links, "a long, b long")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {x: find(x) for x in root}
    assert components.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [500_000, 0])
def test_components_take_few_jobs_and_go_on(spark, monkeypatch, limit):
    """A path against the order of its keys, a star and a ring; then links between them and to new nodes."""
    monkeypatch.setattr(components, "BROADCAST_NODES", limit)
    written = []
    monkeypatch.setattr(components, "settled", lambda df, name="t": written.append(name) or settled(df, name))
    links = [(1000 - i, 999 - i) for i in range(64)] + [(500, i) for i in range(100, 140)] \
        + [(200 + i, 200 + (i + 1) % 50) for i in range(50)]
    df = spark.createDataFrame(links, "a long, b long")
    groups = settled(components.components(df), "groups")
    want = {x: 936 if x > 900 else 100 if x == 500 or x < 140 else 200 for link in links for x in link}
    assert {r.node: r.component for r in groups.collect()} == want
    assert groups.count() == len(want)
    assert len(written) <= 20  # alternating stars wrote a table of eleven shuffles for each of many rounds
    more = spark.createDataFrame([(950, 120), (3000, 2000), (2000, 230), (4000, 4001)], "a long, b long")
    got = components.joined(groups, more).collect()
    want = {x: 100 if c == 936 else c for x, c in want.items()} | {2000: 200, 3000: 200, 4000: 4000, 4001: 4000}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    same = components.joined(groups, more.limit(0))
    assert sorted(same.collect()) == sorted(groups.collect())


def test_near_duplicates_equal_all_pairs(spark):
    texts = copies(3, 240)
    texts += [texts[0]] * 3 + [texts[1].upper()] + ["", None, " ", "lone", "lone", "LONE two"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == near_groups(rows)


def test_a_hot_group_of_near_copies(spark):
    """One bucket over many partitions: its copies are still found together."""
    random.seed(8)
    base = [f"w{random.randrange(500)}" for _ in range(100)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(random.randint(0, 5)):
            w[random.randrange(100)] = f"z{random.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == {k: c for k, (_, c) in near_groups(rows).items()}


def star(seed, copies):
    """An original of 200 words and edits of it, each near the original (Jaccard 0.82) but not near another (0.69)."""
    random.seed(seed)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, copies + 1):
        w = list(base)
        for j, k in enumerate(random.sample(range(0, 200, 2), 10)):
            w[k] = f"z{i}_{j}"
        rows.append((i, " ".join(w)))
    return rows


def test_a_star_of_near_copies(spark):
    """Copies linked to their original alone meet it in buckets far larger than their neighbours."""
    df = spark.createDataFrame(star(12, 2000), "doc_id long, text string").repartition(7)
    left = [r.doc_id for r in minhash.near_duplicates(df).collect() if r.component_id]
    assert len(left) <= 3  # a pair at 0.817 shares no table with probability 0.0003


def test_stars_in_one_bucket_without_a_common_hub(spark):
    """Two originals in the same buckets: what the hub leaves is joined on rare shingles."""
    rows = star(13, 600)
    other = rows[0][1].split()
    for k in range(1, 200, 14):  # 15 words: not near the first original
        other[k] = f"y{k}"
    rows.append((10_000, " ".join(other)))
    random.seed(14)
    for i in range(10_001, 10_301):
        w = list(other)
        for j, k in enumerate(random.sample(range(0, 200, 2), 10)):
            w[k] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    want = {k: 0 if k < 10_000 else 10_000 for k, _ in rows}
    assert sum(got[k] != want[k] for k in want) <= 2 and all(got[k] in (want[k], k) for k in want)


def rare_rows(spark, sets):
    return spark.createDataFrame([(i, i, sorted(x)) for i, x in enumerate(sets)], "id long, group long, set array<bigint>")


@pytest.mark.parametrize("percent", [80, 50])
def test_rare_pairs_lose_no_link(spark, percent):
    """Sets near the threshold, of very short ones too: every linked pair is among the candidates."""
    random.seed(15)
    base = [set(random.sample(range(300), n)) for n in (1, 2, 3, 4, 9, 40, 41)]
    sets = {frozenset(x) for x in base}
    for _ in range(160):
        x = set(random.choice(base))
        for _ in range(random.randint(0, 1 + len(x) // 6)):
            x ^= {random.randrange(300)}
        sets |= {frozenset(x)} if x else set()
    sets = sorted(map(sorted, sets))
    got = {(r.a, r.b) for r in minhash.rare_pairs(rare_rows(spark, sets), percent).collect()}
    want = {(i, j) for j in range(len(sets)) for i in range(j)
            if 100 * len(set(sets[i]) & set(sets[j])) >= percent * len(set(sets[i]) | set(sets[j]))}
    assert want and want <= got
    same = rare_rows(spark, sets).withColumn("group", F.lit(1))
    assert minhash.rare_pairs(same, percent).count() == 0
    assert minhash.rare_pairs(same.limit(0), percent).count() == 0


def test_rows_of_a_crowd_grow_with_its_members(spark, monkeypatch):
    """Twice the members of one star make about twice the rows of the widest step, not four times."""
    rows, real = [], minhash.settled

    def counted(df, name="t"):
        out = real(df, name)
        if name == "starts":
            rows[-1] += out.count()
        return out

    monkeypatch.setattr(minhash, "settled", counted)
    for m in (500, 1000, 2000):
        random.seed(16)
        sets = [sorted(set(range(199)) - set(random.sample(range(199), 20)) | {10 ** 6 + 20 * i + k for k in range(20)})
                for i in range(m)]
        rows.append(0)
        minhash.rare_pairs(rare_rows(spark, sets))
    assert rows[0] > 0 and all(b <= 2.3 * a for a, b in zip(rows, rows[1:]))


def test_ends_of_pairs_are_counted_without_doubling_them(spark):
    pairs = spark.createDataFrame([(1, i) for i in range(2, 40)] + [(2, 3), (3, 50)], "a long, b long")
    ends = minhash._ends(pairs)
    assert "Generate" not in ends._jdf.queryExecution().executedPlan().toString()
    got = ends.groupBy("id").agg(F.sum("degree").alias("degree"))
    want = Counter(x for r in pairs.collect() for x in r)
    assert {r.id: r.degree for r in got.collect()} == want


def test_near_duplicates_on_odd_rows(spark):
    rows = edge_rows()
    got = minhash.near_duplicates(edge(spark)).collect()
    assert len(got) == len(rows)
    own = near_groups([(k, t) for k, t, *_ in rows if k is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == own[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    left = minhash.deduplicated(edge(spark))
    assert left.columns == edge(spark).columns
    keys = Counter(r.doc_id for r in left.select("doc_id").collect())
    assert keys == Counter({k: 1 for k, (_, c) in own.items() if c == k} | {None: 2})
    assert minhash.near_duplicates(none(spark)).count() == 0
    assert minhash.deduplicated(none(spark)).count() == 0


def test_tensored_tables_join_two_collections(spark):
    nodes = spark.createDataFrame([(1, 5, list(range(14))), (2, 5, list(range(13)) + [99])], "id long, n long, keys array<long>")
    rows = minhash._tables(nodes, 14)
    assert rows.count() == 2 * 91
    assert rows.groupBy("key").count().where("count = 2").count() == 13 * 12 // 2


def plain_targets(sizes, weights, cap=3.0):
    """Share again and again until no source is above its cap."""
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[s] for s in free)
        share = {s: left * weights[s] / weight for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def source_key(s):
    return (s is None, s or "")


@pytest.mark.parametrize(("seed", "block", "off"), [(1, 16, 300), (2, 256, 40)])
def test_targets_and_words_taken(spark, seed, block, off):
    """Off by less than the smallest document of the last block that is not taken: here 300 or 40 words."""
    random.seed(seed)
    names = ["a", "B", "é", "z", "c1", "c2", None]
    rows = [(i, "w " * random.choice([0, 1, 5, 40, 300]), names[min(int(random.expovariate(0.6)), 6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.taken(df, mixing.cyclic_weights(df), block_rows=block).collect()
    size = {i: len(words(t)) for i, t, _ in rows}
    src = {i: s for i, _, s in rows}
    sizes = Counter()
    for i in size:
        sizes[src[i]] += size[i]
    order = sorted(sizes, key=source_key)
    goal = plain_targets(dict(sizes), {s: i % 3 + 1 for i, s in enumerate(order)})
    taken = Counter()
    for r in out:
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[src[r.doc_id]])
        assert math.isclose(r.target, goal[src[r.doc_id]], rel_tol=1e-9)
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
        taken[src[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= off
    again = {r.doc_id: r.taken for r in mixing.taken(df.repartition(2), mixing.cyclic_weights(df), block_rows=block).collect()}
    assert again == {r.doc_id: r.taken for r in out}


def test_units_are_dealt_out_exactly(spark):
    df = spark.createDataFrame([(i, f"s{i % 5}", 3) for i in range(2000)], "doc_id long, source string, size long")
    p = mixing.plan(df, mixing.cyclic_weights(df), shards=6, block_rows=8)
    per = p.sources.collect()
    total, shards = sum(r.units for r in per), Counter()
    for r in per:
        assert len(r.bounds) == 6 and r.bounds == sorted(r.bounds) and r.bounds[-1] == r.units
        for i in range(6):
            shards[i] += r.bounds[i] - (r.bounds[i - 1] if i else 0)
    assert sum(shards.values()) == total and max(shards.values()) - min(shards.values()) <= 3
    copies_ = mixing.mix(df, p).collect()
    assert {r.shard for r in copies_} == set(range(6))
    assert len({(r.doc_id, r.place) for r in copies_}) == len(copies_)


def test_hypergeometric_quotas(spark):
    """Many trees: the mean and spread of a source's share on the left are those of drawing without replacement."""
    per = spark.createDataFrame([("a", 6), ("b", 14)], "source string, units long")
    left = [{r.source: r.bounds[0] for r in mixing._dealt(per, 2, seed).collect()}["a"] for seed in range(24)]
    mean, var = 10 * 6 / 20, 10 * 0.3 * 0.7 * 10 / 19
    assert abs(np.mean(left) - mean) < 4 * math.sqrt(var / 24) and 0.3 * var < np.var(left) < 2.5 * var


def test_a_long_document_leaves_its_words_to_later_blocks(spark):
    """What a block with one very long document cannot fill is filled from the others."""
    rows = [(i, "a", 100) for i in range(300)] + [(300, "a", 60_000)] + [(1000 + i, "b", 100) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    weights = spark.createDataFrame([("a", 1.0), ("b", 8.0)], "source string, weight double")  # 20,000 and 160,000 words
    for seed in range(4):
        p = mixing.plan(df, weights, block_rows=150, shards=4, seed=seed)
        out = p.assign(df, "doc_id", "source").collect()
        for s, target in (("a", 20_000), ("b", 160_000)):
            assert sum(r["size"] * len(r._mix_shards) for r in out if r.source == s) == target
        assert all(0 <= x < 4 for r in out for x in r._mix_shards)


def test_mix_on_odd_rows(spark):
    out = mixing.taken(edge(spark), mixing.cyclic_weights(edge(spark))).collect()
    assert len(out) == len(edge_rows())
    assert mixing.taken(none(spark), mixing.cyclic_weights(none(spark))).count() == 0
    only = spark.createDataFrame([(1, "", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.taken(only, mixing.cyclic_weights(only)).collect()] == [0, 0]
    made = mixing.corpus(edge(spark), mixing.cyclic_weights(edge(spark)))
    assert set(edge(spark).columns) < set(made.columns)


def unigrams(rows, fold):
    counts = Counter()
    tokens = {}
    for i, (k, t, *_) in enumerate(rows):
        tokens[i] = [*words((t or "").translate(LOWER)), None]
        if (crc(k, fold) if k is not None else 0) != 0:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    out = defaultdict(list)
    for i, (k, *_) in enumerate(rows):
        out[k].append((len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n,
                       sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[i])))
    return out


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_scores_and_the_unigram_base(spark, head):
    df = table(spark, SF, "documents")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    own = unigrams(rows, 10)
    gain = []
    for r in lbl.score(df, head=head).collect():
        n, known, total, base = own[r.doc_id][0]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, crc(r.doc_id, 10) == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
        if r.held_out:
            gain.append(r.score - r.base_score)
    assert len(gain) > 5


def test_model_probabilities_add_up():
    rng = np.random.default_rng(0)
    m = lbl.Model.start(rng.integers(1, 50, lbl.OUTPUTS).astype(float))
    m.target[:] = rng.normal(0, 0.5, m.target.shape)
    seq, doc = np.zeros(lbl.OUTPUTS, np.int64), np.arange(lbl.OUTPUTS)
    seq[:] = np.arange(lbl.OUTPUTS)  # each text is one token: all have the same context
    assert math.isclose((10.0 ** m.log10(seq, doc)).sum(), 1.0, rel_tol=1e-5)


def test_training_learns_what_follows_what():
    """Units that alternate are told by the one before; a unigram model cannot."""
    seq = np.tile([1, 2], 20_000)
    doc = np.zeros(len(seq), np.int64)
    counts = np.zeros(lbl.OUTPUTS)
    counts[[1, 2]] = len(seq) / 2
    trainer = lbl.Trainer(lbl.Model.start(counts), counts, 1)
    for _ in range(5):
        trainer.learn(seq, doc, np.array([True]))
    assert trainer.m.log10(seq, doc)[1:].mean() > np.log10(0.5) / 2


def test_scores_on_odd_rows(spark):
    rows = edge_rows()
    own = unigrams(rows, 10)
    got = lbl.score(edge(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r.n_tokens == n and r.n_known == k and math.isclose(r.base_score, b, rel_tol=1e-9) for n, k, _, b in own[r.doc_id])
    assert lbl.score(none(spark)).count() == 0


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    vectors, net = classifier.fit(docs, labels)
    out = {r.doc_id: r for r in classifier.predict(docs, vectors, net).collect()}
    assert len(out) == docs.count()
    right = []
    for r in labels.collect():
        o = out[r.doc_id]
        assert o.held_out == (crc(r.doc_id, 5) == 0) and 0 <= o.score <= 1 and o.predicted == int(o.score >= 0.3)
        if o.held_out:
            right.append(o.predicted == r.quality)
    assert len(right) > 50 and np.mean(right) >= 0.95


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(classifier.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (classifier.fit(docs, x)[1] for x in (labels, flipped))
    assert np.allclose(a.w1, b.w1) and a.temperature == b.temperature


def test_classifier_on_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1), (8, 0), (None, 1), (10, None)], "doc_id long, quality int")
    vectors, net = classifier.fit(edge(spark), labels)
    got = classifier.predict(edge(spark), vectors, net).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    vectors, net = classifier.fit(none(spark), labels.limit(0))
    assert {r.score for r in classifier.predict(edge(spark), vectors, net).collect()} == {0.5}


def plain_links(rows, cosine=0.98):
    fine = {}
    for k, label, v in rows:
        if k is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0):
            fine[k] = (label, np.array(v, np.float64) / np.linalg.norm(v))
    links = {k: set() for k in fine}
    for a in fine:
        for b in fine:
            if a < b and fine[a][0] == fine[b][0] and len(fine[a][1]) == len(fine[b][1]) and fine[a][1] @ fine[b][1] >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for k in fine:
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[k] = (len(links[k]), min(seen))
    return out


def vectors(seed, n=500, d=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(1, n):
        if rng.random() < 0.4:
            x[i] = x[rng.integers(0, i)] + rng.normal(scale=0.08, size=d)
    rows = [(i, int(rng.integers(0, 3)), x[i].astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, 1, rows[7][2]) for i in range(60)]  # copies
    hot = rng.normal(size=d)
    rows += [(2000 + i, 2, (hot + rng.normal(scale=0.05, size=d)).astype(np.float32).tolist()) for i in range(150)]
    return rows


@pytest.mark.parametrize("shard_size", [3000, 60])
def test_links_of_vectors(spark, shard_size):
    rows = vectors(4)
    rows += [(3000, 0, None), (3001, 0, []), (3002, 0, [0.0] * 24), (3003, 0, [None] * 24), (3004, 0, [math.nan] * 24),
             (3005, 0, [math.inf] * 24), (3006, None, rows[0][2]), (3007, 1, [1.0, 2.0]), (3008, 1, [1.0, 2.0])]
    rows += [rows[0]] * 2
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(4)
    got = flatgraph.near_duplicates(df, target=100, shard_size=shard_size).collect()
    assert len(got) == len(rows)
    own = plain_links(rows)
    found = sum(r.n_links for r in got if r.vec_id in own)
    exact = sum(own[r.vec_id][0] for r in got if r.vec_id in own)
    assert 0.97 * exact <= found <= exact
    wrong = 0
    for r in got:
        n, c = own.get(r.vec_id, (0, r.vec_id))
        assert r.n_links <= n and r.component_id >= c and r.kept == (r.component_id == r.vec_id)
        wrong += r.component_id != c
    assert wrong <= 0.02 * len(got)
    assert got[0].audit_recall >= 0.95


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert flatgraph.near_duplicates(df).count() == 0


def test_samples_and_heads(spark):
    from fabspark.llm.sample import by_hash, head

    df = spark.range(5000).withColumn("c", F.col("id") % 97 + 1)
    a, b = ({r.id for r in by_hash(d, "id", 300).collect()} for d in (df.repartition(7), df.repartition(2)))
    assert a == b and len(a) == 300
    assert by_hash(df.limit(20), "id", 300).count() == 20 and by_hash(df.limit(0), "id", 3).count() == 0
    some = [r.c for r in head(df, "c", 1000).collect()]
    assert 800 < len(some) <= 1000 and min(some) >= 98 - 20
    assert head(df, "c", 5000).count() == 5000 and head(df, "c", 10).count() == 0

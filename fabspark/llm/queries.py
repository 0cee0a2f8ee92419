"""The operators over the driver's tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fabspark.llm import bpe, classifier, collocations, conversations, flatgraph, lbl, licenses, minhash, mixing, packing, pii, rules, secret_scan
from fabspark.llm.registry import query, table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

WORDS = r"regexp_extract_all(lower_az, '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""WITH RECURSIVE w AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {WORDS} END AS w
    FROM (SELECT doc_id, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
          FROM documents)),
  s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w
          ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
  e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
  c AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
          AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  l AS MATERIALIZED (SELECT a, b FROM c UNION ALL SELECT b, a FROM c),
  r AS (SELECT doc_id AS node, doc_id AS root FROM documents
        UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node AND r.root < l.b)
SELECT d.doc_id, len(s.s) AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM documents d JOIN s USING (doc_id) JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = d.doc_id"""


@query("op2_minhash_near_dedup", OP2_SQL)
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return rules.judge(docs, rules.fit(docs, trusted))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN,
                      ids=False)



@query("op6_mix_sources")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.taken(docs, mixing.cyclic_weights(docs))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.scan(docs, pii.fit(docs)))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vectors, net = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.predict(docs, vectors, net)


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(table(spark, sf_dir, "documents"))


@query("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op1_license_scan", licenses.sql())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


@query("op11_pack_windows")
def op11_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = packing.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


OP13_SQL = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
  w AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
  g AS MATERIALIZED (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, any_value(w[i:i + m - 1]) AS ws,
      count(*)::BIGINT AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS k(m)
          WHERE len(w) >= m)
    GROUP BY lang, m, phrase),
  t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang),
  c AS MATERIALIZED (SELECT * FROM g WHERE f >= 30 AND m > 1),
  s AS (SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.f) // (l.f + r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
    JOIN g l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(c.ws[1:k], ' ')
    JOIN g r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(c.ws[k + 1:c.m], ' ')),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  o AS (SELECT lang, array_to_string(ws[i:i + q - 1], ' ') AS phrase, max(f) AS longer
    FROM (SELECT *, unnest(range(1, m - q + 2)) AS i FROM c, (VALUES (2), (3)) AS k(q) WHERE q < m) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS "rank", b.phrase, a, l, r, t.n, score
FROM b JOIN t USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY "rank" <= 2000"""


@query("op13_collocations", OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))

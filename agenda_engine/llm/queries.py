"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.llm import ann, bpe, clusters, lexical, packing, pii, quality, rules, secret_scan, simhash, suffix, tokens, toxicity

#: The folder of the tokenizer files, or None for the installed package's own.
TOKENIZERS: str | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """The place of a tokenizer file."""
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(make):
    """Registers a query under its function's name."""
    QUERIES[make.__name__] = make
    return make


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the SentencePiece model."""
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document an earlier one holds in passages of 50 bytes."""
    return suffix.deduplicate(table(spark, sf_dir, "documents")).drop("kept", "kept_text")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's base measurements and the current policy's verdict."""
    rows = rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rules.fails("base").alias("base_failed"), (~rules.fails(rules.CURRENT)).alias("kept"), "fail_bits",
    )


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and disclosing terms of every document."""
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of secrets of every document, and all spans with those of what it wraps."""
    return secret_scan.digests(secret_scan.secrets(table(spark, sf_dir, "documents")))


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds of sixteen centroids."""
    return clusters.assigned(table(spark, sf_dir, "embeddings")).drop("computed")


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents of the highest score of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op10_nearest"] = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v AS q, v AS c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op8_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts
  FROM w LEFT JOIN rep USING (r)
), b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_upper > 6 * word_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 10 * n_shouts > 3 * n_words THEN 64 ELSE 0 END) AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits FROM b
"""


def _centroid_sql(k: int, rounds: int) -> str:
    """Rounds of assignment and replacement, each spelled out."""
    far = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = [f"""c0 AS MATERIALIZED (SELECT n - 1 AS c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) AS n FROM v) WHERE n <= {k})"""]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, vec_id, v, min(t) AS t FROM (SELECT r, vec_id, v.v AS v, {{'d': {far}, 'c': c.c}} AS t FROM v, c{i} AS c) GROUP BY ALL)")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, i, sum(x)::BIGINT AS x, count(*) AS n FROM (SELECT t.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN (SELECT c, list((x - ((x % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c) AS m ON m.c = c.c)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), {", ".join(steps)}
SELECT vec_id, t.c::INTEGER AS cluster, t.d AS distance, (sum(t.d) OVER (PARTITION BY t.c))::BIGINT AS cluster_inertia, (sum(t.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} AS c ON c.c = t.c
"""


ORACLES["op12_centroids"] = _centroid_sql(16, 3)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op13_lexical"] = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents
), s AS (
  SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0
), q AS MATERIALIZED (
  SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark)) GROUP BY ALL
), p AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs
), m AS (
  SELECT r, doc_id, 75 + (25 * len(t) * docs) // terms AS m FROM d, s
), f AS (
  SELECT i, item_id, doc_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL
), k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""

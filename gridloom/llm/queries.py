"""The registered queries of this subpackage, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, language_id, minhash, packing, quality, secrets, token_file, topk, toxicity
from ._common import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def language_models(docs: DataFrame):
    """The models learnt from the rows that are not held out."""
    return language_id.fit(docs.filter(fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_models(docs))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "bits_per_char", "accepted")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), _pattern())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.filter(fold("doc_id", 5) != 0).select("doc_id", "toxic"))
    return toxicity.score(docs, index).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "evidence")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(fold("doc_id", 5) != 0).select("doc_id", "quality"))
    return quality.rate(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "expected_grade", "tail_prob", "selected")


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_file.fresh_path(spark, "op6")
    token_file.write_tokens(_table(spark, sf_dir, "documents"), path, _tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_file.read_tokens(spark, path)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), _pattern())


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1, window=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), digest_all=True)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_exact_top_k, op3_byte_bpe, op4_toxicity, op5_quality, op6_token_file, op7_secret_scan, op8_minhash_dedup, op9_packing, op10_exact_dedup)}

ORACLE_SQL = {
    "op2_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op8_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sh AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS s
  FROM w
), items AS (SELECT doc_id, unnest(s) AS x FROM sh),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN sh x ON x.doc_id = p.a JOIN sh y ON y.doc_id = p.b
  WHERE 100 * p.i >= 85 * (len(x.s) + len(y.s) - p.i)
), reach AS (
  SELECT a AS root, a AS node FROM links UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.node
), comp AS (SELECT root AS doc_id, min(node) AS c FROM reach GROUP BY 1)
SELECT sh.doc_id, CAST(len(sh.s) AS BIGINT) AS n_shingles, coalesce(comp.c, sh.doc_id) AS component_id, coalesce(comp.c, sh.doc_id) = sh.doc_id AS kept
FROM sh LEFT JOIN comp ON comp.doc_id = sh.doc_id
""",
    "op10_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
}

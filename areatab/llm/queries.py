"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areatab.llm import crosstok, decontaminate, dualtree, html, multiset, packing, phrases, pii, simhash, suffixes, tokens, toxicity, trie_bpe
from areatab.llm.common import read_table
from areatab.session import ensure_checkpoint_dir


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html.extract(read_table(spark, sf_dir, "pages"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words packed into bins of 2,048 by best fit without conflicts."""
    return packing.pack(packing.measured(read_table(spark, sf_dir, "documents")))


def pseudonymised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with format-preserving pseudonyms."""
    return pii.report(read_table(spark, sf_dir, "documents"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses as 400-byte strings that start elsewhere too."""
    found = suffixes.repeated_bytes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by the chain's marginals, and the offending offsets."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's multiset fingerprint, that of its edited text, and their likeness."""
    return multiset.edited(read_table(spark, sf_dir, "documents"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written bit-packed and read back."""
    return tokens.round_trip(read_table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32", "bucket", "block", "at")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and its group of near duplicates."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), F.col("component_id"))


def repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses as runs of 35 words that start elsewhere too."""
    found = phrases.repeated_words(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap benchmark items, with the best overlap of each pair."""
    return decontaminate.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def trie_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and decoded text, as digests."""
    return trie_bpe.digests(read_table(spark, sf_dir, "documents"), tokens.vocabulary("word_bpe_49k.json"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids of two tokenizers, aligned, with the counts of its links in all documents."""
    paths = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model")
    return crosstok.align(read_table(spark, sf_dir, "documents"), *paths)


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error, and the codebooks' digest."""
    return dualtree.compress(read_table(spark, sf_dir, "embeddings"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES = {
    "op1_html_main_text": _ready(main_texts),
    "op2_best_fit_packing": _ready(packed),
    "op3_pii_pseudonyms": _ready(pseudonymised),
    "op4_suffix_array_dedup": _ready(repeated_bytes),
    "op5_toxicity": _ready(toxic),
    "op6_multiset_fingerprints": _ready(fingerprints),
    "op7_token_ids": _ready(token_ids),
    "op8_simhash": _ready(near_duplicates),
    "op9_repeated_phrases": _ready(repeated_words),
    "op10_decontamination": _ready(leaks),
    "op11_dual_tree_codes": _ready(vector_codes),
    "op12_trie_bpe": _ready(trie_encoded),
    "op13_cross_tokenizer": _ready(aligned),
}

#: Every window of every text, counted; every part of a vector against every entry; the other operators are not expressible in SQL.
ORACLE_SQL: dict[str, str] = {
    "op11_dual_tree_codes": dualtree.oracle_sql(),
    "op4_suffix_array_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM d, unnest(range(0, length(h) // 2 - 399)) AS t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
mark AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM rep),
span AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM mark) GROUP BY r, g),
piece AS (
  SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS s, a AS e FROM span
  UNION ALL SELECT r, max(b), NULL FROM span GROUP BY r),
kept AS (
  SELECT piece.r, string_agg(substr(h, 2 * s + 1, 2 * (coalesce(e, length(h) // 2) - s)), '' ORDER BY s) AS k
  FROM piece JOIN d ON piece.r = d.r GROUP BY piece.r),
num AS (SELECT r, count(*) AS n, sum(b - a) AS m FROM span GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(m, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r LEFT JOIN num ON d.r = num.r
""",
    "op9_repeated_phrases": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS k FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, i + o AS p FROM rep, range(0, 35) AS t(o)),
word AS (SELECT r, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d),
kept AS (
  SELECT word.r, count(*) AS n, string_agg(x, ' ' ORDER BY word.p) AS s
  FROM word ANTI JOIN gone ON word.r = gone.r AND word.p = gone.p GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
""",
}

"""The numbered operators as queries, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from oslogs.llm import alignment, language_id, licenses, mixing, multi_index, order_minhash, packing, pair_index, spelling, token_counts, toxicity, va_file, wrapper
from oslogs.llm.common import fold, table

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document (``order_minhash.near_documents``: null, empty and repeated rows are defined there)."""
    return order_minhash.near_documents(table(spark, sf_dir, "documents"))


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces and places of every document (``packing.pack_documents``); a null text is its end token alone."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op3_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (``wrapper.main_text``); null html gives an empty text, repeated pages are no template."""
    return wrapper.main_text(table(spark, sf_dir, "pages"))


def op4_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document (``pair_index.digests``); a null text counts as empty."""
    return pair_index.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op7_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (``language_id.languages``): ``und`` for null and letterless texts; rows without an id are not learned from."""
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 4)
    network = language_id.fit(docs.where(F.col("doc_id").isNotNull() & (part != 2)))
    return language_id.languages(docs, network).select("doc_id", (part == 2).alias("held_out"), "lang_pred", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document (``token_counts.token_counts``); a null text has none."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector (``multi_index.near_vectors``); vectors that can't be compared link with nothing."""
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document (``toxicity.scores``), null and empty texts too; equal texts score alike."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.scores(docs, model).select("doc_id", held_out, "score", "predicted")


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License findings of every document (``licenses.license_summary``); a null text counts as empty."""
    return licenses.license_summary(table(spark, sf_dir, "documents"))


def op10_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best of every query (``va_file.top_k``); vectors that are null or not finite take no part."""
    vectors = va_file.integer_vectors(table(spark, sf_dir, "embeddings"))
    return va_file.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op11_fragment_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenizers in every document (``alignment.link_summary``); a null or empty text has zeros."""
    return alignment.link_summary(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.path(PIECE_FILE))


def op12_letter_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word (``spelling.variants``); null texts have no words."""
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents")))


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document (``mixing.scores``); a null text counts as empty, a null id as learned from."""
    return mixing.scores(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_order_minhash, op2_vector_packing, op3_wrapper_induction, op4_pair_index_bpe, op5_multi_index, op6_toxicity, op7_byte_gru, op8_token_counts, op9_license_rules, op10_va_file, op11_fragment_monoid, op12_letter_trie, op13_context_mixing)
}
ORACLE: dict[str, str] = {
    "op5_multi_index": """
        WITH RECURSIVE good AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x FOR x IN embedding IF x <> 0]) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
        FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id""",
    "op10_va_file": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op12_letter_trie": """
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents
        ), grouped AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
        ), bytes AS (
            SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM grouped
        ), hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
                   lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM bytes, crc
        ), slipped AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), cut AS (
            SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substr(word, 1, i - 1) || substr(word, i + 1) END AS part
            FROM (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words)
        ), near AS (
            SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (part)
            WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)
        ), ranked AS (
            SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM near
        ), classed AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
                   CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
        ), up(word, root, next) AS (
            SELECT word, word, form FROM classed
            UNION ALL SELECT u.word, c.word, c.form FROM up u JOIN classed c ON c.word = u.next
        )
        SELECT c.word, c.form, u.root, c.n, c.n_near, c.form_n FROM classed c JOIN up u ON u.word = c.word AND u.next IS NULL""",
}

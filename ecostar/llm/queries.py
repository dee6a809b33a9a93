"""One query per pipeline operator over the whole test tables, and the SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ecostar.llm import codes, exact, language, licenses, mixing, packing, simhash, tokenfiles, toxicity, urls, vectors, whitening, wrapper
from ecostar.llm.common import fold, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), ~toxicity.held_out("id"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf, "documents")).drop("text_key")


def op4_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages"), table(spark, sf, "labels"))


def op5_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.train(docs, ~fold(F.col("id"), 4, 2))
    found = language.predict(docs, model)
    return found.select("doc_id", fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), _tokenizer("byte_bpe_50k.json"), with_ids=False).drop("ids")


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).drop("copies", "text_key")


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    manifest, folder = tokenfiles.write_files(table(spark, sf, "documents"), _tokenizer("word_bpe_49k.json"))
    return tokenfiles.read_files(spark, manifest, folder)


def op10_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf, "documents"))


def op11_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.encode(table(spark, sf, "embeddings"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def op13_articles(spark: SparkSession, sf: str) -> DataFrame:
    return wrapper.articles(table(spark, sf, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_licenses, op3_simhash, op4_urls, op5_embeddings, op6_language, op7_packing, op8_mixing,
        op9_token_files, op10_exact, op11_codes, op12_whitening, op13_articles,
    )
}

ORACLE = {
    "op2_licenses": licenses.scan_sql(),
    "op4_urls": urls.tree_sql(),
    "op11_codes": codes.codes_sql(),
    "op10_exact": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)""",
}

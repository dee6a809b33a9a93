"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last
return rows of ``docs`` with the same columns, extra ones included; null texts count as
empty, repeated rows stay as many as the stage decides, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ecostar.llm import exact, mixing, packing, simhash, toxicity
from ecostar.llm.common import ascii_lower, drop_staged, staged, table
from ecostar.llm.queries import _tokenizer

# columns of the stages' own, which documents don't have
_ID, _DIGEST = "_stage_id", "_stage_digest"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below 0.5; fitted on the labelled documents outside the held-out fold."""
    source = table(spark, sf_dir, "documents")
    model = toxicity.train(source, table(spark, sf_dir, "labels"), ~toxicity.held_out("id"))
    return docs.filter(toxicity.scorer(spark, model)(F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text (A-Z lower-cased): the one with the largest doc_id; of repeated rows any, they are equal.

    Rows that share doc_id and text but differ elsewhere are copies too; the one with the
    least hash of the other columns stays.
    """
    kept = exact.exact_groups(docs).filter("kept").select(F.col("doc_id").alias(_ID), F.col("text_sha256").alias(_DIGEST)).distinct()
    marked = docs.withColumn(_DIGEST, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256))
    same = (marked["doc_id"].eqNullSafe(kept[_ID])) & (marked[_DIGEST] == kept[_DIGEST])
    left = marked.join(kept, same, "left_semi")
    return left.dropDuplicates(["doc_id", _DIGEST]).drop(_DIGEST)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with the least doc_id of each group of linked SimHash fingerprints; rows of one id are told apart by their texts."""
    groups = simhash.near_groups(docs)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(_ID), F.col("text_key").alias(_DIGEST)).distinct()
    same = docs["doc_id"].eqNullSafe(kept[_ID]) & (F.xxhash64(docs["text"]) == kept[_DIGEST])
    return docs.join(kept, same, "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes its document; of rows with equal id and text each as often as the most taken one."""
    taken = mixing.mix(docs).filter("copies > 0").groupBy(F.col("doc_id").alias(_ID), F.col("text_key").alias(_DIGEST))
    mixed = taken.agg(F.max("copies").alias("_stage_copies"))
    joined = docs.join(mixed, docs["doc_id"].eqNullSafe(mixed[_ID]) & (F.xxhash64(docs["text"]) == mixed[_DIGEST]))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_stage_copies"))).alias("_stage_copy")
    return joined.select(*[docs[c] for c in docs.columns], each).drop("_stage_copy")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces with their ids, as ``packing.pack`` gives them."""
    return packing.pack(docs, _tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained, iterative and sampling stages: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; a stage's input, if written here, goes when its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = staged(stage(spark, docs, sf_dir), name)
        if hasattr(docs, "staged_path"):
            drop_staged(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)

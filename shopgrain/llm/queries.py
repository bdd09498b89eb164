"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import (
    alignment, bpe, hard_negatives, language, mixing, near_dedup, passages, quality, secret_scan, sharding, token_files, topk, toxicity,
)
from shopgrain.llm.frames import documents, fold

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir, "doc_id", "text")).drop("text")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [r.kind for r in secret_scan.BASE]
    spans = F.col("secret_spans")

    def n_of(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [n_of(kind).alias(f"n_{kind}") for kind in base]
    return found.select(
        "doc_id", *counts,
        F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(spans).alias("spans"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source").select(
        "doc_id", "lang", "source", mixing.topic(F.col("text")).alias("topic"),
        mixing.tokens(F.col("text")).alias("n_words"))
    found = mixing.sample(docs, ["source", "lang", "topic"])
    return found.select("doc_id", "source", "lang", "topic", "n_words",
                        F.round("inclusion", 6).alias("inclusion"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = bpe.encode(documents(spark, sf_dir, "doc_id", "text"), path).drop("text")
    back = bpe.decode(coded, path)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    models = language.train_on_folds(docs)
    found = language.predict(docs.drop("lang"), models)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score",
                        "rejected")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "class_id", "n_in_class")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.apply_rules(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_document_tokens(documents(spark, sf_dir, "doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.train(toxicity.labelled(docs, labels, ~held_out, with_id=True))
    found = toxicity.passages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        F.size("passages").alias("n_passages"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir, "doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
            F.col("label")).alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By count (`rows`): equal texts may lie in several shards, a group can exceed a shard."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = documents(spark, sf_dir, "doc_id", "text", "source").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"))
    found = sharding.interleave(docs, "source", 16)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        documents(spark, sf_dir, "doc_id", "text"), tokenizer_path(), tokenizer_path(PIECES),
        keep=["doc_id"], store=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256)))
    return found.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_top_k": op2_top_k,
        "op3_mixing": op3_mixing,
        "op4_bpe": op4_bpe,
        "op5_language": op5_language,
        "op6_near_dedup": op6_near_dedup,
        "op7_quality": op7_quality,
        "op8_token_counts": op8_token_counts,
        "op9_toxicity": op9_toxicity,
        "op10_passages": op10_passages,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_sharding": op12_sharding,
        "op13_alignment": op13_alignment,
    }

"""A training-corpus pipeline: each stage reads what the one before it wrote.

Stages take and return documents (doc_id, text, lang, source, n_chars, and any further columns).
The last one adds the token ids. Each stage names what it does with a document; a document it has
no quarrel with stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import bpe, language, mixing, near_dedup, secret_scan
from shopgrain.llm.queries import tokenizer_path
from shopgrain.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """docs with the used columns and all others packed into one, and the columns that undo it.

    Operators add columns of their own names; a packed one of that name stays as it came.
    """
    others = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in used}
    packed = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(n) for c, n in others.items()])
    back = [F.col(f"carried.{others[c]}").alias(c) if c in others else F.col(c) for c in docs.columns]
    return docs.select(*used, packed.alias("carried")), back


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    models = language.train_on_folds(docs.select("doc_id", "text", "lang"))
    used, back = apart(docs, "doc_id", "text")
    return language.predict(used, models).where("NOT rejected").select(*back)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    used, back = apart(docs, "doc_id", "text")
    return near_dedup.keep_one(used).select(*back)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a secret go."""
    used, back = apart(docs, "text")
    return secret_scan.find_secrets(used).where(F.size("secret_spans") == 0).select(*back)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens are raked to tempered shares of sources, languages and topics."""
    used, back = apart(docs, "doc_id", "text", "lang", "source")
    weighed = used.withColumns({"mix_topic": mixing.topic(F.col("text")),
                                "mix_words": mixing.tokens(F.col("text"))})
    drawn = mixing.sample(weighed, ["source", "lang", "mix_topic"], weight="mix_words")
    return drawn.select(*back)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their token ids; the ids give back the text.

    The columns n_tokens and ids are the result of the stage: input columns of these names go.
    """
    used, back = apart(docs.drop("n_tokens", "ids"), "doc_id", "text")
    return bpe.encode(used, tokenizer_path()).select(*back, "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
    ("bpe", encoded),
]

# Character models, signatures and byte pairs are beyond SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents of sf_dir, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": lambda spark, sf_dir: run(spark, sf_dir).select(
        "doc_id", "lang", "source", "n_chars", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"))}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, read again from Parquet. All but the last return the columns of
``documents``. None of them fails on nulls, repeated rows or an empty table; what each then does is said below.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, language_id, minhash, packing, secret_scan
from strata.llm.common import Stages, table

#: Language decisions with a lower probability are rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with some certainty; null texts and those without letters go.

    Learns from the labelled documents of its own input. Without any, only documents without letters go.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs, model)
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def with_row_keys(docs: DataFrame, stages: Stages) -> tuple[DataFrame, str]:
    """The rows, each with a number of its own in a further column, and that column's name.

    Written once to the shared folder, so that all later reads see the same numbers.
    """
    key = "row"
    while key in docs.columns:
        key += "_"
    return stages.keep(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, that of the smallest doc_id, of each group of near-duplicates: five words, 0.8.

    Rows are compared by their texts alone: rows without a doc_id too, which are kept only if no row of their group has
    one. Of rows that repeat a doc_id, those with unrelated texts all stay. Texts without words are in no group.
    """
    rows, key = with_row_keys(docs, Stages(spark, "near-duplicates"))
    groups = minhash.near_duplicates(rows.select(key, "text"), words=5, percent=80, key=key).select(key, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.col(key).alias("key"))
    kept = rows.select(key, "doc_id").join(groups, key).groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(kept.select(F.col("first.key").alias(key)), key, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows that hold no benchmark item, up to one edit for ten characters; each row is judged by its own text."""
    rows, key = with_row_keys(docs, Stages(spark, "decontaminate"))
    found = decontamination.leaks(rows, table(spark, sf_dir, "benchmark"), key=key).select(key).distinct()
    return rows.join(found, key, "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a secret of any rule; null texts have none."""
    return secret_scan.scan(docs).where(F.size("findings") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("without_secrets", without_secrets),
    ("pack", pack),
]

#: Scores, signatures and packing are not SQL: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs

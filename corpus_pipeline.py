"""From raw documents to token blocks: five stages, each one operator of ``wordloom.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import decontaminate, near_dedup, source_mix, token_planes, toxicity
from wordloom.workspace import scratch, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels of ``docs``.

    Nulls, empty texts and repeated rows go as in ``toxicity.drop_toxic``, missing labels as in
    ``toxicity.fit``; no rows give none.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows without words or id stay, repeated rows stay once, as in ``near_dedup.drop_near_duplicates``.
    """
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; nulls and repeated rows go as in ``decontaminate.drop_leaks``."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for.

    Texts without words have no weight in it; nulls and repeated rows go as in ``source_mix.mix``.
    """
    return source_mix.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token blocks, and what they hold of each document; a null text is its end id alone."""
    return token_planes.read_digests(*token_planes.write_blocks(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mix", mix_sources),
    ("token_planes", write_tokens),
]

# Log-odds segments, MinHash components and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each result written before the next begins.

    The tables that a stage makes on its way are deleted once its result is written; those of the last
    one, the token blocks and their index, are what the pipeline is for, and stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        last = number == len(STAGES) - 1
        with nullcontext() if last else scratch(spark):
            made = stage(spark, docs, sf_dir)
            path = f"{folder}/{number}-{name}"
            made.write.parquet(path)
            docs = spark.read.schema(made.schema).parquet(path)
    return docs

"""The corpus pipeline: five stages from raw documents to sampled token ids.

Every stage takes (spark, docs, sf_dir) and gives back a DataFrame; ``run`` writes each
result as Parquet into the shared folder and reads it again as the next stage's documents.
All stages but the last keep the columns of ``documents``. Filtering stages decide on all
rows of their input; the stage that finds personal data rewrites texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weekloom.llm import pieces, pii, simhash, toxicity, winnow
from weekloom.sources.staging import stage

#: SQL has no counterpart: the stages rest on a trained index, XXH64 and random sampling.
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic by their nearest labelled examples go.

    Null and empty texts stay unless toxic examples are the majority; of repeated rows all
    stay or all go, null ids included. Extra columns go along, also of clashing names.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id.

    Null and empty texts and those without words are one group; repeated rows leave one.
    """
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go.

    Null and empty texts share none and stay; without benchmark items every row stays.
    """
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes.

    Null texts stay null; repeated rows are rewritten alike, null ids included.
    """
    return pii.redact(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every text, decoded again and compared.

    Null and empty texts have one empty segmentation; a null id is key 0.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.decoded(pieces.encode(docs, model), model)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("sentencepiece", sample_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

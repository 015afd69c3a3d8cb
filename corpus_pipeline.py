"""Corpus pipeline: toxicity, exact copies, near copies, benchmark passages,
tokenisation. ``run(spark, sf_dir)`` applies the stages to ``documents``; each
stage's result is written as Parquet into the shared checkpoint folder and read
back as the next one's input. All stages but the last return the columns of
``documents``; the last appends ``n_tokens`` and ``round_trip``.

Null texts count as empty in every stage; an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plenum.llm import chunk_dedup, decontaminate, piece_table, toxicity, weighted_minhash
from plenum.llm.common import materialise
from plenum.llm.queries import model_path
from plenum.session import ensure_checkpoint_dir, ship_package
from plenum.sources.readers import table


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents scored 0.5 or more; the grammar's weights are learned from
    the labels that are not held out."""
    _ready(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts."""
    _ready(spark)
    return chunk_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    _ready(spark)
    return weighted_minhash.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows cover a twentieth or more."""
    _ready(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count pieces and record whether the ids decode to the text again."""
    _ready(spark)
    return piece_table.keep_round_trips(docs, piece_table.read_model(model_path()))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("piece_table", tokenise_stage),
]

#: Learned scores, weighted sampling and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs

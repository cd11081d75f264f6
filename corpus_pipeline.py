"""A corpus cleaned and packed: five stages over ``documents``, each a written table.

Stages keep the columns of ``documents`` but for the last, which returns pieces of
packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.common import staged, table
from stationflow.llm.decontaminate import drop_leaks
from stationflow.llm.language_id import fit_language_model, keep_identified
from stationflow.llm.near_copies import keep_one_copy
from stationflow.llm.packing import harmonic_pack
from stationflow.llm.queries import PACKING_TOKENIZER
from stationflow.llm.secret_scan import redact_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts whose language stays in doubt, go."""
    return keep_identified(docs, fit_language_model(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word Jaccard of 0.8 or more stays: the one with the smallest id."""
    return keep_one_copy(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out of the texts, and the texts are counted anew."""
    clean = redact_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids, with their ids."""
    return harmonic_pack(docs, PACKING_TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("language_id", language), ("simhash_dedup", near_dedup), ("decontamination", decontaminate), ("secret_scan", secrets), ("packing", packing)]

#: Trained models, fingerprints and tokenizers can't be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``; each stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

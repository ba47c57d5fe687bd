"""The training-data pipeline: five stages over ``documents``.

Every stage reads what its predecessor kept, as a Parquet table, and all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.llm import bpe, line_dedup, mixing, near_dedup, quality
from laketide.llm.common import prepare, table, written
from laketide.llm.queries import VOCABULARY


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects (score under 0.5) go."""
    prepare(spark)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, "_quality_score")
    return scored.where(F.col("_quality_score") >= 0.5).select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: a line that ten documents hold stays in the first of
    them only; n_chars follows the text."""
    prepare(spark)
    drops = line_dedup.line_drops(docs, min_docs=10, keep_first=True)
    done = line_dedup.drop_lines(docs, drops)
    return (done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
            .select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, five words and a similarity of 0.8: one document of each
    group stays."""
    prepare(spark)
    return near_dedup.drop_near(docs).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: sources are repeated to flatter weights, at most twice;
    the budget covers every document once."""
    prepare(spark)
    return mixing.mix(docs, mixing.Target(entropy=1.0, max_epochs=2.0, cover=True))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of every document, with the digest of what they
    decode to."""
    prepare(spark)
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("mixing", source_mix),
    ("bpe", tokens),
]

# Voting over a decomposition, set similarity and BPE are beyond SQL.  The
# tests hold the rows of the near-dedup and BPE stages against brute force
# at the settings used here; of the other stages they compare columns and
# row counts only.  tests/llm/test_operators.py holds line dedup against
# brute force, and of quality and mixing some properties, not whole rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents in, token ids out.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last keep the columns of documents. ``run`` writes every
stage's result to the shared checkpoint folder as Parquet and reads it back as the
next one's input, so a lost executor never sends the work back over a stage.

1. toxicity: documents that score 0.7 or more go.
2. exact_dedup: of equal normalised texts, the smallest doc_id stays.
3. near_dup: of each component of near copies, the smallest doc_id stays.
4. mixing: the words that the mix takes of each document, per pass over its source.
5. pieces: the SentencePiece ids of each of these texts, and whether they decode to it.

A learned score, a pseudorandom mix and a tokenizer are not expressible in SQL, so
there is no oracle; tests compare the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salaria.llm.exact_dedup import dedup_stage
from salaria.llm.jaccard_join import near_dup_stage
from salaria.llm.mixing import mixing_stage
from salaria.llm.pieces import pieces_stage
from salaria.llm.rows import documents, table
from salaria.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", dedup_stage),
    ("near_dup", near_dup_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

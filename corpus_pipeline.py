"""From raw documents to token ids: quality, near-duplicates, personal data, mixing, tokens.

Defined results: each stage does with nulls, empty and very long texts, ties and repeated rows what its module says; no row
goes but those that the quality classifier rejects and those whose text is a copy of another row's that stays. Rows with a
null or repeated id are rows of their own. Mixing repeats rows and drops none. An empty table gives an empty result, and
further columns of documents, whatever their names, are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import bpe, mixing, ngram_join, pii, quality_model
from wellspring.session import materialize

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality", quality_model.stage),
    ("near_duplicates", ngram_join.stage),
    ("personal_data", pii.stage),
    ("mixing", mixing.stage),
    ("tokens", bpe.stage),
]
#: Trained models and MinHash have no SQL form; tests hold each stage's operator against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole of its predecessor's output, which is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

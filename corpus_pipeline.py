"""A corpus pipeline: documents in, token ids of clean, distinct, uncontaminated documents out.

Each stage works on all rows that its predecessor kept. All but the last return the columns of ``documents``; a stage that edits
texts sets n_chars to the new length. Stages that reject drop whole rows.

In every stage nulls of any column pass through, and null text counts as empty; quality rules reject empty texts, so later stages see none from ``run``.
Repeated rows are judged each, and near-duplicates keep one of them. Ties of the least id go to the least text digest. An empty table goes
through empty. Columns that ``documents`` does not have are left behind. Long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrail.llm import byte_bpe, decontaminate, line_dedup, minhash_dedup, quality_rules
from kinetrail.llm.common import staged
from kinetrail.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the repetition rules reject."""
    ship(spark)
    return quality_rules.accepted(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines on more than a tenth of a source's documents out of that source's texts."""
    found = line_dedup.drop_boilerplate(docs.select(*COLUMNS), ratio=0.1, min_pages=2)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.select("doc_id", "text", "lang", "source", length.alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each class of copies and near copies."""
    ship(spark)
    return minhash_dedup.representatives(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    ship(spark)
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts and decodes them again."""
    ship(spark)
    return byte_bpe.round_trip(docs, ("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each stage's rows are written to the shared folder before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: consistent sampling and byte-level BPE have no SQL form; tests hold the pipeline against plain Python
ORACLE_SQL = None

"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it back as the next one's
``docs``. All but the last return the columns of their input.

1. quality: documents that the line classifier rejects go (op 6).
2. near_duplicates: of each group of equal or similar documents the one with the
   smallest doc_id stays (op 4).
3. decontamination: documents that hold a window of a benchmark item go (op 5).
4. secrets: spans are replaced by a mark; all documents stay (op 1).
5. packing: token ids are cut and packed into sequences (op 9); one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetweave.llm.decontam import without_contaminated
from assetweave.llm.ngram_join import without_near_duplicates
from assetweave.llm.packing import packed_digest
from assetweave.llm.quality import good_documents
from assetweave.llm.secrets import redacted
from assetweave.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_digest(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: the classifier is trained, which SQL can't express; tests/llm compares every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

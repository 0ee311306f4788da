"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``; the last returns the packed pieces with their ids. Between stages the
rows are written as Parquet in the shared folder and read again.

Defined cases follow the operators': null or empty texts are rejected, kept or packed as these
say; repeated rows stay until near-duplicate removal keeps one; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import common as C
from evalspark.llm import minhash_dedup, mixing, packing, quality_classifier, secret_scan
from evalspark.llm.queries import tokenizer_path
from evalspark.session import shared_path


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_classifier.keep_good(docs, C.read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    C.prepare(spark)
    return _recounted(secret_scan.redact_secrets(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix reads them."""
    return _recounted(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences: their ids (little-endian uint32), a digest of these, and
    where each lies. The ids of a sequence_id, joined in the order of offset, are one sequence."""
    return packing.pack_documents(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixing", mixture),
    ("packing", packed),
]

#: The fitted classifier, the tokenizer and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = C.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

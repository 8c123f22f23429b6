"""A corpus from raw documents to token ids: five stages, each written as Parquet and read by the next.

1. toxicity: documents that score as toxic go;
2. near duplicates: one document of each group stays, the one with the smallest id; texts are near
   if their SimHash fingerprints of three-word shingles differ in two bits at most, directly or through others;
3. decontamination: documents that hold a passage of the benchmark go;
4. secrets: what looks like a secret is replaced in the text, the document stays;
5. pieces: token ids, and whether they give the text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern import settings
from quern.llm import decontaminate, pieces, secret_scan, simhash, toxicity


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the same folder, as the query on its own does.

    Null and empty texts have a score too and stay unless it rejects them; of repeated rows all go or all stay.
    """
    return toxicity.reject_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles and bits of ``op1_simhash``.  Null texts count as empty ones, a null id comes after all others; of repeated rows one stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts hold no passage and stay, as do repeated rows and rows without an id."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays with its columns; null texts stay null, texts without a secret stay as they are."""
    return secret_scan.redact(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: one row of ids per row; null texts count as empty ones and have no ids."""
    return pieces.tokenize(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", to_pieces),
]

#: No stage but the third could be put as SQL: trained models, sets of shingle hashes, byte-pair merging.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns lies as Parquet in the shared checkpoint folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = settings.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

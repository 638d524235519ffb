"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. An empty ``documents`` gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import read_table, stored
from vigil.llm.mixing import mix_documents
from vigil.llm.packing import pack_documents
from vigil.llm.simhash import MAX_BITS, SHINGLE_WORDS, drop_near_duplicates
from vigil.llm.substrings import dedup_substrings
from vigil.llm.toxicity import drop_toxic, train_on_tables
from vigil.session import drop_work_dirs, work_dirs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects, fitted on the labelled ones that are not held out.

    Null and blank texts are judged as the middle ordinary training document is; repeated rows share one verdict, and
    without labels every document stays.
    """
    return drop_toxic(docs, train_on_tables(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash near-duplicate group."""
    return drop_near_duplicates(docs, shingle=SHINGLE_WORDS, max_bits=MAX_BITS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of passages that an earlier document has; every document stays."""
    return dedup_substrings(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights; repeated epochs are repeated rows."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises every document and packs the pieces into sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mix", mix),
    ("pack", pack),
]

# A trained model, fingerprints, suffix trees and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.

    Once a stage's rows are written, its work folders and the rows of the
    stage before it are removed.
    """
    docs = read_table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        known = len(work_dirs())
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        *done, rows = work_dirs()[known:]
        drop_work_dirs(spark, before + done)
        before = [rows]
    return docs

"""Helpers shared by the operators: table reads, shared-folder writes, SQL word patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import work_dir

# Words: runs of anything but ASCII white space (space, \t \n \v \f \r).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    Cuts the lineage: a lost executor never makes the work before it run
    again, and every later use reads the same rows.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS))


def word_count(text: Column) -> Column:
    """Number of words (0 for null) as a long."""
    return F.size(words_of(text)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names would clash with added ones (case-insensitive)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])

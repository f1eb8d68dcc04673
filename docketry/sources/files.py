"""Landed files: submission indexes, documents and stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.keys import source_type
from docketry.sources.schemas import CLASSIFICATION, METADATA, SUBMISSIONS


def read_submissions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One JSON object per company. Only the recent-filings arrays are read.

    The default is one file per company, as landed. With ``lines`` the files hold one object
    per line; Spark can then split large files instead of opening very many small ones.
    """
    return spark.read.schema(SUBMISSIONS).option("multiLine", not lines).json(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Whole documents as UTF-8 text, with the path they came from."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )


def with_accession(documents: DataFrame, path_col: str = "path") -> DataFrame:
    """Accession number (with dashes) taken from the file name, null when there is none."""
    found = F.regexp_extract(F.col(path_col), r"([0-9]{10})-?([0-9]{2})-?([0-9]{6})[^/]*\z", 0)
    digits = F.regexp_extract(F.replace(found, F.lit("-"), F.lit("")), r"^([0-9]{18})", 1)
    return documents.withColumn(
        "accession_number",
        F.when(
            digits != "",
            F.concat_ws(
                "-", F.substring(digits, 1, 10), F.substring(digits, 11, 2),
                F.substring(digits, 13, 6),
            ),
        ),
    )


def list_documents(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """S3: sorted listing. The content column is pruned, so no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
        .orderBy("path")
    )


def with_source_type(df: DataFrame, column: str, out: str = "source_type") -> DataFrame:
    """Tag inputs as ``URL`` or ``File``."""
    return df.withColumn(out, source_type(F.col(column)))


def _read_named(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name)
        .option("multiLine", True)
        .json(root)
    )


def read_results(spark: SparkSession, root: str, name: str = "classification.json") -> DataFrame:
    """Classification files stored one per filing, at any depth below ``root``.

    ``name`` is the name of the files, or a pattern for it.
    """
    return _read_named(spark, root, name, CLASSIFICATION)


def read_metadata_files(spark: SparkSession, root: str, name: str = "metadata.json") -> DataFrame:
    """Metadata files stored one per filing, at any depth below ``root``."""
    return _read_named(spark, root, name, METADATA)

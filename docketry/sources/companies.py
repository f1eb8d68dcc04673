"""Company directory."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.expr import capitalize
from docketry.sources.schemas import COMPANIES

# Short names of well-known companies and their SEC identifiers.
POPULAR_COMPANIES = {
    "apple": "320193",
    "microsoft": "789019",
    "amazon": "1018724",
    "tesla": "1318605",
    "nvidia": "1045810",
    "alphabet": "1652044",
    "meta": "1326801",
    "berkshire": "1067983",
    "jpmorgan": "19617",
    "visa": "1403161",
}


def popular_companies(spark: SparkSession) -> DataFrame:
    names, ciks = list(POPULAR_COMPANIES), list(POPULAR_COMPANIES.values())
    return spark.createDataFrame(pa.table({"name": names, "cik": ciks}))


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """A larger directory from a CSV file with a header."""
    return spark.read.schema(COMPANIES).option("header", True).csv(path)


def companies_listing(companies: DataFrame) -> DataFrame:
    """Name with a capital first letter, and the identifier."""
    return companies.select(capitalize(F.col("name")).alias("name"), "cik")

"""Writing a result down before it is used more than once."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder, from the session; where none is set, ``fallback`` or the warehouse."""
    folder = spark.conf.get(SETTING, None) or fallback or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def stage(df: DataFrame, fallback: str | None = None) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    Rows that cost a model call are so computed once, and a lost executor does not lose them. A
    write that fails leaves nothing behind.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark, fallback)}/docketry-{uuid4().hex}"
    try:
        df.write.parquet(path)
    except BaseException:
        remove(spark, path)
        raise
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables once what was made of them is written."""
    for table in tables:
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            remove(table.sparkSession, folder)

"""Incremental runs over newly landed filings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructType

from docketry.functions.templates import DEFAULT_STRATEGY
from docketry.operators.filings import explode_filings, filter_form, split_dated
from docketry.operators.scoring import Generate, GenerateMany
from docketry.plans.classify import process_filings, to_classifications
from docketry.sinks.tables import write_classifications, write_metadata
from docketry.sources.schemas import SUBMISSIONS

ARRIVED = "arrived_at"
DEFAULT_DELAY = "30 days"
KEY = ("cik", "accession_number")
BUCKET, KEY_BUCKETS = "__bucket", 4_096  # buckets of keys that are told apart; fixed, as state is kept by them
# What state with a time to live needs: its store, and no batches without data, which would never end.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def stream_submissions(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Submission indexes as they land, with the time at which this run sees them.

    That time never lies behind the watermark of :func:`first_arrivals`, whatever times the files
    carry, so a back-fill or a copy that keeps file times loses nothing. ``landed_at`` is the
    time of the file.
    """
    return (
        spark.readStream.schema(SUBMISSIONS)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")  # else files with old times are passed over
        .json(path)
        .withColumn("landed_at", F.col("_metadata.file_modification_time"))
        .withColumn(ARRIVED, F.current_timestamp())
    )


def arriving_filings(submissions: DataFrame, form: str | None = None) -> DataFrame:
    """Exploded filings with the time their index was seen; see :func:`arriving_split`."""
    return arriving_split(submissions, form)[0]


def arriving_split(submissions: DataFrame, form: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Usable arriving filings, and the quarantined rows without a usable date or key."""
    rows = explode_filings(submissions, keep=(ARRIVED,))
    return split_dated(filter_form(rows, form) if form else rows)


def first_arrivals(
    stream: DataFrame,
    key: Sequence[str] = KEY,
    arrived: str = ARRIVED,
    delay: str = DEFAULT_DELAY,
) -> DataFrame:
    """Each filing of each company once; co-registrants of one accession number all stay.

    State is bounded by ``arrived``, which must be the time of processing, as
    :func:`stream_submissions` sets it: rows behind the watermark would be lost, and that time
    never is. A copy that comes more than ``delay`` later passes again; the sinks replace by key,
    so it is harmless.
    """
    return stream.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(key))


class _Arrivals(StatefulProcessor):
    """Remembers each key of a bucket for as long as its time to live."""

    def __init__(self, key: Sequence[str], schema: StructType, ttl_ms: int):
        self.key, self.names, self.ttl_ms = list(key), schema.names, ttl_ms
        self.key_schema = StructType([schema[name] for name in key])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", self.key_schema, "seen boolean", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        for part in rows:
            # Rows of one key in this part: the state is asked once for each.
            new = ~part.duplicated(self.key).to_numpy()
            for at, known in zip(new.nonzero()[0], zip(*(part.loc[new, name].tolist() for name in self.key))):
                new[at] = not self.seen.containsKey(known)
                if new[at]:
                    self.seen.updateValue(known, (True,))
            yield part[self.names].assign(arrival=["first" if first else "repeat" for first in new])

    def close(self) -> None:
        pass


def marked_arrivals(
    stream: DataFrame, key: Sequence[str] = KEY, days_kept: float = 30, usable: Column | None = None
) -> DataFrame:
    """Every arriving row, with ``arrival``: ``first``, ``repeat`` or ``rejected``.

    Each key has a state of its own, which is dropped ``days_kept`` days of processing time after it was
    first seen, so a key that comes again later is a first arrival once more (the sinks replace by
    key). Rows are never late, as no watermark is involved, and none is lost: rows that are not
    ``usable`` (by default those without a key) come out as rejected, without touching any state. Of
    several rows of a key in one batch, one is the first, whichever comes first. Keys come to Python by
    hashed buckets, since a call for each key would cost far more than its state. Run it with the
    settings KEYED_STATE.
    """
    complete = F.lit(True)
    for name in key:
        complete &= F.col(name).isNotNull()
    if usable is not None:
        complete &= F.coalesce(usable, F.lit(False))
    schema = StructType([*stream.schema.fields]).add("arrival", StringType())
    told = (
        stream.filter(complete)
        .withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(KEY_BUCKETS)))
        .groupBy(BUCKET)
        .transformWithStateInPandas(_Arrivals(key, stream.schema, int(days_kept * 86_400_000)), schema, "Append", "ProcessingTime")
    )
    return told.unionByName(stream.filter(~complete).withColumn("arrival", F.lit("rejected")))


def store_batch(
    root: str,
    documents: Callable[[SparkSession, DataFrame], DataFrame] | None = None,
    taxonomy: Callable[[SparkSession], DataFrame] | None = None,
    generate: Generate | GenerateMany | None = None,
    strategy: str = DEFAULT_STRATEGY,
    fmt: str = "parquet",
    setup: Callable | None = None,
    order: Column | None = None,
    **options,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler that writes metadata and, given a model, classifications.

    ``documents`` is called with each batch, so that it can read just the folders or dates the
    batch needs instead of everything that ever landed. The model is ``generate``, or what ``setup``
    makes once for each task; ``options`` are those of ``classify``. Of conflicting rows of one filing
    in a batch, the last by ``order`` (on the columns of the batch) is stored. Both sinks replace by
    key, so a batch that is run again after a failure changes nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_metadata(batch, f"{root}/metadata", fmt, order)
        if generate is not None or setup is not None:
            spark = batch.sparkSession
            processed = process_filings(
                batch, documents(spark, batch), taxonomy(spark), generate, strategy, setup=setup, **options
            )
            write_classifications(
                to_classifications(processed), f"{root}/classifications", fmt
            )

    return handle


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    settings: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Process all that has landed since the last run, then stop.

    ``settings`` hold for this query alone; pass KEYED_STATE for :func:`marked_arrivals`.
    """
    conf = stream.sparkSession.conf
    before = {name: conf.get(name, None) for name in settings or {}}
    try:
        for name, value in (settings or {}).items():
            conf.set(name, value)
        # A query keeps the settings that it was started with.
        return (
            stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)

"""Counts of a stored table, kept up as it grows (K4)."""

from __future__ import annotations

import hashlib
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.sinks.manifest import Manifest, Manifests
from docketry.sinks.staging import remove
from docketry.sinks.tables import CLASSIFICATIONS, load_parts

COUNTS = "_counts"
MOST_PARTS = 16  # count folders that are read; more are folded into one


def maintained_counts(
    spark: SparkSession, root: str, by: list[str] | None = None, schema: str = CLASSIFICATIONS,
    fmt: str = "parquet", date_col: str = "classification_timestamp",
) -> DataFrame:
    """K4 over a table of ``write_classifications``: counts per ``by``, event type and relevance.

    Equals ``event_counts`` of the whole table, but reads only what came since the last call. The
    folders of a table never change, they come and go with the manifest; so each is counted once, and
    the totals are the sums over the folders of the newest version. A row that is replaced takes its
    folder, and the counts of that, with it. ``by`` may name ``month``, that of ``date_col``. Counts are
    committed by a manifest of their own: a call that fails counts nothing, one that comes again finds
    nothing to do.
    """
    root, keys = root.rstrip("/"), [*(by or []), "event_type", "relevant"]
    table = Manifests(spark, root).latest()
    if table is None:
        raise ValueError(f"no table in {root}")
    live = {(run, bucket) for bucket, runs in table.runs.items() for run in runs}
    place = f"{root}/{COUNTS}/{hashlib.md5(repr((keys, date_col)).encode()).hexdigest()[:12]}"
    manifests = Manifests(spark, place)
    taken = manifests.numbers()
    current = manifests.latest() or Manifest(0, 1)
    counted = set(current.notes)
    parts = current.runs.get(0, [])
    fresh = sorted(part for part in live if f"{part[0]}/{part[1]}" not in counted)

    def stored(names: list[str]) -> DataFrame:
        return spark.read.parquet(*[f"{place}/{name}" for name in names])

    if fresh:
        rows = load_parts(spark, root, fresh, schema, fmt)
        if "month" in keys:
            rows = rows.withColumn("month", F.date_format(F.col(date_col).cast("date"), "yyyy-MM"))
        partial = rows.groupBy("__run", "__bucket", *keys).agg(F.count(F.lit(1)).alias("n_filings"))
        alive = spark.createDataFrame(sorted(live), "__run string, __bucket int")
        if len(parts) >= MOST_PARTS:
            # Folded into one, without the folders that are gone.
            partial = partial.unionByName(stored(parts).join(F.broadcast(alive), ["__run", "__bucket"], "left_semi"))
        name = f"counts-{uuid4().hex}"
        try:
            partial.write.parquet(f"{place}/{name}")
            kept = [] if len(parts) >= MOST_PARTS else parts
            known = (counted & {f"{r}/{b}" for r, b in live}) | {f"{r}/{b}" for r, b in fresh}
            current = Manifest(max([0, *taken]) + 1, 1, {0: [*kept, name]}, sorted(known))
            manifests.commit(current)
        except BaseException:
            remove(spark, f"{place}/{name}")
            raise
    names = current.runs.get(0, [])
    if not names:
        return load_parts(spark, root, [], schema, fmt).withColumn("month", F.lit(None).cast("string")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_filings"))
    # As many rows as the manifest of the table has folders.
    alive = spark.createDataFrame(sorted(live), "__run string, __bucket int")
    sums = stored(names).join(F.broadcast(alive), ["__run", "__bucket"], "left_semi")
    return sums.groupBy(*keys).agg(F.sum("n_filings").alias("n_filings"))

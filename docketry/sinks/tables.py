"""Metadata and classification tables (K1, K2): hashed buckets of companies, one version at a time.

Rows lie in folders ``{run}/bucket={hash of cik}``; a manifest lists the folders that count. A run
writes a folder of its own and then a new manifest, so a reader sees the version before or after it
and nothing in between, whatever happens to the run.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators.filings import filing_key, to_metadata, with_document_url
from docketry.sinks.manifest import Manifest, Manifests
from docketry.sinks.staging import remove, stage, unstage
from docketry.sources.schemas import CLASSIFICATION, METADATA, columns

COMPANY = "cik"
CLASSIFICATIONS = f"{CLASSIFICATION}, {COMPANY} string"
BUCKETS = 64  # of a new table
MOST_RUNS = 16  # folders of a bucket; a run that finds more writes the bucket anew


def bucket_of(company: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(company), F.lit(buckets)).cast("int")


def _one_per_key(df: DataFrame, names: list[str], key: list[str], order: Column | None) -> DataFrame:
    """The last row of each key by ``order``; of rows that tie, or without an order, the greatest."""
    row = F.struct(*[name for name in names if name not in key])
    last = F.max(row) if order is None else F.max_by(row, F.struct(order.alias("order"), row.alias("row")))
    return df.groupBy(*key).agg(last.alias("row")).select(*key, "row.*").select(*names)


def _load(spark: SparkSession, folders: list[str], schema: str, fmt: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    # An absolute glob-free list: only these folders are listed, and their names add no column.
    return spark.read.schema(schema).format(fmt).option("recursiveFileLookup", True).load(folders)


def _with_part(rows: DataFrame) -> DataFrame:
    """Adds ``__run`` and ``__bucket``, the folder that each row comes from."""
    # Cut by slashes: a pattern that looks for its end from each character of a path costs more than the row.
    folder = F.substring_index("_metadata.file_path", "/", -3)
    bucket = F.substring_index(F.substring_index(folder, "/", 2), "/bucket=", -1)
    return rows.withColumns({"__run": F.substring_index(folder, "/", 1), "__bucket": bucket.cast("int")})


def load_parts(spark: SparkSession, root: str, parts: list[tuple[str, int]], schema: str, fmt: str) -> DataFrame:
    """Rows of some folders, given by run and bucket, each with its ``__run`` and ``__bucket``."""
    if not parts:
        return spark.createDataFrame([], f"{schema}, __run string, __bucket int")
    return _with_part(_load(spark, [f"{root}/{run}/bucket={bucket}" for run, bucket in parts], schema, fmt))


def _same_key(rows: DataFrame, others: DataFrame, key: list[str]) -> Column:
    same = F.lit(True)
    for name in key:
        same &= rows[name].eqNullSafe(others[name])
    return same


def stored_keys(
    spark: SparkSession, manifest: Manifest, root: str, schema: str, key: list[str], fmt: str,
    buckets: set[int], bounds: tuple[str | None, str | None],
) -> DataFrame:
    """Keys stored in ``buckets`` whose second part lies in ``bounds``, with the folder of each.

    Second parts begin with the date, so that the range test passes over whole files of other times.
    """
    stored = _load(spark, manifest.folders(root, buckets), schema, fmt)
    low, high = bounds
    within = F.col(key[1]).isNull()
    if low is not None:
        within = within | F.col(key[1]).between(low, high)
    return _with_part(stored.filter(within)).select(*key, "__run", "__bucket")


def upsert(
    df: DataFrame, root: str, schema: str, key: list[str], fmt: str = "parquet",
    order: Column | None = None, buckets: int = BUCKETS,
) -> None:
    """Add rows to a table; rows of equal key (the company and more) are replaced.

    Of rows with one key in ``df`` the last by ``order`` counts. Of the stored table, the run lists
    and reads the buckets of its own companies, and of these the keys in the range of its own; folders
    that hold a key that comes again are written anew without it, all others stay as they are. The
    rebalance hint gives each bucket few files and lets adaptive execution split one that holds a
    large share of the rows. ``buckets`` counts when the table is new.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    manifests = Manifests(spark, root)
    taken = manifests.numbers()
    current = manifests.latest() or Manifest(0, buckets)
    names = columns(schema)
    rows = _one_per_key(df, names, key, order)
    # Used several times, and may have cost model calls: written down.
    new = stage(rows.withColumn("bucket", bucket_of(F.col(COMPANY), current.buckets)), f"{root}/_staged")
    run = f"run-{uuid4().hex}"
    try:
        # One row for each bucket, whatever the size of the run.
        found = new.groupBy("bucket").agg(F.min(key[1]).alias("low"), F.max(key[1]).alias("high")).collect()
        touched = {r["bucket"] for r in found}
        if not touched:
            return
        lows, highs = ([r[n] for r in found if r[n] is not None] for n in ("low", "high"))
        bounds = (min(lows), max(highs)) if lows else (None, None)
        old: set[tuple[int, str]] = set()
        if seen := touched & current.runs.keys():
            held = stored_keys(spark, current, root, schema, key, fmt, seen, bounds)
            again = held.join(new, _same_key(held, new, key), "left_semi").select("__bucket", "__run").distinct()
            # At most the folders that the manifest lists.
            old = {tuple(r) for r in again.collect()}
        old |= {(b, r) for b in touched for r in current.runs.get(b, []) if len(current.runs[b]) >= MOST_RUNS}
        out = new
        if old:
            kept = _load(spark, [f"{root}/{r}/bucket={b}" for b, r in sorted(old)], schema, fmt)
            kept = kept.join(new, _same_key(kept, new, key), "left_anti")
            out = new.unionByName(kept.withColumn("bucket", bucket_of(F.col(COMPANY), current.buckets)))
        out.hint("rebalance", "bucket").write.format(fmt).partitionBy("bucket").save(f"{root}/{run}")
        after = {b: [r for r in runs if (b, r) not in old] for b, runs in current.runs.items()}
        for bucket in touched:
            after[bucket] = [*after.get(bucket, []), run]
        manifests.commit(Manifest(max([0, *taken]) + 1, current.buckets, after))
    except BaseException:
        remove(spark, f"{root}/{run}")
        raise
    finally:
        unstage(new)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete folders that none of the ``keep`` newest versions lists.

    Not while a writer is at work, whose folder no version lists yet, or while readers of older
    versions are.
    """
    root = root.rstrip("/")
    manifests = Manifests(spark, root)
    versions = [m for n in manifests.numbers() if (m := manifests.read(n))][:max(keep, 1)]
    if not versions:
        return
    used = {folder for m in versions for folder in m.folders(root)}
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for run in files.listStatus(place):
        name = run.getPath().getName()
        if not name.startswith("run-"):
            continue
        held = [s.getPath().getName() for s in files.listStatus(run.getPath())]
        left = [b for b in held if f"{root}/{name}/{b}" in used]
        for bucket in held if left else []:
            if bucket not in left and bucket.startswith("bucket="):
                remove(spark, f"{root}/{name}/{bucket}")
        if not left:
            remove(spark, f"{root}/{name}")


def read_table(
    spark: SparkSession, root: str, schema: str, fmt: str = "parquet", companies: list[str] | None = None
) -> DataFrame:
    """The newest version of a table; with ``companies``, only their buckets are listed and read."""
    root = root.rstrip("/")
    manifest = Manifests(spark, root).latest()
    if manifest is None:
        raise ValueError(f"no table in {root}")
    if companies is None:
        return _load(spark, manifest.folders(root), schema, fmt)
    listed = spark.createDataFrame([(c,) for c in companies], "cik string")
    buckets = {r[0] for r in listed.select(bucket_of(F.col("cik"), manifest.buckets)).collect()}
    return _load(spark, manifest.folders(root, buckets), schema, fmt).filter(F.col(COMPANY).isin(companies))


def write_metadata(
    filings: DataFrame, root: str, fmt: str = "parquet", order: Column | None = None
) -> None:
    """K1: store metadata; the same filing written again replaces itself.

    ``order`` (on the columns of ``filings``) tells which of several rows of one filing is the last.
    """
    key = [COMPANY, "filename"]
    if order is None:
        upsert(to_metadata(filings), root, METADATA, key, fmt)
        return
    ordered = filings.withColumn("__order", order)
    wanted = to_metadata(ordered).columns
    rows = with_document_url(ordered) if "document_url" not in ordered.columns else ordered
    rows = filing_key(rows) if "filename" not in rows.columns else rows
    upsert(rows.select(*wanted, "__order"), root, METADATA, key, fmt, F.col("__order"))


def write_classifications(
    classifications: DataFrame, root: str, fmt: str = "parquet", order: Column | None = None
) -> None:
    """K2: store classifications (with ``cik``); the same filing replaces itself."""
    key = [COMPANY, "classification_timestamp", "accession_number"]
    upsert(classifications, root, CLASSIFICATIONS, key, fmt, order)


def read_metadata(
    spark: SparkSession, root: str, fmt: str = "parquet", companies: list[str] | None = None
) -> DataFrame:
    """Read back a table of :func:`write_metadata`, whole or for some ``companies`` (by cik)."""
    return read_table(spark, root, METADATA, fmt, companies)


def read_classifications(
    spark: SparkSession, root: str, fmt: str = "parquet", companies: list[str] | None = None
) -> DataFrame:
    """Read back a table of :func:`write_classifications`, whole or for some ``companies``."""
    return read_table(spark, root, CLASSIFICATIONS, fmt, companies)

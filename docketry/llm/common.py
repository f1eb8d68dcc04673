"""Helpers shared by the operators: the shared folder, staged tables, text buffers, components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from the session.

    A local session that names none gets a temporary one; a cluster must name its own.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_pieces(column: pa.Array, max_bytes: int, max_rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of ``max_rows`` rows and about ``max_bytes`` of text at most; a longer text is one of its own."""
    sizes = np.asarray(pa.compute.binary_length(column).fill_null(0), np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and (held + size > max_bytes or row - start == max_rows):
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def release() -> None:
    """Give memory that is free again back to the system: workers wait for more tasks after one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of the C library of most Linux systems alone
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches; in the end, the memory that it has freed goes back to the system."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and where each text begins and ends.

    A null is an empty text.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][: len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def in_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """Runs of equal ``keys`` in sorted batches, each as an iterator of batches.

    Each run must be used up before the next is asked for.
    """
    source = (b for b in batches if b.num_rows)
    held: list[pa.RecordBatch] = []

    def first() -> pa.RecordBatch | None:
        return held.pop() if held else next(source, None)

    def run(key: tuple) -> Iterator[pa.RecordBatch]:
        while (batch := first()) is not None:
            same = np.ones(batch.num_rows, bool)
            for name, value in zip(keys, key):
                same &= np.asarray(batch.column(name)) == value
            end = batch.num_rows if same.all() else int(np.argmin(same))
            if end:
                yield batch.slice(0, end)
            if end < batch.num_rows:
                held.append(batch.slice(end))
                return

    while (batch := first()) is not None:
        key = tuple(batch.column(name)[0].as_py() for name in keys)
        held.append(batch)
        group = run(key)
        yield key, group
        for _ in group:
            pass


class Forest:
    """Union-find over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.fromiter((self.root(i) for i in range(len(self.parent))), np.int64, len(self.parent))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, component), the smallest node reachable; only of linked nodes.

    ``edges`` has the columns a and b. Each round first points the larger neighbours of every
    node at its smallest neighbour, then does the same for the smaller ones, until nothing
    changes (two aggregations with a map-side minimum and two joins a round, logarithmically many
    rounds in practice). Rounds are written to the shared folder.
    """
    spark = edges.sparkSession

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    current = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        "edges",
    )

    def state(table: DataFrame) -> tuple:
        row = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return tuple(row)

    before = state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct()
        )
        low = smallest(large)
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = stage(small.where("u != v").distinct(), "edges")
        drop_staged(current)
        current, last = after, before
        before = state(current)
        if before == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = smallest(current).select(F.col("u").alias("node"), F.col("m").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

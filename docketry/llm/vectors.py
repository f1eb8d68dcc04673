"""What the vector operators share: valid vectors, cells in blocks, samples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    flat = np.asarray(lists.flatten(), np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def one_each(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) with one row for each id: repeated ids keep their greatest vector.

    Rows without an id are left out.
    """
    rows = vectors.select(
        vectors["vec_id"].cast("bigint").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding")
    ).where("vec_id is not null")
    return rows.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors without null or non-finite components that are not zero.

    Where lengths differ, those of the most frequent length (the greater of equals) take part.
    """
    limit = 1.7976931348623157e308
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > limit))
    some = F.exists("embedding", lambda x: x != 0)
    good = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~bad & some)
    top = good.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return good.where(F.size("embedding") == (top[0]["dims"] if top else -1))


def sample_matrix(vectors: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and rows of the ``limit`` vectors whose ids have the smallest hashes."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).select("vec_id", "embedding").collect()
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    return np.array([r["vec_id"] for r in rows], np.int64), np.array([r["embedding"] for r in rows], np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    # Division by the greatest component first keeps squares of huge and tiny vectors finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def digest(row: np.ndarray) -> bytes:
    return hashlib.blake2b((row + 0.0).tobytes(), digest_size=16).digest()


def read_group(batches: Iterator[pa.RecordBatch], role: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The batches of a group, cut where ``role`` changes; says which are of the given role."""
    for batch in batches:
        mine = np.asarray(batch.column("role")) == role
        cut = int(mine.sum())  # the given role is sorted first
        if cut:
            yield True, batch.slice(0, cut)
        if cut < batch.num_rows:
            yield False, batch.slice(cut)

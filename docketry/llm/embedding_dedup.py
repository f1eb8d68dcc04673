"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one kept of each group.

Equal vectors are one class, counted once with their number. Spherical k-means on a bounded sample
gives the cells, and each vector lives in the cell of its nearest centre. Two vectors of a link are at
most sqrt(2 - 2 t) apart, so a vector can only have a partner in another cell if it lies that near to
the plane between the two centres; there it is sent as a visitor. Every link is found so. Cells larger
than a block are split, and vectors meet the blocks of their cell one after the other.

The links of a block are counted and leave it as a forest, never as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Forest, components, in_groups, stage
from docketry.llm.vectors import digest, matrix, one_each, read_group, sample_matrix, unit, usable

THRESHOLD = 0.95
SAMPLE = 4_096  # vectors that k-means sees
CELL = 4_096  # vectors of a cell, about, and of a block at most, about
MAX_CELLS = 1_024
ROUNDS = 8
SLICE = 512  # visitors that are multiplied at once
SLACK = 1e-9  # for rounding, in deciding where a vector visits


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of unit vectors; the first centres are spread over the sample."""
    cells = min(cells, len(x))
    centres = x[np.linspace(0, len(x) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        filled = size > 1e-12
        centres[filled] = sums[filled] / size[filled, None]
    return centres


def visits(x: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's own cell, and which others may hold a partner within ``reach`` of it.

    Of two cells the one with the greater number sends, so each pair meets once.
    """
    near = x @ centres.T
    own = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    margin = near[np.arange(len(x)), own][:, None] - near
    may = margin <= reach * apart[own] + SLACK
    return own, may & (np.arange(len(centres)) < own[:, None])


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector id.

    Vectors link from a cosine of ``threshold`` (over 0) in double precision. n_links counts the
    other vectors that are linked directly; component_id is the smallest id that links reach; the
    vector of that id is kept. Null and zero vectors, and those with null or non-finite components or
    an odd length, link with nothing. Rows without an id are left out; repeated ids count once, with
    their greatest vector. Other columns are not read. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    all_rows = one_each(vectors)
    good = usable(all_rows)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [digest(row) for row in matrix(batch.column("embedding"))]
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column("vec_id"), "vec_hash": pa.array(prints, pa.binary()), "embedding": batch.column("embedding")}
            )

    rows = stage(good.mapInArrow(classed, "vec_id bigint, vec_hash binary, embedding array<double>"), "vectors")
    classes = stage(
        rows.groupBy("vec_hash").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    firsts = rows.join(classes.select(F.col("rep").alias("vec_id"), "copies"), "vec_id")
    count = classes.count()
    _, sample = sample_matrix(rows.select("vec_id", "embedding"), SAMPLE)
    centres = spherical_kmeans(unit(sample), min(-(-count // CELL), MAX_CELLS)) if count else np.zeros((0, 0))
    reach = float(np.sqrt(2 - 2 * threshold))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, may = visits(unit(matrix(batch.column("embedding"))), centres, reach)
            cells = [np.append(o, np.flatnonzero(m)) for o, m in zip(own, may)]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("vec_id"), "copies": batch.column("copies"), "embedding": batch.column("embedding"),
                "cells": pa.array(cells, pa.list_(pa.int64())),
            })

    placed = stage(firsts.mapInArrow(homes, "id bigint, copies bigint, embedding array<double>, cells array<bigint>"), "cells")
    # Blocks of each cell: at most MAX_CELLS numbers.
    blocks = {r["cell"]: -(-r["n"] // CELL) for r in placed.groupBy(F.col("cells")[0].alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    of_cell = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col("cell")) if blocks else F.lit(1)
    sent = placed.select("id", "copies", "embedding", F.posexplode("cells").alias("place", "cell"))
    sent = sent.withColumn("blocks", F.coalesce(of_cell.cast("int"), F.lit(0)))
    own_block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # At home: its own block, and as a visitor the blocks before it; elsewhere all blocks.
    last = F.when(F.col("place") == 0, own_block).otherwise(F.col("blocks") - 1)
    sent = (
        sent.where("blocks > 0").select("id", "copies", "embedding", "cell", "place", own_block.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("block"))
        .select("id", "copies", "embedding", "cell", "block", F.when((F.col("place") == 0) & (F.col("own") == F.col("block")), 0).otherwise(1).alias("role"))
    )
    sent = sent.repartition("cell", "block").sortWithinPartitions("cell", "block", "role", "id")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in in_groups(batches, ["cell", "block"]):
            yield from _block_links(group, threshold)

    found = stage(sent.mapInArrow(products, "id bigint, links bigint, root bigint"), "links")
    linked = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = (
        classes.join(counts, F.col("rep") == F.col("id"), "left").join(linked, F.col("rep") == F.col("node"), "left")
        .select(
            "vec_hash", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    known = rows.select("vec_id", "vec_hash").join(per_class, "vec_hash").drop("vec_hash")
    return (
        all_rows.select("vec_id").join(known, "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )


def _block_links(group: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links among the vectors that live in a block, and of its visitors with them."""
    held: list[pa.RecordBatch] = []
    home = None
    for at_home, batch in read_group(group, 0):
        if at_home:
            held.append(batch)
            continue
        home = home or _Home(held, threshold)
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            home.meet(np.asarray(part.column("id")), np.asarray(part.column("copies")), unit(matrix(part.column("embedding"))))
    if held:
        home = home or _Home(held, threshold)
        yield from home.result()


class _Home:
    """The vectors of a block, the links that each has so far, and how they hang together."""

    def __init__(self, batches: list[pa.RecordBatch], threshold: float):
        self.threshold = threshold
        self.ids = np.concatenate([np.asarray(b.column("id")) for b in batches])
        self.copies = np.concatenate([np.asarray(b.column("copies")) for b in batches])
        self.x = unit(np.concatenate([matrix(b.column("embedding")) for b in batches]))
        self.links = np.zeros(len(self.ids), np.int64)
        self.forest = Forest(len(self.ids))
        self.guests: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(0, len(self.ids), SLICE):
            near = self.x[start: start + SLICE] @ self.x.T >= threshold
            near[np.arange(len(near)), start + np.arange(len(near))] = False
            self.links[start: start + SLICE] += near @ self.copies
            self._hang(near, start)

    def _hang(self, near: np.ndarray, start: int) -> None:
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            for other in np.flatnonzero(near[row, : start + row]).tolist():
                self.forest.join(start + row, other)

    def meet(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray) -> None:
        near = x @ self.x.T >= self.threshold
        some = near.any(axis=1)
        if not some.any():
            return
        ids, copies, near = ids[some], copies[some], near[some]
        self.links += copies @ near
        for row in near:
            mine = np.flatnonzero(row)
            for other in mine[1:].tolist():
                self.forest.join(int(mine[0]), other)
        self.guests.append((ids, near @ self.copies, near.argmax(axis=1)))

    def result(self) -> Iterator[pa.RecordBatch]:
        roots = self.forest.roots()
        smallest = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(smallest, roots, self.ids)
        tops = smallest[roots]
        mine = (self.links > 0) | (tops != self.ids)
        yield pa.RecordBatch.from_pydict({"id": self.ids[mine], "links": self.links[mine], "root": tops[mine]})
        for ids, links, at in self.guests:
            yield pa.RecordBatch.from_pydict({"id": ids, "links": links.astype(np.int64), "root": tops[at]})

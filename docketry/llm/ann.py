"""Approximate nearest neighbours by learned partitions.

On one half of a bounded sample, the graph of nearest neighbours is cut into partitions of equal size
that keep neighbours together, and a small network learns the partition of a vector. It then places
every row, and sends each query to its most probable partitions, whose rows are ranked exactly. How many
a query visits is calibrated on the other half, which nothing was fitted on: enough that the wanted
share of the true neighbours of its vectors lies in them. Of several numbers of partitions, up to one
that grows with the rows, the one is taken with which a query costs least, by the products and the
visits that the calibration has found; vectors without structure gain nothing from more partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketry.llm.common import in_groups, stage
from docketry.llm.vectors import matrix, one_each, read_group, sample_matrix, unit, usable

SAMPLE = 4_096  # vectors the partitions are learned from, and as many that calibrate the visits, at most
LEAST_PARTITIONS = 16  # where there are enough rows to learn so many from
PER_PARTITION = 16  # sampled vectors of a partition, at least
CALIBRATED = 1_024  # queries of the calibration, at most
SHIPPING = 2_000  # products that sending a query to one more partition costs as much as, about
NEIGHBOURS = 10  # of a sampled vector in the graph
HIDDEN = 64
EPOCHS = 12
RECALL = 0.95  # wanted on the sample
BLOCK = 8_192  # indexed rows of a block, about
SLICE = 256


@dataclass
class Router:
    """A network of one hidden layer: probabilities of the partitions."""

    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray
    probes: int
    share: float = 1.0  # of the rows that a query meets, on the sample

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.inner + self.inner_bias, 0) @ self.outer + self.outer_bias

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")


def balanced_partition(x: np.ndarray, neighbours: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """Partitions of equal size (but for one) of a neighbour graph, few of whose edges are cut.

    Seeds are split by directions of the vectors; then each vector asks for the partition that most
    of its neighbours are in, and the strongest wishes are granted while there is room.
    """
    n = len(x)
    own = np.zeros(n, np.int64)
    pieces = [np.arange(n)]
    while len(pieces) < parts:
        pieces.sort(key=len)
        piece = pieces.pop()
        centred = x[piece] - x[piece].mean(axis=0)
        direction = centred[np.argmax((centred**2).sum(axis=1))] if len(piece) > 1 else centred[0]
        order = np.argsort(centred @ direction, kind="stable")
        pieces += [piece[order[: len(piece) // 2]], piece[order[len(piece) // 2:]]]
    for number, piece in enumerate(pieces):
        own[piece] = number
    room = -(-n // parts)
    both = np.concatenate([np.repeat(np.arange(n), neighbours.shape[1]), neighbours.ravel()])
    other = np.concatenate([neighbours.ravel(), np.repeat(np.arange(n), neighbours.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (both, own[other]), 1)
        gain = votes - votes[np.arange(n), own][:, None]
        order = np.argsort(-gain.max(axis=1), kind="stable")
        wish = gain.argmax(axis=1)
        filled = np.bincount(own, minlength=parts)
        moved = 0
        for i in order.tolist():
            to = wish[i]
            if gain[i, to] <= 0:
                break
            if filled[to] < room + 2:
                filled[own[i]] -= 1
                filled[to] += 1
                own[i] = to
                moved += 1
        if not moved:
            break
    return own


def partitions_for(rows: int) -> int:
    """Partitions for so many rows: half their root as a power of two, as far as the sample can tell them apart."""
    wanted = 1 << max(round(np.log2(max(rows, 1)) / 2 - 1), 0)
    return max(min(max(wanted, LEAST_PARTITIONS), SAMPLE // PER_PARTITION), 1)


def learn_router(
    x: np.ndarray, held: np.ndarray, k: int, parts: int = LEAST_PARTITIONS, recall: float = RECALL, total: int | None = None, seed: int = 5
) -> Router:
    """Partitions ``x``, learns to tell the partition of a vector from its direction, calibrates on ``held``.

    ``total`` is the number of rows that the sample stands for.
    """
    rng = np.random.default_rng(seed)
    n, dims = x.shape
    parts = max(1, min(parts, n // 4))
    if parts == 1 or not len(held):
        return Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    directions = unit(x)
    products = x @ x.T
    np.fill_diagonal(products, -np.inf)
    near = min(NEIGHBOURS, n - 1)
    best = np.argsort(-products, axis=1, kind="stable")[:, :near]
    own = balanced_partition(directions, best, parts)
    router = Router(
        rng.normal(0, np.sqrt(2 / dims), (dims, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts), parts,
    )
    # A vector's target is where it and its neighbours are, as in soft labels.
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), near), own[best].ravel()), 0.5 / near)
    target[np.arange(n), own] += 0.5
    names = ("inner", "inner_bias", "outer", "outer_bias")
    first = {m: np.zeros_like(getattr(router, m)) for m in names}
    second = {m: np.zeros_like(getattr(router, m)) for m in names}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for low in range(0, n, 128):
            rows = order[low: low + 128]
            hidden = np.maximum(directions[rows] @ router.inner + router.inner_bias, 0)
            z = hidden @ router.outer + router.outer_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (dz @ router.outer.T) * (hidden > 0)
            grads = {
                "inner": directions[rows].T @ dh, "inner_bias": dh.sum(axis=0),
                "outer": hidden.T @ dz, "outer_bias": dz.sum(axis=0),
            }
            step += 1
            for m in names:
                first[m] = 0.9 * first[m] + 0.1 * grads[m]
                second[m] = 0.99 * second[m] + 0.01 * grads[m] ** 2
                move = first[m] / (1 - 0.9**step) / (np.sqrt(second[m] / (1 - 0.99**step)) + 1e-9)
                setattr(router, m, getattr(router, m) - 0.01 * (1 - epoch / EPOCHS) * move)
    router.probes, router.share = calibrated(router, x, held, k, recall, total or n + len(held))
    return router


def cheapest_router(x: np.ndarray, held: np.ndarray, k: int, recall: float, total: int) -> Router:
    """The router with which a query of ``total`` rows costs least."""
    best, cost = None, math.inf
    parts, most = LEAST_PARTITIONS, partitions_for(total)
    while True:
        router = learn_router(x, held, k, min(parts, most), recall, total)
        found = router.share * total + router.probes * SHIPPING
        if found < cost:
            best, cost = router, found
        if parts >= most:
            return best
        parts *= 4


def calibrated(router: Router, x: np.ndarray, held: np.ndarray, k: int, recall: float, rows: int) -> tuple[int, float]:
    """Partitions to visit, so that ``recall`` of the neighbours of vectors not learned from lie in them,
    and the share of the rows in these.

    Rows are placed by the network itself, so it is that placement which decides. The sample is thinner
    than the table, where the k nearest are as near as fewer of the sample are; five at least are used.
    """
    every = np.concatenate([held, x])
    asked = min(CALIBRATED, len(held))
    near = min(max(-(-k * len(every) // max(rows, len(every))), 5), k, len(every) - 1)
    placed = router.ranked(unit(every))[:, 0]
    ranked = router.ranked(unit(held[:asked]))
    rank_of = np.argsort(ranked, axis=1)
    depths = []
    for low in range(0, asked, SLICE):
        own = np.arange(low, min(low + SLICE, asked))
        products = held[own] @ every.T
        products[np.arange(len(own)), own] = -np.inf
        best = np.argpartition(-products, near - 1, axis=1)[:, :near]
        depths.append(np.take_along_axis(rank_of[own], placed[best], axis=1).ravel())
    depth = np.sort(np.concatenate(depths))
    probes = int(depth[min(int(np.ceil(recall * len(depth))), len(depth)) - 1]) + 1
    sizes = np.bincount(placed, minlength=ranked.shape[1])
    return probes, float(sizes[ranked[:, :probes]].sum(axis=1).mean() / len(every))


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query, by inner product.

    ``is_query`` is a condition on vec_id. Candidates are all rows but the query's own; ties go to
    the smaller vec_id; a query has fewer rows only if it met fewer candidates than ``k``, for which
    it then is compared with all. Null and zero vectors, and those with null or non-finite components
    or an odd length, take no part; rows without an id are left out and repeated ids count once, with
    their greatest vector. Other columns are not read.
    """
    rows = stage(usable(one_each(vectors)), "index")
    _, sample = sample_matrix(rows, 2 * SAMPLE)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not len(sample):
        return rows.sparkSession.createDataFrame([], schema)
    total = rows.count()
    # In the order of hashes, every other vector is as good a sample as any.
    router = cheapest_router(sample[::2], sample[1::2], k, recall, total)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranked = router.ranked(unit(matrix(batch.column("embedding"))))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("vec_id"), "query": batch.column("query"), "embedding": batch.column("embedding"),
                "ranked": pa.array(list(ranked.astype(np.int64)), pa.list_(pa.int64())),
            })

    flagged = rows.select("vec_id", F.coalesce(is_query, F.lit(False)).alias("query"), "embedding")
    placed = stage(flagged.mapInArrow(route, "id bigint, query boolean, embedding array<double>, ranked array<bigint>"), "placed")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy(F.col("ranked")[0].alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {cell: -(-n // BLOCK) for cell, n in sizes.items()}
    block_map = F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])
    of_cell = F.coalesce(F.element_at(block_map, F.col("cell")).cast("int"), F.lit(0))
    # A query goes on to further partitions until it meets more than k rows.
    size_map = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    met = F.transform("ranked", lambda c: F.coalesce(F.element_at(size_map, c), F.lit(0)))
    before = F.expr("transform(sequence(1, size(ranked)), n -> aggregate(slice(met, 1, n - 1), 0L, (a, b) -> a + b))")
    index = placed.select("id", "embedding", F.col("ranked")[0].alias("cell")).withColumn("blocks", of_cell).select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "id", "embedding"
    )
    queries = (
        placed.where("query").withColumn("met", met).withColumn("before", before)
        .select("id", "embedding", F.posexplode(F.arrays_zip("ranked", "before")).alias("place", "at"))
        .where((F.col("place") < router.probes) | (F.col("at.before") <= k))
        .select("id", "embedding", F.col("at.ranked").alias("cell")).withColumn("blocks", of_cell).where("blocks > 0")
        .select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "id", "embedding")
    )
    sent = index.unionByName(queries).repartition("cell", "block").sortWithinPartitions("cell", "block", "role", "id")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in in_groups(batches, ["cell", "block"]):
            yield from _rank_block(group, k)

    found = sent.mapInArrow(rank, "query_id bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rank_block(group: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best k of a block for every query that visits it."""
    held: list[pa.RecordBatch] = []
    ids = x = top = None
    for indexed, batch in read_group(group, 0):
        if indexed:
            held.append(batch)
            continue
        if not held:
            continue
        if x is None:
            ids = np.concatenate([np.asarray(b.column("id")) for b in held])
            x = np.concatenate([matrix(b.column("embedding")) for b in held])
            top = float(np.abs(x).max())
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            own = np.asarray(part.column("id"))
            asked = matrix(part.column("embedding"))
            scores = asked @ x.T
            scores[own[:, None] == ids[None, :]] = -np.inf
            take = min(k, len(ids))
            edge = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
            # A product of matrices may differ in its last bits from block to block, so all that come near
            # the last one are scored again, each by itself.
            doubt = 1e-12 * np.abs(asked).sum(axis=1) * top
            for row, least, vector, query in zip(scores, edge - np.nan_to_num(doubt, posinf=0.0), asked, own.tolist()):
                able = np.flatnonzero((row >= least) & (row > -np.inf))
                exact = (x[able] * vector).sum(axis=1)
                best = np.lexsort((ids[able], -exact))[:take]
                able, exact = able[best], exact[best]
                if len(able):
                    yield pa.RecordBatch.from_pydict({"query_id": np.full(len(able), query), "vec_id": ids[able], "score": exact})

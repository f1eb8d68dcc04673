"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover it whole. In every chunk, learned filters over
``WIDTH`` bytes slide over all positions and are max-pooled; a document's pooled chunks are combined
by their mean and their maximum, and a logistic unit makes one probability of both.

A filter stands at every byte of a text and once behind the last, over zero bytes beyond the end; no
filter sees two texts, so a score depends on its text alone.

The network is fitted on the driver on a bounded sample of labelled rows; scoring runs where the
documents are, a quarter of a megabyte of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import text_buffer, text_pieces, tidy

WIDTH = 6  # bytes under a filter
FILTERS = 12
STEP = 250  # bytes from one chunk to the next
CHUNK = STEP + WIDTH - 1  # so that every position of a filter lies in exactly one chunk
MAX_SAMPLE = 1_600  # labelled rows the network is fitted on, at most
SAMPLE_CHUNKS = 8  # chunks of one labelled row that are used in fitting, spread over its text
EPOCHS = 14
KEEP_WEIGHT = 0.7  # share of the loss that rows of label 1 have; over 0.5, good documents are kept in doubt
PIECE_BYTES = 1 << 18


@dataclass
class Network:
    """table[k, byte] is what the filters add for that byte at offset k."""

    table: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,), for the mean and the maximum of the chunks
    offset: float

    def pooled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Filters max-pooled over the positions from each start to its end, then rectified.

        ``data`` carries WIDTH bytes beyond the last position. Positions in no chunk are passed over.
        """
        n = len(data) - WIDTH + 1
        hidden = np.take(self.table[0], data[:n], axis=0)
        for k in range(1, WIDTH):
            hidden += np.take(self.table[k], data[k: k + n], axis=0)
        bounds = np.column_stack([starts, ends]).ravel()
        return np.maximum(np.maximum.reduceat(hidden, bounds, axis=0)[::2] + self.bias, 0)

    def probability(self, pooled: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """One probability for each document; ``firsts`` are the rows of their first chunks."""
        counts = np.diff(np.append(firsts, len(pooled)))[:, None]
        mean = np.add.reduceat(pooled, firsts, axis=0) / counts
        features = np.hstack([mean, np.maximum.reduceat(pooled, firsts, axis=0)])
        z = features.astype(np.float64) @ self.weights.astype(np.float64) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def chunk_bounds(sizes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all chunks of texts that begin where they say, and each text's first chunk.

    Sizes count the filter positions of a text, of which there is one at least.
    """
    counts = (sizes + STEP - 1) // STEP
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    within = np.arange(counts.sum()) - np.repeat(firsts, counts)
    starts = np.repeat(begins, counts) + within * STEP
    return starts, np.minimum(starts + STEP, np.repeat(begins + sizes, counts)), firsts


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with WIDTH zero bytes after each, their filter positions and where they begin.

    Positions are the bytes of a text and one behind them; an empty text has that one.
    """
    sizes = np.diff(offsets)
    begins = offsets[:-1] + np.arange(len(sizes)) * WIDTH
    out = np.zeros(len(data) + WIDTH * len(sizes) + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(sizes)) * WIDTH, sizes)] = data
    return out, sizes + 1, begins


def score_texts(network: Network, column: pa.Array) -> np.ndarray:
    """Probabilities of whole texts; a null counts as an empty text."""
    data, offsets = text_buffer(column)
    padded, sizes, begins = _padded(data, offsets)
    starts, ends, firsts = chunk_bounds(sizes, begins)
    pooled = np.empty((len(starts), len(network.bias)), np.float32)
    # Long texts go through the filters in slices of whole chunks.
    at = 0
    while at < len(starts):
        to = min(at + PIECE_BYTES // STEP, len(starts))
        begin = int(starts[at])
        pooled[at:to] = network.pooled(padded[begin: int(ends[to - 1]) + WIDTH], starts[at:to] - begin, ends[at:to] - begin)
        at = to
    return network.probability(pooled, firsts)


def fit_network(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """Gradient descent with Adam on the log loss; the classes have fixed shares of it.

    Only the positions that win the pooling get a gradient, so a pass costs little more than scoring.
    Without rows of both classes, the network says what the rows say, or 0.5 if there are none.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
    network = Network(table, np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), 0.0)
    labels = np.asarray(labels, np.float64)
    if not len(labels) or labels.min() == labels.max():
        network.offset = 4.0 * (2 * labels[0] - 1) if len(labels) else 0.0
        return network
    network.weights = rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
    # Short excerpts of both classes teach that the length of a text says nothing.
    excerpts, known = [], []
    for text, label in zip(texts, labels.tolist()):
        if len(text) > 120:
            start, size = int(rng.integers(0, len(text) - 120)), int(rng.integers(12, 120))
            excerpts.append(text[start: start + size])
            known.append(label)
    texts = [*texts, *excerpts]
    labels = np.append(labels, known)
    balance = np.where(labels == 1, KEEP_WEIGHT / labels.mean(), (1 - KEEP_WEIGHT) / (1 - labels.mean()))
    names = ("table", "bias", "weights", "offset")
    first = {n: np.zeros_like(np.asarray(getattr(network, n), np.float32)) for n in names}
    second = {n: np.zeros_like(v) for n, v in first.items()}
    step, size = 0, 64
    chunks = [_sample_chunks(t, rng) for t in texts]
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), size):
            rows = order[low: low + size]
            grads = _gradients(network, [chunks[i] for i in rows], labels[rows], balance[rows])
            step += 1
            rate = 0.01 * (1 - epoch / EPOCHS)
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.99 * second[n] + 0.01 * grads[n] ** 2
                move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
                setattr(network, n, getattr(network, n) - (rate * move).astype(np.float32))
    network.offset = float(network.offset)
    return network


def _sample_chunks(text: bytes, rng: np.random.Generator) -> list[np.ndarray]:
    """Up to SAMPLE_CHUNKS chunks of a labelled text, spread over the whole of it."""
    data = np.frombuffer(text + bytes(WIDTH), np.uint8)
    count = (len(text) + STEP) // STEP
    if count > SAMPLE_CHUNKS:
        edges = np.linspace(0, count, SAMPLE_CHUNKS + 1).astype(int)
        picked = [int(rng.integers(a, b)) for a, b in zip(edges, edges[1:])]
    else:
        picked = range(count)
    return [data[i * STEP: i * STEP + CHUNK] for i in picked]


def _gradients(network: Network, texts: list[list[np.ndarray]], y: np.ndarray, balance: np.ndarray) -> dict:
    counts = np.array([len(t) for t in texts])
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    parts = [c for t in texts for c in t]
    lengths = np.array([len(p) - WIDTH + 1 for p in parts])
    data = np.concatenate(parts)
    # Positions of each chunk in the joined bytes; a filter never reaches into the next chunk.
    begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) + np.repeat(begins - starts, lengths)
    hidden = network.table[0][data[place]]
    for k in range(1, WIDTH):
        hidden = hidden + network.table[k][data[place + k]]
    top = np.maximum.reduceat(hidden, starts, axis=0)
    pooled = np.maximum(top + network.bias, 0)
    mean = np.add.reduceat(pooled, firsts, axis=0) / counts[:, None]
    most = np.maximum.reduceat(pooled, firsts, axis=0)
    features = np.hstack([mean, most])
    p = 1 / (1 + np.exp(-np.clip(features @ network.weights + float(network.offset), -40, 40)))
    dz = ((p - y) * balance / len(y)).astype(np.float32)
    filters = len(network.bias)
    d_mean = np.outer(dz, network.weights[:filters]) / counts[:, None]
    d_most = np.outer(dz, network.weights[filters:])
    owner = np.repeat(np.arange(len(texts)), counts)
    d_pooled = d_mean[owner] + d_most[owner] * (pooled == most[owner])
    d_pooled *= pooled > 0
    # The first position that reaches the maximum of its chunk, for every filter that has a gradient.
    chunk_of = np.repeat(np.arange(len(parts)), lengths)
    where, which = np.nonzero((hidden == top[chunk_of]) & (d_pooled != 0)[chunk_of])
    _, once = np.unique(chunk_of[where] * filters + which, return_index=True)
    where, which = where[once], which[once]
    g = d_pooled[chunk_of[where], which]
    taps = np.arange(WIDTH)[:, None]
    flat = (taps * 256 + data[place[where] + taps]) * filters + which
    d_table = np.bincount(flat.ravel(), np.broadcast_to(g, flat.shape).ravel(), network.table.size)
    d_table = d_table.astype(np.float32).reshape(network.table.shape)
    decay = 1e-4
    return {
        "table": d_table + decay * network.table,
        "bias": d_pooled.sum(axis=0),
        "weights": features.T @ dz + decay * network.weights,
        "offset": np.float32(dz.sum()),
    }


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def train_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column | None = None, max_sample: int = MAX_SAMPLE
) -> Network:
    """Fits the network on at most ``max_sample`` labelled documents, half of them of each class.

    ``held_out`` (on doc_id) names rows that are never learned from. Of each class the rows with the
    smallest hash of their id are taken, so the sample depends on neither order nor partitions.
    Labels other than 0 and 1, null labels and null ids are passed over.
    """
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality in (0, 1)")
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample // 2)
        for q in (0, 1)
    ]
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # At most max_sample ids are broadcast, so the texts stay where they are.
    rows = (
        texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id")
        .groupBy("doc_id", "quality").agg(F.max(_spread(F.col("text"))).alias("text"))
        .orderBy("doc_id").collect()
    )
    return fit_network([(r["text"] or "").encode() for r in rows], np.array([r["quality"] for r in rows]))


def _spread(text: Column, part: int = 1_600, parts: int = 5) -> Column:
    """A text that the driver can hold many of: longer ones as five parts from beginning to end."""
    step = (F.length(text) - part) / (parts - 1)
    pieces = [F.substr(text, (F.lit(k) * step).cast("int") + 1, F.lit(part)) for k in range(parts)]
    return F.when(F.length(text) <= part * parts, text).otherwise(F.concat(*pieces))


def score_quality(docs: DataFrame, network: Network, keep: bool = False) -> DataFrame:
    """doc_id and ``score`` of every document, in double precision between 0 and 1.

    A null text is scored as an empty one. Only doc_id and text are read; with ``keep``, all columns
    of ``docs`` stay and ``score`` is added (a column of that name is replaced).
    """
    columns = [c for c in docs.columns if c != "score"] if keep else ["doc_id", "text"]
    given = docs.select(*[docs[c] for c in columns])
    if not keep:
        given = given.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = given.schema if keep else given.select("doc_id").schema
    names = out.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for start, end in text_pieces(column, PIECE_BYTES):
                part = batch.slice(start, end - start)
                scores = score_texts(network, part.column("text"))
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(scores)], [*names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    return given.mapInArrow(tidy(score), f"{schema}, score double")

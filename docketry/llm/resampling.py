"""Importance resampling towards a target distribution, with weights from bit-sliced counts.

Features are runs of one to three consecutive words, hashed into buckets. The counts of a document are
cut into bit planes: plane j holds bit j of the counts of all buckets, as one long bit string. The
gains of the buckets, whole numbers of either sign, are cut into planes of their two's complement. The
weight of a document is then a sum over pairs of planes: the bits that both have, counted, times a
power of two (minus one for the sign plane). Nothing is rounded.

The corpus is read twice, once for its totals by bucket, which do not grow with it, and once for the
weights; neither texts nor features are shuffled. The draw ranks documents by weight plus Gumbel noise
from a hash of their id. Ranks come from a range partitioning and one offset for each partition, so no
task sees all rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import stage, text_buffer, text_pieces

BUCKETS = 10_000
LONGEST = 3  # words of a feature, at most
PIECE_BYTES = 1 << 20
BLOCK = 64  # documents whose counts are held at a time
SHORT = 64  # bytes of a word up to which hashes are put together by tables

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[ord("0"): ord("9") + 1] = _WORD[ord("a"): ord("z") + 1] = _WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


def _shift_tables() -> np.ndarray:
    """shift[n, k, b]: what byte k of a crc becomes, if it is b, as n zero bytes follow."""
    shift = np.empty((SHORT + 2, 4, 256), np.uint32)
    shift[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * 8)
    for n in range(1, SHORT + 2):
        shift[n] = _CRC[shift[n - 1] & 255] ^ (shift[n - 1] >> 8)
    return shift


_CRC = _crc_table()
_SHIFT = _shift_tables()


def _appended(crc: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of texts with tails appended, from the crc32 of both and the bytes of the tails."""
    out = tail.copy()
    for k in range(4):
        out ^= _SHIFT[size, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of all words in lower-cased bytes; no word reaches into the next text."""
    inside = _WORD[data]
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1


def word_crcs(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of every word; those up to SHORT bytes all at once, byte by byte."""
    crc = np.full(len(begins), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    longer = int(np.count_nonzero(sizes > SHORT))
    order = order[longer:]
    begin, size, state = begins[order], sizes[order], crc[longer:]
    counts = len(size) - np.searchsorted(size[::-1], np.arange(SHORT), side="right")
    for k, n in enumerate(counts.tolist()):
        if not n:
            break
        state[:n] = _CRC[(state[:n] ^ data[begin[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(begins), np.uint32)
    out[order] = ~state
    for n in np.flatnonzero(sizes > SHORT).tolist():
        out[n] = zlib.crc32(data[begins[n]: begins[n] + sizes[n]])
    return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature of texts laid out one after the other, and words of each text."""
    data = _LOWER[data]
    texts = len(offsets) - 1
    begins, ends, owner = find_words(data, offsets)
    sizes = ends - begins
    words = np.bincount(owner, minlength=texts)
    one = word_crcs(data, begins, sizes)
    space = np.full(1, zlib.crc32(b" "), np.uint32)
    small = np.minimum(sizes, SHORT)
    spaced = _appended(np.broadcast_to(space, one.shape), one, small)  # of words with a space before
    longer = np.flatnonzero(sizes > SHORT).tolist()
    owners, found, last = [owner], [one], one
    for n in range(1, LONGEST):
        # Features of n + 1 words, by their first word; a long word is appended by itself.
        grown = _appended(last[:-1], spaced[n:], small[n:] + 1)
        for at in longer:
            if at >= n:
                grown[at - n] = zlib.crc32(data[begins[at]: ends[at]], zlib.crc32(b" ", int(last[at - n])))
        whole = owner[:-n] == owner[n:] if len(owner) > n else np.zeros(0, bool)
        owners.append(owner[: len(whole)][whole])
        found.append(grown[: len(whole)][whole])
        last = grown
        if not len(last):
            break
    return np.concatenate(owners), np.concatenate(found) % np.uint32(buckets), words


def plane(values: np.ndarray, j: int) -> np.ndarray:
    """Bit j of rows of non-negative numbers, as rows of 64-bit words."""
    packed = np.packbits((values >> values.dtype.type(j)).astype(np.uint8) & 1, axis=1)
    out = np.zeros((len(values), -(-values.shape[1] // 64) * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Planes of the two's complement of whole numbers, and what a bit of each plane is worth."""
    bits = max(int(gains.max(initial=0)).bit_length(), int(-gains.min(initial=0) - 1).bit_length() if gains.min(initial=0) < 0 else 0) + 1
    worth = [1 << k for k in range(bits - 1)] + [-(1 << (bits - 1))]
    cut = (gains & ((1 << bits) - 1))[None, :]
    return np.concatenate([plane(cut, k) for k in range(bits)]), worth


def sliced_weights(counts: np.ndarray, gains: np.ndarray, worth: list[int]) -> np.ndarray:
    """Sums of counts times gains, from the planes of both; rows without a bit in a plane are passed over."""
    weights = np.zeros(len(counts), np.int64)
    most = counts.max(axis=1, initial=0)
    for j in range(int(most.max(initial=0)).bit_length()):
        rows = np.flatnonzero(most >> j)
        kept = counts[rows]
        own = plane(kept.astype(np.min_scalar_type(int(kept.max()))), j)
        for mask, value in zip(gains, worth):
            weights[rows] += np.bitwise_count(own & mask).sum(axis=1, dtype=np.int64) * (value << j)
    return weights


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    column = batch.column("text")
    for start, end in text_pieces(column, PIECE_BYTES):
        for low in range(start, end, BLOCK):
            high = min(low + BLOCK, end)
            yield (low, high, *text_buffer(column.slice(low, high - low)))


def bucket_totals(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; each task adds up its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in _blocks(batch):
                totals += np.bincount(features(data, offsets, buckets)[1], minlength=buckets)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals[held])], ["bucket", "features"])

    text = texts.select(F.col("text").cast("string").alias("text"))
    # At most ``buckets`` rows, whatever the size of the table.
    rows = text.mapInArrow(count, "bucket bigint, features bigint").groupBy("bucket").agg(F.sum("features").alias("features")).collect()
    totals = np.zeros(buckets, np.int64)
    for row in rows:
        totals[row["bucket"]] = row["features"]
    return totals


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the log of its likelihood ratio, in thousandths."""
    whole, aim, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * float(whole + n) / ((s + 1) * float(aim + n)))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def document_weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document row; a null text has no words."""
    cut, worth = gain_planes(gains)
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _blocks(batch):
                owner, bucket, words = features(data, offsets, buckets)
                rows = high - low
                counts = np.bincount(owner * buckets + bucket, minlength=rows * buckets).reshape(rows, buckets)
                weights = sliced_weights(counts, cut, worth)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, rows), pa.array(words.astype(np.int64)), pa.array(counts.sum(axis=1).astype(np.int64)), pa.array(weights)],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, order: list, rank: str = "rank") -> DataFrame:
    """Adds the place of every row in ``order``, from 1.

    Rows are dealt out by ranges and sorted in their partitions; only the number of rows of each
    partition is added up before. Rows that tie in the whole order share them in any order.
    """
    place = F.monotonically_increasing_id()
    dealt = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place), "ranked")
    part, within = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    before, offsets = 0, []
    for size in sizes:
        offsets.append((size["part"], before))
        before += size["rows"]
    # One row for each shuffle partition.
    known = rows.sparkSession.createDataFrame(offsets, "__part bigint, __before bigint")
    joined = dealt.withColumn("__part", part).join(F.broadcast(known), "__part")
    return joined.withColumn(rank, F.col("__before") + within + 1).drop("__part", "__before", "__place")


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS, seed: int = 42
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document row.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower
    case. ``percent`` of the documents with at least ``least_words`` words are drawn (rounded down) by
    highest score, ties by smaller doc_id. A row without doc_id has no score and is not drawn; a null
    or empty text has no features and weight 0. Repeated rows are documents of their own, with equal
    scores and ranks one after the other. Empty tables are no error: without documents nothing is
    drawn, without target texts all features of a common bucket count alike. Other columns are ignored.
    """
    gains = bucket_gains(bucket_totals(docs, buckets), bucket_totals(target, buckets))
    known = stage(document_weights(docs, gains), "weights")
    id_ = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(id_, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")
    scored = known.withColumn("score", F.when(F.col("doc_id").isNotNull(), F.col("weight") + noise))
    may = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = known.where(may).count() * percent // 100
    order = ranked(scored.where(may).select(*columns), [F.desc("score"), F.asc("doc_id")])
    chosen = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return chosen.select(*columns, "rank").unionByName(scored.where(~may).select(*columns, F.lit(None).cast("bigint").alias("rank")))

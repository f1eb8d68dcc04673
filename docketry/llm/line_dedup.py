"""Incremental, reversible line deduplication: sharded cuckoo filters over exact reference counts.

The key of a line is its text without ASCII white space at both ends and with A-Z in lower case, as a
128-bit digest; lines with fewer than ``least_chars`` code points have none. An index keeps three tables:

- postings, signed: which document holds which key, added by inserts and taken back by deletions;
- reference counts, exact: how many documents hold a key, and the largest of them;
- one cuckoo filter for each shard of the keys, of those that ``least`` documents or more hold.

A batch changes the counts of its own keys alone. Keys that reach ``least`` documents enter the filter
of their shard, keys that fall below leave it, which is why the filters are cuckoo filters. To find the
lines to drop, every posting meets the filter of its shard; only the few that pass are joined with the
reference counts, which decide. A batch counts once its marker is there; one that failed is written
anew, and one that is committed already changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.common import U64, in_groups, shared_folder, text_pieces
from docketry.llm.cuckoo import Cuckoo

LEAST = 3
LEAST_CHARS = 20
SALTS = 16  # parts of a shard's postings, by document, so that no task has all that hold one line
PIECE_BYTES = 1 << 20
POSTINGS = "shard int, key binary, doc_id bigint, sign int"
COUNTS = "shard int, key binary, n_docs bigint, last_doc bigint"
FILTERS = "shard int, cells binary"
_INSIDE = bytes(range(0x80, 0xC0))  # bytes within a character; all others begin one


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """The key of a line, none if it is too short to have one."""
    bare = line.strip().lower()
    if len(bare) < least_chars or len(bare.translate(None, _INSIDE)) < least_chars:
        return None
    return hashlib.blake2b(bare, digest_size=16).digest()


def key_hashes(keys: pa.Array) -> np.ndarray:
    """The first eight bytes of every key."""
    return np.frombuffer(b"".join(k[:8] for k in keys.to_pylist()), U64)


def document_keys(docs: DataFrame, shards: int, least_chars: int = LEAST_CHARS) -> DataFrame:
    """shard, key, doc_id: each key once for every row that holds it. Rows without doc_id hold none."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_pieces(batch.column("text"), PIECE_BYTES):
                part = batch.slice(start, end - start)
                keys: list[bytes] = []
                owners: list[int] = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = {line_key(line, least_chars) for line in (text or "").encode().split(b"\n")}
                    own.discard(None)
                    keys += own
                    owners += [doc] * len(own)
                shard = [int.from_bytes(k[8:12], "little") % shards for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], ["shard", "key", "doc_id"]
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.where("doc_id is not null and text is not null").mapInArrow(find, "shard int, key binary, doc_id bigint")


class LineIndex:
    """An index in a folder that all executors share, with one writer at a time.

    ``shards`` (by default the number of shuffle partitions) is set when the folder is new and kept from
    then on; a filter is held by one task, so it should grow with the lines.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int | None = None, least: int = LEAST, least_chars: int = LEAST_CHARS):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.least, self.least_chars = least, least_chars
        wanted = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not self._names("layout"):
            self._files().createNewFile(self._path(f"layout/{wanted}-{least}-{least_chars}"))
        self.shards, *kept = (int(n) for n in self._names("layout")[0].split("-"))
        if kept != [least, least_chars] or shards not in (None, self.shards):
            raise ValueError(f"the index has {self.shards} shards and its limits are {kept}")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, place = self._files(), self._path(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def committed(self) -> list[str]:
        """Ids of the batches that count, oldest first."""
        return [name.split("-", 1)[1] for name in self._names("commits")]

    def _read(self, batch_id: str, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/batches/{batch_id}/{name}")

    def _write(self, rows: DataFrame, batch_id: str, name: str, schema: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batches/{batch_id}/{name}")
        return self._read(batch_id, name, schema)

    def _latest(self, name: str, schema: str, key: str, extra: DataFrame | None = None) -> DataFrame | None:
        """Of every key the row of the last batch that has one; ``extra`` counts as a later batch."""
        parts = [self._read(batch, name, schema) for batch in self.committed()] + ([extra] if extra is not None else [])
        if len(parts) < 2:
            return parts[0] if parts else None
        union = None
        for n, part in enumerate(parts):
            part = part.withColumn("__batch", F.lit(n))
            union = part if union is None else union.unionByName(part)
        names = part.columns[:-1]
        rest = F.struct(*[n for n in names if n != key])
        return union.groupBy(key).agg(F.max_by(rest, "__batch").alias("last")).select(key, "last.*").select(*names)

    def postings(self) -> DataFrame:
        """shard, key, doc_id of all documents that are in the index."""
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], POSTINGS).drop("sign")
        union = self._read(batches[0], "postings", POSTINGS)
        if len(batches) == 1:
            return union.drop("sign")
        for batch in batches[1:]:
            union = union.unionByName(self._read(batch, "postings", POSTINGS))
        held = union.groupBy("shard", "key", "doc_id").agg(F.sum("sign").alias("held"))
        return held.where("held > 0").drop("held")

    def counts(self) -> DataFrame:
        """shard, key, n_docs, last_doc of all keys that documents hold."""
        found = self._latest("counts", COUNTS, "key")
        return self.spark.createDataFrame([], COUNTS) if found is None else found.where("n_docs > 0")

    def filters(self) -> DataFrame:
        """shard, cells: the filter of each shard that has or had keys to drop."""
        found = self._latest("filters", FILTERS, "shard")
        return self.spark.createDataFrame([], FILTERS) if found is None else found

    def _is_new(self, batch_id: str) -> bool:
        if not batch_id or not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch id has letters, digits, - and _ only: {batch_id!r}")
        return batch_id not in self.committed()

    def insert(self, batch_id: str, docs: DataFrame) -> bool:
        """Adds the lines of documents; False if this batch is committed already.

        Lines of rows with one doc_id, here or in earlier batches, count as lines of one document.
        """
        if not self._is_new(batch_id):
            return False
        rows = document_keys(docs, self.shards, self.least_chars).dropDuplicates(["shard", "key", "doc_id"])
        if self.committed():
            rows = rows.join(self.postings(), ["shard", "key", "doc_id"], "left_anti")
        added = self._write(rows.withColumn("sign", F.lit(1)), batch_id, "postings", POSTINGS)
        # Tasks add up their own rows first, so a line that very many documents hold does no harm.
        delta = added.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("change"), F.max("doc_id").alias("newest"))
        return self._commit(batch_id, delta, F.greatest("newest", "last_doc"))

    def delete(self, batch_id: str, doc_ids: DataFrame) -> bool:
        """Takes documents out again, with all their lines; ids that are not in the index change nothing."""
        if not self._is_new(batch_id):
            return False
        ids = doc_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
        held = self.postings()
        removed = self._write(held.join(ids, "doc_id", "left_semi").select("shard", "key", "doc_id", F.lit(-1).alias("sign")), batch_id, "postings", POSTINGS)
        delta = removed.groupBy("shard", "key").agg(F.sum("sign").alias("change"))
        left = held.join(ids, "doc_id", "left_anti").join(delta.select("key"), "key", "left_semi")
        newest = left.groupBy("key").agg(F.max("doc_id").alias("newest"))
        return self._commit(batch_id, delta.join(newest, "key", "left"), F.col("newest"))

    def _commit(self, batch_id: str, delta: DataFrame, last_doc) -> bool:
        first = not self.committed()
        before = self.counts().drop("shard") if not first else None
        if before is None:
            joined = delta.withColumns({"n_docs": F.lit(0).cast("bigint"), "last_doc": F.lit(None).cast("bigint")})
        else:
            joined = delta.join(before, "key", "left").fillna(0, ["n_docs"])
        after = F.col("n_docs") + F.col("change")
        changed = joined.select("shard", "key", after.alias("n_docs"), F.when(after > 0, last_doc).alias("last_doc"))
        changed = self._write(changed, batch_id, "counts", COUNTS)
        self._write(self._new_filters(changed, first), batch_id, "filters", FILTERS)
        # Creating the marker is atomic: of two writers one gets True.
        return bool(self._files().createNewFile(self._path(f"commits/{len(self.committed()):06d}-{batch_id}")))

    def _new_filters(self, changed: DataFrame, first: bool) -> DataFrame:
        """The filters of all shards in which keys have crossed the limit, either way."""
        none = F.lit(None).cast("binary")
        many = F.col("n_docs") >= self.least
        if first:
            rows = changed.where(many).select("shard", F.lit(3).alias("kind"), "key", none.alias("cells"))
        else:
            was = self.counts().select("key", F.col("n_docs").alias("n_before"))
            was_many = F.coalesce(F.col("n_before"), F.lit(0)) >= self.least
            crossed = changed.join(was, "key", "left").where(many != was_many)
            crossed = crossed.select("shard", F.when(many, 2).otherwise(1).alias("kind"), "key", none.alias("cells"))
            touched = crossed.select("shard").distinct()
            held = self.filters().select("shard", F.lit(0).alias("kind"), none.alias("key"), "cells")
            now = self._latest("counts", COUNTS, "key", changed).where(many)
            kept = now.select("shard", F.lit(3).alias("kind"), "key", none.alias("cells"))
            rows = held.unionByName(kept).join(touched, "shard", "left_semi").unionByName(crossed)

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (shard,), group in in_groups(batches, ["shard"]):
                table, keys = None, {1: [], 2: [], 3: []}
                for part in group:
                    kinds = np.asarray(part.column("kind"))
                    if (kinds == 0).any():
                        table = Cuckoo.from_bytes(part.column("cells")[int(np.argmax(kinds == 0))].as_py())
                    for kind, held in keys.items():
                        if (kinds == kind).any():
                            held.append(key_hashes(part.column("key").filter(pa.array(kinds == kind))))
                gone, come, every = (np.concatenate(held) if held else np.zeros(0, U64) for held in keys.values())
                if table is not None:
                    table.remove(gone)
                # A filter without room is made anew from the keys that the exact counts name.
                if table is None or not table.add(come):
                    table = Cuckoo.of(every)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([table.to_bytes()], pa.binary())], ["shard", "cells"])

        return rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(update, FILTERS)

    def candidates(self) -> DataFrame:
        """key, doc_id, salt of the postings that pass the filter of their shard."""
        salt = F.pmod("doc_id", F.lit(SALTS)).cast("int")
        posted = self.postings().select("shard", salt.alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", F.lit(None).cast("binary").alias("cells"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        held = self.filters().select("shard", salts, F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("bigint").alias("doc_id"), "cells")
        dealt = posted.unionByName(held).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, group in in_groups(batches, ["shard", "salt"]):
                table = None
                for part in group:
                    if part.column("kind")[0].as_py() == 0:
                        table = Cuckoo.from_bytes(part.column("cells")[0].as_py())
                        part = part.slice(1)
                    if table is None or not part.num_rows:
                        continue
                    passed = part.filter(pa.array(table.has(key_hashes(part.column("key")))))
                    yield passed.select(["key", "doc_id", "salt"])

        return dealt.mapInArrow(probe, "key binary, doc_id bigint, salt int")

    def drops(self) -> DataFrame:
        """key, doc_id: which documents lose which lines."""
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        exact = self.counts().where(F.col("n_docs") >= self.least).select("key", "last_doc", salts)
        return self.candidates().join(exact, ["key", "salt"]).where("doc_id < last_doc").select("key", "doc_id")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and ``kept`` text of every row of ``docs``.

        Keys that ``least`` documents of the index hold lose all their lines but those in the document
        with the largest doc_id; the other lines stay as they are, joined by line feeds. A null text is
        one empty line, as an empty text is. Rows without doc_id and documents that are not in the index
        keep all lines. Repeated rows give repeated rows; other columns are not carried.
        """
        least_chars = self.least_chars
        lost = self.drops().groupBy("doc_id").agg(F.collect_list("key").alias("lost"))
        narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, end in text_pieces(batch.column("text"), PIECE_BYTES):
                    part = batch.slice(start, end - start)
                    lines, dropped, kept = [], [], []
                    for text, lost in zip(part.column("text").to_pylist(), part.column("lost").to_pylist()):
                        text = text or ""
                        if not lost:
                            lines.append(text.count("\n") + 1)
                            dropped.append(0)
                            kept.append(text)
                            continue
                        every, gone = text.encode().split(b"\n"), set(lost)
                        left = [line for line in every if line_key(line, least_chars) not in gone]
                        lines.append(len(every))
                        dropped.append(len(every) - len(left))
                        kept.append(b"\n".join(left).decode())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                        ["doc_id", "n_lines", "n_dropped", "kept"],
                    )

        return narrow.join(lost, "doc_id", "left").mapInArrow(keep, "doc_id bigint, n_lines bigint, n_dropped bigint, kept string")


def dedup_lines(docs: DataFrame, least: int = LEAST, least_chars: int = LEAST_CHARS) -> DataFrame:
    """:meth:`LineIndex.dedup` of a table by an index of its own, in a new folder of the shared one."""
    spark = docs.sparkSession
    index = LineIndex(spark, f"{shared_folder(spark)}/lines-{uuid4().hex}", least=least, least_chars=least_chars)
    index.insert("all", docs)
    return index.dedup(docs)

"""Token counts as rollups that signed changes maintain.

A batch of changes (inserts, deletes and revised counts) becomes signed numbers of documents and
tokens for each source, language and tokenizer version. Its sums are written under the batch's id and
then committed by an empty marker file; totals are the sums of committed batches. A batch that runs
again after a failure replaces what it left behind, and one that is already committed changes nothing,
so each counts once. ``compact`` folds the batches committed so far into one table of totals, under a
marker that lists them; they stay committed.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs bigint, tokens bigint"
COMPACTED = "compacted-"


def signed(changes: DataFrame) -> DataFrame:
    """Changes as additive rows: source, lang, version, docs, tokens.

    ``changes`` has op (insert, delete, revise), the keys, tokens, and old_tokens for a revision,
    which adds the difference and no document. A null count is 0; null keys are a group of their own;
    a change of another kind is an error.
    """
    op = F.lower("op")
    tokens, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    known = F.when(op.isin("insert", "delete", "revise"), op).otherwise(
        F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null"))))
    )
    return changes.select(
        *KEYS,
        F.when(known == "insert", 1).when(known == "delete", -1).otherwise(0).cast("bigint").alias("docs"),
        F.when(known == "insert", tokens).when(known == "delete", -tokens).otherwise(tokens - old).cast("bigint").alias("tokens"),
    )


def summed(rows: DataFrame) -> DataFrame:
    """Sums by key; each task adds up its own rows before the shuffle, so hot keys do no harm."""
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Totals kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Ids of the batches that count."""
        place = self._path("commits")
        files = self._files()
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch once; False if it is committed already."""
        if not batch_id or not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch id has letters, digits, - and _ only: {batch_id!r}")
        if self._files().exists(self._path(f"commits/{batch_id}")):
            return False
        summed(signed(changes)).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch_id}")
        # Creating the marker is atomic: of two writers one gets True.
        return bool(self._files().createNewFile(self._path(f"commits/{batch_id}")))

    def _folded(self) -> tuple[str | None, set[str]]:
        """The newest table of totals, and the batches that are in it."""
        place, files = self._path("compactions"), self._files()
        if not files.exists(place):
            return None, set()
        for name in sorted((s.getPath().getName() for s in files.listStatus(place)), reverse=True):
            stream = files.open(self._path(f"compactions/{name}"))
            try:
                lines = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
            finally:
                stream.close()
            if lines[-1:] == ["end"]:  # else its writer died half way
                return lines[0], set(lines[1:-1])
        return None, set()

    def _rows(self) -> DataFrame | None:
        table, folded = self._folded()
        names = ([table] if table else []) + [f"batches/{b}" for b in self.committed() if b not in folded]
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{n}" for n in names]) if names else None

    def compact(self) -> bool:
        """Folds all committed batches into one table; False if there is nothing to fold.

        Totals are the same before, after and, if it fails, in between. The folded batches are no longer
        read, but still known, so that none of them counts twice.
        """
        batches = self.committed()
        if set(batches) == self._folded()[1]:
            return False
        table = f"totals/{COMPACTED}{uuid4().hex}"
        self.totals().write.parquet(f"{self.folder}/{table}")
        number = len(self._files().listStatus(self._path("compactions"))) if self._files().exists(self._path("compactions")) else 0
        stream = self._files().create(self._path(f"compactions/{number:09d}"), False)
        try:
            stream.write(bytearray("\n".join([table, *batches, "end"]) + "\n", "utf-8"))
        finally:
            stream.close()
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens; groups that came back to nothing are left out."""
        rows = self._rows()
        if rows is None:
            return self.spark.createDataFrame([], SCHEMA)
        return summed(rows).where("docs != 0 or tokens != 0")


def word_tokens(text: Column) -> Column:
    """Words between white space; 0 for a null text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\r\x0B\f]+")).cast("bigint")


def piece_tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits or of other characters, without white space; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\x0B\f]+")).cast("bigint")

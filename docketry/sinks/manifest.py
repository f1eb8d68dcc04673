"""Which files of a table count: numbered manifests, each written once."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_manifests"  # names with an underscore are no data to Spark
END = "end"


@dataclass
class Manifest:
    """Version ``number`` of a table: the runs whose files count, for each bucket that has any.

    ``notes`` are whatever a writer wants to find again.
    """

    number: int
    buckets: int
    runs: dict[int, list[str]] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)

    def folders(self, root: str, buckets: set[int] | None = None) -> list[str]:
        """Folders of all buckets, or of those given."""
        wanted = self.runs if buckets is None else buckets & self.runs.keys()
        return [f"{root}/{run}/bucket={b}" for b in sorted(wanted) for run in self.runs[b]]


class Manifests:
    """The manifests of one table.

    A manifest is created by name, which fails if another writer was faster, and its last line says
    that it is whole, so a reader passes over one whose writer has died.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm = root.rstrip("/"), spark._jvm
        place = self._path("")
        self._files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{FOLDER}/{name}")

    def numbers(self) -> list[int]:
        """Numbers taken so far, newest first."""
        place = self._path("")
        if not self._files.exists(place):
            return []
        return sorted((int(s.getPath().getName()) for s in self._files.listStatus(place) if s.getPath().getName().isdigit()), reverse=True)

    def read(self, number: int) -> Manifest | None:
        """One manifest, if it is whole."""
        stream = self._files.open(self._path(f"{number:09d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        lines = text.splitlines()
        if lines[-1:] != [END]:
            return None
        head = json.loads(lines[0])
        return Manifest(number, head["buckets"], {int(b): runs for b, runs in map(json.loads, lines[1:-1])}, head["notes"])

    def latest(self) -> Manifest | None:
        """The newest whole manifest; none for a table that does not exist."""
        return next((found for number in self.numbers() if (found := self.read(number))), None)

    def commit(self, manifest: Manifest) -> None:
        """Make ``manifest`` the newest version; an error if its number is taken."""
        lines = [json.dumps({"buckets": manifest.buckets, "notes": manifest.notes}), *(json.dumps([b, runs]) for b, runs in sorted(manifest.runs.items())), END]
        stream = self._files.create(self._path(f"{manifest.number:09d}"), False)
        try:
            stream.write(bytearray("\n".join(lines) + "\n", "utf-8"))
        finally:
            stream.close()

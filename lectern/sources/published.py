"""Tables whose runs are published by a manifest.

A run writes its rows to a folder of its own under ``data/`` and only then creates the next manifest, a small JSON file that
names the folder of every slot (a date and day bucket, a split run). Readers resolve the newest whole manifest, so a run that
was killed half way is never read and a rerun replaces its slot at once; a rerun without rows removes it. Manifests are
created under the next free number and never overwritten: of two publishers the later one takes its number from the newer
manifest and keeps the other's slots. ``collect`` deletes what no kept manifest names.

The file system must refuse to create a file that exists (HDFS and local disks do).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lectern.sources.sinks import write_counted


class Published:
    def __init__(self, spark: SparkSession, base: str, schema: StructType):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- manifests

    def _list(self, folder: str) -> list[str]:
        where = self._path(f"{self.base}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def versions(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in self._list("manifest") if name.endswith(".json"))

    def _read(self, version: int) -> dict | None:
        """The slots of a manifest; None if it was never finished."""
        stream = self._fs.open(self._path(self._manifest(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text[:-1]) if text.endswith("\n") else None

    def _manifest(self, version: int) -> str:
        return f"{self.base}/manifest/{version:012d}.json"

    def slots(self) -> dict[str, dict]:
        """slot -> {"path", "rows"} of the newest whole manifest."""
        for version in reversed(self.versions()):
            found = self._read(version)
            if found is not None:
                return found
        return {}

    def _commit(self, change) -> None:
        while True:
            version = (self.versions() or [0])[-1] + 1
            slots = change(self.slots())
            try:
                out = self._fs.create(self._path(self._manifest(version)), False)
            except Py4JJavaError as e:  # another publisher took this number: start again from its manifest
                if "FileAlreadyExists" not in str(e.java_exception):
                    raise
                continue
            out.write(bytearray((json.dumps(slots, sort_keys=True) + "\n").encode()))
            out.close()
            return

    # --- runs

    def publish(self, rows: DataFrame, slot: str) -> int:
        """Write the rows and let them be the slot's; no rows: the slot goes. Returns the rows written."""
        path = f"data/{uuid.uuid4().hex}"
        out = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])
        n = write_counted(out, lambda o: o.write.parquet(f"{self.base}/{path}"))

        def change(slots: dict) -> dict:
            kept = {k: v for k, v in slots.items() if k != slot}
            return kept | {slot: {"path": path, "rows": n}} if n else kept

        self._commit(change)
        return n

    def read(self, slot: str | None = None) -> DataFrame:
        """The rows of all slots, or of one."""
        paths = [f"{self.base}/{v['path']}" for k, v in sorted(self.slots().items()) if slot in (None, k)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def collect(self, keep: int = 1) -> list[str]:
        """Delete folders and manifests that the ``keep`` newest whole manifests do not name; returns the folders deleted.

        Not to be run while another run writes: its folder is not named yet.
        """
        whole = [v for v in self.versions() if self._read(v) is not None]
        kept = whole[-keep:]
        named = {entry["path"] for v in kept for entry in self._read(v).values()}
        gone = [f"data/{name}" for name in self._list("data") if f"data/{name}" not in named]
        for path in gone:
            self._fs.delete(self._path(f"{self.base}/{path}"), True)
        for v in self.versions():
            if kept and v < kept[0]:
                self._fs.delete(self._path(self._manifest(v)), False)
        return gone

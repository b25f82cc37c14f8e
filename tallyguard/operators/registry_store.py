"""The registry as numbered snapshots that several writers may add to at once.

A writer reads the newest snapshot, derives the next from it, writes that below a name of its
own, and then publishes it under the next number. Only one can have a number: who comes second
takes the snapshot that won, and derives its own from that. A snapshot is visible when its
number is, whole, and is never changed.

Publishing needs a file system that can create a name only if it is absent: a rename that
fails where the target exists (HDFS), or a hard link on one machine's disk.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyguard import schemas


class CommitConflict(RuntimeError):
    """Other writers were first too many times."""


class RegistryStore:
    """Snapshots of a registry below ``root``: ``data`` holds their rows, ``commits`` their numbers."""

    def __init__(self, spark: SparkSession, root: str, schema: str = schemas.REGISTRY):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        at = self._path("commits")
        self.files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in (at, self._path("data")):
            self.files.mkdirs(folder)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def latest(self) -> int:
        """The newest number, 0 before the first commit."""
        names = [f.getPath().getName() for f in self.files.listStatus(self._path("commits"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a snapshot, by default the newest; before the first commit, none."""
        number = self.latest() if number is None else number
        if not number:
            return self.spark.createDataFrame([], self.schema)
        lines = self.spark.read.text(self._path(f"commits/{number}.json").toString()).collect()
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{json.loads(lines[0][0])['data']}")

    def commit(self, change: Callable[[DataFrame], DataFrame], tries: int = 10) -> int:
        """Publish ``change(newest snapshot)`` and return its number.

        ``change`` is called again with what won where another writer was first, so it must say what to do
        with any snapshot, not hold rows of one. What lost is removed.
        """
        for _ in range(tries):
            base = self.latest()
            name = uuid.uuid4().hex
            rows = change(self.read(base))
            typed = [F.col(f.name).cast(f.dataType) for f in self.spark.createDataFrame([], self.schema).schema]
            rows.select(*typed).write.mode("errorifexists").parquet(f"{self.root}/data/{name}")
            if self._publish(base + 1, {"data": name, "base": base}):
                return base + 1
            self.files.delete(self._path(f"data/{name}"), True)
        raise CommitConflict(f"no number free after {tries} tries")

    def _publish(self, number: int, about: dict) -> bool:
        """Whether ``number`` is ours now. Its file appears with all its content or not at all."""
        draft, target = self._path(f"commits/.{uuid.uuid4().hex}"), self._path(f"commits/{number}.json")
        out = self.files.create(draft, False)
        out.write(bytearray(json.dumps(about).encode()))
        out.close()
        try:
            if self.files.getUri().getScheme() == "file":  # a rename would replace what is there
                local = lambda p: self.spark._jvm.java.io.File(p.toUri().getPath()).toPath()
                target, draft_ = self.files.makeQualified(target), self.files.makeQualified(draft)
                try:
                    self.spark._jvm.java.nio.file.Files.createLink(local(target), local(draft_))
                except Exception as e:
                    if "FileAlreadyExistsException" in str(e):
                        return False
                    raise
                return True
            return not self.files.exists(target) and self.files.rename(draft, target)
        finally:
            self.files.delete(draft, False)

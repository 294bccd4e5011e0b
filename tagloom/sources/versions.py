"""Versions of an output below one root, so that replacing it disturbs no reader.

A writer fills a folder of its own, which then becomes the next version by a rename that never
replaces. A reader resolves a version once and keeps it: a rerun that ends meanwhile adds a version beside it, and a
failed one leaves only a folder that no one reads. The rename is atomic where the file
system's is (HDFS), not on object stores.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Versions:
    spark: SparkSession
    root: str

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        pattern, files = self._path("version=*")
        return sorted(int(found.getPath().getName().removeprefix("version=")) for found in files.globStatus(pattern) or [])

    def newest(self) -> int | None:
        return max(self.numbers(), default=None)

    def path(self, version: int | None = None) -> str | None:
        """Folder of a version, by default of the newest; None when there is none yet."""
        version = self.newest() if version is None else version
        return None if version is None else f"{self.root}/version={version:08d}"

    def new_run(self) -> str:
        """Name of a fresh folder that is no version yet."""
        return f"run-{uuid.uuid4().hex}"

    def publish(self, run: str, version: int) -> bool:
        """Whether the run became this version; not when another writer was first."""
        source, files = self._path(run)
        target, _ = self._path(f"version={version:08d}")
        if files.exists(target):
            return False
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        no_overwriting = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(source), context.makeQualified(target), no_overwriting)
        except Py4JJavaError:
            if files.exists(target):
                return False
            raise
        return True

    def drop(self, run: str) -> None:
        path, files = self._path(run)
        files.delete(path, True)

    def put(self, write: Callable[[str], None]) -> int:
        """Lets ``write`` fill a folder and makes it the version after the newest."""
        run = self.new_run()
        write(f"{self.root}/{run}")
        version = (self.newest() or 0) + 1
        while not self.publish(run, version):
            version += 1
        return version

    def put_table(self, df: DataFrame) -> int:
        return self.put(lambda path: df.write.parquet(path))

    def read_table(self, version: int | None = None) -> DataFrame:
        path = self.path(version)
        if path is None:
            raise FileNotFoundError(f"{self.root} has no version yet")
        return self.spark.read.parquet(path)

    def put_note(self, run: str, name: str, text: str) -> None:
        """A small file beside the rows of a run; readers of the rows do not see it."""
        path, files = self._path(f"{run}/{name}")
        out = files.create(path, False)
        out.write(bytearray(text.encode()))
        out.close()

    def note(self, version: int, name: str) -> str:
        path, files = self._path(f"version={version:08d}/{name}")
        stream = files.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

"""Small files put in place exactly once, on a local disk or any store of the engine's file system layer."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

#: Stores whose rename is one step that fails if the target exists.
ATOMIC = ("file", "hdfs", "viewfs", "abfs", "abfss")


class LocalFiles:
    """Files of one machine; a hard link is the step that fails if the name exists."""

    def put(self, path: str, data: bytes) -> bool:
        """Writes a new file; False if the name is taken."""
        os.makedirs(os.path.dirname(path), exist_ok=True)
        temp = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        with open(temp, "wb") as f:
            f.write(data)
        try:
            os.link(temp, path)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temp)

    def read(self, path: str) -> bytes:
        with open(path, "rb") as f:
            return f.read()

    def names(self, folder: str) -> list[str]:
        return sorted(n for n in os.listdir(folder) if not n.startswith(".")) if os.path.isdir(folder) else []


class SharedFiles:
    """Files of a store that all nodes see.

    Safe where rename is one step that does not overwrite (`ATOMIC`).  Stores that
    copy on rename are refused unless ``single_writer`` promises that nobody else writes."""

    def __init__(self, spark: SparkSession, single_writer: bool = False):
        self.spark, self.single_writer = spark, single_writer
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put(self, path: str, data: bytes) -> bool:
        fs, final = self.fs(path), self._path(path)
        scheme = fs.getUri().getScheme()
        if scheme == "file":  # rename overwrites there
            return LocalFiles().put(fs.makeQualified(final).toUri().getPath(), data)
        if scheme not in ATOMIC and not self.single_writer:
            raise ValueError(f"a rename in {scheme}:// is not one step; tables and claims there need single_writer")
        fs.mkdirs(final.getParent())
        temp = self._path(final.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(data))
        out.close()
        try:
            return not fs.exists(final) and fs.rename(temp, final)
        finally:
            fs.delete(temp, False)

    def read(self, path: str) -> bytes:
        stream = self.fs(path).open(self._path(path))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        fs, at = self.fs(folder), self._path(folder)
        found = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in found if not n.startswith("."))

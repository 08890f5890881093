"""Small documents and folders through Hadoop's file system, so that any store Spark reads will do."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """Replaces the target: a file in one step where the store can, a folder by setting the old one aside until the new
        one stands."""
        fs, s = self._at(source)
        _, t = self._at(target)
        if fs.getFileStatus(s).isFile():
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
            option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
            options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = option
            context.rename(s, t, options)
            return
        aside = self.spark._jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}.aside")
        if fs.exists(t) and not fs.rename(t, aside):
            raise OSError(f"cannot set {target} aside")
        if not fs.rename(s, t):
            fs.rename(aside, t)
            raise OSError(f"cannot move {source} to {target}")
        fs.delete(aside, True)

    def changed(self, path: str) -> int | None:
        """When a file or folder was changed last, in milliseconds."""
        fs, p = self._at(path)
        return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def read_json(self, path: str, default=None):
        data = self.get_bytes(path)
        return default if data is None else json.loads(data)

    def create_json(self, path: str, value) -> bool:
        """Writes a file that must not be there yet; False if it is. Exclusive where the file system creates files so."""
        fs, p = self._at(path)
        try:
            stream = fs.create(p, False)
        except Py4JJavaError as problem:
            if "AlreadyExists" in problem.java_exception.getClass().getName():
                return False
            raise
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        stream.close()
        return True

    def put_bytes(self, path: str, data: bytes) -> None:
        """Each writer has a name of its own for what it writes, so of two the last one stands whole."""
        aside = f"{path}.{uuid.uuid4().hex}.next"
        fs, t = self._at(aside)
        stream = fs.create(t, True)
        stream.write(bytearray(data))
        stream.close()
        self.move(aside, path)

    def get_bytes(self, path: str) -> bytes | None:
        if not self.exists(path):
            return None
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write_json(self, path: str, value) -> None:
        self.put_bytes(path, json.dumps(value, sort_keys=True).encode())

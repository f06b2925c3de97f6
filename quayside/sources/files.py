"""The warehouse's folders, through Hadoop's file system interface, so that
local disks, HDFS and object stores are listed and cleaned alike.  Only names
and times pass the driver, never table contents."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, base: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def modified(self, path: str) -> int:
        """When the file, or the newest file or folder below, was written (ms)."""
        status = self._fs.getFileStatus(self._path(path))
        newest = status.getModificationTime()
        if status.isDirectory():
            for s in self._fs.listStatus(status.getPath()):
                newest = max(newest, self.modified(s.getPath().toString()))
        return newest

    def claim(self, path: str) -> bool:
        """Create an empty file; False if another writer has it already."""
        try:
            self._fs.create(self._path(path), False).close()
        except Py4JJavaError as e:
            if self.exists(path):
                return False
            raise e
        return True

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

"""A few operations on folders of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self._at(path).getFileSystem(conf)

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._at(path))

    def children(self, path: str) -> list[str]:
        """Names inside a folder, sorted; none if it isn't there."""
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self._at(path))) if self.exists(path) else []

    def move(self, old: str, new: str) -> None:
        """One rename, which either happens as a whole or not at all."""
        self.fs.mkdirs(self._at(new).getParent())
        if not self.fs.rename(self._at(old), self._at(new)):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._at(path), True)

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self._at(path), True)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self._at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

"""Names, small files and removal in a folder, on whatever file system it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def matching(self, pattern: str) -> list[str]:
        """Names below the folder that match; none where it is not there yet."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        return ["/".join(f.getPath().toString().split("/")[-depth:]) for f in found]

    def create(self, name: str, text: str) -> None:
        """A new file; one that is there already is an error."""
        out = self._fs.create(self._at(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

"""Small files and folders on whatever file system a path names, through Spark's own clients."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Whole small texts, folder names and sizes; nothing here reads table data."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self.jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.conf)

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if it exists. One of several writers succeeds."""
        at, fs = self._at(path)
        if fs.exists(at):
            return False
        part = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{self.jvm.java.util.UUID.randomUUID()}")
        out = fs.create(part, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        # Written aside and put in place under its name at once: no reader sees half a file, and
        # no writer replaces another's.
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), self.conf).rename(part, at, options)
        except Py4JJavaError as error:
            fs.delete(part, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def text(self, path: str) -> str:
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, path: str) -> list[str]:
        """Names in a folder in order, none if there is no such folder."""
        at, fs = self._at(path)
        if not fs.exists(at):
            return []
        return sorted(x.getPath().getName() for x in fs.listStatus(at))

    def size(self, path: str) -> int:
        """Bytes below a path, 0 if there is none."""
        at, fs = self._at(path)
        return fs.getContentSummary(at).getLength() if fs.exists(at) else 0

    def remove(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

"""Names and small texts of a shared folder, through Hadoop's file-system client."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder in any file system that Spark reads; paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._path("").toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        """What the folder ``name`` holds, nothing if there is none."""
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(path))

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file whole or not at all; False if there is one of this name already."""
        path, part = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.part")
        self._fs.mkdirs(path.getParent())
        stream = self._fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self._context.rename(part, path, self._no_options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(part, False)
            return False
        return True

    def delete(self, name: str) -> None:
        """Remove a folder and all that it holds."""
        self._fs.delete(self._path(name), True)

"""Small files in a shared folder, through the file system Spark itself writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Names, texts and removal below one root folder, wherever Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = self._root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def names(self, name: str = "") -> list[str]:
        """What stands directly in a folder; nothing where there is none."""
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A new file that is there whole or not at all; one that stands already is an error."""
        path, draft = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        if self._fs.exists(path):
            raise FileExistsError(name)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(draft, path):
            self._fs.delete(draft, False)
            raise FileExistsError(name)

    def make(self) -> None:
        self._fs.mkdirs(self._root)

    def delete_at_end(self) -> None:
        """Remove the folder, with all that is in it then, when the application ends."""
        self.make()
        self._fs.deleteOnExit(self._root)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

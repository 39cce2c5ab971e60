"""Small-file helpers on the Hadoop file system that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class FileExists(Exception):
    """The file to create is already there."""


class SharedFiles:
    """Folders and small text files of any file system Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs(path).listStatus(self._path(path)))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Publish a whole file, or raise ``FileExists``; readers never see a part of it.

        The text goes to a temporary name and is renamed without overwrite, which a
        distributed file system does atomically. A store without atomic rename needs a
        conditional put here, and only here.
        """
        temporary = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = self._fs(path).create(temporary, False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs(path).getUri(), self._conf
        )
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(
                self._fs(path).makeQualified(temporary),
                self._fs(path).makeQualified(self._path(path)),
                self._gateway.new_array(rename, 0),
            )
        except Py4JJavaError as error:
            self._fs(path).delete(temporary, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise FileExists(path) from None
            raise

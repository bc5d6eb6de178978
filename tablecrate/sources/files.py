"""Small metadata files on whatever file system the cluster uses (through Hadoop's API)."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class MetadataFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str) -> JavaObject:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str) -> JavaObject:
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._file_system(path).exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self._file_system(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Readers see the old file or the whole new one, never a part."""
        staged = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._file_system(path).create(self._path(staged), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        overwrite = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(path).toUri(), self._conf
        ) if self._path(path).toUri().getScheme() else (
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        )
        context.rename(self._path(staged), self._path(path), overwrite)

    def delete_tree(self, path: str) -> None:
        self._file_system(path).delete(self._path(path), True)

    def subfolders(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        statuses = self._file_system(path).listStatus(self._path(path))
        return sorted(s.getPath().getName() for s in statuses if s.isDirectory())

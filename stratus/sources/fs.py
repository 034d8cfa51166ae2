"""Small file operations through the Hadoop API, so that they act on the cluster's
file system (HDFS, object store, local) and not on the driver's disk."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """File operations of one session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm  # noqa: SLF001
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def is_folder(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it is absent."""
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read_text(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Rename to a name that must not exist; False if it does.  Of several
        callers one succeeds (atomic where the file system's rename is)."""
        p, fs = self._at(source)
        q, _ = self._at(target)
        if not fs.exists(q.getParent()):
            fs.mkdirs(q.getParent())
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        none = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(p), fs.makeQualified(q), none)
        except Py4JJavaError as exc:
            if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
                return False
            raise
        return True

    def write_new(self, path: str, text: str) -> bool:
        """A small file, whole or not at all; False if the name is taken."""
        folder, _, name = path.rpartition("/")
        part = f"{folder}/.{name}-{uuid.uuid4().hex}"
        p, fs = self._at(part)
        stream = fs.create(p, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.rename_new(part, path):
            return True
        fs.delete(p, False)
        return False

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

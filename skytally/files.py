"""Small files on the cluster's shared storage: created once, or replaced as a whole.

Commits and the pointer to the current run are single small JSON files.  They go
through Hadoop's file system API, which every path that Spark reads has;
no Spark job is needed.  A file appears under its name with its full content or not at
all: it is written beside it first, under a hidden name that Spark's readers skip.

``create`` lets the file system decide between two writers.  On local disks and
mounts that is a hard link, elsewhere a rename that does not overwrite, which HDFS
does atomically.  Object stores without an atomic rename need a lock of their own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    @staticmethod
    def _local(fs, p) -> str | None:
        """The path on this machine if the file system is the local one."""
        q = fs.makeQualified(p).toUri()
        return q.getPath() if q.getScheme() == "file" else None

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        fs, p = self._open(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str | None:
        """A file's text, or None if there is no such file."""
        fs, p = self._open(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a file with this text; False, and nothing changed, if it exists."""
        return self._put(path, text, replace=False)

    def replace(self, path: str, text: str) -> None:
        """Create a file, or put it in the place of the one that is there."""
        self._put(path, text, replace=True)

    def _put(self, path: str, text: str, replace: bool) -> bool:
        fs, p = self._open(path)
        folder, name = os.path.split(path)
        hidden = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
        target, source = self._local(fs, p), None
        if target is not None:
            source = os.path.join(os.path.dirname(target), os.path.basename(hidden))
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with open(source, "w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            if replace:
                os.replace(source, target)
                return True
            try:
                os.link(source, target)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(source)
        _, q = self._open(hidden)
        out = fs.create(q, True)
        out.write(bytearray(text.encode()))
        out.close()
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(kinds, 1)
        how[0] = kinds.valueOf("OVERWRITE" if replace else "NONE")
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        try:
            files.rename(fs.makeQualified(q), fs.makeQualified(p), how)
            return True
        except Exception as err:
            fs.delete(q, False)
            if "FileAlreadyExistsException" in str(err):
                return False
            raise

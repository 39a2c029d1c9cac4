"""Driver-side file-system calls: exists, list, rename, delete, tiny manifests.

Only metadata work happens here, bounded by the number of days touched, never
by rows.  Cluster stores (HDFS, object stores) go through Hadoop's FileSystem
over Py4J; ``file:`` paths use the driver's own file calls, since a Py4J round
trip per call costs milliseconds and a full rebuild renames one folder per day.
"""

from __future__ import annotations

import os
import shutil
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _first_line_of(fh) -> str | None:
    line = fh.readline()
    if not line:
        return None
    return line.rstrip("\r\n")


class _LocalFS:
    @staticmethod
    def _os(path: str) -> str:
        u = urlparse(path)
        return u.path if u.scheme == "file" else path

    def exists(self, path):
        return os.path.exists(self._os(path))

    def is_dir(self, path):
        return os.path.isdir(self._os(path))

    def mkdirs(self, path):
        os.makedirs(self._os(path), exist_ok=True)

    def delete(self, path):
        p = self._os(path)
        if os.path.isdir(p):
            shutil.rmtree(p)
        elif os.path.exists(p):
            os.remove(p)

    def rename(self, src, dst):
        d = self._os(dst)
        os.makedirs(os.path.dirname(d), exist_ok=True)
        os.rename(self._os(src), d)

    def children(self, path, dirs=None):
        p = self._os(path)
        if not os.path.isdir(p):
            return []
        return sorted(n for n in os.listdir(p)
                      if dirs is None or os.path.isdir(os.path.join(p, n)) == dirs)

    def write_text(self, path, text):
        p = self._os(path)
        with open(p + ".tmp", "w", encoding="utf-8") as fh:
            fh.write(text)
        os.replace(p + ".tmp", p)

    def read_text(self, path):
        with open(self._os(path), encoding="utf-8") as fh:
            return fh.read()

    def open_first_line(self, path):
        with open(self._os(path), encoding="utf-8", errors="replace") as fh:
            return _first_line_of(fh)


class _HadoopFS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def _p(self, path):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path):
        return bool(self.fs.exists(self._p(path)))

    def is_dir(self, path):
        return bool(self.fs.getFileStatus(self._p(path)).isDirectory())

    def mkdirs(self, path):
        self.fs.mkdirs(self._p(path))

    def delete(self, path):
        self.fs.delete(self._p(path), True)      # False if absent: fine

    def rename(self, src, dst):
        parent = self._p(dst).getParent()
        if parent is not None:
            self.fs.mkdirs(parent)
        if not self.fs.rename(self._p(src), self._p(dst)):
            raise OSError(f"rename failed: {src} -> {dst}")

    def children(self, path, dirs=None):
        if not self.fs.exists(self._p(path)):
            return []
        return sorted(st.getPath().getName() for st in self.fs.listStatus(self._p(path))
                      if dirs is None or bool(st.isDirectory()) == dirs)

    def write_text(self, path, text):
        tmp = path + ".tmp"
        stream = self.fs.create(self._p(tmp), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        self.fs.delete(self._p(path), False)
        self.rename(tmp, path)

    def _reader(self, path):
        stream = self.fs.open(self._p(path))
        return stream, self._jvm.java.io.BufferedReader(
            self._jvm.java.io.InputStreamReader(stream, "UTF-8"))

    def read_text(self, path):
        stream, reader = self._reader(path)
        try:
            lines, line = [], reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def open_first_line(self, path):
        stream, reader = self._reader(path)
        try:
            return reader.readLine()
        finally:
            stream.close()


class FS:
    """File-system facade for one store (chosen from the path's scheme)."""

    def __init__(self, spark: SparkSession, path: str):
        scheme = urlparse(path).scheme
        if scheme in ("", "file"):
            default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
            local = scheme == "file" or default.startswith("file:")
        else:
            local = False
        self._impl = _LocalFS() if local else _HadoopFS(spark, path)

    def __getattr__(self, name):
        return getattr(self._impl, name)

    def first_line(self, path: str) -> str | None:
        """First line of a text file; of its first non-hidden part for a folder."""
        if not self._impl.exists(path):
            raise FileNotFoundError(f"[PATH_NOT_FOUND] Path does not exist: {path}")
        if self._impl.is_dir(path):
            parts = [n for n in self._impl.children(path, dirs=False)
                     if not n.startswith(("_", "."))]
            if not parts:
                return None
            path = f"{path.rstrip('/')}/{parts[0]}"
        return self._impl.open_first_line(path)

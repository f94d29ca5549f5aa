"""Folders and small files of a table, through the file system that its path names."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_folder: bool
    size: int
    changed_ms: int


class Files:
    """Names below ``root`` are relative to it; only metadata and small files go through the driver."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def list(self, name: str = "") -> list[Entry]:
        """Entries of a folder in order of their names; none where there is no such folder."""
        if not self.exists(name):
            return []
        found = [
            Entry(s.getPath().getName(), f"{name}/{s.getPath().getName()}".lstrip("/"), s.isDirectory(), s.getLen(), s.getModificationTime())
            for s in self._files.listStatus(self._at(name))
        ]
        return sorted(found, key=lambda e: e.name)

    def content(self, name: str) -> tuple[int, int]:
        """Number of files below a folder and their bytes."""
        summary = self._files.getContentSummary(self._at(name))
        return summary.getFileCount(), summary.getLength()

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> bool:
        return self._files.delete(self._at(name), True)

    def create_new(self, name: str, text: str) -> bool:
        """Create a file with its whole content; False when the name is taken. Of several at once, one succeeds.

        The content goes to a hidden file first. A local file gets its name by a hard link, others by a rename that
        does not replace; the file system must offer that as one step, as HDFS does.
        """
        folder, _, last = name.rpartition("/")
        hidden = f"{folder}/.{last}.{uuid.uuid4().hex}".lstrip("/")
        out = self._files.create(self._at(hidden), False)
        try:
            out.write(text.encode())
        finally:
            out.close()
        try:
            if self._files.getUri().getScheme() == "file":
                os.link(self._local(hidden), self._local(name))
            else:
                self.rename_new(hidden, name)
        except FileExistsError:
            return False
        finally:
            self._files.delete(self._at(hidden), False)
        return True

    def rename_new(self, name: str, to: str) -> None:
        """Rename, or raise ``FileExistsError`` when the new name is taken."""
        from py4j.protocol import Py4JJavaError

        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        plain = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._at(name), self._at(to), plain)
        except Py4JJavaError as problem:
            if "FileAlreadyExists" in problem.java_exception.getClass().getName():
                raise FileExistsError(to) from problem
            raise

    def _local(self, name: str) -> str:
        return urlparse(self._files.makeQualified(self._at(name)).toString()).path

"""Small files and folders next to the data, through the file system Spark itself uses.

Only names and small texts (commit files) go through the driver here; rows never do.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Storage:
    """Listing, reading, creating and deleting under paths of any Hadoop file system."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._array = spark.sparkContext._gateway.new_array

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def names(self, folder: str) -> list[str]:
        """Names directly in a folder; none if it does not exist."""
        fs, where = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, path: str) -> str | None:
        """The text of a small file; None if it does not exist."""
        fs, where = self._at(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a small file whole, or not at all; False if there is one of that name.

        The text is written under another name and then given its own, which no two
        writers can do: by a link on a local or mounted folder, by a rename that refuses to
        overwrite elsewhere. HDFS renames atomically; an object store that does not
        needs a single writer.
        """
        fs, where = self._at(path)
        draft = self._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        try:
            if fs.getScheme() == "file":
                return _linked(fs.makeQualified(draft), fs.makeQualified(where))
            files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self._conf)
            none = self._array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # no overwriting
            try:
                files.rename(draft, where, none)
            except Exception as error:
                if "FileAlreadyExists" in str(error):
                    return False
                raise
            return True
        finally:
            fs.delete(draft, False)

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def modified(self, path: str) -> int:
        """Seconds since 1970."""
        fs, where = self._at(path)
        return fs.getFileStatus(where).getModificationTime() // 1000


def _linked(draft, where) -> bool:
    local = [unquote(urlparse(p.toUri().toString()).path) for p in (draft, where)]
    try:
        os.link(*local)
    except FileExistsError:
        return False
    return True

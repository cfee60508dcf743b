"""Versions of a table as files that come into being whole and once.

Version v of a table is the file ``versions/v`` below its folder: a JSON list
of the data folders that it is made of. A writer reads the latest version,
writes a data folder of its own, and publishes version v + 1; of two writers
that try the same number one wins, and the other looks at what was added
meanwhile and tries the next. A file is written under another name first and
then given its own by an operation that fails if the name is taken: a hard link
on a local or mounted folder, ``FileContext.rename`` elsewhere (atomic on HDFS;
a store without an atomic rename needs one writer at a time).
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Versions:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, f"{base.rstrip('/')}/versions"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.base).getFileSystem(self._conf)
        qualified = self.fs.makeQualified(self._path(self.base)).toString()
        self.local = unquote(urlparse(qualified).path) if qualified.startswith("file:") else None

    def numbers(self) -> list[int]:
        at = self._path(self.base)
        if not self.fs.exists(at):
            return []
        return sorted(int(s.getPath().getName()) for s in self.fs.listStatus(at) if s.getPath().getName().isdigit())

    def latest(self) -> tuple[int, list[dict]]:
        """(number, data folders); (0, []) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, [])

    def read(self, number: int) -> list[dict]:
        stream = self.fs.open(self._path(f"{self.base}/{number}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def publish(self, number: int, folders: list[dict]) -> bool:
        """Whether this call made version ``number``."""
        draft = f"{self.base}/draft-{uuid.uuid4().hex}"
        out = self.fs.create(self._path(draft), False)
        try:
            out.write(bytearray(json.dumps(folders).encode()))
        finally:
            out.close()
        try:
            if self.local is not None:
                os.link(f"{self.local}/{os.path.basename(draft)}", f"{self.local}/{number}")
            else:
                context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
                context.rename(self._path(draft), self._path(f"{self.base}/{number}"), self._no_options())
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            self.fs.delete(self._path(draft), False)

    def _no_options(self):
        gateway = self.spark.sparkContext._gateway
        return gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def drop(self, folder: str) -> None:
        """Removes a data folder that no version has."""
        self.fs.delete(self._path(folder), True)

"""Numbered commit files, each created only if it is absent (for atomic changes of a store)."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


class CommitLog:
    """JSON states ``<number>.json`` in a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def fs(self, path: str):
        """Hadoop file system and path object of ``path``."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def numbers(self) -> list[int]:
        """Numbers of the commits at hand, ascending."""
        fs, p = self.fs(self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        fs, p = self.fs(f"{self.path}/{number:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, number: int, state: dict) -> bool:
        """Create commit ``number`` if no one else has; readers never see half of it."""
        target, temp = f"{self.path}/{number:012d}.json", f"{self.path}/_{uuid.uuid4().hex}"
        fs, src = self.fs(temp)
        out = fs.create(src, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        _, dst = self.fs(target)
        try:
            if fs.getUri().getScheme() == "file":
                try:
                    os.link(src.toUri().getPath(), dst.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            jvm = self.spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            try:
                context.rename(fs.makeQualified(src), fs.makeQualified(dst), none)
            except Exception:
                if fs.exists(dst):
                    return False
                raise
            return True
        finally:
            if fs.exists(src):
                fs.delete(src, False)

    def drop(self, number: int) -> None:
        fs, p = self.fs(f"{self.path}/{number:012d}.json")
        fs.delete(p, False)

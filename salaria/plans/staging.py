"""The tables that a run writes on its way, and what a later run may take up of them.

A run that may be resumed keeps its tables in a folder named by everything that they depend on:
the input files with their lengths and times, and the options. A driver that is started
again with the same inputs and options finds the folder and takes every table
that was finished (its mark is written after it); a changed input or option gives another
folder. Such a folder belongs to one run at a time.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salaria.plans.scratch import durable_root, drop_scratch, materialize, new_scratch
from salaria.sources.paths import file_system

#: Changes when the staged tables' contents do.
LAYOUT = 1


def fingerprint(spark: SparkSession, path: str) -> dict:
    """Number, bytes and a digest of names, lengths and times of all files below ``path``; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("_metadata.file_path").alias("name"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("time"))
    # Sums of hashes: the order in which files are listed does not matter.
    digests = [F.sum(F.xxhash64(F.lit(seed), "name", "length", F.unix_micros("time")).cast("decimal(38,0)")) for seed in (1, 2)]
    count, length, *sums = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), *digests).first()
    return {"path": path, "files": count, "bytes": length, "digest": [str(s) for s in sums]}


class Staging:
    """Tables of one run in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, label: str, manifest: dict | None = None):
        """``manifest``: what the tables depend on; the run may then be resumed. Without one the folder is new."""
        self.spark, self.manifest, self.resumed = spark, manifest, []
        if manifest is None:
            self.folder = new_scratch(spark, label)
            return
        text = json.dumps({"layout": LAYOUT, **manifest}, sort_keys=True)
        self.folder = f"{durable_root(spark)}/salaria/{label}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"
        self._write("manifest.json", text + "\n")

    def _path(self, name: str):
        return file_system(self.spark, f"{self.folder}/{name}")

    def _write(self, name: str, text: str) -> None:
        path, fs = self._path(name)
        out = fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def __call__(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        """``df`` written as ``name`` (in folders by the columns ``by``) and read back; the finished table of an earlier run if there is one."""
        where = f"{self.folder}/{name}"
        if self.manifest is not None:
            path, fs = self._path(f"{name}.done")
            if fs.exists(path):
                self.resumed.append(name)
                return self.spark.read.parquet(where)
        out = materialize(df, where, by)
        if self.manifest is not None:
            self._write(f"{name}.done", "")
        return out

    def drop(self) -> None:
        drop_scratch(self.spark, self.folder)

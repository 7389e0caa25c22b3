"""Publish an output folder whole or not at all.

A result is written to a sibling of its folder, checked there, and then put in its
place by renames of the file system: the old output is moved aside, the new one
moved in, and only then the old one deleted. Until the swap the old output is
untouched, and a run that fails leaves it as it was.

Names of siblings begin with ``_``, so that readers of the parent folder skip them. A
driver that dies between the two renames leaves the old output under its sibling's
name; ``recover`` (called by the next run for that folder) moves it back. Renames are atomic on
HDFS and local disks; an object store copies each file instead, which takes longer and is as safe, since
the old output is still deleted last.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from salaria.sources.paths import file_system

_NEXT, _OLD = "next", "old"


def _target(spark: SparkSession, path: str):
    """The folder to replace, behind links and mounts (a rename acts on the link itself), and its file system."""
    hpath, fs = file_system(spark, path)
    hpath = fs.makeQualified(hpath)
    there, below = hpath, []
    while there.getParent() is not None and not fs.exists(there):
        below.insert(0, there.getName())
        there = there.getParent()
    uri = fs.resolvePath(there).toUri()
    real = os.path.realpath(uri.getPath()) if uri.getScheme() in (None, "file") else None
    resolved = f"file://{real}" if real else uri.toString()
    return file_system(spark, "/".join([resolved.rstrip("/"), *below]))


def _sibling(spark: SparkSession, target, kind: str, run: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{kind}-{run}")


def _move(fs, source, to) -> None:
    if not fs.rename(source, to):
        raise OSError(f"could not move {source.toString()} to {to.toString()}")


def recover(spark: SparkSession, path: str) -> None:
    """Put back an old output that a run left aside when it died in the middle of its swap."""
    target, fs = _target(spark, path)
    if target.getParent() is None or fs.exists(target) or not fs.exists(target.getParent()):
        return
    prefix = f"_{target.getName()}.{_OLD}-"
    aside = [s for s in fs.listStatus(target.getParent()) if s.getPath().getName().startswith(prefix)]
    if aside:
        _move(fs, max(aside, key=lambda s: s.getModificationTime()).getPath(), target)


@contextmanager
def publishing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to; at the end of the block it takes the place of ``path``.

    If the block raises, what was written is deleted and ``path`` stays as it was.
    """
    recover(spark, path)
    target, fs = _target(spark, path)
    if target.getParent() is None:
        raise ValueError(f"output path {path!r} is the root of a store")
    run = uuid.uuid4().hex
    new, old = (_sibling(spark, target, kind, run) for kind in (_NEXT, _OLD))
    try:
        yield new.toString()
        had = fs.exists(target)
        if had:
            _move(fs, target, old)
        try:
            _move(fs, new, target)
        except Exception:
            if had:
                _move(fs, old, target)
            raise
        if had:
            fs.delete(old, True)
    finally:
        if fs.exists(new):
            fs.delete(new, True)

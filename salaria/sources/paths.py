"""Input and output paths, as the Hadoop file systems see them.

A place is a store and a path in it. Two names are one place if their paths agree and
their stores share a name, so that two buckets or clusters that hold the same path
stay apart, while links, mounts and other names of one store are still recognised.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import SparkSession

Parts = tuple[str, ...]
#: Names of a store, and the parts of a path in it.
Place = tuple[frozenset[str], Parts]

# Schemes that are ways to one kind of store.
_KINDS = {"s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "webhdfs": "hdfs", "swebhdfs": "hdfs",
          "abfs": "azure", "abfss": "azure", "wasb": "azure", "wasbs": "azure"}


def _parts(path: str) -> Parts:
    return tuple(p for p in path.split("/") if p)


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(sc._jsc.hadoopConfiguration())


def _matches(spark: SparkSession, path: str) -> list:
    """Every existing path that ``path`` (with its wildcards) names; none is an error."""
    hpath, fs = file_system(spark, path)
    found = [s.getPath() for s in fs.globStatus(hpath) or ()]
    if not found:
        raise FileNotFoundError(f"no input at {path!r}")
    return found


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the paths that ``path`` names."""
    _, fs = file_system(spark, path)
    return sum(fs.getContentSummary(p).getLength() for p in _matches(spark, path))


def store_names(scheme: str | None, authority: str | None, setting: Callable[[str], str | None] = lambda key: None) -> frozenset[str]:
    """Every name of the store behind a scheme and an authority.

    Local disks are one store. Schemes of one kind of store count as one. Of a cluster's authority the host counts,
    not the port (its protocols have ports of their own); a logical name stands for the hosts that the Hadoop
    settings (``setting``: key to value) list for it as well.
    """
    scheme, authority = (scheme or "file").lower(), authority or ""
    kind = _KINDS.get(scheme, scheme)
    if kind == "file":
        return frozenset({"file"})
    if kind != "hdfs":
        return frozenset({f"{kind}:{authority.lower()}"})
    host = authority.rsplit("@", 1)[-1].split(":")[0]
    hosts = {host}
    for node in (setting(f"dfs.ha.namenodes.{host}") or "").split(","):
        hosts |= {(setting(f"dfs.namenode.{protocol}-address.{host}.{node.strip()}") or "").split(":")[0] for protocol in ("rpc", "http", "https")}
    return frozenset(f"hdfs:{h.lower()}" for h in hosts - {""})


def _store(spark: SparkSession, uri) -> frozenset[str]:
    return store_names(uri.getScheme(), uri.getAuthority(), spark.sparkContext._jsc.hadoopConfiguration().get)


def _mounted_below(spark: SparkSession, fs, path: Parts) -> list:
    """Targets of the mounts that lie below ``path`` of a file system made of mounts."""
    if fs.getUri().getScheme() != "viewfs":
        return []
    return [target for mount in fs.getMountPoints() if _parts(mount.getMountedOnPath().toString())[:len(path)] == path
            for target in mount.getTargetFileSystemURIs()]


def places(spark: SparkSession, fs, hpath) -> set[Place]:
    """The places of a path: qualified against its file system, behind mounts (its own and those below it), and behind links of local folders."""
    qualified = fs.makeQualified(hpath)
    own = _parts(qualified.toUri().getPath())
    found = {(_store(spark, fs.getUri()), own)}
    there, below = qualified, []
    while there.getParent() is not None and not fs.exists(there):
        below.insert(0, there.getName())
        there = there.getParent()
    behind = [(fs.resolvePath(there).toUri(), below), *((uri, []) for uri in _mounted_below(spark, fs, own))]
    for uri, rest in behind:
        resolved = "/".join([uri.getPath(), *rest])
        # A path without an authority of its own belongs to the file system that resolved it.
        store = _store(spark, uri if uri.getScheme() else fs.getUri())
        found.add((store, _parts(resolved)))
        if store == store_names("file", None):
            found.add((store, _parts(os.path.realpath(resolved))))
    return found


def overlap(a: set[Place], b: set[Place]) -> bool:
    """Whether a place of ``a`` equals, holds or lies in one of ``b``."""
    return any(s & t and x[:n] == y[:n] for s, x in a for t, y in b for n in [min(len(x), len(y))])


def _same(a: set[Place], b: set[Place]) -> bool:
    return any(s & t and x == y for s, x in a for t, y in b)


def check_paths(spark: SparkSession, employee_path: str, payroll_path: str, *outputs: str) -> None:
    """Refuse an output that equals, contains or lies inside an input or another output, and inputs that are one.

    The old output is deleted once the new one is published, so such an
    overlap would destroy the inputs. Wildcards of the inputs are expanded; paths
    without a scheme, and relative ones, are taken as Spark takes them: against the
    default file system and its working folder.
    """
    seen = []
    for name, path in (("employee", employee_path), ("payroll", payroll_path)):
        _, fs = file_system(spark, path)
        seen.append((name, set().union(*(places(spark, fs, p) for p in _matches(spark, path)))))
    if _same(seen[0][1], seen[1][1]):
        raise ValueError("employee and payroll inputs are the same path")
    for output in outputs:
        hpath, fs = file_system(spark, output)
        there = places(spark, fs, hpath)
        if any(not path for _, path in there):
            raise ValueError(f"output path {output!r} is the root of a store")
        for name, other in seen:
            if overlap(there, other):
                raise ValueError(f"output path {output!r} overlaps the {name} input" if name in ("employee", "payroll")
                                 else f"output path {output!r} overlaps {name!r}")
        seen.append((output, there))

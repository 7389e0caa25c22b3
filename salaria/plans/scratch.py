"""Where intermediate tables are written to cut lineage.

On a cluster the shared folder named by ``spark.checkpoint.dir`` (or set with
``SparkContext.setCheckpointDir``) is used; it must be reachable by every
executor, so an executor loss never loses a materialised table. A ``file:`` folder
on a cluster (a network mount) is accepted only after the executors have read a
file that the driver wrote there. Only a local master (tests, single-node runs) may
fall back to a fresh temporary folder.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (falls back to the shuffle partition setting)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def seen_by_executors(spark: SparkSession, folder: str) -> bool:
    """Whether tasks on the executors can read a file that the driver writes to ``folder``."""
    sc = spark.sparkContext
    marker = f"{folder}/salaria/probe-{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(marker)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.writeBytes("seen\n")
    out.close()
    reads = 2 * max(2, sc.defaultParallelism)
    try:
        return spark.read.text([marker] * reads).where("value = 'seen'").count() == reads
    except Exception:  # noqa: BLE001 - a task that finds no file fails
        return False
    finally:
        fs.delete(path, False)


_PROBED: set[tuple[str, str]] = set()


def _require_shared(spark: SparkSession, sc, root: str) -> None:
    """Refuse a local folder on a cluster unless the executors see it."""
    known = (getattr(sc, "applicationId", ""), root)
    if sc.master.startswith("local") or known in _PROBED:
        return
    scheme = root.split(":", 1)[0] if ":" in root else ""
    if not scheme and hasattr(sc, "_jvm"):
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        scheme = path.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme == "file" and not (hasattr(sc, "_jvm") and seen_by_executors(spark, root)):
        raise RuntimeError(f"spark.checkpoint.dir {root!r} is a local folder that the executors do not share")
    _PROBED.add(known)


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a temporary one only on a local master."""
    sc = _context(spark)
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        root = root.rstrip("/")
        if sc is not None:
            _require_shared(spark, sc, root)
        return root
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; intermediate tables need a folder shared by all executors"
        )
    root = tempfile.mkdtemp(prefix="salaria-checkpoint-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def durable_root(spark: SparkSession) -> str:
    """The folder that was named for checkpoints: Spark gives each application a folder of its own (a UUID) in it."""
    root = checkpoint_root(spark)
    parent, _, name = root.rpartition("/")
    return parent if parent and re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", name) else root


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/salaria/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder that is deleted when the block ends."""
    path = new_scratch(spark, label)
    try:
        yield path
    finally:
        drop_scratch(spark, path)


_OWNED: list[tuple[object, object, str]] = []


def session_scratch(spark: SparkSession, label: str) -> str:
    """A scratch folder for tables behind a lazy result: deleted by ``drop_session_scratch`` or when Python ends."""
    path = new_scratch(spark, label)
    sc = _context(spark)
    if sc is not None:
        if not _OWNED:
            atexit.register(drop_session_scratch)
        _OWNED.append((sc._jvm, sc._jsc.hadoopConfiguration(), path))
    return path


def drop_session_scratch() -> None:
    """Delete every folder that ``session_scratch`` gave out; results that read them are void after that."""
    while _OWNED:
        jvm, conf, path = _OWNED.pop()
        try:
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(conf).delete(hpath, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            return


def materialize(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` (in folders by the columns ``by``) and read it back.

    This is an action: later plans start from files (no recomputation after executor
    loss) and Catalyst sees the true size.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a run's scratch folder from the checkpoint folder (Hadoop FileSystem API).

    Best effort: where the session exposes no JVM (Spark Connect) the folder stays.
    """
    sc = _context(spark)
    if sc is None:
        return
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)

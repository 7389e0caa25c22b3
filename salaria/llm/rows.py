"""Helpers shared by the operators of this package: scratch tables, row keys, prefix sums.

Row keys: ``doc_id`` names a document, but repeated rows may carry one id twice.
``(doc_id, row_fp)`` with ``row_fp = xxhash64(text)`` tells such rows apart; rows
that agree on both are copies of one row and are interchangeable.
"""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salaria.plans.scratch import drop_scratch, materialize, new_scratch, session_scratch

#: Key bits of ``prefix_positions``; keys lie in [0, 2**KEY_BITS).
KEY_BITS = 52
#: Rows of one leaf of the prefix tree, and leaves of one inner node (as bits).
LEAF_ROWS, FAN_BITS = 256, 10


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage is cut.

    The folder is deleted when Python ends (``plans.scratch.drop_session_scratch`` does it earlier).
    """
    return materialize(df, session_scratch(df.sparkSession, label))


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df``, written first if its plan shuffles: rows that come out of a shuffle may come in another order when a task is run again."""
    return table(df, label) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


@contextmanager
def parts_by_size(spark: SparkSession) -> Iterator[None]:
    """Within the block, adaptive execution merges shuffle parts up to the advisory size, not only down to the number of
    cores: small intermediate tables are a file or two. For work that runs inside the block."""
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def passing_tables(spark: SparkSession, label: str) -> Iterator:
    """A function that writes tables as ``table`` does; they are deleted at the end, so what is kept must be written elsewhere by then."""
    with parts_by_size(spark):
        yield from _passing(spark, label)


def _passing(spark: SparkSession, label: str) -> Iterator:
    folder, number = new_scratch(spark, label), 0

    def write(df: DataFrame, name: str) -> DataFrame:
        nonlocal number
        number += 1
        return materialize(df, f"{folder}/{number}-{name}")

    try:
        yield write
    finally:
        drop_scratch(spark, folder)


#: Rows of an Arrow batch that carries whole texts.
TEXT_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Have Arrow batches of at most ``TEXT_BATCH`` rows from now on in this session.

    Spark's 10,000 rows of whole texts are tens of megabytes on both sides of every
    task. The setting is read when a plan runs, so it is not put back.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_BATCH:
        spark.conf.set(name, str(TEXT_BATCH))


#: Of the C library's ``mallopt``.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def reuse_memory() -> None:
    """Keep freed arrays of up to 32 MB in this process until ``release_memory``: else each new one is
    fetched from the system page by page. For work on arrays that come and go."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(_MMAP_THRESHOLD, 32 << 20)
        libc.mallopt(_TRIM_THRESHOLD, 256 << 20)
    except (OSError, AttributeError):  # another C library
        pass


def release_memory() -> None:
    """Give freed memory back to the system; a Python worker lives on after its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def row_fp(text: Column) -> Column:
    return F.xxhash64(text)


def seeded_key(*cols, seed: int) -> Column:
    """A pseudorandom key in [0, 2**KEY_BITS), a pure function of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 64 - KEY_BITS)


def prefix_positions(df: DataFrame, rows: int, group: str, key: str, ties: list[str], sums: tuple[str, ...] = (),
                     ) -> DataFrame:
    """Position of every row in its group's order by (key, ties), without sorting a group in one task.

    Adds ``pos`` (rows before it), ``before_<c>`` (sum of ``c`` over those rows),
    ``group_rows`` and ``group_<c>``. ``key`` must spread evenly over
    [0, 2**KEY_BITS) within each group (a hash, or a scaled rank). The key space
    is a tree: leaves of about ``LEAF_ROWS`` rows, inner nodes of 2**FAN_BITS
    children. Totals go up the tree, offsets come down, and rows are numbered
    within their leaf, so a group of any size costs the same per row. ``rows``:
    rows of ``df``, which should be a written table (it is read twice).
    """
    bits = max(0, math.ceil(math.log2(max(1, rows) / LEAF_ROWS)))
    names = ["rows", *sums]
    up = df.groupBy(group, F.shiftright(key, KEY_BITS - bits).alias("_node"))
    levels = [up.agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(f"_{c}") for c in sums))]
    while bits > FAN_BITS:
        bits -= FAN_BITS
        levels.append(levels[-1].groupBy(group, F.shiftright("_node", FAN_BITS).alias("_node"))
                      .agg(*(F.sum(f"_{c}").alias(f"_{c}") for c in names)))
    leaf_bits = max(0, math.ceil(math.log2(max(1, rows) / LEAF_ROWS)))

    def before(part: Window) -> list[Column]:
        upto = part.orderBy("_node").rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"_{c}").over(upto), F.lit(0)).alias(f"_off_{c}") for c in names]

    top = Window.partitionBy(group)
    nodes = levels.pop().select(group, "_node", *before(top), *(F.sum(f"_{c}").over(top).alias(f"group_{c}") for c in names))
    while levels:
        level = levels.pop().withColumn("_up", F.shiftright("_node", FAN_BITS))
        level = level.select(group, "_node", "_up", *before(Window.partitionBy(group, "_up")))
        above = nodes.select(group, F.col("_node").alias("_up"), *(F.col(f"_off_{c}").alias(f"_add_{c}") for c in names),
                             *(f"group_{c}" for c in names))
        nodes = level.join(above, [group, "_up"]).select(
            group, "_node", *((F.col(f"_off_{c}") + F.col(f"_add_{c}")).alias(f"_off_{c}") for c in names),
            *(f"group_{c}" for c in names))
    leaf = Window.partitionBy(group, "_node").orderBy(key, *ties)
    upto = leaf.rowsBetween(Window.unboundedPreceding, -1)
    own = [F.col(c) for c in df.columns]
    return (
        df.withColumn("_node", F.shiftright(key, KEY_BITS - leaf_bits)).join(nodes, [group, "_node"])
        .select(*own, *(f"group_{c}" for c in names),
                (F.col("_off_rows") + F.row_number().over(leaf) - 1).alias("pos"),
                *((F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(upto), F.lit(0))).alias(f"before_{c}") for c in sums))
    )


def pick_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``keys`` (``doc_id``, ``row_fp``: one row each); of copies of one row, one.

    All columns of ``docs`` are kept as they are. Ids may be null.
    """
    cols = docs.columns
    d = docs.select(F.struct(*(docs[c] for c in cols)).alias("_row"), docs["doc_id"].alias("_id"),
                    row_fp(docs["text"]).alias("_fp"))
    k = keys.select(F.col("doc_id").alias("_kid"), F.col("row_fp").alias("_kfp"))
    d = d.join(k, (d["_fp"] == k["_kfp"]) & d["_id"].eqNullSafe(k["_kid"]), "left_semi")
    one = Window.partitionBy("_id", "_fp").orderBy("_fp")
    return d.withColumn("_copy", F.row_number().over(one)).where("_copy = 1").select("_row.*")

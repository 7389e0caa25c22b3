"""Vectors and queries brought together in bounded units of work.

A unit holds a bounded number of vectors; the queries that need it pass by as a stream. Both go through one shuffle as rows of one vector each,
sorted so that a unit's vectors come first, so that no row, batch or broadcast grows with a page or a block, and a query is
sent once to a unit whatever number of pages it meets there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria.llm.rows import table

#: Vectors of a table are dealt to so many units at least where these hold a page; components and queries of a unit at most.
UNITS, UNIT_CELLS, UNIT_QUERIES = 48, 1 << 22, 1 << 18
#: Rows of an Arrow batch of vectors, and of those that a routing step gives out at once.
BATCH, OUT = 2048, 8192
#: Partitions of the shuffle at most.
MOST = 25_000


def unit_rows(total: int, page_rows: int, width: int) -> int:
    """Vectors of a unit (about) for ``total`` vectors of ``width`` components."""
    return max(1, min(max(page_rows, total // UNITS), UNIT_CELLS // max(1, width)))


def deal(counts, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First unit and number of units of each group: small groups share a unit, one of more than ``rows`` rows has its own. Empty groups have none."""
    first, number, unit, held = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64), -1, rows
    for g, n in enumerate(map(int, counts)):
        if not n:
            continue
        if held + n > rows:
            unit, held = unit + 1, 0
        first[g], number[g] = unit, -(-n // rows)
        unit, held = unit + int(number[g]) - 1, held + n if n <= rows else rows
    return first, number


def picked(values, place: Column) -> Column:
    """The integer at ``place`` (from 0): the list is one literal, however long."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<int>")[place]


def least_draws(df: DataFrame, total: int, want: int) -> DataFrame:
    """The ``want`` rows of smallest (draw, vec_id) of ``df``'s ``total``; ``draw`` is a 64-bit hash. Only rows below a cut that leaves about twice as many are
    sorted, so that what tasks give out does not grow with their number."""
    share = (2 * want + 64) / max(1, total)
    if share < 0.5:
        below = df.where(F.col("draw") <= int((share - 0.5) * 2.0 ** 64))
        if below.count() >= want:
            df = below
    return df.orderBy("draw", "vec_id").limit(want)


def padded(vectors: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows of numbers, shorter ones ending in zeros."""
    lengths = vectors.value_lengths().to_numpy().astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(-1, width).astype(kind, copy=False)
    out = np.zeros((len(lengths), width), kind)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)]).cast(pa.binary())


def unpacked(column: pa.Array, width: int, kind) -> np.ndarray:
    """Rows from their bytes."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros((0, width), kind)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])), kind).reshape(-1, width)


def sent(need: np.ndarray, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """A row of ``columns`` for each unit that it needs (``need``: rows by units)."""
    query, unit = np.nonzero(need)
    for at in range(0, len(query), OUT):
        rows = pa.array(query[at:at + OUT])
        yield pa.RecordBatch.from_arrays([pa.array(unit[at:at + OUT], pa.int32()), *(c.take(rows) for c in columns.values())], ["unit", *columns])


def units_needed(groups: np.ndarray, first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Rows by units: where a row needs any group of the unit (``groups``: rows by groups)."""
    out = np.zeros((len(groups), int((first + number).max(initial=0))), bool)
    for g in np.flatnonzero(groups.any(axis=0) & (number > 0)):
        out[:, first[g]:first[g] + number[g]] |= groups[:, g:g + 1]
    return out


def _search(build: Callable[[pa.Table], object], answer: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, built = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("unit", "block", "query")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                unit, rows = (keys[start, 0], keys[start, 1]), batch.slice(start, end - start)
                if unit != at:
                    at, held, built = unit, [], None
                if not keys[start, 2]:
                    held.append(rows)
                    continue
                if held:
                    built, held = build(pa.Table.from_batches(held).combine_chunks()), []
                if built is not None:
                    yield from answer(built, rows)
    return run


def search(vectors: DataFrame, queries: DataFrame, asked: int, units: int, build, answer, schema: str, label: str) -> DataFrame:
    """``answer(build(vectors of a unit), some of its queries)`` over all units, as a written table.

    ``vectors`` and ``queries`` have unit, grp, vec_id, x and, in one order, further columns of the same types; ``asked``: number of different queries, of
    which a unit of work gets ``UNIT_QUERIES`` (about); more are dealt to blocks, to each of which the unit's vectors go. A unit's vectors come ordered by
    grp and vec_id, its queries in batches, ordered so as well.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-asked // UNIT_QUERIES))
    both = vectors.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("query")).unionAll(
        queries.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("query")))
    dealt = both.repartitionById(max(1, min(MOST, units * blocks)), F.col("unit") * blocks + F.col("block"))
    work = dealt.sortWithinPartitions("unit", "block", "query", "grp", "vec_id").mapInArrow(_search(build, answer), schema)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH))  # read when the plan runs, so it runs here
    try:
        return table(work, label)
    finally:
        spark.conf.set(name, before)

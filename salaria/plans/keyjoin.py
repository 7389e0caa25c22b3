"""Attach one-row-per-key attributes to a large, possibly skewed row set.

The rows side may hold a single key with a third of all rows, or a third of all
rows as identical copies. Neither path below ever sends one key's rows to one
task:

* **broadcast** when the measured size of the key table is under a byte budget:
  the rows are not shuffled at all;
* **salted shuffle join** otherwise: a key with more than ``rows_per_task`` rows is
  spread over ``ceil(n / rows_per_task)`` buckets by a hash of the unique row id
  (so copies spread too), and its attribute row is replicated once per bucket.
  The list of such hot keys is broadcast if its measured bytes fit, else joined by
  shuffle (adaptive execution splits its skewed parts).

A total order needs no sampling on the salted path: the key table's counts, summed in
key order, give every key the part of the output in which it begins, and a hot
key's rows, counted by ranges of their ids, the parts over which they go on. That
part is the salt, too, and after the join the rows are dealt out by it once.

The key table must already be materialised (see ``plans.scratch.materialize``)
so that measuring it is cheap and exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salaria.plans import ordering, sizing

DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
DEFAULT_ROWS_PER_TASK = 2_000_000
# Per-row overhead of a broadcast hash relation entry (key and value rows with
# their null bits and 8-byte slots, record headers, hash-map slots at 2x
# capacity); added to the measured payload bytes. Calibrated on a 996,142-row key
# table: payload ~42 B/row, BroadcastExchange "data size" 167.8 MB (~168 B/row).
ROW_OVERHEAD_BYTES = 128

_SALT = "_salt"
_BUCKETS = "_buckets"
_CHUNK = "_chunk"
_FIRST = "_first_part"
# Ranges of a hot key's row ids are this share of an output part at most.
_CHUNKS_PER_PART = 8


@dataclass(frozen=True)
class KeyTableSize:
    keys: int
    payload_bytes: int
    total_rows: int
    hot_bytes: int = 0

    @property
    def estimated_bytes(self) -> int:
        return self.payload_bytes + self.keys * ROW_OVERHEAD_BYTES


def _value_bytes(field: T.StructField) -> str:
    """SQL for the bytes of a column's value. (One expression text takes far fewer calls to the JVM than columns put together.)"""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return f"cast(coalesce(octet_length(`{field.name}`), 0) as bigint)"
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    return f"{fixed.get(type(field.dataType), 8)}L"


def size_exprs(keys: DataFrame, count_col: str, where: Column | None = None, *, key: str | None = None,
               rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> list[Column]:
    """Aggregates giving ``KeyTableSize`` of ``keys`` (rows where ``where`` holds).

    Returned as expressions so a caller can fold them into an aggregate it runs
    anyway (see ``plans.job``). ``key``: its bytes are summed over the keys of more
    than ``rows_per_task`` rows, the list that the salted join needs.
    """
    schema = keys.schema
    payload = F.expr(" + ".join(_value_bytes(f) for f in schema.fields if f.name != count_col))
    cond = F.lit(True) if where is None else where
    hot = cond & (F.col(count_col) > rows_per_task)
    hot_bytes = F.lit(0) if key is None else F.expr(f"{_value_bytes(schema[key])} + {ROW_OVERHEAD_BYTES}L")

    def total(what: Column, name: str) -> Column:
        return F.coalesce(F.sum(what), F.lit(0)).cast("bigint").alias(name)

    return [
        F.count_if(cond).alias("_size_keys"),
        total(F.when(cond, payload), "_size_bytes"),
        total(F.when(cond, F.col(count_col)), "_size_rows"),
        total(F.when(hot, hot_bytes), "_size_hot"),
    ]


def size_from_row(row) -> KeyTableSize:
    return KeyTableSize(int(row["_size_keys"]), int(row["_size_bytes"]), int(row["_size_rows"]), int(row["_size_hot"]))


def measure(keys: DataFrame, count_col: str, key: str | None = None, rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> KeyTableSize:
    """Exact key count, payload bytes, summed row count and hot-list bytes of a key table (one small job)."""
    return size_from_row(keys.agg(*size_exprs(keys, count_col, key=key, rows_per_task=rows_per_task)).first())


BROADCAST = "broadcast"
SALTED = "salted-shuffle"


def choose_strategy(size: KeyTableSize, max_broadcast_bytes: int) -> str:
    return BROADCAST if size.estimated_bytes <= max_broadcast_bytes else SALTED


def attach_by_key(
    rows: DataFrame,
    keys: DataFrame,
    key: str,
    count_col: str,
    row_id_col: str,
    *,
    how: str = "left",
    order_by: tuple[str, ...] = (),
    order_partitions: int | None = None,
    join_partitions: int | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    rows_per_task: int = DEFAULT_ROWS_PER_TASK,
    max_hot_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    size: KeyTableSize | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """``rows JOIN keys USING (key)``; ``keys`` has one row per key and ``count_col``
    holds the number of ``rows`` with that key. ``count_col`` is not returned.

    ``order_by`` (the key and the row id) asks for a total order of the result, in
    ``order_partitions`` part files (default ``spark.sql.shuffle.partitions``).
    On the broadcast path the narrow ``rows`` are range-partitioned before the
    join, which keeps the order of its streamed side, and sorted within
    partitions after it: the shuffle and the range sampling pass carry only the
    row columns, not the attached attributes. ``join_partitions`` sizes the
    salted join's exchange (default ``spark.sql.shuffle.partitions``); both sides
    are hash-partitioned on ``(key, salt)`` into that many parts, which the
    sort-merge join then uses as they are.

    On the salted path the rows are neither sampled nor written before they are ordered
    (``_ordered_salted``); every row's key must be in ``keys``. ``stage`` (a table and its
    name) writes the small tables of that path and reads them back. ``size``: a
    ``measure`` of ``keys`` with ``key`` and the same ``rows_per_task``.
    """
    if order_by and tuple(order_by) != (key, row_id_col):
        raise ValueError("rows can be ordered by the key and the row id")
    ranged_args = ((order_partitions,) if order_partitions else ()) + tuple(order_by)
    size = size or measure(keys, count_col, key, rows_per_task)
    attrs = keys.drop(count_col)
    if choose_strategy(size, max_broadcast_bytes) == BROADCAST:
        if not order_by:
            return rows.join(F.broadcast(attrs), key, how)
        ranged = rows.repartitionByRange(*ranged_args)
        return ranged.join(F.broadcast(attrs), key, how).sortWithinPartitions(*order_by)

    if order_by:
        parts = order_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return _ordered_salted(rows, keys, key, count_col, row_id_col, how, parts, join_partitions, max_hot_bytes, size,
                               stage or (lambda df, name: df))

    # Salted path.
    hot = keys.filter(F.col(count_col) > rows_per_task).select(
        key, F.ceil(F.col(count_col) / F.lit(rows_per_task)).cast("int").alias(_BUCKETS)
    )
    hot = F.broadcast(hot) if size.hot_bytes <= max_hot_bytes else hot.hint("merge")
    salted_rows = rows.join(hot, key, "left").withColumn(
        _SALT,
        F.when(F.col(_BUCKETS).isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.col(row_id_col)), F.col(_BUCKETS)).cast("int")
        ),
    ).drop(_BUCKETS)
    salted_keys = attrs.join(hot, key, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_BUCKETS), F.lit(1)) - 1))
    ).drop(_BUCKETS)
    if join_partitions:
        salted_rows = salted_rows.repartition(join_partitions, key, _SALT)
        salted_keys = salted_keys.repartition(join_partitions, key, _SALT)
    return salted_rows.join(salted_keys, [key, _SALT], how).drop(_SALT)


def _ordered_salted(rows: DataFrame, keys: DataFrame, key: str, count_col: str, row_id_col: str, how: str, parts: int,
                    join_partitions: int | None, max_hot_bytes: int, size: KeyTableSize, stage) -> DataFrame:
    """The salted join, totally ordered by ``(key, row id)`` over ``parts`` part files of about equal rows.

    Running sums over the key table give each key its first part. A key of more rows than a part is hot: there are
    fewer than ``parts`` of them. Their rows are counted by ranges of ids, whose running
    sums give each range its part, which is the salt of its rows; all other keys keep one salt and lie
    in their first part. The narrow rows cross the shuffle for the join, the joined rows once
    more, straight to their part.
    """
    total = size.total_rows
    share = -(-total // parts)
    starts = ordering.running_sums(keys, [key], count_col, sizing.partitions(size.payload_bytes, 1), stage, "report_starts")
    starts = starts.withColumn(_FIRST, ordering.part_at(F.col(ordering.BEFORE), total, parts))
    own, attrs = [F.col(c) for c in rows.columns], [F.col(c) for c in keys.columns if c != count_col]
    hot = starts.filter(F.col(count_col) > share).select(key, ordering.BEFORE)
    hot_rows = hot.collect()
    if hot_rows:
        hot = rows.sparkSession.createDataFrame(hot_rows, hot.schema)
        bits = max(0, (share // _CHUNKS_PER_PART).bit_length() - 1)
        chunk = F.shiftright(row_id_col, bits)
        ahead = Window.partitionBy(key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        chunks = rows.select(key, chunk.alias(_CHUNK)).join(F.broadcast(hot), key).groupBy(key, _CHUNK).agg(
            F.count(F.lit(1)).alias("_n"), F.first(ordering.BEFORE).alias(ordering.BEFORE))
        before = F.col(ordering.BEFORE) + F.coalesce(F.sum("_n").over(ahead), F.lit(0))
        chunks = stage(chunks.select(key, _CHUNK, ordering.part_at(before, total, parts).alias(_SALT)), "report_chunks")
        # Measured before it is broadcast, as the hot list is.
        chunk_bytes = chunks.agg(F.expr(f"sum({_value_bytes(keys.schema[key])} + {ROW_OVERHEAD_BYTES}L)")).first()[0]

        def sized(df: DataFrame) -> DataFrame:
            return F.broadcast(df) if chunk_bytes <= max_hot_bytes else df.hint("merge")

        other = F.coalesce(F.col(_SALT), F.lit(-1)).alias(_SALT)
        salted_rows = rows.withColumn(_CHUNK, chunk).join(sized(chunks), [key, _CHUNK], "left").select(*own, other)
        salted_keys = starts.join(sized(chunks.select(key, _SALT).distinct()), key, "left").select(*attrs, _FIRST, other)
    else:
        salted_rows, salted_keys = (df.withColumn(_SALT, F.lit(-1)) for df in (rows, starts.select(*attrs, _FIRST)))
    if join_partitions:
        salted_rows = salted_rows.repartition(join_partitions, key, _SALT)
        salted_keys = salted_keys.repartition(join_partitions, key, _SALT)
    joined = salted_rows.join(salted_keys, [key, _SALT], how)
    part = F.when(F.col(_SALT) >= 0, F.col(_SALT)).otherwise(F.coalesce(F.col(_FIRST), F.lit(0)))
    return joined.repartitionById(parts, part).sortWithinPartitions(key, row_id_col).drop(_SALT, _FIRST)

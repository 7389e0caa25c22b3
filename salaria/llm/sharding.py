"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded key and ranked; row ``r`` of
``n`` gets the fractional rank ``(r + u) / n``, with a seeded offset ``u`` of its source between 0 and 1, so that
many sources of few rows do not meet at one rank. Sorting all rows by it deals
every source evenly over the whole order, so cutting the order into equal runs
gives shards that each hold the corpus's mixture and differ by one row at most.

Both rankings use ``prefix_positions``: no source, however large, is sorted in one
task, and only ids, hashes and sizes are shuffled. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salaria.llm.rows import KEY_BITS, documents, prefix_positions, seeded_key, table

SHARDS, SEED = 40, 20


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard).

    Returns doc_id, source, size (UTF-8 bytes of the text, null: none, plus 16),
    text_crc32 (null text: that of no bytes, 0), shard, slot. A null source is a
    source of its own. Rows that repeat a doc_id are told apart by their text; equal
    rows are interchangeable. With fewer rows than shards some shards stay empty; an
    empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    narrow = docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(F.when(docs["source"].isNull(), "n").otherwise("s"), F.coalesce(docs["source"].cast("string"), F.lit(""))).alias("_group"),
        seeded_key(docs["doc_id"], text, seed=seed).alias("_key"))
    narrow = table(narrow, "shard-rows")
    rows = narrow.count()
    ranked = prefix_positions(narrow, rows, "_group", "_key", ["doc_id", "size", "text_crc32"])
    # Doubles hold 53 bits; ties of the scaled rank fall to the source, then to the rank.
    offset = seeded_key("_group", seed=seed + 1) / float(1 << KEY_BITS)
    fraction = (F.col("pos") + offset) / F.col("group_rows")
    ranked = table(ranked.select("doc_id", "source", "size", "text_crc32", "_group", F.col("pos").alias("_rank"),
                                 F.least(F.floor(fraction * float(1 << KEY_BITS)), F.lit((1 << KEY_BITS) - 1)).alias("_key"),
                                 F.lit(0).alias("_all")), "shard-ranks")
    order = prefix_positions(ranked, rows, "_all", "_key", ["_group", "_rank"])
    # Shard s holds the positions from floor(s * rows / shards) on.
    total = max(rows, 1)
    shard = F.expr(f"((pos + 1) * {shards}L - 1) div {total}L")
    return order.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "shard",
        (F.col("pos") - F.expr(f"(shard * {total}L) div {shards}L")).alias("slot"))


def op2_stratified_sharding(spark, sf_dir):
    """All documents in 40 shards; counts are at most one apart."""
    out = shard_rows(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")

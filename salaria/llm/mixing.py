"""Mixing sources to target weights.

Each source is one stream of words (its documents in a seeded order), packed into
fixed-length blocks; a small source has shorter ones, so that it has ``LEAST_BLOCKS`` of
them, or one a word, and meets its target as closely as a large one. The mix is a row of slots, cut into output shards of equal
length. Which source fills a slot is drawn: a pseudorandom permutation of all slots
is laid over the sources' quotas, so the counts of a shard are a multinomial draw
conditioned on the mix's totals (without replacement). An unconditioned draw would
miss the targets by its noise and take some documents more than twice. The slot's
index in its quota then goes through the source's own pseudorandom permutation of
its blocks (one per pass over the source), and blocks are joined by that index.

Permutations are swap-or-not shuffles (Hoang, Morris, Rogaway 2012): exact
permutations of [0, n) for any n, computed per value, so nothing is sorted or kept.
Word offsets come from ``prefix_positions``: no source is walked in one task. Only
ids, sizes and indexes are shuffled. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import documents, pick_rows, prefix_positions, row_fp, seeded_key, table  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
BLOCK_WORDS, LEAST_BLOCKS, SHARD_SLOTS, SEED, ROUNDS = 128, 64, 4096, 11, 24
#: Cells, at least, of the grid in which a slot finds its source's quota; there are as many as sources.
CELLS = 1024


def permuted(x: Column, n: Column, *seed) -> Column:
    """Swap-or-not: a pseudorandom permutation of [0, n), chosen by ``seed``."""
    def swap(value, r):
        partner = F.pmod(F.pmod(F.xxhash64(r, *seed), n) - value, n)
        coin = F.xxhash64(r, F.greatest(value, partner), F.lit(1), *seed)
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, partner).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap)


def block_length(words: str, block_words: int) -> Column:
    """Words of a block of a source with (the column) ``words``."""
    return F.expr(f"least({block_words}L, greatest(1L, {words} div {LEAST_BLOCKS}))")


def stream_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row with its place in its source's word stream: doc_id, row_fp, source, size, grp, pos, before_size, group_size."""
    text = F.coalesce(docs["text"], F.lit(""))
    narrow = docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"), row_fp(docs["text"]).alias("row_fp"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.concat(F.when(docs["source"].isNull(), "n").otherwise("s"), F.coalesce(docs["source"].cast("string"), F.lit(""))).alias("grp"),
        seeded_key(docs["doc_id"], text, seed=seed).alias("_key"))
    narrow = table(narrow, "mix-rows")
    out = prefix_positions(narrow, narrow.count(), "grp", "_key", ["doc_id", "row_fp"], sums=("size",))
    return table(out.select("doc_id", "row_fp", "source", "size", "grp", "pos", "before_size", "group_size"), "mix-stream")


def source_targets(stream: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: words, weight, target, blocks, quota (slots), first_slot.

    The targets are the level at which each source holds ``weight * level``, at most
    ``repeats`` times its words: sources are walked in the order in which a rising
    level reaches their limits. The windows run over one row per source.
    """
    s = stream.groupBy("grp", "source").agg(F.sum("size").alias("words"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("nth", nth).withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1))
    s = s.withColumn("cap", float(repeats) * F.col("words")).withColumn("reach", F.col("cap") / F.col("weight"))
    rise, all_ = Window.orderBy("reach", "nth"), Window.partitionBy(F.lit(0))
    s = s.withColumn("level", (share * F.sum("words").over(all_) - F.coalesce(F.sum("cap").over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
                     / F.sum("weight").over(rise.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", F.min_by(F.when(F.col("level") < F.col("reach"), F.col("level")),
                                       F.when(F.col("level") < F.col("reach"), F.struct("reach", "nth"))).over(all_))
    s = s.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))))
    s = s.withColumn("length", block_length("words", block_words)).withColumn("blocks", F.expr("(words + length - 1) div length"))
    # A slot takes words / blocks words on average (the last block of a source is short).
    slots = F.round(F.col("target") * F.col("blocks") / F.col("words"))
    s = s.withColumn("quota", F.when(F.col("words") > 0, F.least(slots.cast("long"), repeats * F.col("blocks"))).otherwise(F.lit(0)))
    first = F.coalesce(F.sum("quota").over(Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return table(s.withColumn("first_slot", first).select("grp", "source", "words", "weight", "target", "blocks", "quota", "first_slot"),
                 "mix-sources")


def mix_slots(sources: DataFrame, seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix: one row per slot with shard, slot (in the shard), grp, pass, block."""
    slots, n = sources.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count(F.lit(1))).first()
    cell = max(1, -(-slots // max(CELLS, n)))
    quotas = sources.where("quota > 0").select(
        "grp", "blocks", "first_slot", (F.col("first_slot") + F.col("quota")).alias("_end"),
        F.explode(F.sequence(F.expr(f"first_slot div {cell}"), F.expr(f"(first_slot + quota - 1) div {cell}"))).alias("_cell"))
    drawn = sources.sparkSession.range(slots).select(
        F.expr(f"id div {shard_slots}").alias("shard"), F.expr(f"id % {shard_slots}").alias("slot"),
        permuted(F.col("id"), F.lit(slots).cast("long"), F.lit(seed)).alias("_drawn")).withColumn("_cell", F.expr(f"_drawn div {cell}"))
    drawn = drawn.join(quotas, "_cell").where("_drawn >= first_slot and _drawn < _end")
    index = F.col("_drawn") - F.col("first_slot")
    drawn = drawn.select("shard", "slot", "grp", "blocks", F.expr("(_drawn - first_slot) div blocks").alias("pass"),
                         (index % F.col("blocks")).alias("_index"))
    return drawn.select("shard", "slot", "grp", "pass",
                        permuted(F.col("_index"), F.col("blocks"), F.lit(seed), F.col("grp"), F.col("pass")).alias("block"))


def shard_counts(slots: DataFrame) -> DataFrame:
    """The drawn source counts of every output shard."""
    return slots.groupBy("shard", "grp").agg(F.count(F.lit(1)).alias("slots"))


def block_pieces(stream: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The words of each row by block: grp, pos, block, from_word and n_words (in the row). Rows without words have none."""
    b = F.col("block") * F.col("length")
    start, end = F.col("before_size"), F.col("before_size") + F.col("size")
    pieces = stream.where("size > 0").withColumn("length", block_length("group_size", block_words)).select(
        "grp", "pos", "before_size", "size", "length",
        F.explode(F.sequence(F.expr("before_size div length"), F.expr("(before_size + size - 1) div length"))).alias("block"))
    lo, hi = F.greatest(b, start), F.least(b + F.col("length"), end)
    return pieces.select("grp", "pos", "block", (lo - start).alias("from_word"), (hi - lo).alias("n_words"))


def mixed(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stream rows, sources, slots) of the mix of ``docs``."""
    stream = stream_rows(docs, seed)
    sources = source_targets(stream, block_words=block_words)
    return stream, sources, mix_slots(sources, seed)


def mix_taken(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` with the words that the mix takes of it, repeats counted.

    Returns doc_id, source, size, source_size, target (its source's words in the
    mix), taken. Null or empty texts have size 0 and give nothing; a null source is a
    source of its own, last in order. A source's taken words miss its target by less than two of its blocks
    (``block_length``: 1/64 of its words at most each, or a word). Repeated rows are rows like others, each with
    its own place. An empty table gives an empty result. Other columns are ignored.
    """
    stream, sources, slots = mixed(docs, seed, block_words)
    times = slots.groupBy("grp", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (block_pieces(stream, block_words).join(times, ["grp", "block"])
             .groupBy("grp", "pos").agg(F.sum(F.col("n_words") * F.col("times")).alias("taken")))
    out = stream.join(taken, ["grp", "pos"], "left").join(sources.select("grp", "target"), "grp")
    return out.select("doc_id", "source", "size", F.col("group_size").alias("source_size"), "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of documents: per document and pass over its source, the words taken, in their order.

    All columns of ``docs`` stay; ``text`` holds the taken words with the white space
    behind them (the text itself where all is taken) and ``n_chars``, if there, is its length.
    """
    stream, _, slots = mixed(docs, seed, block_words)
    parts = (block_pieces(stream, block_words).join(slots.select("grp", "block", "pass"), ["grp", "block"])
             .groupBy("grp", "pos", "pass").agg(F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("_parts"),
                                                F.sum("n_words").alias("_taken")))
    plan = stream.join(parts, ["grp", "pos"]).withColumn(
        "_copy", F.dense_rank().over(Window.partitionBy("doc_id", "row_fp").orderBy("grp", "pos")))
    plan = plan.select(F.col("doc_id").alias("_kid"), F.col("row_fp").alias("_kfp"), "_copy", "_parts", (F.col("_taken") == F.col("size")).alias("_whole"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs["doc_id"].alias("_id"), row_fp(docs["text"]).alias("_fp"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_fp").orderBy("_fp")))
    out = rows.join(plan, (F.col("_fp") == F.col("_kfp")) & (F.col("_nth") == F.col("_copy")) & F.col("_id").eqNullSafe(F.col("_kid")))
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = out.withColumn("_words", F.when(~F.col("_whole"), words)).withColumn(
        "_text", F.when(F.col("_whole"), F.col("_row.text")).otherwise(F.array_join(F.flatten(F.transform(
            "_parts", lambda p: F.slice(F.col("_words"), (p["from_word"] + 1).cast("int"), p["n_words"].cast("int")))), "")))
    return cut.select(*(F.col("_text").alias("text") if c == "text" else
                        F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"_row.{c}").alias(c)
                        for c in docs.columns))


def op1_source_mixing(spark, sf_dir):
    """The mix of all documents, as words taken of each."""
    return mix_taken(documents(spark, sf_dir))


def mixing_stage(spark, docs, sf_dir):
    """Pipeline stage: the mix of its input, as rows of documents."""
    return mix_documents(docs)

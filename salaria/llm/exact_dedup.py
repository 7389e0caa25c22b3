"""Exact deduplication by deterministic block naming.

The whitespace-normalised text is cut into fixed-size blocks. Equal blocks get one
integer name: the position (document, block number) of their smallest occurrence,
found by sorting the blocks into groups; no hash decides whether blocks are equal. (Rows that repeat an id, null ids among
them, are told apart by a 64-bit hash of their text, so two different texts under one id are taken for one row with a
chance of 2**-64 per pair.) Then adjacent
names are paired and the pairs named in the same way, which halves every sequence,
until each document has one name. Documents share a name (of the same level)
exactly when their normalised texts are identical.

Only DataFrame functions. A block or pair that a third of all rows share costs one
partial row per map task in the naming aggregate; the join that hands names back
reads written tables on both sides, so that adaptive execution can split its hot
partitions. Names are a pure function of the data: a re-run task gives them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import documents, parts_by_size, table

BLOCK_BYTES = 8192
#: Every maximal run of these characters that is not already one space.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUN, " ")


def _named(seq: DataFrame, content: list[str], place: list[str], label: str) -> DataFrame:
    """``seq`` with ``name`` for each distinct ``content``: the smallest ``place`` that holds it."""
    at = F.struct(*place)
    shared = table(seq.groupBy(*content).agg(F.min(at).alias("_name"), F.count(F.lit(1)).alias("_n"))
                   .where("_n > 1").drop("_n"), f"{label}-names")
    named = seq.join(shared, content, "left").withColumn("name", F.coalesce("_name", at))
    return named.drop("_name", *content)


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per (doc_id, row key): ``level`` and ``name`` identify its normalised text; ``copies`` counts equal rows.

    Columns: doc_id, fp (row key: tells rows that repeat a doc_id apart), sha (binary
    SHA-256 of the normalised text, not used to compare), level, name, copies.
    """
    norm = docs.select(docs["doc_id"].alias("doc_id"), normalised(docs["text"]).alias("norm"))
    rows = norm.select("doc_id", F.xxhash64("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"),
                       F.col("norm").cast("binary").alias("raw"))
    n = F.greatest(F.lit(1), F.ceil(F.length("raw") / block_bytes).cast("int"))
    cut = rows.withColumn("n", n).select(
        "doc_id", "fp", "sha", "n",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                                 lambda i: F.col("raw").substr(i * block_bytes + 1, F.lit(block_bytes)))).alias("idx", "block"))
    cut = cut.withColumn("sha", F.when(F.col("idx") == 0, F.col("sha")))
    place = ["doc_id", "fp", "idx"]
    seq = table(_named(cut, ["block"], place, "dedup-blocks"), "dedup-level")
    # Whole rows may repeat: copies of a row key are counted here, and collapse at the first pairing.
    counted = seq.groupBy("doc_id", "fp", "n", "idx", "name").agg(F.max("sha").alias("sha"), F.count(F.lit(1)).alias("copies"))
    done, level = [], 0
    while True:
        one = counted if level == 0 else seq
        done.append(one.where("n = 1").select("doc_id", "fp", "sha", F.lit(level).alias("level"), "name", "copies"))
        more = seq.where("n > 1")
        if more.isEmpty():
            break
        level += 1
        copies = F.count(F.when(F.col("idx") == 0, 1)) if level == 1 else F.max("copies")
        none = F.struct(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                        F.lit(0).cast("long").alias("fp"), F.lit(-1).alias("idx"))
        even = F.col("idx") % 2 == 0
        pairs = (
            more.groupBy("doc_id", "fp", ((F.col("n") + 1) / 2).cast("int").alias("n"), F.floor(F.col("idx") / 2).cast("int").alias("_half"))
            .agg(F.max(F.when(even, F.col("name"))).alias("left"), F.max(F.when(~even, F.col("name"))).alias("right"),
                 F.max("sha").alias("sha"), copies.alias("copies"))
            .withColumnRenamed("_half", "idx")
            .withColumn("copies", F.when(F.col("idx") == 0, F.col("copies")))
            .withColumn("right", F.coalesce("right", none)))
        pairs = table(pairs, "dedup-pairs")
        seq = table(_named(pairs, ["left", "right"], place, "dedup-pairs"), "dedup-level")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with its group of equal normalised texts.

    Returns doc_id, keep_id (smallest doc_id of the group; null ids come last),
    group_size, kept (true for one row of the group), text_sha256, row_fp_norm (row key).
    Null texts count as empty and equal each other and texts without words only if
    their normalised forms are equal ("" and " " differ). Repeated rows each count
    and each come out; one of them is kept. An empty table gives an empty result.
    Other columns are ignored, whatever their names.
    """
    with parts_by_size(docs.sparkSession):
        ids = table(identities(docs, block_bytes), "dedup-ids")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id")))
    with parts_by_size(docs.sparkSession):
        groups = table(ids.groupBy("level", "name").agg(smallest.alias("keep"), F.sum("copies").alias("size"),
                                                        F.count(F.lit(1)).alias("rows"))
                       .where("rows > 1").drop("rows"), "dedup-groups")
    out = ids.join(groups, ["level", "name"], "left").withColumn(
        "keep_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.id")))
    out = out.select("doc_id", "keep_id", F.coalesce("size", "copies").alias("group_size"), "fp", "sha",
                     F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"), F.col("fp").alias("row_fp_norm"))


def op9_exact_dedup(spark, sf_dir):
    """Exact groups of all documents."""
    return exact_dedup(documents(spark, sf_dir)).drop("row_fp_norm")


def dedup_stage(spark, docs, sf_dir):
    """Pipeline stage: of equal texts, the row with the smallest doc_id stays, as it is."""
    kept = exact_dedup(docs).where("kept").select("doc_id", F.col("row_fp_norm").alias("norm_fp"))
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs["doc_id"].alias("_id"),
                    F.xxhash64(normalised(docs["text"])).alias("_fp"))
    d = d.join(kept, (d["_fp"] == kept["norm_fp"]) & d["_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    # Rows with one id and one normalised text: one stays (the least text, for a fixed choice).
    one = Window.partitionBy("_id", "_fp").orderBy("_row.text")
    return d.withColumn("_copy", F.row_number().over(one)).where("_copy = 1").select("_row.*")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM n GROUP BY t
)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, n.doc_id = g.keep_id AS kept, g.text_sha256
FROM n JOIN g USING (t)
"""

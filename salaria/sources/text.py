"""Line sources: one row per text line, as the reference's line reader gives.

``spark.read.text`` splits at LF, CR and CRLF, drops a leading UTF-8 BOM and
keeps blank lines, so blank-line counts are exact. Invalid UTF-8 is replaced by
U+FFFD, as Java's decoding of each line does. Files are split across tasks by
``spark.sql.files.maxPartitionBytes`` (uncompressed or splittable codecs). Large files of codecs
that cannot be split (gzip) are read whole, as they must be, but their raw lines are dealt out over
many tasks before anything is done with them. Folders are
read with all their subfolders (names that begin with ``_`` or ``.`` are hidden files, as
everywhere in Spark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.plans import sizing
from salaria.plans.keyjoin import DEFAULT_MAX_BROADCAST_BYTES, ROW_OVERHEAD_BYTES
from salaria.plans.ordering import BEFORE, Stage, running_sums
from salaria.plans.scratch import default_parallelism

#: Text is about so many times as large as its compressed file.
EXPANSION = 4
#: Splits whose line numbers are summed on the driver at most (some 200 bytes each).
MAX_COLLECTED = 50_000
#: Line ids of files that are dealt out are told from the others' by this bit.
_DEALT_BIT = 1 << 62


_ENDINGS: dict[str, list[str]] = {}


def _unsplittable_endings(spark: SparkSession) -> list[str]:
    """File endings of the application's codecs that cannot be split."""
    sc = spark.sparkContext
    known = _ENDINGS.get(sc.applicationId)
    if known is None:
        known = _ENDINGS[sc.applicationId] = _find_endings(sc)
    return known


def _find_endings(sc) -> list[str]:
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    codec_of = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    splittable = jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    codecs = [codec_of.getCodecByClassName(c.getName()) for c in jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)]
    return [c.getDefaultExtension() for c in codecs if c is not None and not splittable.isInstance(c)]


def _to_deal(spark: SparkSession, paths: list[str], text: DataFrame, deal_bytes: int | None) -> tuple[list[str], int]:
    """Files that cannot be split and hold more than ``deal_bytes`` (None: a split) of text; and the bytes of text in them, about."""
    if getattr(spark, "sparkContext", None) is None:
        return [], 0
    endings = tuple(_unsplittable_endings(spark))
    if not any(f.endswith(endings) for f in text.inputFiles()):
        return [], 0
    # The listing's own table: sizes without a call to the store for each file.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    files = files.select(F.col("_metadata.file_path").alias("path"), (F.col("_metadata.file_size") * EXPANSION).alias("bytes"))
    ends = F.lit(False)
    for ending in endings:
        ends = ends | F.col("path").endswith(ending)
    if deal_bytes is None:
        deal_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    found = files.where(ends & (F.col("bytes") > deal_bytes)).collect()
    return [r["path"] for r in found], sum(r["bytes"] for r in found)


def read_lines(spark: SparkSession, path: str | list[str], *, with_line_id: bool = False, with_origin: bool = False,
               deal_bytes: int | None = None) -> DataFrame:
    """Column ``line`` (valid UTF-8), plus a unique ``line_id`` and the line's origin when asked.

    ``line_id`` comes from ``monotonically_increasing_id`` on the scan itself: file
    splits and their row order are fixed, so a retried task gives the same ids. Lines of
    one split are in order; Spark orders splits by size, not by file name. ``with_origin`` adds the file and the
    start of the split (``_file``, ``_start``), from which ``number_lines`` makes ids that follow files and offsets.
    ``deal_bytes``: text from which the lines of a file that cannot be split are dealt out (default: a split's bytes).
    """
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.option("recursiveFileLookup", "true").text(paths)
    cols = [F.make_valid_utf8(F.col("value")).alias(S.LINE)]
    if with_origin:
        cols += [F.col("_metadata.file_path").alias(S.FILE), F.col("_metadata.file_block_start").alias(S.START)]
    deal, size = _to_deal(spark, paths, text, deal_bytes)
    if not deal:
        return text.select(*cols, *([F.monotonically_increasing_id().alias(S.LINE_ID)] if with_line_id else []))
    dealt = F.col("_metadata.file_path").isin(deal)  # prunes the listed files
    split = text.where(~dealt).select(*cols, F.monotonically_increasing_id().alias(S.LINE_ID))
    whole = text.where(dealt).select(*cols, F.monotonically_increasing_id().bitwiseOR(F.lit(_DEALT_BIT)).alias(S.LINE_ID))
    lines = split.unionAll(whole.repartition(sizing.partitions(size, default_parallelism(spark)), S.LINE_ID))
    return lines if with_line_id else lines.drop(S.LINE_ID)


def number_lines(lines: DataFrame, origins: DataFrame, stage: Stage, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 max_collected: int = MAX_COLLECTED) -> DataFrame:
    """``lines`` (with ``line_id`` and origin) with the line's place among all lines, by file name and offset, as ``line_id``.

    Within a split the scan's ids follow the offsets. ``origins`` (the same ids and origins,
    of every line) is summed up to one row per split; running sums over the splits in
    order of file and start give each its first number. So numbers do not depend on how files are
    split, or on how splits are packed into tasks. Up to ``max_collected`` splits are summed on the driver, more by Spark.
    """
    spark = lines.sparkSession
    splits = origins.groupBy(S.FILE, S.START).agg(F.expr(f"min({S.LINE_ID}) as _low"), F.expr(f"max({S.LINE_ID}) - min({S.LINE_ID}) + 1L as _lines"))
    few = splits.limit(max_collected + 1).collect()
    if len(few) <= max_collected:
        first, ahead = [], 0
        for file, start, low, count in sorted(few):
            first.append((file, start, ahead - low))
            ahead += count
        first = F.broadcast(spark.createDataFrame(first, f"{S.FILE} string, {S.START} bigint, _shift bigint"))
    else:
        splits = stage(splits, "line_splits")
        size = splits.agg(F.sum(F.octet_length(S.FILE) + ROW_OVERHEAD_BYTES)).first()[0]
        first = running_sums(splits, [S.FILE, S.START], "_lines", sizing.partitions(size, 1), stage, "line_starts")
        first = first.select(S.FILE, S.START, (F.col(BEFORE) - F.col("_low")).alias("_shift"))
        first = F.broadcast(first) if size <= max_broadcast_bytes else first.hint("merge")
    number = (F.col(S.LINE_ID) + F.col("_shift")).alias(S.LINE_ID)
    return lines.join(first, [S.FILE, S.START]).select(*(number if c == S.LINE_ID else c for c in lines.columns if c not in (S.FILE, S.START)))


def write_lines(lines: DataFrame, path: str, *, compression: str | None = None, by: tuple[str, ...] = ()) -> None:
    """Write a string column as text lines, replacing ``path``; ``by``: other columns, as folders."""
    writer = lines.write.mode("overwrite").partitionBy(*by) if by else lines.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)

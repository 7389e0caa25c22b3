"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

One word of a pair contributes two disjoint chunks, its halves; the other its
positional grams (Qin et al. 2011). One edit lies in one half, so the other half is
kept: at its own place, or shifted by the difference of lengths (0 or 1) if the
edit lies before it. That fixes the place of the only grams that can join, out of
all positional ones; the others are not written. The halves that are left are
again at most one edit apart, so the same step is taken once more inside them: of
their two disjoint quarters one is kept. The join key is a kept half with a kept
quarter, three quarters of the word, which leaves few pairs to verify even where
thousands of words share an ending. Every pair that joins is verified by its exact
edit distance; every pair one edit apart joins, whatever its grams' frequency.

Words are counted with bounded memory inside tasks and summed by Spark; the join,
the choice of forms and the walk to the roots are DataFrame operations.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria.llm.rows import documents, passing_tables, small_batches, table

#: Least code points and occurrences of a word; times a word that a form must occur; one run in DROP loses a letter.
LETTERS, OCCURRENCES, TIMES, DROP = 7, 2, 10, 31
#: Distinct words that a task counts before it hands them on.
MEMORY = 200_000


def runs(text: str, letters: int) -> list[str]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least ``letters`` code points, A-Z lower-cased."""
    return re.findall(f"[a-zÀ-ÿ]{{{letters},}}", text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def misspelt(doc_id: int | None, run: str, drop: int) -> str:
    """``run``, without one code point where ``drop`` divides the checksum of ``<doc_id>:<run>`` (null id: nothing before the colon)."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % drop:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(letters: int, drop: int):
    def out(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # A run below the least length stays below it; one without a letter lost may be of that length.
                for run, n in Counter(runs(text.as_py() or "", letters)).items():
                    word = misspelt(doc_id, run, drop)
                    if len(word) >= letters:
                        words[word] += n
                if len(words) >= MEMORY:
                    yield out(words)
                    words = Counter()
        yield out(words)
    return count


def word_counts(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, drop: int = DROP) -> DataFrame:
    """Words of all texts (``word``, ``n``) of at least ``letters`` code points and ``occurrences`` occurrences.

    A null text has none. Rows that repeat an id, or are equal, count each.
    """
    small_batches(docs.sparkSession)
    words = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(_counts(letters, drop), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _signatures(word: str, shift: int, gram_side: bool) -> Column:
    """Keys of ``word``: as the word of chunks that meets words ``shift`` letters longer, or as the longer word that meets it.

    Each key names length, shift and the kept quarters by their places in the word of chunks. The four
    places of the edit: last, third, second, first quarter.
    """
    w, size = F.col(word), F.char_length(word)
    length = size - shift if gram_side else size  # of the word of chunks
    half = F.floor(length / 2).cast("int")
    early, late = F.floor(half / 2).cast("int"), half + F.floor((length - half) / 2).cast("int")
    moved = F.lit(shift if gram_side else 0)

    def part(start: Column, end: Column, behind: bool) -> Column:
        """Letters from ``start`` to ``end``; ``behind`` the edit all places move by the shift."""
        return F.substring(w, start + 1 + (moved if behind else 0), end - start)

    zero = F.lit(0)
    kept = [
        (part(zero, half, False), part(half, late, False)),
        (part(zero, half, False), part(late, length, True)),
        (part(half, length, True), part(zero, early, False)),
        (part(half, length, True), part(early, half, True)),
    ]
    return F.array(*(F.xxhash64(F.lit(4 * shift + k), length, *pieces) for k, pieces in enumerate(kept)))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of ``words`` (``word``, ``n``; distinct) that differ by one inserted, deleted or replaced code point.

    Returns word, n, near, near_n, each pair in both directions. Words of fewer than
    two letters, whose halves are empty, join by their length alone.
    """
    both = [F.struct(F.lit(s).alias("shift"), _signatures("word", s, side).alias("keys")) for side in (False, True) for s in (0, 1)]

    def side(name: str, keys: list[Column]) -> DataFrame:
        rows = words.select(F.col("word").alias(name), F.col("n").alias(f"{name}_n"), F.explode(F.array(*keys)).alias("s"))
        return rows.select(name, f"{name}_n", F.col("s.shift").alias(f"{name}_shift"), F.explode("s.keys").alias("key"))

    chunks, grams = side("a", both[:2]), side("b", both[2:])
    one_edit = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    pairs = chunks.join(grams, "key").where(((F.col("a_shift") == 1) | (F.col("a") < F.col("b"))) & one_edit)
    pairs = pairs.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))
    ways = F.array(*(F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n"))
                     for x, y in (("a", "b"), ("b", "a"))))
    return pairs.select(F.explode(ways).alias("p")).select("p.*")


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Each of ``words`` (``word``, ``n``) with its form and root.

    Returns word, n, n_near (words one edit apart), form (of these the one of largest n, ties: the smallest
    in code-point order; null unless that n is at least ``times`` the word's), form_n, root (the last form on
    the way from form to form; the word itself if it has none). ``times`` above 1 rules out circles. An empty
    table gives an empty result; other columns are ignored.
    """
    if times <= 1:
        raise ValueError("times must be above 1: forms could run in circles")
    words = table(words.select("word", "n"), "variant-words")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    strong = -F.col("best.less") >= times * F.col("n")
    forms = table(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "variant-forms")
    # Each step doubles the way; a word's n grows at least times-fold on each form, so there are few.
    with passing_tables(words.sparkSession, "variant-roots") as passing:
        ways = passing(forms.where("form is not null").select("word", F.col("form").alias("root")), "ways")
        while True:
            further = ways.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
            step = passing(ways.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("went")), "ways")
            ways = step.select("word", "root")
            if not step.where("went").limit(1).count():
                break
        roots = table(ways, "variant-roots")
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir):
    """Words of all documents with the form each may be misspelt from."""
    return spelling_variants(word_counts(documents(spark, sf_dir)))

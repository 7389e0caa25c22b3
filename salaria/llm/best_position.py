"""Ranked lexical search by the Best Position Algorithm.

Documents are read once for each block of items: every task notes, for each text, its
number of terms and how often the block's terms occur in it. Document frequencies and
lengths are summed by Spark. The written postings are then searched split by split:
a task holds impact lists (documents of a term by falling impact) of a bounded number
of postings, and ranks them for every item with the Best Position Algorithm (Akbarinia,
Pacitti, Valduriez 2007):

* sorted access reads each list on from its best position, the last one up to which
  every position has been seen;
* a document met anywhere is looked up in all other lists of the item (direct access),
  which also marks its positions there as seen and moves best positions on;
* a document not yet seen lies behind all best positions, so the weighted sum of the
  impacts there bounds its score. The search ends when that is strictly below the k-th
  best score: at equality a smaller doc_id could still be found.

Every split gives its k best per item; a window, whose group limit runs before the
shuffle too, ranks them. Impacts and scores are 64-bit integers, so results are exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import documents, small_batches, table

#: Results per item; bytes of item texts in a block (about); postings that a task searches at a time; first step of sorted access.
K, BLOCK_BYTES, POSTINGS, STEP = 50, 8 << 20, 2_000_000, 32
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")


def count_terms(text: bytes | None, piece: int = PIECE) -> Counter:
    """Terms of a whole UTF-8 text: maximal runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased."""
    data = (text or b"").lower()  # of bytes: A-Z only
    if len(data) <= piece:
        return Counter(_TERM.findall(data))
    terms: Counter = Counter()
    at = 0
    while at < len(data):
        cut = _OTHER.search(data, at + piece)
        end = cut.start() if cut else len(data)
        terms.update(_TERM.findall(data, at, end))
        at = end
    return terms


def _postings(numbers: dict[bytes, int]):
    known = numbers.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = count_terms(text.as_py())
                if not found:
                    continue
                ids.append(doc_id)
                sizes.append(found.total())
                for term in known & found.keys():
                    terms.append(numbers[term])
                    counts.append(found[term])
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "tfs"])
    return run


class ImpactLists:
    """Impact lists over documents 0 to ``docs`` - 1, whose order breaks ties."""

    def __init__(self, docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int):
        """One posting per (``term``, ``doc``), in any order; ``terms``: number of terms."""
        self.docs = docs
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=terms))])
        by_impact = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        by_doc = np.lexsort((self.doc, term[by_impact]))  # the same postings by document, for direct access
        self.known, self.place = self.doc[by_doc], by_doc - np.repeat(self.ends[:-1], np.diff(self.ends))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, step: int = STEP) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, document) of score above 0, ties to the smaller document, for ``terms`` of
        positive ``weights``; and the number of documents looked up."""
        lists = [(int(w), *(x[self.ends[t]:self.ends[t + 1]] for x in (self.doc, self.impact, self.known, self.place)))
                 for t, w in zip(terms, weights) if self.ends[t + 1] > self.ends[t]]
        marks = [np.zeros(len(docs), bool) for _, docs, *_ in lists]
        best = [0] * len(lists)  # positions of a list that are seen without a gap
        seen = np.zeros(self.docs, bool)
        top_score, top_doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
        looked_up = 0
        while any(b < len(m) for b, m in zip(best, marks)):
            fresh = np.unique(np.concatenate([docs[b:b + step] for b, (_, docs, *_) in zip(best, lists)]))
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            looked_up += len(fresh)
            score = np.zeros(len(fresh), np.int64)
            bound = 0
            for i, (weight, _, impact, known, place) in enumerate(lists):
                at = np.searchsorted(known, fresh)
                hit = known[np.minimum(at, len(known) - 1)] == fresh
                places = place[at[hit]]
                score[hit] += weight * impact[places]
                marks[i][places] = True
                gap = int(np.argmin(marks[i][best[i]:])) if best[i] < len(marks[i]) else 0
                best[i] = best[i] + gap if best[i] < len(marks[i]) and not marks[i][best[i] + gap] else len(marks[i])
                if best[i] < len(marks[i]):
                    bound += weight * int(impact[best[i] - 1])
            top_score, top_doc = np.concatenate([top_score, score]), np.concatenate([top_doc, fresh])
            order = np.lexsort((top_doc, -top_score))[:k]
            top_score, top_doc = top_score[order], top_doc[order]
            if len(top_doc) == k and bound < top_score[-1]:
                break
            step *= 2
        return [(int(s), int(d)) for s, d in zip(top_score, top_doc) if s > 0], looked_up


def _search(items: list[tuple[int, np.ndarray]], weights: np.ndarray, k: int, postings: int):
    """Rank split by split. ``items``: id and term numbers; ``weights``: of all terms."""
    items = [(item, terms[weights[terms] > 0]) for item, terms in items]

    def ranked(parts: list[tuple]) -> pa.RecordBatch:
        ids = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        m, sizes, term, tf = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        # Documents by ascending id, nulls last: their order breaks ties.
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        doc = np.repeat(number, sizes)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes))
        lists = ImpactLists(len(order), term, doc, impact, len(weights))
        found = [(item, d, s) for item, terms in items for s, d in lists.best(terms, weights[terms], k)[0]]
        item, d, score = (np.array([f[i] for f in found], np.int64) for i in range(3))
        return pa.RecordBatch.from_arrays([pa.array(item), ids.take(pa.array(order[d])), pa.array(score)], ["item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            parts.append((batch.column(0), batch.column(1).to_numpy(), terms.value_lengths().to_numpy(),
                          terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)))
            held += len(parts[-1][3])
            if held >= postings:
                yield ranked(parts)
                parts, held = [], 0
        if parts:
            yield ranked(parts)
    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, postings: int = POSTINGS) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id, score (above 0); equal scores by
    ascending doc_id, null ids last. Weights and impacts are those of op12's contract
    over all of ``docs``. Null and empty texts, and texts without a term, have no score
    and count nowhere. Rows that repeat an id are documents of their own. Items without id take no part; the terms
    of items that repeat an id are taken together. Empty tables give an empty result; other
    columns are ignored. ``items`` is worked on in blocks of about ``block_bytes`` of text, chosen by a hash of the
    id: a block's terms are held by the driver and every task, and each block reads ``docs`` once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("binary").alias("text")).where("item_id is not null and text is not null")
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    found = None
    for block in range(blocks):
        own: dict[int, set[bytes]] = {}
        for item, text in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            own.setdefault(item, set()).update(count_terms(bytes(text)))
        numbers = {term: i for i, term in enumerate(sorted(set().union(*own.values())))}
        held = table(rows.mapInArrow(_postings(numbers), "doc_id long, n long, terms array<int>, tfs array<int>"), "lexical-postings")
        total, length = held.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(numbers), np.int64)
        for term, n in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = n
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)
        m = F.expr(f"100 - 50 + ((50L * n * {total}L) div {length or 1}L)")
        search = _search([(item, np.array(sorted(numbers[t] for t in terms), np.int64)) for item, terms in sorted(own.items())], weights, k, postings)
        part = held.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs").mapInArrow(search, "item_id long, doc_id long, score long")
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_best_position_search(spark, sf_dir):
    """The 50 best of all documents for every benchmark item."""
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
f AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM p
  WHERE term IN (SELECT term FROM q) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term
), i AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))) AS impact FROM f, s
), c AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM q JOIN i USING (term) JOIN w USING (term) GROUP BY item_id, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM c WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= {K}
"""

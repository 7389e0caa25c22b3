"""N-gram Jaccard self-join by a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns are distinct five-word
shingles. The matrix is held in sparse blocks: a row block is a run of documents
of one task, a column block a range of shingle keys.

1. Each task packs its documents' sorted keys into one blob per column block.
2. Per column block the occurrences of every column are counted over all
   documents. Columns that one document alone has cannot add to any product; the
   others go back to their row blocks with their (coarse logarithmic) count.
3. Per document, the size bound: two documents with similarity 0.8 or more share
   at least ceil(0.8 n) shingles of each, so they share one of the first
   n - ceil(0.8 n) + 1 columns in any order common to all documents. The order is
   rarest first; for most documents these are columns of their own, and they are
   done: no pair of theirs can reach the bound.
4. Pairs that meet in such a column are candidates, unless the bounds rule them out: two rows of a and b entries need
   ceil(4 (a + b) / 9) in common, and from place i on a row of a entries has a - i
   left. Rows meet by column and by band of size, so most pairs that the bounds rule
   out are never formed. Documents with equal sets are one row throughout.
5. Candidates get their overlap from products of sparse blocks: the candidates' rows are dealt to row blocks, and for each pair of
   row blocks that has candidates, the rows that occur in them are brought together once, however many pairs they are in. The product
   is accumulated column block by column block; after each, pairs whose count cannot reach the bound any more are
   discarded, and rows without a pair left take no further part.

Pairs within a group are not all needed for its component: each column first
compares its rows with one pivot, the row with the fewest rare columns before it
(the one nearest to the others), then only rows of different components are
compared. No pair that could join two components is skipped.

Hot columns: a column with more than ``LOCAL_ROWS`` rows in one row block is sent as
a count alone, its rows stay with their row block.

Keys are 48-bit hashes. An accidental hit of two shingles adds one to a count or an
overlap; between two documents of 500 shingles its chance is about 1e-9.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria.llm.components import components
from salaria.llm.rows import documents, parts_by_size, passing_tables, pick_rows, release_memory, row_fp, settled, small_batches, table

WORDS = 5
KEY_BITS = 48
#: Keys of a row block, rows of one column that a row block sends on, characters per column block.
BLOCK_KEYS, LOCAL_ROWS, COLUMN_CHARS = 1_000_000, 64, 8_000_000
#: Pivot rounds go on while the open pairs outnumber this many times the entries, and get fewer.
OPEN_PAIRS = 1
#: Rows of a row block of the product (about), and products of entries that are held at a time.
BLOCK_ROWS, PRODUCT_ENTRIES = 1000, 4_000_000
#: Sizes of one band differ by this factor at most.
BAND = 1.12

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_keys(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit keys of the five-word shingles (A-Z lowered); fewer words: one key for all of them; none: none."""
    words = (text or "").encode().lower().split()  # bytes.split: space and 09-0D
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    width = min(WORDS, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = (out ^ h[j:len(h) - width + 1 + j]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bound(n):
    """Columns of a document of ``n`` shingles that must be looked at: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


def pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _delta(keys: np.ndarray) -> tuple[int, bytes]:
    """Sorted keys as first key and 32-bit steps, or whole where a step is too wide."""
    if not len(keys):
        return 0, b""
    steps = np.diff(keys, prepend=keys[:1])
    return (int(keys[0]), steps.astype("<u4").tobytes()) if steps.max() < 1 << 32 else (-1, keys.astype("<u8").tobytes())


def _undelta(first: int, raw: bytes) -> np.ndarray:
    if first < 0:
        return np.frombuffer(raw, "<u8")
    return np.cumsum(np.frombuffer(raw, "<u4"), dtype=np.uint64) + np.uint64(first)


def _row_blocks(bits: int):
    """Documents to packed blocks: (col, block, own, blob)."""
    def flush(docs: list, block: int):
        ids, fps, ns, sids, keys = zip(*docs)
        count = np.array([len(k) for k in keys], np.int64)
        flat, row = np.concatenate(keys), np.repeat(np.arange(len(docs), dtype=np.uint16), count)
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        uniq, local = np.unique(flat, return_counts=True)
        hot = np.repeat(local > LOCAL_ROWS, local)
        hot_keys, hot_counts = uniq[local > LOCAL_ROWS], local[local > LOCAL_ROWS]
        own = pickle.dumps((ids, fps, np.array(ns, np.int64), count, sids, flat[hot], row[hot]), protocol=5)
        out = [(xxhash.xxh3_64_intdigest(block.to_bytes(8, "little")) % (1 << bits), block, True, own)]
        flat, row = flat[~hot], row[~hot]
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(KEY_BITS - bits)
        for c, (k, r, hk, hc) in enumerate(zip(*(np.split(x, np.searchsorted(by, edges)) for x, by in (
                (flat, flat), (row, flat), (hot_keys, hot_keys), (hot_counts, hot_keys))))):
            if len(k) or len(hk):
                out.append((c, block, False, pickle.dumps((*_delta(k), r.tobytes(), hk.tobytes(), hc.astype("<i8").tobytes()), protocol=5)))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.bool_(), pa.binary()))],
                                          names=["col", "block", "own", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            for doc_id, fp, text in zip(*(c.to_pylist() for c in batch.columns)):
                keys = shingle_keys(text)
                n, keys = len(keys), np.unique(keys >> np.uint64(64 - KEY_BITS))
                held.append((doc_id, fp, n, xxhash.xxh3_128_digest(keys.tobytes() + n.to_bytes(8, "little")), keys))
                size += n
                if size >= BLOCK_KEYS or len(held) == 1 << 16:
                    yield flush(held, block)
                    block, held, size = block + 1, [], 0
        if held:
            yield flush(held, block)
        held.clear()
        release_memory()
    return run


def _column_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of the columns of one range; per row block, its entries in columns that others share."""
    passed = pdf[pdf.own]
    parts = [pickle.loads(b) for b in pdf.blob[~pdf.own]]
    keys = [_undelta(p[0], p[1]) for p in parts]
    hot = [np.frombuffer(p[3], "<u8") for p in parts]
    every = np.concatenate([*keys, *hot, np.empty(0, np.uint64)])
    counts = np.concatenate([np.ones(sum(map(len, keys)), np.int64), *(np.frombuffer(p[4], "<i8") for p in parts)])
    uniq, inverse = np.unique(every, return_inverse=True)
    df = np.bincount(inverse, weights=counts, minlength=len(uniq))
    # Any function of the column's count orders the columns alike for all documents.
    grade = np.minimum(255, np.floor(8 * np.log2(np.maximum(df, 1)))).astype(np.uint8)
    blobs = []
    for p, k, h in zip(parts, keys, hot):
        g, gh = grade[np.searchsorted(uniq, k)], grade[np.searchsorted(uniq, h)]
        some = g > 0
        blobs.append(pickle.dumps((pack(k[some]), np.frombuffer(p[2], np.uint16)[some].tobytes(), g[some].tobytes(),
                                   h.tobytes(), gh.tobytes()), protocol=5))
    return pd.DataFrame({"block": [*passed.block, *pdf.block[~pdf.own]], "own": [True] * len(passed) + [False] * len(parts),
                         "blob": [*passed.blob, *blobs]})


def _bounded_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Documents of one row block, with the shared columns under the size bound and all shared keys."""
    ids, fps, n, count, sids, hot_keys, hot_rows = pickle.loads(pdf.blob[pdf.own].iloc[0])
    parts = [pickle.loads(b) for b in pdf.blob[~pdf.own]]
    known = np.concatenate([*(np.frombuffer(p[3], "<u8") for p in parts), np.empty(0, np.uint64)])
    graded = np.concatenate([*(np.frombuffer(p[4], np.uint8) for p in parts), np.empty(0, np.uint8)])
    by = np.argsort(known)
    hot_grade = graded[by][np.searchsorted(known[by], hot_keys)] if len(hot_keys) else np.empty(0, np.uint8)
    keys = np.concatenate([*(unpack(p[0]) for p in parts), hot_keys])
    row = np.concatenate([*(np.frombuffer(p[1], np.uint16) for p in parts), hot_rows]).astype(np.int64)
    grade = np.concatenate([*(np.frombuffer(p[2], np.uint8) for p in parts), hot_grade])
    order = np.lexsort((keys, grade, row))
    keys, row = keys[order], row[order]
    shared = np.bincount(row, minlength=len(ids))
    start = np.concatenate([[0], np.cumsum(shared)])
    place = (count - shared)[row] + np.arange(len(row)) - start[row]
    first = place < np.where(n > 0, bound(n), 0)[row]
    taken = np.bincount(row[first], minlength=len(ids))
    alone = count - shared
    prefix, packed = [], []
    for i in range(len(ids)):
        own = keys[start[i]:start[i + 1]]
        prefix.append(own[:taken[i]].astype(np.int64) if taken[i] else None)
        packed.append(pack(np.sort(own)) if taken[i] else None)
    release_memory()
    return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "row_fp": fps, "n_shingles": n, "sid": sids,
                         "alone": alone, "prefix": prefix, "shared_keys": packed})


class _Side:
    """The rows of one side of a product: their entries by key, and how many entries each has left."""

    def __init__(self, rows: pd.DataFrame):
        self.sid = {sid: k for k, sid in enumerate(rows.sid)}
        self.n = rows.n.to_numpy(np.int64)
        keys = [unpack(k) for k in rows.shared_keys]
        self.left = np.array([len(k) for k in keys], np.int64)
        flat, row = np.concatenate(keys), np.repeat(np.arange(len(keys)), self.left)
        order = np.argsort(flat, kind="stable")
        self.key, self.row = flat[order], row[order]


def overlaps(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, entries: int) -> np.ndarray:
    """Entries common to rows ``i`` of ``a`` and ``j`` of ``b``, pair by pair; -1 for pairs found to be under the bound.

    The product of the two blocks, summed up over column blocks of at most about ``entries`` products of entries.
    """
    need = -(-4 * (a.n[i] + b.n[j]) // 9)
    pair = np.full((len(a.n), len(b.n)), -1, np.int64)
    pair[i, j] = np.arange(len(i))
    count, live = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    left_a, left_b = a.left.copy(), b.left.copy()
    # Columns of both sides, and the products of entries that each takes.
    columns = np.intersect1d(a.key, b.key)
    first_a, end_a = (np.searchsorted(a.key, columns, side) for side in ("left", "right"))
    first_b, end_b = (np.searchsorted(b.key, columns, side) for side in ("left", "right"))
    work = np.cumsum((end_a - first_a) * (end_b - first_b))
    at = 0
    while at < len(columns) and live.any():
        stop = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + entries, "right")))
        rows_a = np.zeros(len(a.n), bool)
        rows_a[i[live]] = True
        rows_b = np.zeros(len(b.n), bool)
        rows_b[j[live]] = True
        for k in _runs(first_a[at:stop], end_a[at:stop], first_b[at:stop], end_b[at:stop], entries):
            x, y = a.row[k[0]], b.row[k[1]]
            some = rows_a[x] & rows_b[y]
            found = pair[x[some], y[some]]
            count += np.bincount(found[found >= 0], minlength=len(i))
        # What is left of a row: its entries in columns beyond this block.
        last = columns[stop - 1]
        for side, left in ((a, left_a), (b, left_b)):
            left[:] = np.bincount(side.row[np.searchsorted(side.key, last, "right"):], minlength=len(left))
        live &= count + np.minimum(left_a[i], left_b[j]) >= need
        at = stop
    return np.where(live & (count >= need), count, -1)


def _runs(first_a, end_a, first_b, end_b, entries: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the entries of both sides that meet in the columns given, at most about ``entries`` pairs of them at a time."""
    wide_a, wide_b = end_a - first_a, end_b - first_b
    size = wide_a * wide_b
    for k in np.flatnonzero(size > entries):  # a column of very many rows, some of its rows of one side at a time
        step = max(1, entries // int(wide_b[k]))
        for low in range(int(first_a[k]), int(end_a[k]), step):
            own = np.arange(low, min(low + step, int(end_a[k])))
            yield np.repeat(own, wide_b[k]), np.tile(np.arange(first_b[k], end_b[k]), len(own))
    small = np.flatnonzero(size <= entries)
    if len(small):
        size, wide = size[small], wide_b[small]
        nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(wide, size)
        yield np.repeat(first_a[small], size) + nth // wide, np.repeat(first_b[small], size) + nth % wide


def _product(rows: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Of the candidate ``pairs`` of two row blocks, those that link, with their overlap. ``rows``: the rows in them, by side."""
    out = pd.DataFrame({"a": [], "b": [], "both": []}).astype({"both": "int64"})
    if not len(pairs):
        return out
    a, b = (_Side(rows[rows.side == side]) for side in (0, 1))
    i, j = (np.array([side.sid[s] for s in pairs[c]]) for side, c in ((a, "a"), (b, "b")))
    both = overlaps(a, b, i, j, PRODUCT_ENTRIES)
    linked = 5 * both >= 4 * (a.n[i] + b.n[j] - both)
    linked &= both >= 0
    release_memory()
    return pd.DataFrame({"a": pairs.a[linked], "b": pairs.b[linked], "both": both[linked]})


def shingle_rows(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: doc_id, row_fp, n_shingles, sid (its shingle set's 128-bit identity), alone
    (columns that it alone has), prefix and shared_keys (null where no other document can reach the bound). Written to the checkpoint folder."""
    small_batches(docs.sparkSession)
    docs = settled(docs.select("doc_id", "text"), "join-docs")
    chars = docs.select(F.length(docs["text"]).alias("n")).agg(F.sum("n")).first()[0] or 0
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4, chars // COLUMN_CHARS, 1)
    bits = min(24, math.ceil(math.log2(width)))
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_fp(docs["text"]).alias("fp"), docs["text"].alias("text"))
    blocks = src.mapInArrow(_row_blocks(bits), "col int, block long, own boolean, blob binary")
    counted = blocks.groupBy("col").applyInPandas(_column_block, "block long, own boolean, blob binary")
    rows = counted.groupBy("block").applyInPandas(
        _bounded_rows, "doc_id long, row_fp long, n_shingles long, sid binary, alone long, prefix array<long>, shared_keys binary")
    return table(rows, "join-rows")


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(BAND)).cast("int")


def _entries(sets: DataFrame) -> DataFrame:
    """Columns under the size bound: key, band, sid, n, place, small.

    A row stands in every band of sizes that a partner no larger than itself can have,
    with this column as their first common one; ``small``: it can itself be that partner.
    """
    e = sets.select("sid", "n", "alone", F.posexplode("prefix").alias("k", "key")).withColumn("place", F.col("alone") + F.col("k"))
    n, least = F.col("n"), F.expr("(4 * n + 4) div 5")
    most = F.least(n, F.expr("(9 * (n - place)) div 4 - n"))
    e = e.withColumn("least", least).withColumn("most", most).where("most >= least")
    e = e.select("key", "sid", "n", "place", F.explode(F.sequence(_band(F.col("least")), _band(F.col("most")))).alias("band"))
    return e.withColumn("small", (F.col("band") == _band(n)) & F.expr("place <= n - (8 * n + 8) div 9"))


def _may_reach(n, i, m, j) -> Column:
    """Rows of n and m entries that first meet at places i and j can share 4 (n + m) / 9 entries."""
    n, i, m, j = map(F.col, (n, i, m, j))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * (n - i) >= 4 * (n + m)) & (9 * (m - j) >= 4 * (n + m))


def _linked(pairs: DataFrame, sets: DataFrame, passing) -> DataFrame:
    """Of the pairs (a, b, component_a, component_b), those with similarity 0.8 or more, as components."""
    total, rows = pairs.agg(F.count(F.lit(1)), F.approx_count_distinct("a")).first()
    # As many row blocks as give each about BLOCK_ROWS of the rows that have candidates.
    blocks = max(1, -(-max(rows, 1) // BLOCK_ROWS))

    def block(x: str) -> Column:
        return F.pmod(F.xxhash64(x), F.lit(blocks)).cast("int").alias(f"block_{x}")

    pairs = pairs.select("*", block("a"), block("b"))
    where = ["block_a", "block_b"]
    used = pairs.select(*where, F.explode(F.array(*(F.struct(F.lit(k).alias("side"), F.col(x).alias("sid")) for k, x in enumerate("ab")))).alias("r"))
    used = used.select(*where, "r.side", "r.sid").distinct().join(sets.select("sid", "n", "shared_keys"), "sid")
    candidates = pairs.select(F.col("block_a").alias("of_a"), F.col("block_b").alias("of_b"), "a", "b").groupBy("of_a", "of_b")
    found = used.groupBy(*where).cogroup(candidates).applyInPandas(_product, "a binary, b binary, both long")
    return passing(found.join(pairs, ["a", "b"]).select(F.col("component_a").alias("a"), F.col("component_b").alias("b")), "linked")


def set_components(sets: DataFrame) -> DataFrame:
    """(sid, component) of the distinct sets ``sets`` (sid, n, alone, prefix, shared_keys); sets without a possible partner may be missing."""
    spot = ["key", "band"]
    with passing_tables(sets.sparkSession, "join") as passing:
        exploded = _entries(sets)
        meet = passing(exploded.groupBy(*spot).agg(F.count(F.lit(1)).alias("rows"), F.max("small").alias("small"))
                       .where("rows > 1 and small").select(*spot), "spots")
        entries = passing(exploded.join(meet, spot, "left_semi"), "entries")
        comp = passing(entries.select("sid", F.col("sid").alias("component")).distinct(), "components")

        def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
            to = components(links).select(F.col("node").alias("component"), F.col("component").alias("_to"))
            return passing(comp.join(to, "component", "left").select("sid", F.coalesce("_to", "component").alias("component")), "components")

        left, turn = None, 0
        while True:
            placed = passing(entries.join(comp, "sid"), "placed")
            parts = placed.groupBy(*spot, "component").agg(F.count(F.lit(1)).alias("m"), F.count_if("small").alias("s"))
            open_ = parts.groupBy(*spot).agg(F.sum("m").alias("m"), F.sum("s").alias("s"), F.sum(F.col("m") * F.col("s")).alias("own"))
            open_ = passing(open_.where("m * s > own"), "open")
            pairs, rows = open_.agg(F.coalesce(F.sum(F.col("m") * F.col("s") - F.col("own")), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
            if not pairs:
                return table(comp, "join-components")
            placed = passing(placed.join(open_.select(*spot), spot, "left_semi"), "placed")
            if turn and (pairs <= OPEN_PAIRS * rows or pairs > 0.8 * left):
                break
            # The first pivot is the row nearest to the others; later ones are drawn with a preference for such rows.
            draw = F.shiftrightunsigned(F.xxhash64(F.lit(turn), "sid"), 11) / float(1 << 53)
            rank = F.col("place") * (F.lit(1.0) if turn == 0 else 0.5 + draw)
            left, turn = pairs, turn + 1
            pivots = placed.where("small").groupBy(*spot).agg(F.min(F.struct(
                rank.alias("rank"), draw.alias("draw"), F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"),
                F.col("component").alias("component_b"))).alias("p"))
            pivots = passing(pivots.select(*spot, "p.b", "p.n_b", "p.place_b", "p.component_b"), "pivots")
            pairs = (placed.join(pivots, spot).where(F.col("component") != F.col("component_b")).where(_may_reach("n", "place", "n_b", "place_b"))
                     .select(F.col("sid").alias("a"), "b", F.col("component").alias("component_a"), "component_b").distinct())
            comp = merged(comp, _linked(passing(pairs, "pairs"), sets, passing))
        # Every pair of rows of different components that may reach the bound.
        groups = passing(parts.join(open_.select(*spot), spot, "left_semi"), "groups")
        both = groups.select(*spot, F.col("component").alias("component_a")).join(
            groups.where("s > 0").select(*spot, F.col("component").alias("component_b")), spot).where("component_a <> component_b")
        a = placed.select(*spot, F.col("component").alias("component_a"), F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("place_a"))
        b = placed.where("small").select(*spot, F.col("component").alias("component_b"), F.col("sid").alias("b"), F.col("n").alias("n_b"),
                                         F.col("place").alias("place_b"))
        pairs = (both.join(a, [*spot, "component_a"]).join(b, [*spot, "component_b"])
                 .where("n_a > n_b or n_a = n_b and a > b").where(_may_reach("n_a", "place_a", "n_b", "place_b"))
                 .select("a", "b", "component_a", "component_b").distinct())
        return table(merged(comp, _linked(passing(pairs, "pairs"), sets, passing)), "join-components")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with n_shingles and component_id (smallest doc_id reachable by links of similarity 0.8 or more).

    Returns doc_id, n_shingles, component_id, row_fp (row key). Null and empty texts,
    and texts without words, have no shingles and link with nothing. Equal texts link.
    Repeated rows come out as often as they came in; rows that repeat an id with
    another text are compared by their own text. A null id takes part; its component is
    the smallest id reached, or null. An empty table gives an empty result. Other columns are ignored.
    """
    rows = shingle_rows(docs)
    with parts_by_size(docs.sparkSession):
        by_set = _set_ids(rows)
    out = rows.select("doc_id", "row_fp", "n_shingles", "sid").join(by_set, "sid", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row_fp")


def _named_sets(rows: DataFrame) -> DataFrame:
    """(sid, low, component) of the sets that may have a partner: smallest doc_id of the set, component as its smallest sid. Written."""
    sets = rows.where("prefix is not null").groupBy("sid").agg(
        F.min("doc_id").alias("low"), *(F.any_value(F.col(c)).alias(a) for c, a in (("n_shingles", "n"), ("alone", "alone"), ("prefix", "prefix"), ("shared_keys", "shared_keys"))))
    sets = table(sets, "join-sets")
    comp = set_components(sets)
    named = sets.select("sid", "low").join(comp, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    return table(named, "join-named")


def _set_ids(rows: DataFrame) -> DataFrame:
    """(sid, component_id) of the sets that may have a partner."""
    named = _named_sets(rows)
    lows = table(named.groupBy("component").agg(F.min("low").alias("component_id")), "join-lows")
    return table(named.join(lows, "component").select("sid", "component_id"), "join-ids")


def op10_ngram_jaccard_join(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return jaccard_components(documents(spark, sf_dir)).drop("row_fp")


def near_dup_stage(spark, docs, sf_dir):
    """Pipeline stage: of each component, one row stays: the smallest doc_id (a null one last), then the smallest row key.

    Components are told apart by their sets, not by their smallest id, which rows of
    other texts may repeat. A row without a partner is a component of its own.
    """
    rows = shingle_rows(docs)
    with parts_by_size(docs.sparkSession):
        named = _named_sets(rows)
    found = rows.select("doc_id", "row_fp", "sid").join(named.select("sid", "component"), "sid", "left")
    own = [F.when(F.col("component").isNull(), F.col(c)).alias(f"own_{c}") for c in ("doc_id", "row_fp")]
    first = found.groupBy("component", *own).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_fp")).alias("first"))
    return pick_rows(docs, first.select("first.doc_id", "first.row_fp"))

"""Approximate nearest neighbours by learned partitions.

The way of neural locality-sensitive partitions (Dong et al. 2020): the neighbour graph of a
sample is cut into balanced parts with few cut edges, and a small classifier learns
to tell from a vector the parts in which its neighbours lie. The classifier then deals *every* row
to its most probable part, and routes each query to its most probable parts, whose
rows are reranked by exact cosine.

How many parts a query visits follows from its own probabilities: parts are taken in falling order
until those before hold the mass that was enough, on vectors kept out of the graph and
of training, to meet the wanted share of their true neighbours. Clear queries visit few parts, doubtful ones many.

Only the fit uses a sample (``SAMPLE_ROWS`` at most, drawn by hash; one task). Index and search cover every row: parts are dealt to
units of bounded size (``units``), and a query is sent once to each unit that holds rows of its parts; a large part is many units.
Within a unit work is products of two bounded matrices (``PAGE_ROWS``, ``QUERY_BLOCK``).
Rows of one vector count up to the k + 1 smallest ids, cut before the shuffle: no other can be among k results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from salaria.llm.rows import table
from salaria.llm.units import deal, least_draws, packed, padded, picked, search, sent, unit_rows, units_needed, unpacked

#: Results per query; queries are ids divisible by EVERY (the registered query).
K, EVERY = 5, 50
#: Parts: least and most, and rows of one aimed at between them.
PARTS, PART_ROWS = (32, 256), 65_536
#: Fit: rows at most, rows per part at least, neighbours in the graph, hidden units, passes, share of true neighbours to meet.
SAMPLE_ROWS, SAMPLE_PER_PART, GRAPH_K, HIDDEN, EPOCHS, RECALL = 16_384, 64, 10, 128, 8, 0.98
#: Rows of a page and queries of a block (about).
PAGE_ROWS, QUERY_BLOCK = 2048, 1024
#: Scores of a matrix product this far below the k-th best are still computed exactly.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """The vector as doubles; null where it is null, zero, or holds null or non-finite components."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(doubles, lambda x: x != 0), doubles)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows as doubles, each scaled by a power of two (exactly; cosines stay the same) so that squares neither overflow nor vanish."""
    rows = rows.astype(float)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0))[1][:, None]) if len(rows) else rows


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def neighbours(queries: np.ndarray, rows: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places of the ``k`` nearest of ``rows`` (unit vectors) to each query; ``own``: queries are the rows themselves."""
    out = np.empty((len(queries), k), np.int64)
    for start in range(0, len(queries), 1024):
        near = queries[start:start + 1024] @ rows.T
        if own:
            near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        out[start:start + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, sweeps: int = 15, slack: float = 1.05) -> np.ndarray:
    """Part of each vertex of a neighbour graph (places of neighbours, one row a vertex); none holds more than ``slack`` times the mean.

    Vertices in breadth-first order are cut into equal runs; then sweeps move vertices, largest gain first, to the
    part of most of their neighbours, as long as there is room.
    """
    n, k = graph.shape
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    ends = np.searchsorted(a, np.arange(n + 1))
    met, walk = np.zeros(n, bool), []
    for start in range(n):
        front = [] if met[start] else [start]
        met[start] = True
        while front:
            walk += front
            beyond = []
            for v in front:
                for w in b[ends[v]:ends[v + 1]]:
                    if not met[w]:
                        met[w] = True
                        beyond.append(w)
            front = beyond
    part = np.empty(n, np.int64)
    part[walk] = np.arange(n) * parts // n
    room = int(np.ceil(slack * n / parts)) - np.bincount(part, minlength=parts)
    for _ in range(sweeps):
        of_part = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        to = of_part.argmax(axis=1)
        gain = of_part[np.arange(n), to] - of_part[np.arange(n), part]
        moved = 0
        for v in np.argsort(-gain, kind="stable")[:np.count_nonzero(gain > 0)]:
            if room[to[v]] > 0:
                room[part[v]] += 1
                room[to[v]] -= 1
                part[v] = to[v]
                moved += 1
        if not moved:
            break
    return part


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Router:
    """A classifier of one hidden layer over unit vectors, and the mass of probability to visit."""

    weights: list[np.ndarray]
    mass: float = 1.0

    @property
    def parts(self) -> int:
        return len(self.weights[3])

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return _softmax(np.maximum(0, rows * np.sqrt(rows.shape[1]) @ w1 + b1) @ w2 + b2)

    def before(self, rows: np.ndarray) -> np.ndarray:
        """Per row and part, the probability of the parts ahead of it in falling order."""
        p = self.probabilities(rows)
        order = np.argsort(-p, axis=1, kind="stable")
        falling = np.take_along_axis(p, order, 1)
        out = np.empty_like(p)
        np.put_along_axis(out, order, np.cumsum(falling, axis=1) - falling, 1)
        return out

    def visits(self, rows: np.ndarray) -> np.ndarray:
        """Which parts each query visits."""
        return self.before(rows) <= self.mass


def train(rows: np.ndarray, target: np.ndarray, hidden: int, epochs: int, seed: int = 0, rate: float = 2e-3, decay: float = 1e-3, batch: int = 256) -> Router:
    """Cross-entropy to ``target`` (a distribution over parts per row) by Adam."""
    rng = np.random.default_rng(seed)
    width, parts = rows.shape[1], target.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            at = order[start:start + batch]
            x = rows[at] * np.sqrt(width)
            h = np.maximum(0, x @ weights[0] + weights[1])
            error = (_softmax(h @ weights[2] + weights[3]) - target[at]) / len(at)
            back = (error @ weights[2].T) * (h > 0)
            slopes = [x.T @ back + decay * weights[0], back.sum(axis=0), h.T @ error + decay * weights[2], error.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Router(weights)


def fit_router(rows: np.ndarray, parts: int, k: int = K, recall: float = RECALL, seed: int = 0) -> Router:
    """Graph, balanced parts, classifier and mass from a sample of unit vectors. One eighth is kept out for the mass."""
    out = np.random.default_rng(seed).permutation(len(rows))
    held, kept = rows[out[:len(rows) // 8]], rows[out[len(rows) // 8:]]
    if parts < 2 or len(held) < 1 or len(kept) <= max(GRAPH_K, k):
        return Router([np.zeros((rows.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    graph = neighbours(kept, kept, GRAPH_K, own=True)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(kept), parts))
    np.add.at(target, (np.repeat(np.arange(len(kept)), GRAPH_K), part[graph].ravel()), 1 / (GRAPH_K + 1))
    target[np.arange(len(kept)), part] += 1 / (GRAPH_K + 1)
    router = train(kept, target, HIDDEN, EPOCHS, seed)
    true = neighbours(held, kept, k, own=False)
    dealt = router.probabilities(kept).argmax(axis=1)
    needed = np.take_along_axis(router.before(held), dealt[true], 1)
    router.mass = float(np.quantile(needed, recall, method="higher"))
    return router


def _fit(width: int, parts: int, k: int, recall: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches)).sort_by([("draw", "ascending"), ("vec_id", "ascending")])
        rows = unit(scaled(padded(found["x"].combine_chunks(), width)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_router(rows, parts, k, recall))], pa.binary())], ["router"])
    return run


def _deal(router: Router, width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = padded(batch.column("x"), width)
            part = router.probabilities(unit(scaled(rows))).argmax(axis=1) if len(rows) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column("vec_id"), packed(rows.astype(kind))], ["grp", "vec_id", "x"])
    return run


def _route(router: Router, width: int, kind: str, first: np.ndarray, number: np.ndarray):
    """Queries, once for each unit that holds rows of their parts, with all parts to visit (as bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = padded(batch.column("x"), width)
            visits = router.visits(unit(scaled(rows))) if len(rows) else np.zeros((0, router.parts), bool)
            likely, ids, x, bits = pa.array(visits.argmax(axis=1), pa.int32()), batch.column("vec_id"), packed(rows.astype(kind)), packed(np.packbits(visits, axis=1))
            for at in range(0, len(rows), 1024):
                columns = {"grp": likely, "vec_id": ids, "x": x, "parts": bits}
                yield from sent(units_needed(visits[at:at + 1024], first, number), {c: v.slice(at, 1024) for c, v in columns.items()})
    return run


@dataclass
class Page:
    """Rows of one part: their doubles, lengths, and the rows over them."""

    part: int
    ids: np.ndarray
    rows: np.ndarray
    norms: np.ndarray
    units: np.ndarray


def _pages(width: int, kind: str, page_rows: int):
    def build(held: pa.Table) -> list[Page]:
        part, ids = (held[c].to_numpy() for c in ("grp", "vec_id"))
        rows = scaled(unpacked(held["x"].combine_chunks(), width, kind))
        norms = np.sqrt((rows * rows).sum(axis=1))
        units = rows / norms[:, None]
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        places = [slice(at, min(at + page_rows, b)) for a, b in zip(cuts, cuts[1:]) for at in range(a, b, page_rows)]
        return [Page(int(part[p.start]), ids[p], rows[p], norms[p], units[p]) for p in places]
    return build


def rerank(query_ids: np.ndarray, queries: np.ndarray, norms: np.ndarray, page: Page, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of the rows of ``page`` that can be among the k best per query by cosine, without rows of the query's own id.

    A matrix product finds them; their score is then computed
    pair by pair, so that it does not depend on the block it was found in.
    """
    near = (queries / norms[:, None]) @ page.units.T
    near[query_ids[:, None] == page.ids[None]] = -np.inf
    kth = np.partition(near, len(page.ids) - k, axis=1)[:, len(page.ids) - k] if len(page.ids) > k else np.full(len(query_ids), -2.0)
    q, r = np.nonzero(near >= np.maximum(kth, -2.0)[:, None] - SLACK)
    q, r, score = best(q, page.ids[r], (queries[q] * page.rows[r]).sum(axis=1) / (norms[q] * page.norms[r]), k)
    return q, r, score


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k rows of largest score per query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[top], ids[top], score[top]


def _search(width: int, kind: str, parts: int, k: int):
    def answer(pages: list[Page], asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = asked.column("vec_id").to_numpy()
        queries = scaled(unpacked(asked.column("x"), width, kind))
        norms = np.sqrt((queries * queries).sum(axis=1))
        visits = np.unpackbits(unpacked(asked.column("parts"), -(-parts // 8), np.uint8), axis=1).astype(bool)
        for at in range(0, len(ids), QUERY_BLOCK):
            found = []
            for page in pages:
                who = at + np.flatnonzero(visits[at:at + QUERY_BLOCK, page.part])
                if len(who):
                    q, near, score = rerank(ids[who], queries[who], norms[who], page, k)
                    found.append((who[q], near, score))
            if found:
                q, near, score = best(*(np.concatenate(x) for x in zip(*found)), k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(near), pa.array(score)], ["query_id", "vec_id", "score"])
    return answer


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, parts: int | None = None, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS,
            page_rows: int = PAGE_ROWS) -> DataFrame:
    """Nearly always the ``k`` rows of ``vectors`` of largest cosine with each row of ``queries``, but for rows of the same id.

    Both have vec_id and embedding. Returns query_id, rank (from 1), vec_id, score (exact), nearest first, ties to
    the smaller vec_id. ``recall``: share of true neighbours that the visited parts should hold, set on held-out rows of
    the sample; 1.0 visits all that it took there. ``parts``: by default from the rows (``PARTS``, ``PART_ROWS``). Null ids and vectors that are null, zero or hold null or non-finite components take no part;
    a shorter vector ends in zeros. Rows that repeat id and vector count once; of queries that repeat an id the one of
    smallest vector counts. Up to about a hundred rows there is one part and the search is exact. Empty tables give an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        out = df.select(df["vec_id"].cast("long").alias("vec_id"), usable(df["embedding"]).alias("x"))
        return out.where("vec_id is not null and x is not null")

    same = Window.partitionBy("x").orderBy("vec_id")
    rows = clean(vectors).distinct().withColumn("_place", F.row_number().over(same)).where(F.col("_place") <= k + 1)
    rows = table(rows.select("vec_id", "x"), "nearest-rows")
    asked = clean(queries).groupBy("vec_id").agg(F.min("x").alias("x"))
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    n_asked, asked_width = asked.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = max(width, asked_width or 0)
    parts = parts or min(PARTS[1], max(PARTS[0], total // PART_ROWS))
    parts = max(1, min(parts, min(total, sample_rows) // SAMPLE_PER_PART))
    draw = least_draws(rows.withColumn("draw", F.xxhash64("vec_id", "x")), total, sample_rows)
    router = pickle.loads(draw.coalesce(1).mapInArrow(_fit(width, parts, k, recall), "router binary").first()[0])

    # Vectors travel as they were given, if that is as floats; they are scaled where they are used.
    kind = "<f4" if all(isinstance(df.schema["embedding"].dataType, ArrayType) and isinstance(df.schema["embedding"].dataType.elementType, FloatType)
                        for df in (vectors, queries)) else "<f8"
    dealt = table(rows.mapInArrow(_deal(router, width, kind), "grp int, vec_id long, x binary"), "nearest-parts")
    sizes = dict(dealt.groupBy("grp").count().collect())
    first, number = deal([sizes.get(p, 0) for p in range(router.parts)], unit_rows(total, page_rows, width))
    unit_of = (picked(first, F.col("grp")) + F.pmod(F.xxhash64("vec_id"), picked(np.maximum(1, number), F.col("grp")))).cast("int")
    held = dealt.select(unit_of.alias("unit"), "grp", "vec_id", "x", F.lit(b"").alias("parts"))
    sending = asked.mapInArrow(_route(router, width, kind, first, number), "unit int, grp int, vec_id long, x binary, parts binary")
    found = search(held, sending, n_asked, int((first + number).max()), _pages(width, kind, page_rows), _search(width, kind, router.parts, k),
                   "query_id long, vec_id long, score double", "nearest-found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_learned_partitions(spark, sf_dir):
    """The 5 nearest found for every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))

"""Exact top-k search by inner product: best-first search of paged M-trees.

An M-tree (Ciaccia, Patella, Zezula 1997) needs a metric. With every vector x of
squared length at most M lengthened by sqrt(M - |x|^2), the Euclidean distance to a
query (lengthened by 0) falls as the inner product grows, so nearest neighbours are
the highest scores. Squared distances come from integer inner products.

Vectors are dealt to groups by their nearest pivot, and groups to units of bounded size (``units``); a unit holds a tree for each page of
a group, whose nodes keep a routing vector, a covering radius and the distances to
the parent. A query first searches the unit of its nearest group. Its k-th best score goes along to the other units:
whole groups are skipped by their pivots and radii, and within a page the node of the least possible distance is expanded first
and entries that cannot beat the k-th best so far are skipped by the triangle
inequality on stored distances, without computing their distance. Queries walk a tree in blocks: a node is
visited once for all queries it may still serve, with one matrix product.

Vectors and queries go through the shuffle as rows of one vector; a query is sent once to a unit. Each unit gives at most k rows per query to the
final ranking.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salaria.llm.rows import table
from salaria.llm.units import deal, least_draws, packed, padded, picked, search, sent, unit_rows, units_needed, unpacked

#: Vectors of a page (about), entries of a node, groups at most, queries that walk together. SCALE turns components into integers.
PAGE_ROWS, NODE, GROUPS, WALK, SCALE, K, EVERY = 8192, 256, 1024, 512, 256, 5, 50
#: A score below all others.
NONE = np.iinfo(np.int64).min


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component as double; null for null vectors and ones with null or non-finite components."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(ok, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows: in doubles where their sums stay below 2**53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return np.rint(a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


class Space:
    """The metric over vectors of squared length at most ``most``."""

    def __init__(self, most: int):
        self.most = most
        #: Distances are roots of exact integers; bounds are widened by this against rounding.
        self.slack = 1e-6 + 1e-12 * float(most) ** 0.5

    def heights(self, squares: np.ndarray) -> np.ndarray:
        return np.sqrt((self.most - squares).astype(float))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of lengthened vectors, rows of ``a`` by rows of ``b``."""
        square_a, square_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
        flat = square_a[:, None] + square_b[None] - 2 * dots(a, b)
        return np.sqrt(np.maximum(0, flat) + (self.heights(square_a)[:, None] - self.heights(square_b)[None]) ** 2)

    def from_scores(self, squares: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distances of queries of squared lengths ``squares`` (one a row, at most ``most``) to vectors by their scores."""
        return np.sqrt(np.maximum(0, squares[:, None] + self.most - 2 * scores).astype(float))

    def within(self, squares: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Distances beyond which scores are below ``floor``."""
        return np.where(floor == NONE, np.inf, np.sqrt(np.maximum(0, squares + self.most - 2 * np.where(floor == NONE, 0, floor)).astype(float))) + self.slack


class Node:
    """``pivot``: row of the routing vector; ``radius`` covers all rows below; ``own``: distances of the
    entries to the pivot. A leaf has ``rows``, an inner node ``children``."""

    __slots__ = ("pivot", "radius", "own", "rows", "children")

    def __init__(self, pivot, radius, own, rows=None, children=None):
        self.pivot, self.radius, self.own, self.rows, self.children = pivot, radius, own, rows, children


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: int | None = None):
        """``ids`` in ascending order, ``vectors``: integers, one row each; ``most``: largest squared length of the table."""
        self.ids, self.vectors = ids, vectors
        self.space = Space(int((vectors * vectors).sum(axis=1).max(initial=0)) if most is None else most)
        self.root = self._build(np.arange(len(ids)), 0) if len(ids) else None

    def _from(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        return self.space.between(self.vectors[pivot][None], self.vectors[rows])[0]

    def _build(self, rows: np.ndarray, pivot: int) -> Node:
        own = self._from(pivot, rows)
        radius = float(own.max())
        if len(rows) <= NODE:
            return Node(pivot, radius, own, rows=rows)
        # Routing vectors: spread over the order of distance to the pivot; rows go to the nearest.
        parts = min(NODE, -(-len(rows) // NODE) + 1)
        marks = rows[np.unique(np.argsort(own, kind="stable")[np.linspace(0, len(rows) - 1, parts).astype(int)])]
        nearest = np.argmin(self.space.between(self.vectors[marks], self.vectors[rows]), axis=0)
        groups = [(m, rows[nearest == k]) for k, m in enumerate(marks) if (nearest == k).any()]
        if max(len(g) for _, g in groups) > 0.9 * len(rows):  # (nearly) equal vectors: deal by place
            groups = [(g[0], g) for g in np.array_split(rows, min(NODE, -(-len(rows) // NODE)))]
        children = [self._build(g, int(m)) for m, g in groups]
        return Node(pivot, radius, self._from(pivot, np.array([c.pivot for c in children])), children=children)

    def search(self, queries: np.ndarray, own_ids: np.ndarray, k: int, floor: np.ndarray | None = None, found: Best | None = None,
               some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query number, id, score) of the k best of each of ``queries`` (squared lengths at most the space's), ties to the smaller id, without the
        row of the query's own id; and the distances computed. ``floor``: scores below it are not wanted. ``found``: the best of other trees,
        which are added to; ``some``: the queries to search for."""
        n = len(queries)
        found = Best(n, k, floor) if found is None else found
        if self.root is None or not n:
            return *found.rows(), 0
        space = self.space
        squares = (queries * queries).sum(axis=1)
        asked = 0

        def distances(who: np.ndarray, rows: np.ndarray) -> np.ndarray:
            nonlocal asked
            asked += len(who) * len(rows)
            return space.from_scores(squares[who], dots(queries[who], self.vectors[rows]))

        def worst(who: np.ndarray) -> np.ndarray:
            """Distances beyond which nothing is wanted."""
            return space.within(squares[who], found.least[who])

        tick = itertools.count()
        everyone = np.arange(n) if some is None else some
        queue = [(0.0, next(tick), everyone, distances(everyone, np.array([self.root.pivot]))[:, 0], self.root)]
        while queue:
            _, _, who, at, node = heapq.heappop(queue)
            live = at - node.radius <= worst(who)
            who, at = who[live], at[live]
            if not len(who):
                continue
            if node.children is not None:
                radii = np.array([c.radius for c in node.children])
                limit = worst(who)[:, None]
                possible = np.abs(at[:, None] - node.own[None]) - radii[None] <= limit
                near = np.flatnonzero(possible.any(axis=0))
                if not len(near):
                    continue
                to = distances(who, np.array([node.children[i].pivot for i in near]))
                least = np.maximum(0.0, to - radii[near][None])
                possible = possible[:, near] & (least <= limit)
                for j, i in enumerate(near):
                    some = possible[:, j]
                    if some.any():
                        heapq.heappush(queue, (float(least[some, j].min()), next(tick), who[some], to[some, j], node.children[i]))
                continue
            possible = np.abs(at[:, None] - node.own[None]) <= worst(who)[:, None]
            used = np.flatnonzero(possible.any(axis=0))
            if len(used):
                rows = node.rows[used]
                scores = dots(queries[who], self.vectors[rows])
                asked += len(who) * len(rows)
                scores[~possible[:, used] | (self.ids[rows][None] == own_ids[who][:, None])] = NONE
                found.offer(who, self.ids[rows], scores)
        return *found.rows(), asked


class Best:
    """The k best (score, id) of each of ``n`` queries so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores, self.ids = np.full((n, k), NONE), np.zeros((n, k), np.int64)
        #: Scores below this are not wanted: the k-th best, or the floor given.
        self.least = np.full(n, NONE) if floor is None else floor.copy()

    def offer(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of the queries ``who`` (rows) with the vectors ``ids`` (columns); ``NONE``: not offered."""
        wanted = (scores >= self.least[who][:, None]) & (scores != NONE)
        many = np.flatnonzero(wanted.sum(axis=1) > self.k)
        if len(many):
            wanted[many] &= scores[many] >= np.partition(scores[many], len(ids) - self.k, axis=1)[:, len(ids) - self.k, None]
        q, r = np.nonzero(wanted)
        if not len(q):
            return
        held = np.repeat(np.arange(len(who)), self.k)
        q = np.concatenate([held, q])
        score = np.concatenate([self.scores[who].ravel(), scores[q[len(held):], r]])
        name = np.concatenate([self.ids[who].ravel(), ids[r]])
        order = np.lexsort((name, -np.maximum(score, NONE + 1), q))
        q, score, name = q[order], score[order], name[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < self.k
        self.scores[who[q[top]], place[top]], self.ids[who[q[top]], place[top]] = score[top], name[top]
        self.least[who] = np.maximum(self.least[who], self.scores[who, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, place = np.nonzero(self.scores != NONE)
        return q, self.ids[q, place], self.scores[q, place]


def _near(pivots: np.ndarray, space: Space, width: int, kind: str):
    """Nearest pivot (group) of each vector, and its distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = padded(batch.column("q"), width, np.int64)
            group, off = np.zeros(len(m), np.int32), np.zeros(len(m))
            for at in range(0, len(m), 1024):
                to = space.between(m[at:at + 1024], pivots)
                group[at:at + 1024], off[at:at + 1024] = to.argmin(axis=1), to.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed(m.astype(kind)), pa.array(group), pa.array(off)], ["vec_id", "x", "grp", "off"])
    return run


def _other_units(pivots: np.ndarray, radii: np.ndarray, first: np.ndarray, number: np.ndarray, space: Space, width: int, kind: str):
    """Queries, once for each unit that they may still need, but for their first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                rows = batch.slice(at, 1024)
                m = unpacked(rows.column("x"), width, kind).astype(np.int64)
                squares = (m * m).sum(axis=1)
                far = space.within(squares, rows.column("floor").to_numpy())
                need = units_needed(space.from_scores(squares, dots(m, pivots)) - radii[None] <= far[:, None], first, number)
                need[np.arange(len(m)), rows.column("unit").to_numpy()] = False
                yield from sent(need, {c: rows.column(c) for c in ("grp", "vec_id", "x", "floor")})
    return run


def _trees(most: int, width: int, kind: str, page_rows: int):
    """A unit's trees, one a page, with their groups."""
    def build(rows: pa.Table) -> list[tuple[int, Tree]]:
        grp, ids = (rows[c].to_numpy() for c in ("grp", "vec_id"))
        m = unpacked(rows["x"].combine_chunks(), width, kind).astype(np.int64)
        cuts = [0, *(np.flatnonzero(grp[1:] != grp[:-1]) + 1).tolist(), len(grp)]
        pages = [page for a, b in zip(cuts, cuts[1:]) for page in np.array_split(np.arange(a, b), -(-(b - a) // page_rows))]
        return [(int(grp[page[0]]), Tree(ids[page], m[page], most)) for page in pages]
    return build


def _best(pivots: np.ndarray, radii: np.ndarray, space: Space, k: int, width: int, kind: str):
    """The k best of a unit for some queries: nearer pages first, the k-th best score so far going along."""
    def answer(trees: list[tuple[int, Tree]], rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, floor = (rows.column(c).to_numpy() for c in ("vec_id", "floor"))
        m = unpacked(rows.column("x"), width, kind).astype(np.int64)
        groups = np.array([g for g, _ in trees])
        for at in range(0, len(ids), WALK):
            some, own = m[at:at + WALK], ids[at:at + WALK]
            squares = (some * some).sum(axis=1)
            least = space.from_scores(squares, dots(some, pivots[groups])) - radii[groups][None]
            found = Best(len(own), k, floor[at:at + WALK])
            for t in np.argsort(least.mean(axis=0), kind="stable"):
                live = np.flatnonzero(least[:, t] <= space.within(squares, found.least))
                if len(live):
                    trees[t][1].search(some, own, k, found=found, some=live)
            q, near, score = found.rows()
            yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(near), pa.array(score)], ["query_id", "vec_id", "score"])
    return answer


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The ``k`` rows of ``vectors`` of highest integer inner product with each row of ``queries``, but for the row of the same id.

    Both have vec_id and embedding. Returns query_id, rank (from 1), vec_id, score;
    ties go to the smaller vec_id. Null ids and vectors that are null or hold null or
    non-finite components take no part; a shorter vector ends in zeros. Rows that
    repeat id and vector count once; of queries that repeat an id the one of the smallest vector counts. With
    fewer than k other rows all come; empty tables give an empty result. Other columns are ignored. Refused (ValueError) are
    vectors whose squared lengths could pass 2**61, where scores would not fit 64 bits.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        out = df.select(df["vec_id"].cast("long").alias("vec_id"), quantised(df["embedding"]).alias("q"))
        return out.where("vec_id is not null and q is not null")

    rows = table(usable(vectors).distinct(), "search-rows")
    asked = table(usable(queries).groupBy("vec_id").agg(F.min("q").alias("q")), "search-queries")
    # As doubles: squares of large components must not overflow before they are refused.
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = [F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0))]
    (total, width, most), (n_asked, asked_width, asked_most) = (df.agg(*sizes).first() for df in (rows, asked))
    schema = "query_id long, rank int, vec_id long, score long"
    if not total or not n_asked:
        return spark.createDataFrame([], schema)
    if max(most, asked_most) >= 1 << 61:
        raise ValueError("components are too large for 64-bit scores")
    width, most = max(width, asked_width, 1), int(max(most, asked_most)) + 1
    space = Space(most)
    pages = -(-total // page_rows)
    drawn = least_draws(rows.withColumn("draw", F.xxhash64("vec_id", "q")), total, min(GROUPS, pages)).select("q").toArrow()["q"].combine_chunks()
    pivots = padded(drawn, width, np.int64)
    # Components as the narrowest integers that hold them: none is beyond the longest vector.
    kind = next(x for x in ("<i2", "<i4", "<i8") if most < float(np.iinfo(x).max) ** 2)
    near, columns = _near(pivots, space, width, kind), "vec_id long, x binary, grp int, off double"
    dealt = table(rows.mapInArrow(near, columns), "search-groups")
    groups = {r.grp: r for r in dealt.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("off").alias("off")).collect()}
    # The farthest vector of each group; nothing lies in a group without vectors.
    radii = np.array([groups[g].off if g in groups else -np.inf for g in range(len(pivots))])
    first, number = deal([groups[g].n if g in groups else 0 for g in range(len(pivots))], unit_rows(total, page_rows, width))
    units = int((first + number).max())
    # A vector's unit, and a query's first: one of its (nearest) group.
    unit = (picked(first, F.col("grp")) + F.pmod(F.xxhash64("vec_id"), picked(np.maximum(1, number), F.col("grp")))).cast("int").alias("unit")
    nothing = F.lit(NONE).alias("floor")
    held = dealt.select(unit, "grp", "vec_id", "x", nothing)
    seeking = table(asked.mapInArrow(near, columns).select(unit, "grp", "vec_id", "x"), "search-seeking")
    build, answer = _trees(most, width, kind, page_rows), _best(pivots, radii, space, k, width, kind)
    out = "query_id long, vec_id long, score long"
    found = search(held, seeking.select("*", nothing), n_asked, units, build, answer, out, "search-first")
    floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    left = seeking.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    others = left.mapInArrow(_other_units(pivots, radii, first, number, space, width, kind), "unit int, grp int, vec_id long, x binary, floor long")
    found = found.unionAll(search(held, others, n_asked, units, build, answer, out, "search-others"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark, sf_dir):
    """The 5 best of all vectors for every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {K}
"""

"""Exact top-k by inner product with an M-tree.

Vectors are turned into whole numbers, and every candidate gets one more coordinate that makes
all lengths equal. In that space the largest inner products are the smallest distances, so
the triangle inequality bounds them. The tree has a fixed root, whose entries are pivots
from a bounded sample. Each vector belongs to its nearest pivot; a pivot's vectors are dealt
to pages of about ``PAGE`` rows, however many share a pivot or an id or are equal. A page is one subtree of
metric nodes with covering radius and distance to the parent node.

A query visits nodes nearest bound first. Its first page gives a k-th distance; it then goes
only to pages whose pivot and covering radius allow something as near. Inside a page,
the stored distance to the parent rules out nodes and entries before their own distance is
computed, and the search ends when no node left is near enough. Scores themselves
are whole numbers, so bounds only ever need a slack for rounding. Each page's tree is built once and
kept as one row. Queries meet pages in blocks, and a page is sent to the blocks that visit it only.

Defined results: rows with a NULL id, a NULL vector, or a NULL or non-finite component take no part; shorter
vectors count as padded with 0; a query never finds rows with its own id; rows that repeat are candidates of
their own, and a repeated query is asked once (with its smallest vector); fewer candidates
than k give them all; ties go to the smaller id; very long vectors are compared whole; an empty table gives an empty result; other columns are not read.
Scores must fit bigint.
"""

import heapq
import pickle
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plateful.plans.staging import checkpointed

SAMPLE, PIVOTS, PAGE, QUERY_BLOCK = 2048, 32, 16384, 8192
FANOUT, LEAF = 16, 256
# Rows of visits that a task holds before it sends them on.
VISITS = 20_000
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, factor: int = 1024) -> DataFrame:
    """(vec_id, v) with v = floor(factor * x) for the rows that take part, padded to one length."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = (rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(usable)
              .select(F.col("vec_id").cast("long"),
                      F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v")))
    scaled = checkpointed(scaled)
    size = scaled.agg(F.max(F.size("v"))).first()[0] or 0
    return scaled.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))).alias("v"))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


class Space(NamedTuple):
    """Candidates on a sphere of squared radius ``top``; queries have 0 in the added coordinate."""

    top: int

    def lift(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(float)
        return np.column_stack([x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0.0))])

    def ask(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v.astype(float), np.zeros(len(v))])

    def distance(self, score, query: np.ndarray):
        """Distance of a candidate with this score."""
        return np.sqrt(np.maximum(float(query @ query) + self.top - 2.0 * score, 0.0))

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + self.top ** 0.5)

    def scores(self, v: np.ndarray, query: np.ndarray) -> np.ndarray:
        # Below 2**52 sums of products are exact in floating point.
        if self.top < 2 ** 50 and float(query.astype(float) @ query) < 2 ** 50:
            return (v.astype(float) @ query.astype(float)).astype(np.int64)
        return v @ query


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(axis=-1))


def spread_out(points: np.ndarray, k: int) -> list[int]:
    """Indexes of up to k different points, each next one farthest from those before."""
    chosen = [0]
    nearest = distances(points, points[0])
    while len(chosen) < k and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(points, points[chosen[-1]]))
    return chosen


class Node(NamedTuple):
    """A metric node: its centre, and of each entry its distance to the centre.

    An entry of an inner node is a node with its radius, one of a leaf is a row of the page.
    """

    centre: np.ndarray
    radius: float
    children: list
    rows: np.ndarray
    to_centre: np.ndarray
    radii: np.ndarray


def bulk_load(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """An M-tree over ``points``: entries go to the nearest of up to ``FANOUT`` spread-out centres."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    centre = own[distances(own, own.mean(axis=0)).argmin()]
    to_centre = distances(own, centre)
    radius = float(to_centre.max())
    if len(rows) <= LEAF or radius == 0:
        return Node(centre, radius, [], rows, to_centre, np.zeros(len(rows)))
    step = max(1, len(rows) // (8 * FANOUT))
    seeds = own[::step][spread_out(own[::step], FANOUT)]
    if len(seeds) == 1:
        seeds = own[spread_out(own, 2)]
    nearest = np.argmin([distances(own, s) for s in seeds], axis=0)
    children = [bulk_load(points, rows[nearest == i]) for i in np.unique(nearest)]
    return Node(centre, radius, children, rows[:0], distances(np.array([c.centre for c in children]), centre),
                np.array([c.radius for c in children]))


def search(tree: Node, space: Space, ids: np.ndarray, v: np.ndarray, query_id: int, query: np.ndarray, k: int,
           known: int | None) -> list[tuple[int, int]]:
    """The best k (score, vec_id) of a page, or fewer if others cannot be among the best; ``known`` is a k-th score."""
    point = np.append(query.astype(float), 0.0)
    best, limit = [], np.inf if known is None else float(space.distance(known, query.astype(float))) + space.slack
    first = float(distances(tree.centre, point))
    queue, n = [(first - tree.radius, 0, first, tree)], 1
    while queue:
        bound, _, away, node = heapq.heappop(queue)
        if bound > limit:
            break
        # By the triangle inequality an entry is at least this far away.
        able = np.flatnonzero(np.abs(away - node.to_centre) - node.radii <= limit)
        if node.children:
            for i in able:
                child = node.children[i]
                to = float(distances(child.centre, point))
                if to - child.radius <= limit:
                    heapq.heappush(queue, (to - child.radius, n, to, child))
                    n += 1
            continue
        rows = node.rows[able]
        rows = rows[ids[rows] != query_id]
        found = space.scores(v[rows], query)
        if len(best) == k:
            near = found >= best[-1][0]
            rows, found = rows[near], found[near]
        order = np.lexsort((ids[rows], -found))[:k]
        best = sorted([*best, *zip(found[order].tolist(), ids[rows[order]].tolist())], key=lambda b: (-b[0], b[1]))[:k]
        if len(best) == k:
            limit = min(limit, float(space.distance(best[-1][0], query.astype(float))) + space.slack)
    return best


def _built_page(space: Space, key, page: pa.Table) -> pa.Table:
    """A page as one row: its tree, ids and vectors, built once for all that visit it."""
    ids, v = page.column("vec_id").to_numpy(), _matrix(page.column("v"))
    made = pickle.dumps((bulk_load(space.lift(v)), ids, v), protocol=pickle.HIGHEST_PROTOCOL)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([made], pa.binary())],
                    names=["pivot", "page", "built"])


def _search_page(space: Space, k: int, key, page: pa.Table, queries: pa.Table) -> pa.Table:
    found = []
    if page.num_rows and queries.num_rows:
        tree, ids, v = pickle.loads(page.column("built")[0].as_py())
        asked = zip(queries.column("query_id").to_pylist(), _matrix(queries.column("q")), queries.column("known").to_pylist())
        for query_id, query, known in asked:
            found += [(query_id, i, s) for s, i in search(tree, space, ids, v, query_id, query, k, known)]
    columns = list(zip(*found)) or [(), (), ()]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def page_of(pages: dict[int, int]) -> Column:
    """The page, of so many of its pivot, that a row is dealt to by its number ``row``."""
    n_pages = F.element_at(F.create_map(*[F.lit(x) for pair in pages.items() for x in pair]), F.col("pivot"))
    return F.pmod(F.xxhash64("row"), n_pages).cast("int")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, v) where ``is_query`` holds."""
    # As doubles, since squares of components pass the range of a bigint long before scores do; a little above for rounding.
    longest = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()[0] or 0.0
    space = Space(int(longest * (1 + 1e-9)) + 1)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    if not sample:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = space.lift(np.array([r["v"] for r in sample], dtype=np.int64))
    pivots = points[spread_out(points, PIVOTS)]

    def nearest(batches):
        for batch in batches:
            far = np.array([distances(space.lift(_matrix(batch.column("v"))), p) for p in pivots])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"),
                                              pa.array(far.argmin(axis=0).astype(np.int32)), pa.array(far.min(axis=0))],
                                             names=["vec_id", "v", "pivot", "to_pivot"])

    dealt = checkpointed(vectors.mapInArrow(nearest, "vec_id long, v array<long>, pivot int, to_pivot double")
                         .withColumn("row", F.monotonically_increasing_id()))
    root = {r["pivot"]: r for r in dealt.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.max("to_pivot").alias("radius")).collect()}
    pages = {p: -(-r["n"] // PAGE) for p, r in root.items()}
    asked = (vectors.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")))
    asked = checkpointed(asked)
    blocks = -(-asked.count() // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(max(blocks, 1))).cast("int")
    built = checkpointed(dealt.select("vec_id", "v", "pivot", page_of(pages).alias("page")).groupBy("pivot", "page")
                         .applyInArrow(lambda key, page: _built_page(space, key, page), "pivot int, page int, built binary"))

    def visits(batches, first: bool):
        """The nearest pivot's first page; or all other pages that may hold something near enough."""
        def filled(batch, rows):
            i, pivot, page, known = zip(*rows) if rows else ((), (), (), ())
            at = pa.array(i, pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(at), batch.column("q").take(at), batch.column("block").take(at),
                 pa.array(pivot, pa.int32()), pa.array(page, pa.int32()), pa.array(known, pa.int64())],
                names=["query_id", "q", "block", "pivot", "page", "known"])

        for batch in batches:
            at, rows = space.ask(_matrix(batch.column("q"))), []
            far = np.array([distances(at, pivots[p]) - root[p]["radius"] for p in root]).T
            scores = [None] * len(far) if first else batch.column("known").to_pylist()
            for i, (bounds, known) in enumerate(zip(far, scores)):
                home = [*root][int(bounds.argmin())]
                if first:
                    rows.append((i, home, 0, None))
                else:
                    limit = np.inf if known is None else space.distance(known, at[i]) + space.slack
                    rows += [(i, p, page, known) for p, bound in zip(root, bounds) if bound <= limit
                             for page in range(pages[p]) if (p, page) != (home, 0)]
                if len(rows) >= VISITS:
                    yield filled(batch, rows)
                    rows = []
            yield filled(batch, rows)

    visit = "query_id long, q array<long>, block int, pivot int, page int, known long"

    def searched(queries):
        """Pages go to the blocks of queries that visit them, and to no others."""
        queries = checkpointed(queries)
        met = queries.select(F.col("pivot").alias("at_pivot"), F.col("page").alias("at_page"), F.col("block").alias("at_block")).distinct()
        sent = built.join(met, (F.col("pivot") == F.col("at_pivot")) & (F.col("page") == F.col("at_page")))
        return (sent.groupBy("at_pivot", "at_page", "at_block").cogroup(queries.groupBy("pivot", "page", "block"))
                .applyInArrow(lambda key, a, b: _search_page(space, k, key, a, b), _FOUND))

    asked = asked.withColumn("block", block)
    home = checkpointed(searched(asked.mapInArrow(partial(visits, first=True), visit)))
    known = (_ranked(home, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
             .select("query_id", F.when(F.col("n") == k, F.col("least")).alias("known")))
    others = asked.join(known, "query_id", "left").mapInArrow(partial(visits, first=False), visit)
    return (_ranked(home.unionByName(searched(others)), k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def neighbours(rows: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """Top k of the rows whose vec_id is divisible by ``every``, among all rows (vec_id, embedding)."""
    return top_k(whole_vectors(rows), F.col("vec_id") % every == 0, k)

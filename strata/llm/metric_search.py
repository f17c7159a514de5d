"""Exact top-k search by inner product with paged metric trees.

Vectors get one more coordinate that gives all of them the same norm M; then the largest inner product is the smallest
distance, and metric bounds hold. Rows go to the nearest of a bounded number of pivots and, where a region is large, are
dealt on into subtrees of bounded size. A subtree is an M-tree: a node has a pivot, a covering radius and the distance to
its parent's pivot, a page has its entries' distances to the page's pivot.

A query first searches one subtree, which gives it a k-th best score, and then each subtree that the bound of its region
does not exclude. In a subtree a block of queries goes best first; stored distances and the triangle inequality leave out
nodes and entries before their own distances are computed. Scores are exact integers; bounds only leave out what is surely worse.

Query blocks meet subtrees; nothing is broadcast but the pivots, at most ``MOST_REGIONS``.

Defined cases: vectors that are null or hold null or non-finite components take no part; only vectors of equal length are
compared; rows that have the query's id are its own; a query id with several rows is asked once, with its smallest vector;
with fewer than k candidates all are returned; an empty table gives no rows. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import tasks_need_package, written

SUBTREE_ROWS = 8192
MOST_REGIONS = 512
PAGE_ROWS = 256
QUERY_BLOCK = 1024
SLACK = 1e-9

FOUND = "query_id long, vec_id long, score long"


class Tree:
    """One subtree. Nodes are (pivot, radius, distance to the parent's pivot, children or a page's row numbers)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm2: float):
        by_id = np.argsort(ids, kind="stable")  # so that of equal vectors the smallest ids come first
        ids, vectors = ids[by_id], vectors[by_id]
        real = vectors.astype(np.float64)
        points = np.column_stack([real, np.sqrt(np.maximum(norm2 - (real**2).sum(1), 0.0))])
        self.nodes: list[tuple] = []
        self.pages: list[np.ndarray] = []
        self.fars: list[np.ndarray] = []
        self.filled = 0
        self.root = self._grow(points, np.arange(len(ids)), 0, None)
        order = np.concatenate(self.pages)  # rows of a page lie side by side
        self.ids, self.vectors, self.far = ids[order], vectors[order], np.concatenate(self.fars)
        del self.pages, self.fars

    def _grow(self, points: np.ndarray, rows: np.ndarray, first: int, parent: np.ndarray | None) -> int:
        pivot = points[rows[first]]
        far = np.sqrt(((points[rows] - pivot) ** 2).sum(1))
        radius, up = float(far.max()), float(np.sqrt(((pivot - parent) ** 2).sum())) if parent is not None else 0.0
        if len(rows) <= PAGE_ROWS or radius == 0.0:
            order = np.argsort(far, kind="stable")
            self.pages.append(rows[order])
            self.fars.append(far[order])
            self.nodes.append((pivot, radius, up, None, self.filled, self.filled + len(rows)))
            self.filled += len(rows)
            return len(self.nodes) - 1
        # pivots of the children: each the farthest from those before it, nearest pivot takes a row
        wanted = min(16, -(-len(rows) // PAGE_ROWS) + 1)
        chosen, nearest, owner = [first], far, np.zeros(len(rows), np.int64)
        while len(chosen) < wanted and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            away = np.sqrt(((points[rows] - points[rows[chosen[-1]]]) ** 2).sum(1))
            owner[away < nearest] = len(chosen) - 1
            nearest = np.minimum(nearest, away)
        numbers = []
        for c, row in enumerate(chosen):
            members = np.flatnonzero(owner == c)
            numbers.append(self._grow(points, rows[members], int(np.flatnonzero(members == row)[0]), pivot))
        below = [self.nodes[i] for i in numbers]
        children = (np.array(numbers), np.array([n[0] for n in below]), np.array([n[1] for n in below]), np.array([n[2] for n in below]))
        self.nodes.append((pivot, radius, up, children, 0, 0))
        return len(self.nodes) - 1

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray, norm2: float) -> tuple[np.ndarray, ...]:
        """(number of the query, vec_id, score) of each query's best k, of those that reach its floor (nan: none given).

        The queries share one agenda, so that a node meets all queries it may still serve in one product: the node with
        the smallest bound of any query comes first, and a query leaves a node its own bound excludes.
        """
        real = np.column_stack([queries.astype(np.float64), np.zeros(len(queries))])
        base = (real**2).sum(1) + norm2
        longest = float((self.vectors.astype(np.float64) ** 2).sum(1).max(initial=0.0))
        exact = max(2 * longest, float(base.max(initial=0.0))) < 2**50  # sums of such products are exact in doubles
        kind, number = (np.float64, np.int64) if exact else (object, object)
        rows, asked = self.vectors.astype(kind), queries.astype(kind)
        best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, number)
        least = np.where(np.isnan(floors), -np.inf, _rounded_down(floors))  # a score below it is of no use,
        last = np.full(len(queries), np.iinfo(np.int64).max)  # nor one equal to it with an id above this
        limits = _reach(base, least)

        first = np.arange(len(queries))
        pivot, radius = self.nodes[self.root][:2]
        away = np.sqrt(((real - pivot) ** 2).sum(1))
        low = np.maximum(away - radius, 0.0)
        agenda = [(float(low.min(initial=np.inf)), self.root, first, away, low)]
        while agenda:
            _, node, who, away, low = heapq.heappop(agenda)
            open_ = low <= limits[who]
            who, away = who[open_], away[open_]
            if not len(who):
                continue
            _, _, _, children, start, end = self.nodes[node]
            if children is not None:
                for child, pivot, radius, up in zip(*children, strict=True):
                    near = np.abs(away - up) - radius <= limits[who]  # stored distances leave out the others
                    some = who[near]
                    distance = np.sqrt(((real[some] - pivot) ** 2).sum(1))
                    low = np.maximum(distance - radius, 0.0)
                    reached = low <= limits[some]
                    if reached.any():
                        low = low[reached]
                        heapq.heappush(agenda, (float(low.min()), int(child), some[reached], distance[reached], low))
                continue
            # entries that no query's stored distances let in are left out
            lo = np.searchsorted(self.far[start:end], float((away - limits[who]).min()))
            hi = np.searchsorted(self.far[start:end], float((away + limits[who]).max()), side="right")
            start, end = start + int(lo), start + int(hi)
            for begin in range(start, end, PAGE_ROWS):  # a page of equal vectors may be longer
                upto = min(begin + PAGE_ROWS, end)
                scores = asked[who] @ rows[begin:upto].T
                q, at = np.nonzero((scores >= least[who][:, None]) & (self.ids[begin:upto] != query_ids[who][:, None]))
                found = who[q], self.ids[begin + at], scores[q, at].astype(number)
                useful = (found[2] > least[found[0]]) | (found[1] < last[found[0]])
                if not useful.any():
                    continue
                best = _best(*(np.concatenate([old, new[useful]]) for old, new in zip(best, found, strict=True)), k)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(queries)) == k)
                worst = np.searchsorted(best[0], full, side="right") - 1
                least[full], last[full] = _rounded_down(best[2][worst]), best[1][worst]
                limits[full] = _reach(base[full], least[full])
        return best


def _reach(base: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The distance beyond which no vector reaches the score ``least``, and a little more for rounding."""
    return np.sqrt(np.maximum(base - 2.0 * least, 0.0)) * (1 + SLACK) + base * 1e-12 + 1e-6


def _rounded_down(scores: np.ndarray) -> np.ndarray:
    """As doubles, none above the score it stands for."""
    real = scores.astype(np.float64)
    return np.where(np.abs(real) < 2.0**53, real, np.nextafter(real, -np.inf))


def _best(query: np.ndarray, name: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k first of each query by descending score, then name; ordered by query."""
    order = np.lexsort((name, -score, query))
    query, name, score = query[order], name[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], name[place < k], score[place < k]


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, null if one is null or not finite."""
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _counted(numbers: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n, one after the other."""
    return np.arange(int(numbers.sum())) - np.repeat(np.cumsum(numbers) - numbers, numbers)


def _narrow(vectors: np.ndarray) -> np.ndarray:
    most = int(np.abs(vectors).max(initial=0))
    return vectors.astype(np.int8 if most < 128 else np.int16 if most < 2**15 else np.int64)


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` holds, the k other rows of highest inner product."""
    tasks_need_package(df)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("v"), is_query.alias("asks"))
    rows = written(rows.where("v is not null and vec_id is not null"), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    found = None
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), F.max(norm).alias("norm2")).collect()
    for length in lengths:
        part = _search(rows.where(F.size("v") == length.n), length.rows, length.norm2, k)
        found = part if found is None else found.union(part)
    if found is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ordered = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, n: int, norm2: float, k: int) -> DataFrame:
    spark = rows.sparkSession
    regions = min(MOST_REGIONS, -(-n // SUBTREE_ROWS))
    sample = rows.select("v").distinct().orderBy(F.xxhash64("v")).limit(regions).collect()
    centres = np.array([r.v for r in sample], np.float64).reshape(len(sample), -1)
    centres = np.column_stack([centres, np.sqrt(np.maximum(norm2 - (centres**2).sum(1), 0.0))])
    pivots = spark.sparkContext.broadcast(centres)

    def place(batches):
        for batch in batches:
            real = _matrix(batch.column("v")).astype(np.float64)
            points = np.column_stack([real, np.sqrt(np.maximum(norm2 - (real**2).sum(1), 0.0))])
            square = (points**2).sum(1)[:, None] - 2 * points @ pivots.value.T + (pivots.value**2).sum(1)
            region = square.argmin(1)
            far = np.sqrt(((points - pivots.value[region]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(region.astype(np.int64)), pa.array(far)], names=["vec_id", "v", "asks", "region", "far"]
            )

    placed = written(rows.mapInArrow(place, "vec_id long, v array<long>, asks boolean, region long, far double"), "regions")
    sizes = placed.groupBy("region").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    parts = {r.region: (-(-r.n // SUBTREE_ROWS), r.radius) for r in sizes}
    names = np.array(sorted(parts))
    numbers, radii = np.ones(len(centres), np.int64), np.zeros(len(centres))
    for region, (number, radius) in parts.items():
        numbers[region], radii[region] = number, radius
    counts = F.create_map(*[F.lit(x) for r, (p, _) in parts.items() for x in (r, p)])
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.element_at(counts, F.col("region")))
    dealt = placed.select("vec_id", "v", "region", part.alias("part"))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vectors = _narrow(_matrix(table.column("v").combine_chunks()))
        tree = Tree(table.column("vec_id").to_numpy(), vectors, norm2)
        return pa.table({"region": [key[0].as_py()], "part": [key[1].as_py()], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = written(dealt.groupBy("region", "part").applyInArrow(build, "region long, part long, tree binary"), "trees")

    queries = placed.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    spread = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def routed(later: bool):
        def route(batches):
            for batch in batches:
                real = np.column_stack([_matrix(batch.column("v")).astype(np.float64), np.zeros(batch.num_rows)])
                base = (real**2).sum(1) + norm2
                away = np.sqrt(np.maximum(base[:, None] - 2 * real @ pivots.value.T, 0.0))
                ids = batch.column("vec_id").to_numpy()
                own = names[away[:, names].argmin(1)]
                home = ids % numbers[own]
                if not later:
                    picked = np.arange(len(ids)), own, home
                else:
                    floors = batch.column("floor").cast(pa.float64()).to_numpy(zero_copy_only=False)
                    limits = _reach(base, np.where(np.isnan(floors), -np.inf, floors))[:, None]
                    i, r = np.nonzero(away[:, names] - radii[names] <= limits + 1e-6 * radii[names])
                    r = names[r]
                    i, r, p = np.repeat(i, numbers[r]), np.repeat(r, numbers[r]), _counted(numbers[r])
                    other = (r != own[i]) | (p != home[i])
                    picked = i[other], r[other], p[other]
                taken, *where = (pa.array(x, pa.int64()) for x in picked)
                kept = [batch.column(c).take(taken) for c in batch.schema.names]
                yield pa.RecordBatch.from_arrays([*kept, *where], names=[*batch.schema.names, "region", "part"])

        return route

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=["query_id", "vec_id", "score"])
        tree = pickle.loads(right.column("tree")[0].as_py())
        ids, vectors = left.column("vec_id").to_numpy(), _matrix(left.column("v").combine_chunks())
        floors = left.column("floor").cast(pa.float64()).to_numpy()
        query, name, score = tree.search(ids, vectors, k, floors, norm2)
        return pa.table([pa.array(c, pa.int64()) for c in (ids[query], name, score)], names=["query_id", "vec_id", "score"])

    keys = ["region", "part", "block"]

    def searched(asked: DataFrame, later: bool) -> DataFrame:
        sent = asked.mapInArrow(routed(later), "vec_id long, v array<long>, block long, floor long, region long, part long")
        return sent.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(ask, FOUND)

    first = written(searched(queries.withColumn("floor", F.lit(None).cast("long")), False), "first")
    ordered = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    floors = first.withColumn("place", F.row_number().over(ordered)).where(F.col("place") == k)
    floors = floors.select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    return first.union(searched(queries.join(floors, "vec_id", "left").select("vec_id", "v", "block", "floor"), True))

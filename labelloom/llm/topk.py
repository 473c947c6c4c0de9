"""Exact top-k search by inner product, with a table of distances to pivots.

Vectors are integers: floor of 256 times each component. For every vector the distances to a fixed
number of pivots are worked out once and stored. The triangle inequality turns the table into a
lower bound of the distance between any query and any candidate (the largest difference of their
distances to a pivot), hence into an upper bound of the inner product, as
``2 q.x = |q|^2 + |x|^2 - |q - x|^2``. A query looks at candidates in the order of that bound and
stops once the next bound is below the k-th score it has: nothing behind can be better or tie.

Candidates lie in blocks by their nearest pivot, of bounded size. A block knows the least and the
largest distance of its vectors to every pivot, so a query has a bound for a whole block, too. Each query first
searches the block of its best bound; its k-th score there is a threshold, and it is sent only to
blocks whose bound reaches that. Queries meet a block in groups of bounded size, which Spark
shuffles; every block gives each of its queries at most k rows, and these are ranked at the end.
On vectors without structure the bounds leave hardly a candidate out, and the work is that of all products.

Defined cases: vectors that are null or hold a null or a number that is not finite, and rows
without id, take no part; rows of one id are vectors of their own, each a candidate for the other; shorter vectors count
as filled up with zeros; ties go to the smaller id; with fewer than k candidates all are given; a score beyond the range of a
long is its end; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, small

K = 5
SCALE = 256
#: Pivots, and the vectors among which they are chosen: those of least hash.
PIVOTS = 32
PIVOT_CHOICE = 2048
#: Queries of a group; rows of a block, and blocks at most: larger tables have larger blocks.
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
MOST_BLOCKS = 8192
#: Candidates that a query evaluates at first; four times as many at each further step.
STEP = 256
#: Queries whose bounds are worked out together.
TOGETHER = 64
#: Integers up to here are exact in a double; distances up to here are precise enough in single precision.
EXACT = 1 << 53
SINGLE = 1e6


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (array of doubles that are whole) of the vectors that take part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    # Whole numbers stay doubles: a long could not hold every one.
    whole = F.transform(wide, lambda x: F.rint(x * SCALE - F.pmod(x * SCALE, F.lit(1.0))))
    good = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    return good.select(F.col(key).cast("long").alias("id"), whole.alias("v"))


def _matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of equal width, filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(vectors), width))
    found[np.repeat(np.arange(len(vectors)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return found


def choose_pivots(points: np.ndarray, wanted: int) -> np.ndarray:
    """Points far from each other: each the farthest from those chosen before."""
    chosen = [int(np.argmax((points**2).sum(1)))] if len(points) else []
    nearest = np.full(len(points), np.inf)
    while len(chosen) < min(wanted, len(points)):
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(np.argmax(nearest)))
    return points[chosen]


def _with_distances(pivots: np.ndarray):
    width = pivots.shape[1]
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.float64())), ("d", pa.list_(pa.float64())), ("cell", pa.int32()), ("norm", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), width)
            # One pivot at a time: a difference has no cancellation, and a block stays small.
            distances = np.stack([np.sqrt(((points - p) ** 2).sum(1)) for p in pivots], axis=1)
            lists = pa.ListArray.from_arrays(np.arange(len(points) + 1, dtype=np.int32) * len(pivots), distances.ravel())
            cells = distances.argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array(cells), pa.array((points**2).sum(1))], schema=schema)

    return add


def block_bounds(norms: np.ndarray, distances: np.ndarray, low: np.ndarray, high: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of queries (rows) in blocks (columns), from the range of distances to each pivot."""
    least = np.zeros((len(norms), len(largest)))
    for p in range(distances.shape[1]):
        own = distances[:, p, None]
        np.maximum(least, np.maximum(low[None, :, p] - own, own - high[None, :, p]), out=least)
    total = norms[:, None] + largest[None]
    return (total - least * least) / 2 + 1e-9 * total + 1e-6


def block_arrays(rows: list, width: int) -> tuple[np.ndarray, ...]:
    """What every query needs to know of the blocks, at most ``MOST_BLOCKS`` + ``PIVOTS`` of them: plain arrays, to be broadcast."""
    low, high = (np.array([r[c] for r in rows], dtype=np.float64).reshape(len(rows), width) for c in ("low", "high"))
    return np.array([r["block"] for r in rows], dtype=np.int32), low, high, np.array([r["norm"] for r in rows])


def _routes(blocks: Broadcast, first: bool):
    """Queries -> a row for each block that they search: the best one, or the others that reach the threshold."""
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("v", pa.list_(pa.float64())), ("d", pa.list_(pa.float64())), ("norm", pa.float64()), ("least", pa.float64()), ("block", pa.int32())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, low, high, largest = blocks.value
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                distances = np.array(part["d"].to_pylist())
                bounds = block_bounds(part["norm"].to_numpy(), distances, low, high, largest)
                best = bounds.argmax(1)
                if first:
                    query, block = np.arange(len(part)), best
                else:
                    least = part["least"].fill_null(-np.inf).to_numpy()
                    reached = bounds >= least[:, None]
                    reached[np.arange(len(part)), best] = False
                    query, block = np.nonzero(reached)
                sent = part.take(pa.array(query))
                yield pa.RecordBatch.from_arrays([*(sent[c] for c in schema.names[:-1]), pa.array(numbers[block])], schema=schema)

    return read


class Side:
    """Vectors of a group as matrices."""

    def __init__(self, table: pa.Table, width: int):
        self.rows, self.ids = table["row"].to_numpy(), table["id"].to_numpy()
        self.points = _matrix(table["v"], width)
        self.norms = table["norm"].to_numpy()
        flat = table["d"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.distances = flat.reshape(len(self.rows), -1)


def search_block(queries: Side, candidates: Side, thresholds: np.ndarray, k: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """The k best ``(query row, query id, id, score)`` of each query among the candidates that can reach its threshold, and how many were evaluated."""
    found, evaluated = [], 0
    widest = max(queries.distances.max(initial=0), candidates.distances.max(initial=0))
    kind, slack = (np.float32, 1e-5) if widest < SINGLE else (np.float64, 1e-9)
    near, own = candidates.distances.T.astype(kind).copy(), queries.distances.astype(kind)
    least, step = np.empty((TOGETHER, len(candidates.ids)), kind), np.empty((TOGETHER, len(candidates.ids)), kind)
    for at in range(0, len(queries.ids), TOGETHER):
        part = slice(at, min(at + TOGETHER, len(queries.ids)))
        n = part.stop - at
        least[:n] = 0
        for p in range(len(near)):
            np.subtract(near[p][None], own[part, p, None], out=step[:n])
            np.abs(step[:n], out=step[:n])
            np.maximum(least[:n], step[:n], out=least[:n])
        total = queries.norms[part, None] + candidates.norms[None]
        # Rounding of the distances must not cut off a candidate.
        bounds = (total - least[:n].astype(np.float64) ** 2) / 2 + slack * total + 1
        for i in range(n):
            q = at + i
            bound = bounds[i]
            bound[candidates.rows == queries.rows[q]] = -np.inf
            threshold = thresholds[q]
            open_ = np.flatnonzero(bound >= max(threshold, -np.finfo(np.float64).max))
            best: list[tuple[int, int]] = []
            size = STEP
            while len(open_):
                if len(open_) > size:
                    cut_at = np.argpartition(-bound[open_], size)
                    now, open_ = open_[cut_at[:size]], open_[cut_at[size:]]
                else:
                    now, open_ = open_, open_[:0]
                scores = exact_scores(candidates.points[now], queries.points[q])
                evaluated += len(now)
                if len(now) > 4 * k:
                    # All that tie with the k-th stay.
                    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
                    top = np.flatnonzero(scores >= edge)
                    now, scores = now[top], scores[top]
                best = sorted([*best, *((-int(s), int(c)) for s, c in zip(scores, candidates.ids[now]))])[:k]
                if len(best) == k:
                    threshold = max(threshold, -best[-1][0])
                    open_ = open_[bound[open_] >= threshold]
                size *= 4
            found += [(int(queries.rows[q]), int(queries.ids[q]), c, min(max(-s, -(2**63)), 2**63 - 1)) for s, c in best]
    return found, evaluated


def exact_scores(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    largest = float(np.abs(points).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(q))
    if largest < EXACT:
        return np.rint(points @ q)
    whole = np.vectorize(int, otypes=[object])
    return whole(points) @ whole(q)


FOUND = "row long, query_id long, vec_id long, score long"


def _block_search(width: int, k: int):
    schema = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if len(left) and len(right):
            thresholds = left["least"].fill_null(-np.inf).to_numpy()
            rows, _ = search_block(Side(left, width), Side(right, width), thresholds, k)
        columns = zip(*rows) if rows else ([], [], [], [])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return search


def _searched(routes: DataFrame, placed: DataFrame, width: int, k: int) -> DataFrame:
    """What each query finds in the blocks that it is sent to."""
    routes = cut(routes)
    groups = cut(routes.groupBy("block").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("groups")))
    hinted = small(groups, (MOST_BLOCKS + PIVOTS) * 16)
    asked = routes.join(hinted, "block").withColumn("group", F.pmod(F.xxhash64("row"), F.col("groups")).cast("int"))
    # A block goes to each group of its queries.
    held = placed.join(hinted, "block").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    columns = ["row", "id", "v", "d", "norm", "block", "group"]
    met = asked.select(*columns, "least").groupBy("block", "group").cogroup(held.select(*columns).groupBy("block", "group"))
    return met.applyInArrow(_block_search(width, k), FOUND)


def top_k(df: DataFrame, every: int = 50, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: queries are the rows whose id is divisible by ``every``."""
    vectors = cut(integer_vectors(df, key, vector))
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    # The pivots decide the work, not the result: a bounded choice, the same at every run.
    choice = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(PIVOT_CHOICE).toPandas()
    points = np.zeros((len(choice), width))
    for i, v in enumerate(choice["v"]):
        points[i, : len(v)] = v
    pivots = choose_pivots(points, PIVOTS) if len(points) else np.zeros((1, width))
    told = vectors.mapInArrow(_with_distances(pivots), "id long, v array<double>, d array<double>, cell int, norm double")
    known = cut(told.withColumn("row", F.monotonically_increasing_id()))
    rows = max(CANDIDATE_BLOCK, -(-n // MOST_BLOCKS))
    ways = {r["cell"]: -(-r["count"] // rows) for r in known.groupBy("cell").count().collect()}
    starts, many = [], []
    for cell in range(len(pivots)):
        starts.append(sum(many))
        many.append(ways.get(cell, 1))
    of = lambda numbers: F.get(F.array(*[F.lit(x) for x in numbers]), F.col("cell"))
    block = (of(starts) + F.pmod(F.xxhash64("row"), of(many))).cast("int")
    placed = known.withColumn("block", block)
    ranges = [F.array(*[f(F.col("d")[p]) for p in range(len(pivots))]).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    blocks = placed.groupBy("block").agg(*ranges, F.max("norm").alias("norm")).orderBy("block").collect()
    shared = df.sparkSession.sparkContext.broadcast(block_arrays(blocks, len(pivots)))
    route = "row long, id long, v array<double>, d array<double>, norm double, least double, block int"
    queries = known.where(F.col("id") % every == 0).select("row", "id", "v", "d", "norm")
    unknown = queries.withColumn("least", F.lit(None).cast("double"))
    first = cut(_searched(unknown.mapInArrow(_routes(shared, True), route), placed, width, k))
    kth = first.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("least"))
    # A double of a large score may be rounded up.
    rounded = kth.select("row", (F.col("least") - F.abs("least") * 1e-15).alias("least"))
    rest = _searched(queries.join(rounded, "row", "left").select("row", "id", "v", "d", "norm", "least").mapInArrow(_routes(shared, False), route), placed, width, k)
    ranked = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    found = first.unionByName(rest)
    return found.select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

"""Approximate nearest neighbours by largest inner product, with low-dimensional stable projections.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and queries
are scaled to length M: then the nearest vector has the largest inner product. A Gaussian
(2-stable) projection to ``dims`` dimensions turns a squared distance r^2 into r^2 times a chi-square variable. The
projected vectors are indexed by a kd-tree (split points from a bounded sample; every vector is in a
leaf, every leaf has its exact bounding box). A query visits the leaves in the order of their distance from its projection, a few first,
then more, then the rest, and verifies vectors on the original ones. With d_k, its k-th distance so far, a leaf or a vector at projected
distance b is left out once chi2_cdf(b^2 / d_k^2) >= ``sure``: each true neighbour is lost with probability 1 - ``sure``
at most. d_k is renewed from round to round, and inside a leaf after the vectors nearest in projection are verified; no
product is formed with a vector that fails the test.

Neighbouring leaves are met in bundles of at most ``CHUNK_VECTORS`` vectors: a query is sent once to a bundle, with a bit for every leaf in
it that is due. Bundles with many vectors or queries (a vector that a third of all rows share) are split into chunks, each
chunk of vectors meeting each chunk of queries. A query that little can be left out for goes to most bundles, so what a task
holds at once is bounded: distances to ``BLOCK_CELLS`` boxes, and ``BLOCK_BYTES`` of vectors in a batch.

Vectors NULL, zero, or holding NULL or non-finite components take no part, nor do rows
without an id. Queries meet vectors of their own dimension only. A query id that repeats is asked once, with its
least vector; repeated candidates are candidates of their own. Other columns are not read; without queries or
candidates there are no rows.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

DIMS, SURE = 8, 0.97
LEAF_ROWS, MOST_LEAVES = 512, 8192
CHUNK_VECTORS, CHUNK_QUERIES, BUNDLE_LEAVES = 4096, 2048, 32
#: Pairs of a query and a box, and bytes of query vectors, that a task holds at once while it lists the leaves to visit.
BLOCK_CELLS, BLOCK_BYTES = 1 << 18, 4 << 20
#: Vectors that the split points are read from, at most, and their bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 32_768, 64 << 20
#: Leaves, by nearness, up to which the rounds go (the last one takes all).
ROUNDS = (3, 16, MOST_LEAVES)
_DENSE = 0.25                          # share of products from which a whole matrix product is cheaper


def chi_square_cdf(x: float, dims: int) -> float:
    """For an even number of dimensions: 1 - exp(-x/2) * sum of (x/2)^i / i!."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))


def chi_square_point(p: float, dims: int) -> float:
    """The x at which the distribution function reaches ``p``."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < p else (low, mid)
    return high


@dataclass
class Index:
    """Projection and kd-tree; boxes are filled in once all vectors are placed."""

    norm: float
    matrix: np.ndarray
    axis: list[int]
    split: list[float]
    left: list[int]                    # node numbers; leaves are -1 - leaf
    right: list[int]
    leaves: int = 1
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    rows: np.ndarray | None = None
    bundle: np.ndarray | None = None   # of every leaf, and its place there
    bit: np.ndarray | None = None

    @classmethod
    def build(cls, sample: np.ndarray, norm: float, leaves: int, dims: int, seed: int = 5) -> Index:
        matrix = np.random.default_rng([seed, sample.shape[1]]).standard_normal((sample.shape[1] + 1, dims))
        index = cls(norm, matrix, [], [], [], [], 0)
        points = index.project(sample, False)

        def grow(rows: np.ndarray, most: int) -> int:
            spread = np.ptp(points[rows], axis=0)
            if most <= 1 or len(rows) < 2 or spread.max() <= 0:
                index.leaves += 1
                return -index.leaves
            axis = int(spread.argmax())
            values = points[rows, axis]
            at = float(np.median(values))
            below = values < at
            if not below.any():
                at = float(values[values > at].min())
                below = values < at
            node = len(index.axis)
            index.axis.append(axis)
            index.split.append(at)
            index.left.append(0)
            index.right.append(0)
            index.left[node] = grow(rows[below], most // 2)
            index.right[node] = grow(rows[~below], most - most // 2)
            return node

        grow(np.arange(len(points)), leaves)
        return index

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        length = np.sqrt((x * x).sum(axis=1))
        if query:
            return (x * (self.norm / length)[:, None]) @ self.matrix[:-1]
        rest = np.sqrt(np.maximum(self.norm ** 2 - length ** 2, 0))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64) if self.axis else np.full(len(points), -1)
        axis, split, left, right = map(np.array, (self.axis, self.split, self.left, self.right))
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            node[inner] = np.where(points[inner, axis[at]] < split[at], left[at], right[at])
        return -1 - node

    def box_distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every leaf's box (infinite for empty leaves)."""
        out = np.zeros((len(points), self.leaves))
        for i in range(points.shape[1]):
            p = points[:, i:i + 1]
            out += np.square(np.maximum(np.maximum(self.low[:, i] - p, p - self.high[:, i]), 0))
        out[:, self.rows == 0] = np.inf
        return out

    def tie(self) -> None:
        """Bundles of consecutive leaves with at most CHUNK_VECTORS vectors together; a larger leaf stays alone."""
        self.bundle, self.bit = np.zeros(self.leaves, np.int64), np.zeros(self.leaves, np.int64)
        at, size, held = 0, 0, 0
        for leaf, n in enumerate(self.rows.tolist()):
            if held and (size + n > CHUNK_VECTORS or held == BUNDLE_LEAVES):
                at, size, held = at + 1, 0, 0
            self.bundle[leaf], self.bit[leaf] = at, held
            size, held = size + n, held + 1

    def bundle_rows(self) -> np.ndarray:
        return np.bincount(self.bundle, weights=self.rows).astype(np.int64)


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(
        F.forall("vec", good) & F.exists("vec", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _meet(left: pa.Table, right: pa.Table, k: int, index: Index, stop: float) -> pa.Table:
    """The best k candidates (above the query's floor) of a chunk of a bundle's vectors for each query of a chunk, leaf by leaf; and per
    query and leaf a row without vec_id that says how many vectors were verified."""
    found: list[list[np.ndarray]] = [[], [], [], []]
    if left.num_rows and right.num_rows:
        ids, v, leaf = left.column("vec_id").to_numpy(), _matrix(left.column("vec")), left.column("leaf").to_numpy()
        qids, floors, due = (right.column(c).to_numpy() for c in ("query_id", "floor", "due"))
        q = _matrix(right.column("vec"))
        pv, pq = index.project(v, False), index.project(q, True)
        size = (pv * pv).sum(axis=1)
        scale = index.norm / np.sqrt((q * q).sum(axis=1))
        for at in np.unique(leaf).tolist():
            own, asked = np.flatnonzero(leaf == at), np.flatnonzero(due >> index.bit[at] & 1)
            some = ids[own], v[own], pv[own], size[own]
            for start in range(0, len(asked), 256):
                rows = asked[start:start + 256]
                _meet_block(found, some, (qids[rows], q[rows], pq[rows], floors[rows], scale[rows]), k, index, stop)
    query, vec, score, verified = (np.concatenate(f) if f else np.zeros(0) for f in found)
    lacks = verified >= 0
    return pa.Table.from_arrays([pa.array(query.astype(np.int64)), pa.array(vec.astype(np.int64), mask=lacks), pa.array(score.astype(float), mask=lacks),
                                 pa.array(np.maximum(verified, 0).astype(np.int64))], names=["query_id", "vec_id", "score", "verified"])


def _meet_block(found: list[list[np.ndarray]], vectors: tuple, queries: tuple, k: int, index: Index, stop: float) -> None:
    """Add to ``found`` (ids of query and vector, score, -1) for each query's best of one leaf, and (id, 0, 0, vectors verified)."""
    ids, v, pv, size = vectors
    own, part, pq, floor, scale = queries
    gaps = np.maximum((pq ** 2).sum(axis=1)[:, None] + size - 2 * (pq @ pv.T), 0)
    gaps[own[:, None] == ids[None, :]] = np.inf
    verified = np.zeros(len(part), np.int64)
    few = min(len(ids), 2 * k)
    if len(ids) > few:                      # the vectors nearest in projection give a first d_k
        close = np.argpartition(gaps, few - 1, axis=1)[:, :few]
        scores = np.einsum("id,ijd->ij", part, v[close])
        scores[~np.isfinite(np.take_along_axis(gaps, close, axis=1))] = -np.inf
        floor = np.maximum(floor, np.partition(scores, few - k, axis=1)[:, few - k])
        verified += few
    with np.errstate(invalid="ignore"):
        reach = np.where(np.isfinite(floor), np.maximum(2 * index.norm ** 2 - 2 * scale * floor, 0) * stop, np.inf)
    # rounding must not lose a vector at the query's own place
    due = np.isfinite(gaps) & (gaps <= reach[:, None] + 1e-9 * index.norm ** 2)
    rows, cols = np.nonzero(due)
    verified = np.maximum(verified, np.bincount(rows, minlength=len(part)))
    # products of one matrix product may differ in the last bits for equal vectors: keep a margin, then score anew
    if len(rows) > _DENSE * due.size:
        scores = np.where(due, part @ v.T, -np.inf)
        least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(part), -np.inf)
        least = np.maximum(least, floor)
        margin = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
        rows, cols = np.nonzero((scores >= (least - margin)[:, None]) & due)
    step = max(1, BLOCK_BYTES // (8 * v.shape[1]))
    exact = np.concatenate([(part[rows[i:i + step]] * v[cols[i:i + step]]).sum(axis=1) for i in range(0, len(rows), step)] or [np.zeros(0)])
    order = np.lexsort((ids[cols], -exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    n, none = int(best.sum()), np.zeros(len(part))
    for held, new in zip(found, ((own[rows[best]], own), (ids[cols[best]], none.astype(np.int64)), (exact[best], none), (np.full(n, -1), verified))):
        held += new


def _round(vectors: DataFrame, due: DataFrame, first: int, last: int, index: Index, shared, k: int, stop: float) -> DataFrame:
    """Candidates (query_id, vec_id, score, verified) of the queries ``due`` (vec_id, vec, kth) in their leaves from the ``first`` up to
    the ``last`` by nearness that their d_k so far leaves due."""
    spark = vectors.sparkSession

    def listed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of a block of queries: its first row, and for each bundle to visit the row, the bundle and the bits of its leaves."""
        x = shared.value
        step = max(1, BLOCK_CELLS // x.leaves)
        starts = np.flatnonzero(np.r_[True, np.diff(x.bundle) > 0])
        for start in range(0, batch.num_rows, step):
            block = batch.slice(start, step)
            q = _matrix(block.column("vec"))
            gaps = x.box_distances(x.project(q, True))
            place = np.argsort(np.argsort(gaps, axis=1, kind="stable"), axis=1, kind="stable")
            kth = block.column("kth").to_numpy(zero_copy_only=False).astype(float)
            scale = x.norm / np.sqrt((q * q).sum(axis=1))
            # d_k^2 of the scaled query; without k candidates every leaf is due
            reach = np.where(np.isnan(kth), np.inf, np.maximum(2 * x.norm ** 2 - 2 * scale * kth, 0) * stop + 1e-9 * x.norm ** 2)
            near = (place >= first) & (place < last) & np.isfinite(gaps) & (gaps <= reach[:, None])
            bits = np.add.reduceat(near << x.bit, starts, axis=1)
            rows, bundles = np.nonzero(bits)
            yield start, rows, bundles, bits[rows, bundles]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros(int(shared.value.bundle[-1]) + 1, np.int64)
        for batch in batches:
            for _, _, bundles, _ in listed(batch):
                asked += np.bincount(bundles, minlength=len(asked))
        some = np.flatnonzero(asked)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(asked[some])], names=["bundle", "n"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows, bundles, bits in listed(batch):
                block, step = batch.slice(start), max(1, BLOCK_BYTES // (8 * shared.value.matrix.shape[0]))
                kth = block.column("kth").to_numpy(zero_copy_only=False).astype(float)
                floor = np.where(np.isnan(kth), -np.inf, kth)
                for i in range(0, len(rows), step):
                    at = rows[i:i + step]
                    yield pa.RecordBatch.from_arrays(
                        [block.column("vec_id").take(pa.array(at)), block.column("vec").take(pa.array(at)), pa.array(floor[at]),
                         pa.array(bundles[i:i + step].astype(np.int32)), pa.array(bits[i:i + step])], names=["query_id", "vec", "floor", "bundle", "due"])

    # few queries come in one partition, but may have many leaves to visit
    due = due.repartition(spark.sparkContext.defaultParallelism, "vec_id")
    asked = {r["bundle"]: r["n"] for r in due.mapInArrow(counted, "bundle int, n long").groupBy("bundle").agg(F.sum("n").alias("n")).collect()}   # one row per bundle at most
    rows = index.bundle_rows()
    plan = spark.createDataFrame(
        [(b, max(1, -(-int(rows[b]) // CHUNK_VECTORS)), -(-n // CHUNK_QUERIES)) for b, n in sorted(asked.items())]
        or [(-1, 1, 1)], "bundle int, v_parts int, q_parts int")
    def salted(df, own, own_parts, other, other_parts):
        return (df.join(F.broadcast(plan), "bundle")
                .withColumn(own, F.pmod(F.xxhash64("vec_id" if own == "vp" else "query_id"), F.col(own_parts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1))).drop("v_parts", "q_parts"))
    keys = ["bundle", "vp", "qp"]
    asking = due.mapInArrow(visits, "query_id long, vec array<double>, floor double, bundle int, due long")
    v = salted(vectors, "vp", "v_parts", "qp", "q_parts").groupBy(*keys)
    q = salted(asking, "qp", "q_parts", "vp", "v_parts").groupBy(*keys)
    return v.cogroup(q).applyInArrow(lambda a, b: _meet(a, b, k, shared.value, stop), "query_id long, vec_id long, score double, verified long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, and its count of verified vectors on its rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.where("vec_id is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.drop("verified").join(found.groupBy("query_id").agg(F.sum("verified").alias("verified")), "query_id")


def nearest(base: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            dims: int = DIMS, sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score, verified): each query's ``k`` nearest found among ``base`` (but its own id), best first, and
    on how many original vectors the query was verified."""
    spark = base.sparkSession
    vectors = _usable(base, vec_id, vector)
    asked = _usable(queries, vec_id, vector).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    sizes = {r["d"]: r for r in vectors.groupBy(F.size("vec").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(square).alias("norm")).collect()}
    wanted = [r["d"] for r in asked.select(F.size("vec").alias("d")).distinct().collect()]
    parts = [_nearest_of(vectors.where(F.size("vec") == d), asked.where(F.size("vec") == d), d, sizes[d]["n"],
                         math.sqrt(sizes[d]["norm"]), k, dims, sure) for d in sorted(wanted) if d in sizes]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, verified long")
    return reduce(DataFrame.unionByName, parts).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "verified")


def _nearest_of(vectors: DataFrame, asked: DataFrame, d: int, n: int, norm: float, k: int, dims: int, sure: float) -> DataFrame:
    spark = vectors.sparkSession
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * d)))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003))
    sample = vectors.where(place < max(1, min(1.0, 1.5 * most / n) * 1_000_003)).orderBy(place, "vec_id").limit(most)
    points = np.array([r["vec"] for r in sample.select("vec").toLocalIterator()], float).reshape(-1, d)
    index = Index.build(points if len(points) else np.zeros((1, d)), norm, min(MOST_LEAVES, -(-n // LEAF_ROWS), max(1, len(points) // 4)), dims)
    shared = spark.sparkContext.broadcast(index)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.project(_matrix(batch.column("vec")), False) if batch.num_rows else np.zeros((0, dims))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.leaf_of(p).astype(np.int32)), *[pa.array(p[:, i].copy()) for i in range(dims)]],
                names=["vec_id", "vec", "leaf", *[f"p{i}" for i in range(dims)]])

    schema = "vec_id long, vec array<double>, leaf int"
    held = vectors.mapInArrow(placed, schema + "".join(f", p{i} double" for i in range(dims)))
    boxes = held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[f(f"p{i}").alias(f"{f.__name__}{i}")
                                                                 for i in range(dims) for f in (F.min, F.max)]).collect()
    index.low, index.high = np.zeros((index.leaves, dims)), np.zeros((index.leaves, dims))
    index.rows = np.zeros(index.leaves, np.int64)
    for r in boxes:                              # one row per leaf: MOST_LEAVES at most
        index.rows[r["leaf"]] = r["n"]
        index.low[r["leaf"]] = [r[f"min{i}"] for i in range(dims)]
        index.high[r["leaf"]] = [r[f"max{i}"] for i in range(dims)]
    index.tie()
    boxed = spark.sparkContext.broadcast(index)
    stop = chi_square_point(sure, dims)

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = boxed.value
        for batch in batches:
            leaf = x.leaf_of(x.project(_matrix(batch.column("vec")), False) if batch.num_rows else np.zeros((0, dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(x.bundle[leaf].astype(np.int32))],
                                             names=["vec_id", "vec", "leaf", "bundle"])

    slim = vectors.mapInArrow(bundled, "vec_id long, vec array<double>, leaf int, bundle int")
    due, met, first = asked.withColumn("kth", F.lit(None).cast("double")), None, 0
    for last in ROUNDS:
        found = _round(slim, due, first, last, index, boxed, k, stop)
        met = found if met is None else met.drop("rank").unionByName(found)
        if last >= index.leaves:
            break
        first, met = last, materialize(_best(met, k))
        # the rows of a query carry its count: kept once
        met = met.withColumn("verified", F.when(F.col("rank") == 1, F.col("verified")).otherwise(F.lit(0)))
        kth = met.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
        due = asked.join(kth, "vec_id", "left").select("vec_id", "vec", "kth")
    return _best(met, k)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = spark.read.parquet(os.path.join(sf_dir, "embeddings.parquet")).select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0)).drop("verified")

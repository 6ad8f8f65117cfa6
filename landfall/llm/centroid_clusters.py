"""Centroid clustering of integer vectors (Lloyd's rounds, exact) with the
Shallot search.

Every vector carries its centroid, its second-nearest centroid, an upper bound
on the distance to the first and a lower bound on the distances to all others.
When centroids move, the bounds move with them; only vectors whose bounds meet
are searched. A search starts from the closer of the two remembered centroids
and visits that one's neighbours by their distance from it. It ends where the
gap between the two centroids exceeds the vector's distance to the start plus
that to the second best so far: nothing further away can come first or second.
This ball shrinks whenever the second best improves. Survivors are compared by
squared distances in exact integers, ties by number; bounds are only used where
they hold with room for rounding.

A round is one pass over a written table, a row per vector; the rows of a batch
are searched together in numpy. Each batch adds a row of component sums, which
Spark adds up. The driver holds K centroids. A lost executor reads the table of
the round before again.

Defined cases: vectors that are null, have not exactly WIDTH components, or
hold null or non-finite ones are left out; a null vec_id takes part but never
starts a centroid before others; rows with equal vec_id are vectors of their
own (equal hashes: by components); with fewer than K vectors every one starts a
centroid; equal centroids keep their numbers, the smaller one takes all;
components beyond +-LIMIT are set to it, so that distances fit a long; an
inertia beyond a long is the largest long; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.session import delete_uri
from landfall.sources.constants import values_frame

from .common import Scratch, utf8_column

WIDTH = 64
K = 40
ROUNDS = 5
SCALE = 256
SALT = "2:"
LIMIT = 1 << 26
EXACT_IN_DOUBLES = 1 << 21  # below it sums of WIDTH squared differences are exact in doubles
FIRST_CANDIDATES = 400      # expected number of vectors among which the K starts are sought first
SLACK = 1e-9                # relative; far above the rounding of square roots and sums of moves
_LONG_MAX = (1 << 63) - 1

_STATE = ("kind int, vec_id long, point binary, own int, second int, upper double, lower double, sums array<long>")


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances row by row."""
    d = a - b
    return np.einsum("ij,ij->i", d, d).astype(np.int64)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + SLACK)


def _below(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 - SLACK)


class Centroids:
    """The centroids of a round, their gaps, and how far each has moved."""

    def __init__(self, points: np.ndarray, before: np.ndarray | None = None):
        self.points = points = np.asarray(points, np.int64)
        k = len(points)
        squares = np.stack([_squared(points, np.broadcast_to(p, points.shape)) for p in points])
        np.fill_diagonal(squares, -1)
        self.order = np.argsort(squares, axis=1, kind="stable")  # itself first
        np.fill_diagonal(squares, 0)
        self.gap = _below(squares)
        self.half = self.gap[np.arange(k), self.order[:, 1]] / 2 if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k) if before is None else _above(_squared(points, np.asarray(before, np.int64)))
        top = np.argsort(-self.moved, kind="stable")
        self.others_moved = np.full(k, self.moved[top[0]])
        self.others_moved[top[0]] = self.moved[top[1]] if k > 1 else 0.0


def _exact(values: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and centroids in a type that holds squared distances exactly."""
    largest = max(np.abs(values).max(initial=0), np.abs(centroids.points).max(initial=0))
    kind = np.float64 if largest < EXACT_IN_DOUBLES else np.int64
    return values.astype(kind), centroids.points.astype(kind)


def search(x: np.ndarray, points: np.ndarray, centroids: Centroids, start: np.ndarray, best: np.ndarray,
           other: np.ndarray, other_best: np.ndarray):
    """(nearest, its square, second, its square) of each vector. ``start`` is
    the closer of the two known centroids, ``other`` the second one."""
    first, first_d, second, second_d = start.copy(), best.copy(), other.copy(), other_best.copy()
    reach = _above(best)
    for r in np.unique(start):
        here = np.flatnonzero(start == r)
        for j in centroids.order[r, 1:]:
            here = here[centroids.gap[r, j] <= reach[here] + _above(second_d[here])]  # the ball only shrinks
            if not len(here):
                break
            at = here[other[here] != j]
            d = _squared(x[at], points[j])
            wins = (d < first_d[at]) | ((d == first_d[at]) & (j < first[at]))
            places = ~wins & ((d < second_d[at]) | ((d == second_d[at]) & (j < second[at])))
            w, p = at[wins], at[places]
            second[w], second_d[w] = first[w], first_d[w]
            first[w], first_d[w] = j, d[wins]
            second[p], second_d[p] = j, d[places]
    return first, first_d, second, second_d


def assign(x: np.ndarray, points: np.ndarray, centroids: Centroids, own, second, upper, lower):
    """The next (own, second, upper, lower) of vectors whose centroids moved;
    ``own`` below 0 means that nothing is known yet. Also returns how many
    vectors had to be searched."""
    new = own < 0
    own, second = np.where(new, 0, own), np.where(new, min(1, len(points) - 1), second)
    upper = np.where(new, np.inf, upper + centroids.moved[own])
    lower = np.where(new, -np.inf, lower - centroids.others_moved[own])
    if len(points) == 1:
        return own, second, upper, lower, 0
    safe = np.maximum(lower, centroids.half[own])
    left = np.flatnonzero(upper * (1 + SLACK) >= safe)
    d_own = _squared(x[left], points[own[left]])
    upper[left] = _above(d_own)
    close = upper[left] * (1 + SLACK) >= safe[left]
    left, d_own = left[close], d_own[close]
    a, b = own[left], second[left]
    d_second = _squared(x[left], points[b])
    swap = (d_second < d_own) | ((d_second == d_own) & (b < a))
    first, first_d, again, again_d = search(
        x[left], points, centroids, np.where(swap, b, a), np.where(swap, d_second, d_own),
        np.where(swap, a, b), np.where(swap, d_own, d_second))
    own[left], second[left] = first, again
    upper[left], lower[left] = _above(first_d), _below(again_d)
    return own, second, upper, lower, len(left)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(
        F.col("embedding").isNotNull() & (F.size("embedding") == WIDTH) & ~bad)


def _points(column: pa.Array) -> np.ndarray:
    """int64 rows of a column of little-endian int32 rows."""
    data, _ = utf8_column(column)
    return np.frombuffer(data.tobytes(), "<i4").reshape(-1, WIDTH).astype(np.int64)


def _binary_rows(values: np.ndarray) -> pa.Array:
    """A binary value per row of int32 values."""
    data = np.ascontiguousarray(values, "<i4").tobytes()
    offsets = np.arange(len(values) + 1, dtype=np.int32) * (4 * WIDTH)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _state_rows(vec_id, point, own, second, upper, lower) -> pa.RecordBatch:
    n = len(own)
    return pa.record_batch(
        [pa.array(np.zeros(n, np.int32)), vec_id, point, pa.array(own, pa.int32()), pa.array(second, pa.int32()),
         pa.array(upper, pa.float64()), pa.array(lower, pa.float64()), pa.nulls(n, pa.list_(pa.int64()))],
        names=[f.split()[0] for f in _STATE.split(", ")])


def _sum_row(sums: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
         pa.nulls(1, pa.int32()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64()),
         pa.array([sums.tolist()], pa.list_(pa.int64()))], names=[f.split()[0] for f in _STATE.split(", ")])


def integer_rows(kept: DataFrame) -> DataFrame:
    """State rows of vectors about which nothing is known yet."""
    def run(batches):
        for b in batches:
            n = b.num_rows
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, WIDTH)
            whole = np.clip(np.floor(np.clip(x, -LIMIT, LIMIT) * SCALE), -LIMIT, LIMIT)
            unknown = np.full(n, -1, np.int32)
            yield _state_rows(b.column(0), _binary_rows(whole.astype(np.int64)), unknown, unknown,
                              np.zeros(n), np.zeros(n))

    return kept.mapInArrow(run, _STATE)


def next_round(table: DataFrame, centroids) -> DataFrame:
    """State rows after an assignment to the broadcast ``centroids``, and per
    batch a row with the count and the component sums of each cluster."""
    def run(batches):
        c = centroids.value
        k = len(c.points)
        for b in batches:
            values = _points(b.column(1))
            x, points = _exact(values, c)
            state = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            own, second, upper, lower, _ = assign(x, points, c, *state)
            yield _state_rows(b.column(0), b.column(1), own, second, upper, lower)
            sums = np.zeros((k, WIDTH + 1), np.int64)
            np.add.at(sums, own, np.concatenate([np.ones((len(own), 1), np.int64), values], axis=1))
            yield _sum_row(sums.ravel())

    return table.where("kind = 0").select("vec_id", "point", "own", "second", "upper", "lower").mapInArrow(run, _STATE)


def last_round(table: DataFrame, centroids) -> DataFrame:
    """(vec_id, cluster, distance) after a last assignment."""
    def run(batches):
        c = centroids.value
        for b in batches:
            x, points = _exact(_points(b.column(1)), c)
            state = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            own = assign(x, points, c, *state)[0]
            yield pa.record_batch([b.column(0), pa.array(own, pa.int32()), pa.array(_squared(x, points[own]))],
                                  names=["vec_id", "cluster", "distance"])

    return table.where("kind = 0").select("vec_id", "point", "own", "second", "upper", "lower").mapInArrow(
        run, "vec_id long, cluster int, distance long")


def starting_points(kept: DataFrame, n: int, k: int) -> np.ndarray:
    """The k of ``n`` vectors with the smallest hashes, in their order. Only
    vectors below a hash that lets FIRST_CANDIDATES pass on average are looked
    at; the bound is raised while they are too few."""
    order = F.sha2(F.concat(F.lit(SALT), F.col("vec_id").cast("string")).cast("binary"), 256)
    whole = F.transform("embedding", lambda x: F.floor(
        F.least(F.greatest(x, F.lit(float(-LIMIT))), F.lit(float(LIMIT))) * SCALE))
    rows = kept.select(order.alias("order"), F.transform(whole, lambda x: F.least(
        F.greatest(x, F.lit(-LIMIT)), F.lit(LIMIT)).cast("int")).alias("point"))
    share = FIRST_CANDIDATES / max(n, 1)
    while True:
        among = rows if share >= 1 else rows.where(F.col("order") < f"{int(share * 2 ** 32):08x}")
        found = among.orderBy(F.asc_nulls_last("order"), "point").limit(k).collect()  # K rows
        if share >= 1 or len(found) == min(k, n):
            return np.array([r["point"] for r in found], np.int64).reshape(-1, WIDTH)
        share *= 8


def moved_centroids(table: DataFrame, points: np.ndarray) -> np.ndarray:
    """The floors of the clusters' means; an empty cluster's centroid stays."""
    sums = table.where("kind = 1").select(F.posexplode("sums").alias("place", "part")).groupBy("place").agg(
        F.sum("part").alias("total")).collect()  # K * (WIDTH + 1) rows
    total = np.zeros(len(points) * (WIDTH + 1), np.int64)
    for r in sums:
        total[r["place"]] = r["total"]
    total = total.reshape(len(points), WIDTH + 1)
    out = points.copy()
    some = total[:, 0] > 0
    out[some] = total[some, 1:] // total[some, :1]  # numpy floors
    return out


def clusters(spark, vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every vector that takes part."""
    schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                           T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    with Scratch(spark, "clusters") as scratch:
        kept = kept_vectors(vectors)
        uri, table = _written(scratch, integer_rows(kept), "vectors")
        points = starting_points(kept, table.count(), k)
        centroids = Centroids(points) if len(points) else None
        for i in range(rounds if len(points) else 0):
            old = uri
            uri, table = _written(scratch, next_round(table, spark.sparkContext.broadcast(centroids)), f"round-{i + 1}")
            delete_uri(spark, old)
            moved = moved_centroids(table, centroids.points)
            centroids = Centroids(moved, centroids.points)
        if not len(points):
            return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                             "inertia long, centroid_sha256 string")
        found = scratch.keep(last_round(table, spark.sparkContext.broadcast(centroids)), "result", result=True)
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}  # K rows
    total = min(sum(inertia.values()), _LONG_MAX)
    rows = [(c, min(inertia[c], _LONG_MAX), total,
             hashlib.sha256(",".join(map(str, centroids.points[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    known = F.broadcast(values_frame(spark, rows, schema))  # at most K rows
    return found.join(known, F.col("cluster") == F.col("c")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _written(scratch: Scratch, df: DataFrame, tag: str) -> tuple[str, DataFrame]:
    uri = scratch.path(tag)
    scratch.temporary(uri)
    df.write.parquet(uri)
    return uri, scratch.spark.read.schema(df.schema).parquet(uri)

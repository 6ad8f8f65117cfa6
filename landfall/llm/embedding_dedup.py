"""Embedding near-duplicates by int8 tile products with error bounds.

Vectors with equal label and length are dealt to tiles; each pair of tiles is
one task. A unit vector ``u`` is quantised to ``s q`` with int8 ``q``; with
``e = |u - s q|`` the cosine of two vectors differs from ``s1 s2 (q1 . q2)``
by at most ``e1 + e2 + e1 e2``. Products that are above or below the threshold
by more than that are decided; only the others are recomputed in doubles.

A tile pair gives a row per vector: how many vectors it links with there, and
one edge to the smallest vector it reaches inside the pair. Links between the
members of a group are counted, never listed. Equal vectors are one with a
count, so a vector that is copied often is dealt once.

Defined cases: a null label or vector, an empty or zero vector, and one with
null or non-finite components link with nothing (n_links 0, component: own
vec_id, kept); vectors of different length do not link; rows that repeat are
vectors that link with each other; a null vec_id gets the smallest id that it
reaches, or null, and is kept only if it reaches none; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

THRESHOLD = 0.98
TILE = 1024            # vectors of a tile, on average
EXACT_PAIRS = 1 << 15  # pairs recomputed at once
EXACT_COLUMNS = 1024   # 127 * 127 * 1024 < 2 ** 24: float32 sums of int8 products are exact
SLACK = 1e-12          # rounding of the bounds themselves


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit rows, int8 codes, scales, error norms) of double rows."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return unit, codes, scale, error


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as doubles."""
    total = np.zeros((len(a), len(b)))
    for c in range(0, a.shape[1], EXACT_COLUMNS):
        total += a[:, c:c + EXACT_COLUMNS].astype(np.float32) @ b[:, c:c + EXACT_COLUMNS].astype(np.float32).T
    return total


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row cosine in doubles."""
    top_x, top_y = np.abs(x).max(axis=1, keepdims=True), np.abs(y).max(axis=1, keepdims=True)
    x, y = x / top_x, y / top_y
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Boolean matrix of the row pairs with cosine >= threshold."""
    _, qx, sx, ex = quantise(x)
    _, qy, sy, ey = quantise(y)
    near = code_products(qx, qy) * sx[:, None] * sy[None, :]
    bound = ex[:, None] + ey[None, :] + ex[:, None] * ey[None, :] + SLACK
    links = near - bound >= threshold
    i, j = np.nonzero(~links & (near + bound >= threshold))
    for at in range(0, len(i), EXACT_PAIRS):
        a, b = i[at:at + EXACT_PAIRS], j[at:at + EXACT_PAIRS]
        links[a, b] = cosines(x[a], y[b]) >= threshold
    return links


def least_reached(links: np.ndarray, ids_x: np.ndarray, ids_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and per column the smallest id that it reaches in the bipartite
    graph of the links, its own included."""
    low_x, low_y = ids_x.copy(), ids_y.copy()
    i, j = np.nonzero(links)
    while len(i):
        before_x, before_y = low_x.copy(), low_y.copy()
        np.minimum.at(low_x, i, low_y[j])
        np.minimum.at(low_y, j, low_x[i])
        if (low_x == before_x).all() and (low_y == before_y).all():
            break
    return low_x, low_y


def _tile_pair(table: pa.Table) -> pa.Table:
    ids = table.column("class_id").to_numpy()
    counts = table.column("n").to_numpy()
    first = table.column("tile").to_numpy() == table.column("low_tile").to_numpy()
    width = table.column("width")[0].as_py()
    x = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = x.astype(np.float64).reshape(-1, width)
    same = table.column("low_tile")[0].as_py() == table.column("high_tile")[0].as_py()
    a = np.flatnonzero(first)
    b = a if same else np.flatnonzero(~first)
    if not len(a) or not len(b):
        return _linked_rows([], [], [])
    links = tile_links(x[a], x[b])
    if same:
        np.fill_diagonal(links, False)
    low_a, low_b = least_reached(links, ids[a], ids[b])
    n_a, n_b = links @ counts[b], counts[a] @ links
    if same:
        low, n, rows = np.minimum(low_a, low_b), n_a, a
    else:
        low, n, rows = np.concatenate([low_a, low_b]), np.concatenate([n_a, n_b]), np.concatenate([a, b])
    some = n > 0
    return _linked_rows(ids[rows][some], n[some], low[some])


def _linked_rows(ids, n, low) -> pa.Table:
    return pa.table({"class_id": pa.array(ids, pa.int64()), "links": pa.array(n, pa.int64()),
                     "low": pa.array(low, pa.int64())})


def classes_of(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Distinct vectors: (label, h1, h2, width, class_id, n, first_id, vector, tile, n_tiles)."""
    distinct = rows.where("valid").groupBy("label", "h1", "h2", "width").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.first("vector").alias("vector"))
    # written once: the ids stay what they are
    table = scratch.keep(distinct.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    sizes = scratch.keep(table.groupBy(F.col("label").alias("s_label"), F.col("width").alias("s_width"))
                         .agg(F.ceil(F.count("*") / TILE).cast("int").alias("n_tiles")), "label-sizes")
    return table.join(sizes, (F.col("label") == F.col("s_label")) & (F.col("width") == F.col("s_width"))).drop(
        "s_label", "s_width").withColumn(
        "tile", F.pmod(F.xxhash64("class_id"), F.col("n_tiles").cast("long")).cast("int"))


def near_duplicates(spark, vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id,
    embedding, label)."""
    with Scratch(spark, "embedding-dedup") as scratch:
        vector = F.col("embedding").cast("array<double>")
        bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        largest = F.array_max(F.transform(vector, F.abs))
        valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & (largest > 0)
        rows = vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector"),
            F.coalesce(valid, F.lit(False)).alias("valid"), F.xxhash64("embedding").alias("h1"),
            F.hash("embedding").alias("h2"), F.size("embedding").alias("width"))
        classes = scratch.keep(classes_of(scratch, rows), "tiles")
        other = F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1))
        paired = classes.select("label", "width", "class_id", "n", "vector", "tile", other.alias("other")).select(
            "label", "width", "class_id", "n", "vector", "tile",
            F.least("tile", "other").alias("low_tile"), F.greatest("tile", "other").alias("high_tile"))
        found = scratch.keep(paired.groupBy("label", "width", "low_tile", "high_tile").applyInArrow(
            _tile_pair, "class_id long, links long, low long"), "links")
        joined = components(scratch, found.select(F.col("class_id").alias("a"), F.col("low").alias("b")))
        links = found.groupBy(F.col("class_id").alias("l_id")).agg(F.sum("links").alias("links"))
        known = scratch.keep(classes.drop("vector").join(links, F.col("class_id") == F.col("l_id"), "left").join(
            joined, F.col("class_id") == F.col("node"), "left").select(
            F.col("label").alias("k_label"), F.col("h1").alias("k1"), F.col("h2").alias("k2"),
            F.col("width").alias("k_width"), "first_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "class_id").alias("component")), "known")
        lowest = scratch.keep(known.groupBy(F.col("component").alias("c_id")).agg(
            F.min("first_id").alias("component_id")), "lowest")
        known = scratch.keep(known.join(lowest, F.col("component") == F.col("c_id")).drop(
            "component", "c_id", "first_id"), "known-components")
        keys = rows.drop("vector")
        out = keys.join(known, F.col("valid") & (F.col("label") == F.col("k_label")) & (F.col("h1") == F.col("k1"))
                        & (F.col("h2") == F.col("k2")) & (F.col("width") == F.col("k_width")), "left")
        component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
        return scratch.keep(out.select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept")), "result", result=True)

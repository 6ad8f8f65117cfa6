"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are the distinct shingle sets (equal sets are one
row), columns the shingles. The product of the matrix with its transpose holds
every pair's overlap; only entries that can reach the bound are computed:

1. Columns of a row are ordered from rare to common; the order puts shingles
   that repeat within tasks last. Two sets with Jaccard >= t share a column
   among the first ``p = n - ceil(t n) + 1`` of each, whatever the order is,
   and each has at most ``p - 1`` columns that the other lacks.
2. The first ``1.5 p`` columns of each row (``p`` of at most 5) are dealt by column range in packed
   blocks (documents x columns). A range task marks the columns with two rows
   or more; a row with more than ``p - 1`` unmarked columns cannot link.
3. Among the remaining rows, entries of the product are dropped when the sizes
   of two rows, or the columns left after the shared one, cannot give the
   overlap ``t (n1 + n2) / (1 + t)``; the others get their full overlap in
   blocks: an Arrow batch of pairs, counted over (pair, column) keys.

A column with many rows never lists its pairs. First each column is multiplied
with one of its rows per size class, and the links found merge rows into
components. Then only products across components are left: rows are dealt to
tiles by component, a row meets the tiles that hold enough of its columns, and
a task multiplies a block of rows with a tile in full and keeps one link per
row and component.

Defined cases: null, empty and blank texts have no shingles and stay alone;
fewer than ``k`` words are one shingle; equal texts (and texts with equal
sets) are linked; repeated rows are equal texts; a null doc_id gets the
smallest other id that it reaches, or null; an empty table an empty result.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batch_slices, components, row_numbers, utf8_column
from .shingles import Powers, shingle_sets

K = 5
PERCENT = 80           # links need 100 * intersection >= PERCENT * union
SLICE_BYTES = 1 << 19  # text bytes that numpy works on at once
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 1 << 15  # text bytes and rows of a document block
RANGE_COLUMNS = 1 << 19  # columns of a range, about
PAIR_SLICE = 1 << 18   # shingles of the pairs whose overlaps are counted at once
HEAVY = 100_000        # most shingles whose counts order the columns (order only, never results)
STAR_ROUNDS = 1
CHUNK = 2048            # tiles of a column that are packed together
TILE_ROWS = 1024        # rows of a tile, and of a block that meets it
PRODUCTS = 1 << 20      # products that are added up at once


def needed(n):
    """Least overlap of a set of n shingles with any set it links to."""
    return -(-n * PERCENT // 100)


def first_columns(n):
    """(p, columns dealt) of sets of n shingles."""
    p = np.where(n > 0, n - needed(n) + 1, 0)
    # p // 2 more; a set of 5 would miss two of 3 that a set of 4, dealt one, shares with it
    return p, np.minimum(n, p + np.where(n > 5, p // 2, 0))


def _parts(batch, limit: int = SLICE_BYTES):
    """(first row, last row, data, offsets) slices of the text column of a batch."""
    data, offsets = utf8_column(batch.column(1))
    for a, b in batch_slices(offsets, limit):
        for c in range(a, b, BLOCK_ROWS):
            d = min(c + BLOCK_ROWS, b)
            yield c, d, data[offsets[c]:offsets[d]], offsets[c:d + 1] - offsets[c]


def _signed(x):
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _block_sets(data, offsets, k, powers, rank=None):
    """``shingle_sets`` of a block, slice by slice."""
    out = [shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k, powers, rank)
           for a, b in batch_slices(offsets, SLICE_BYTES)]
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[1]) for x in out]))])
    return np.concatenate([x[0] for x in out]), at, np.concatenate([x[2] for x in out])


def sets_and_heavy(docs: DataFrame, k: int) -> DataFrame:
    """kind 0: (doc_id, set id, set size) per document; kind 1: (shingle,
    number of rows, 0) of shingles that repeat within a block."""
    def run(batches):
        powers = Powers()
        for b in batches:
            for lo, hi, data, offsets in _parts(b, BLOCK_BYTES):
                h, at, digest = _block_sets(data, offsets, k, powers)
                yield pa.record_batch(
                    [pa.array(np.zeros(hi - lo, np.int32)), b.column(0).slice(lo, hi - lo),
                     _signed(digest), _signed(np.diff(at))], names=["kind", "a", "b", "c"])
                h.sort()
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
                count = np.diff(np.append(first, len(h)))
                many = count > 1
                yield pa.record_batch(
                    [pa.array(np.ones(many.sum(), np.int32)), _signed(h[first][many]), _signed(count[many]),
                     _signed(np.zeros(many.sum(), np.int64))], names=["kind", "a", "b", "c"])
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "kind int, a long, b long, c long")


class _Ranks:
    """Rank 0 of most shingles; 1 and up (log2 of the count) of the heavy ones."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.ranks = keys, 1 + np.log2(np.maximum(counts, 1)).astype(np.int64)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(keys >> np.uint64(42)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
            out[some] = np.where(self.keys[at] == h[some], self.ranks[at], 0)
        return out


# packed layouts: of dealt columns, and of a block's rows with their heavy columns
_ENTRY = np.dtype([("column", "<u4"), ("more", "u1"), ("row", "<u2"), ("pos", "<u2")])
_ROW = np.dtype([("set", "<i8"), ("n", "<i4")])
_HEAVY = np.dtype([("column", "<i8"), ("row", "<u2"), ("pos", "<u2")])


def column_blocks(docs: DataFrame, k: int, heavy, n_ranges: int) -> DataFrame:
    """(block, range, data, heavy): a row per document block and column range
    with packed entries; range -1 holds the block's rows and heavy columns."""
    def run(batches):
        from pyspark import TaskContext

        powers, ranks = Powers(), _Ranks(*heavy.value)
        block = TaskContext.get().partitionId() << 32
        limits = np.array([(r << 64) // n_ranges for r in range(1, n_ranges)], np.uint64)
        for b in batches:
            for _, _, data, offsets in _parts(b, BLOCK_BYTES):
                h, at, digest = _block_sets(data, offsets, k, powers, ranks)
                sizes = np.diff(at)
                first = np.zeros(len(digest), bool)  # equal sets of a block are one row
                first[np.unique(digest, return_index=True)[1]] = True
                kept = np.flatnonzero(first & (sizes > 0))
                n = sizes[kept]
                take = first_columns(n)[1]
                row = np.repeat(np.arange(len(n)), take)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
                column = h[at[kept][row] + pos]
                is_heavy = ranks(column) > 0
                entry = np.zeros(len(row), _ENTRY)
                entry["column"], entry["more"] = column & np.uint64(0xFFFFFFFF), (column >> np.uint64(32)) & np.uint64(255)
                entry["row"], entry["pos"] = row, np.minimum(pos, 65535)
                table = np.zeros(len(n), _ROW)
                table["set"], table["n"] = digest[kept].view(np.int64), n
                common = np.zeros(is_heavy.sum(), _HEAVY)
                common["column"] = column[is_heavy].view(np.int64)
                common["row"], common["pos"] = row[is_heavy], entry["pos"][is_heavy]
                column, entry = column[~is_heavy], entry[~is_heavy]
                order = np.argsort(column)
                entry = entry[order]
                cuts = np.concatenate([[0], np.searchsorted(column[order], limits), [len(order)]])
                used = np.flatnonzero(np.diff(cuts))
                ranges = [-1, *used.tolist()]
                packed = [table.tobytes(), *(entry[cuts[r]:cuts[r + 1]].tobytes() for r in used)]
                yield pa.record_batch(
                    [pa.array([block] * len(ranges), pa.int64()), pa.array(ranges, pa.int32()),
                     pa.array(packed, pa.binary()),
                     pa.array([common.tobytes()] + [None] * len(used), pa.binary())],
                    names=["block", "range", "data", "heavy"])
                block += 1
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "block long, range int, data binary, heavy binary")


def shared_columns(blocks: DataFrame) -> DataFrame:
    """(block, range, data): the entries whose column has two rows or more."""
    def mark(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), _ENTRY) for x in table.column("data")]
        every = np.concatenate(parts)
        column = every["column"].astype(np.uint64) | every["more"].astype(np.uint64) << np.uint64(32)
        order = np.argsort(column)
        sorted_ = column[order]
        same = np.append(False, sorted_[1:] == sorted_[:-1])
        marked = np.zeros(len(every), bool)
        marked[order] = same | np.append(same[1:], False)
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        out = [x[m].tobytes() for x, m in zip(parts, np.split(marked, cuts), strict=True)]
        return pa.table({"block": table.column("block"), "range": table.column("range"),
                         "data": pa.array(out, pa.binary())})

    return blocks.where("range >= 0").select("block", "range", "data").groupBy("range").applyInArrow(
        mark, "block long, range int, data binary")


def possible_entries(blocks: DataFrame, shared: DataFrame) -> DataFrame:
    """(shingle, set, n, pos): dealt columns of the rows that have few enough
    columns of their own. A block's rows come together again here."""
    def unpack(table: pa.Table) -> pa.Table:
        ranges = table.column("range").to_pylist()
        head = ranges.index(-1)
        rows = np.frombuffer(table.column("data")[head].as_py(), _ROW)
        heavy = np.frombuffer(table.column("heavy")[head].as_py(), _HEAVY)
        parts = [(r, np.frombuffer(x.as_py(), _ENTRY))
                 for r, x in zip(ranges, table.column("data"), strict=True) if r >= 0]
        column = [(p["column"].astype(np.int64) | p["more"].astype(np.int64) << 32) + (r << 40) for r, p in parts]
        column = np.concatenate([heavy["column"], *column])
        row = np.concatenate([heavy["row"], *(p["row"] for _, p in parts)]).astype(np.int64)
        pos = np.concatenate([heavy["pos"], *(p["pos"] for _, p in parts)]).astype(np.int64)
        n = rows["n"].astype(np.int64)
        p, dealt = first_columns(n)
        can = dealt - np.bincount(row, minlength=len(n)) <= p - 1
        good = can[row]
        return pa.table({"shingle": pa.array(column[good]), "set": pa.array(rows["set"][row[good]]),
                         "n": pa.array(rows["n"][row[good]]), "pos": pa.array(pos[good].astype(np.int32))})

    heads = blocks.where("range = -1").select("block", "range", "data", "heavy")
    every = heads.unionByName(shared.withColumn("heavy", F.lit(None).cast("binary")))
    return every.groupBy("block").applyInArrow(unpack, "shingle long, set long, n int, pos int")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(set, shingles): sorted hashes of the whole set of each document."""
    def run(batches):
        powers = Powers()
        for b in batches:
            for _, _, data, offsets in _parts(b):
                h, at, digest = shingle_sets(data, offsets, k, powers)
                out = pa.record_batch(
                    [_signed(digest), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _signed(h))],
                    names=["set", "shingles"])
                yield out.take(pa.array(np.unique(digest, return_index=True)[1]))  # equal sets once
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "set long, shingles array<long>")


def _block_overlaps(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Overlap of each pair of rows: the wanted entries of the sparse product
    of two blocks, counted over (pair, column) keys that both sides hold."""
    def flat(x):
        return x.flatten().to_numpy(zero_copy_only=False), np.diff(x.offsets.to_numpy())

    (a, na), (b, nb) = flat(left), flat(right)
    columns, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    width = max(len(columns), 1)
    pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
    keys = np.sort(pair * width + inverse)
    both = keys[1:][keys[1:] == keys[:-1]]
    return np.bincount(both // width, minlength=len(na))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose full overlap reaches the bound."""
    def run(batches):
        for batch in batches:
            # blocks of bounded size, however long the sets are
            sizes = np.diff(batch.column(2).offsets.to_numpy()) + np.diff(batch.column(3).offsets.to_numpy())
            for lo, hi in batch_slices(np.append(0, np.cumsum(sizes)), PAIR_SLICE):
                part = batch.slice(lo, hi - lo)
                x, y = part.column(2), part.column(3)
                common = _block_overlaps(x, y)
                union = np.diff(x.offsets.to_numpy()) + np.diff(y.offsets.to_numpy()) - common
                good = pa.array(100 * common >= PERCENT * union)
                yield pa.record_batch([part.column(0).filter(good), part.column(1).filter(good)], names=["a", "b"])
            pa.default_memory_pool().release_unused()

    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return full.mapInArrow(run, "a long, b long")


def _size_bound(n1, n2):
    return (100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2))


def _reachable(n1, pos1, n2, pos2):
    """Whether the shared column, if it is the first, and all later ones can
    give the overlap."""
    most = F.least(n1 - pos1, n2 - pos2)
    return (100 + PERCENT) * most >= PERCENT * (n1 + n2)


def set_components(scratch: Scratch, docs: DataFrame, prefix: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """(node, component) of the linked sets."""
    spark = docs.sparkSession
    # columns with two rows or more; a column's rows are grouped by size class
    size_class = F.floor(F.log(F.col("n")) / F.lit(float(np.log(100 / PERCENT)))).cast("int")
    shared = scratch.keep(prefix.groupBy("shingle").agg(F.min("set").alias("low"), F.max("set").alias("high"))
                          .where("low <> high").select("shingle"), "shared")
    entries = scratch.keep(prefix.join(shared, "shingle").distinct()
                           .withColumn("size_class", size_class), "entries")
    active = entries.select("set").distinct()
    # one document per set, before the join: a set may have very many
    one = scratch.keep(table.groupBy("set").agg(F.min("doc_id").alias("id")).join(active, "set", "left_semi")
                       .select("id").distinct(), "rows-of-sets")
    sets = scratch.keep(full_sets(docs.join(one, F.col("doc_id").eqNullSafe(F.col("id")))
                                  .select("doc_id", "text"), k), "sets")
    nothing = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    edges = nothing
    comp = nothing.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for round_no in range(STAR_ROUNDS + 1):
        sizes = comp.groupBy(F.col("component").alias("c_id")).agg(F.count("*").alias("size"))
        of_set = comp.join(sizes, F.col("component") == F.col("c_id")).select("node", "component", "size")
        here = entries.join(of_set, F.col("set") == F.col("node"), "left").select(
            "shingle", "set", "n", "pos", "size_class", F.coalesce("component", "set").alias("comp"),
            F.coalesce("size", F.lit(1)).alias("comp_size"))
        # columns whose rows are in different components
        spread = scratch.keep(here.groupBy("shingle").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"),
            F.max(F.struct("comp_size", "comp")).alias("largest")).where("low <> high").drop("low", "high"),
            "open-columns")
        here = scratch.keep(here.join(spread, "shingle"), "open-entries")
        if here.isEmpty():
            break
        if round_no < STAR_ROUNDS:
            links = linked(scratch.keep(star_pairs(here, round_no), "pairs"), sets)
        else:
            links = tile_links(scratch, here, sets)
        found = scratch.keep(links, "links")
        if not found.isEmpty():
            edges = edges.unionByName(found)
            comp = scratch.keep(components(scratch, edges), "components")
    return comp


def star_pairs(here: DataFrame, round_no: int) -> DataFrame:
    """Possible pairs (a, b) of each open column's rows with one of them per
    size class, another one each round."""
    here = here.where(F.col("pos") < F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)  # linked rows share one
    x = here.select("shingle", "size_class", F.col("set").alias("a"), F.col("comp").alias("ca"),
                    F.col("n").alias("na"), F.col("pos").alias("pa"))
    y = here.select("shingle", "size_class", F.col("set").alias("b"), F.col("comp").alias("cb"),
                    F.col("n").alias("nb"), F.col("pos").alias("pb"))
    order = F.struct(F.xxhash64("b", F.lit(round_no)).alias("h"), "b", "cb", "nb", "pb")
    y = y.groupBy("shingle", "size_class").agg(F.min(order).alias("m")).select(
        "shingle", "size_class", "m.b", "m.cb", "m.nb", "m.pb")
    pairs = x.join(y, ["shingle", "size_class"]).where(
        (F.col("ca") != F.col("cb")) & _size_bound(F.col("na"), F.col("nb"))
        & _reachable(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def tiles_of(scratch: Scratch, here: DataFrame) -> DataFrame:
    """(set, n, comp, comp_size, tile) of the open rows. Rows of a component
    share tiles; rows that are alone share them with rows of the same least
    column. A tile has about TILE_ROWS rows; ``alone`` tells the two kinds."""
    rows = here.groupBy("set").agg(F.min("n").alias("n"), F.min("comp").alias("comp"),
                                   F.min("comp_size").alias("comp_size"), F.min(F.xxhash64("shingle")).alias("least"))
    alone = F.col("comp_size") == 1
    rows = scratch.keep(rows.select("set", "n", "comp", "comp_size", alone.alias("alone"),
                                    F.when(alone, F.col("least")).otherwise(F.col("comp")).alias("cluster")), "open-rows")
    parts = scratch.keep(rows.groupBy(F.col("cluster").alias("p_cluster"), F.col("alone").alias("p_alone")).agg(
        F.ceil(F.count("*") / TILE_ROWS).alias("parts")), "clusters")
    part = F.pmod(F.xxhash64("set"), F.col("parts"))
    return scratch.keep(rows.join(parts, (F.col("cluster") == F.col("p_cluster")) & (F.col("alone") == F.col("p_alone")))
                        .select("set", "n", "comp", "comp_size", "alone",
                                F.xxhash64("cluster", "alone", part).alias("tile")), "tiles")


def possible_tiles(here: DataFrame, tiles: DataFrame) -> DataFrame:
    """(a, tile): open rows and tiles of larger (size, id) components, or of
    rows that are alone too, in which the row misses few enough columns."""
    of_column = here.join(tiles.select(F.col("set").alias("t_set"), "tile", "alone"), F.col("set") == F.col("t_set")).select(
        "shingle", "rows", F.struct("tile", "alone", F.col("comp_size").cast("long").alias("size"),
                                    F.when(F.col("alone"), 0).otherwise(F.col("comp")).alias("comp")).alias("member"))
    chunk = F.pmod(F.xxhash64("member"), F.ceil(F.col("rows") / CHUNK)).alias("chunk")
    packed = of_column.distinct().groupBy("shingle", chunk).agg(F.collect_list("member").alias("members"))
    probes = here.where(F.struct("comp_size", "comp") < F.col("largest")).select(
        "shingle", F.col("set").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"),
        F.col("comp_size").cast("long").alias("sa"))

    def count(table: pa.Table) -> pa.Table:
        a, na, ca, sa = (table.column(c)[0].as_py() for c in ("a", "na", "ca", "sa"))
        flat = table.column("members").combine_chunks().flatten()
        tile, alone, size, comp = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("tile", "alone", "size", "comp"))
        wanted = (size > sa) | ((size == sa) & (alone | (comp > ca)))
        tile, met = np.unique(tile[wanted], return_counts=True)
        p, dealt = first_columns(np.array(na))
        tile = tile[dealt - met <= p - 1]
        return pa.table({"a": pa.array(np.full(len(tile), a, np.int64)), "tile": pa.array(tile, pa.int64())})

    met = probes.join(packed, "shingle").select("a", "na", "ca", "sa", "members")
    return met.groupBy("a").applyInArrow(count, "a long, tile long")


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    x = lists.combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False), np.diff(x.offsets.to_numpy())


def _tile_links(rows: pa.Table, tile: pa.Table) -> pa.Table:
    """(a, b): one link per row and component of the tile. The block product
    of the rows and the tile, a few million products at a time."""
    if not rows.num_rows or not tile.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    column, size_b = _flat(tile.column("y"))
    row_b = np.repeat(np.arange(len(size_b)), size_b)
    order = np.argsort(column)
    column, row_b = column[order], row_b[order]
    set_b, comp_b, rank_b = (tile.column(c).to_numpy() for c in ("b", "cb", "sb"))
    wanted, size_a = _flat(rows.column("x"))
    set_a, comp_a, rank_a = (rows.column(c).to_numpy() for c in ("a", "ca", "sa"))
    start, stop = np.searchsorted(column, wanted), np.searchsorted(column, wanted, side="right")
    ends = np.append(0, np.cumsum(size_a))
    products = np.append(0, np.cumsum(stop - start))[ends] if len(wanted) else ends
    out_a, out_b = [], []
    for lo, hi in batch_slices(products, PRODUCTS):
        first, last = ends[lo], ends[hi]
        n = stop[first:last] - start[first:last]
        at = np.arange(n.sum()) + np.repeat(start[first:last] - (np.cumsum(n) - n), n)
        row_a = np.repeat(np.repeat(np.arange(hi - lo), size_a[lo:hi]), n)
        common = np.bincount(row_a * len(size_b) + row_b[at], minlength=(hi - lo) * len(size_b)).reshape(hi - lo, -1)
        union = size_a[lo:hi, None] + size_b[None, :] - common
        larger = (rank_b[None, :] > rank_a[lo:hi, None]) | (
            (rank_b[None, :] == rank_a[lo:hi, None]) & (comp_b[None, :] > comp_a[lo:hi, None]))
        i, j = np.nonzero((100 * common >= PERCENT * union) & larger)
        _, one = np.unique(np.stack([i, comp_b[j]]), axis=1, return_index=True)
        out_a.append(set_a[lo:hi][i[one]])
        out_b.append(set_b[j[one]])
    empty = np.zeros(0, np.int64)
    return pa.table({"a": pa.array(np.concatenate([empty, *out_a])), "b": pa.array(np.concatenate([empty, *out_b]))})


def tile_links(scratch: Scratch, here: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) links between open rows of different components: at least one
    for each two components that are linked."""
    tiles = tiles_of(scratch, here)
    met = scratch.keep(possible_tiles(here, tiles), "rows-of-tiles")
    blocks = scratch.keep(met.groupBy(F.col("tile").alias("b_tile")).agg(
        F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("blocks")), "blocks-of-tiles")
    own = tiles.select(F.col("set").alias("o_set"), F.col("comp").alias("ca"), F.col("comp_size").cast("long").alias("sa"))
    rows = met.join(blocks, F.col("tile") == F.col("b_tile")).withColumn(
        "block", F.pmod(F.xxhash64("a"), F.col("blocks").cast("long")).cast("int")).join(
        own, F.col("a") == F.col("o_set")).join(sets, F.col("a") == F.col("set")).select(
        F.col("tile").alias("a_tile"), F.col("block").alias("a_block"), "a", "ca", "sa", F.col("shingles").alias("x"))
    members = tiles.join(blocks, F.col("tile") == F.col("b_tile")).join(sets, "set").select(
        F.col("tile").alias("m_tile"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("m_block"),
        F.col("set").alias("b"), F.col("comp").alias("cb"), F.col("comp_size").cast("long").alias("sb"),
        F.col("shingles").alias("y"))
    return rows.groupBy("a_tile", "a_block").cogroup(members.groupBy("m_tile", "m_block")).applyInArrow(
        _tile_links, "a long, b long")


def heavy_shingles(scratch: Scratch, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the shingles that repeat most, by ascending hash:
    those with log2(count) from the lowest level on that at most HEAVY reach."""
    level = F.floor(F.log2("n")).cast("int")
    summed = scratch.keep(counts.groupBy(F.col("a").alias("shingle")).agg(F.sum("b").alias("n")), "repeats")
    least, total = None, 0
    for r in sorted(summed.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 64 rows
        total += r["count"]
        if total > HEAVY:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = summed.where(level >= least).toArrow()  # at most HEAVY rows, whatever the number of tasks
    keys, n = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def jaccard_groups(spark, docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(spark, "jaccard") as scratch:
        both = scratch.keep(sets_and_heavy(docs, k), "sets-heavy")
        table = both.where("kind = 0").select(
            F.col("a").alias("doc_id"), F.col("b").alias("set"), F.col("c").alias("n_shingles"))
        heavy = heavy_shingles(scratch, both.where("kind = 1"))
        known = spark.sparkContext.broadcast(heavy)
        dealt = table.agg(F.sum(F.ceil(F.col("n_shingles") * (150 - 1.5 * PERCENT) / 100) + 2)).first()[0] or 0
        blocks = scratch.keep(column_blocks(docs, k, known, int(dealt // RANGE_COLUMNS) + 1), "blocks")
        shared = scratch.keep(shared_columns(blocks), "shared")
        entries = scratch.keep(possible_entries(blocks, shared), "possible")
        comp = set_components(scratch, docs, entries, table, k)
        named = scratch.keep(
            table.where("n_shingles > 0").join(comp, F.col("set") == F.col("node"), "left").select(
                "doc_id", "n_shingles", F.coalesce("component", "set").alias("component")), "named")
        lowest = scratch.keep(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "lowest")
        out = named.join(lowest, "component").select("doc_id", "n_shingles", "component_id")
        alone = table.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        return scratch.keep(out.unionByName(alone), "result", result=True)


def one_of_each_group(spark, docs: DataFrame) -> DataFrame:
    """One row of each group of linked rows: that with the smallest doc_id
    (null last), of equal ids the first in the files. Rows that link with
    nothing, those without a word among them, all stay."""
    with Scratch(spark, "jaccard-stage") as scratch:
        numbered = row_numbers(scratch, docs)
        groups = jaccard_groups(spark, numbered("text").select(F.col("key").alias("doc_id"), "text"))
        order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("key").alias("k"))
        named = groups.select(F.col("doc_id").alias("g_key"), F.col("component_id").alias("group"))
        known = scratch.keep(numbered("doc_id").select("key", order.alias("order")).join(
            named, F.col("key") == F.col("g_key")).select("key", "order", "group"), "ordered")
        first = known.groupBy(F.col("group").alias("f_group")).agg(F.min("order").alias("first"), F.count("*").alias("size"))
        # the rows that go are the smaller table to join with
        gone = scratch.keep(known.join(first.where("size > 1"), F.col("group") == F.col("f_group")).where(
            F.col("key") != F.col("first.k")).select(F.col("key").alias("gone")), "gone-rows", result=True)
    rows = numbered(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(gone, F.col("key") == F.col("gone"), "left_anti").select("row.*")

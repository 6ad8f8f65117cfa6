"""Prefix trie of rebuilt conversations by double arrays.

A conversation is rebuilt from the first turns of the first conversation of its
hundred and its own later turns. Equal conversations become one sequence with
the digest of their ids. Sequences are dealt to shards by prefix: a node with
more than LARGE sequences below it is an upper node, shared by shards; what
hangs below an upper node falls into one shard. A shard numbers its turns
densely, packs its trie into BASE and CHECK (child = BASE[node] + turn id, with
CHECK[child] = node) and walks its sequences through them, all sequences a
level at a time; CHECK leads the sums back to the parents. A shard's own nodes
are final there. Its part of the upper nodes (members, children, leaves, saved
text) is merged over all shards in Spark.

What the parts of an upper node must count once (its own text, itself as its
parent's child) is counted by the shard that holds the node's smallest member,
which every shard knows.

Turns travel as 128-bit hashes of role and text with the text's length. The ids
of a node's ends are sorted over ranges, packed into rows and hashed as a
stream, so that many copies of one conversation are never held at once. One
conversation's turns (24 bytes each) are held by the task that rebuilds it.

Defined cases: rows without conv_id belong to no conversation; equal turn
numbers are ordered by the md5 of role and text, repeated rows are turns of
their own; a null turn number comes first; null role and text are empty; c-c%100
is SQL's (towards zero for negative ids); an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, utf8_column
from .shingles import mix64

LARGE = 256          # sequences below a node that shards may share
SHARD_TURNS = 4096   # turns of a shard, on average
PACK = 1024          # ids of a packed row
TRIES = 64           # places tried for a node's children among the gaps
GROUP = 100          # conversations that borrow from the first of their hundred
BORROWED = 6         # fewer turns than this are borrowed
_NODE = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_NONE = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's (key, length) in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), key.alias("key"), F.length(text).alias("length")).alias("t"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select("conv_id", F.transform("ts", lambda t: F.struct(t["key"].alias("key"), t["length"].alias("length"))).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """(conv_id, seq, turns) of every conversation; seq tells sequences apart.
    At most 199 conversations borrow from the same one."""
    first = lists.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("b_id"), F.col("turns").alias("b_turns"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("int")
    joined = lists.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % GROUP}).join(
        first, F.col("base") == F.col("b_id"), "left")
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    turns = F.when(F.col("b_turns").isNull(), own).otherwise(F.concat(F.slice("b_turns", F.lit(1), F.col("h")), own))
    chain = F.aggregate("turns", F.lit(b""), lambda a, t: F.unhex(F.md5(F.concat(a, t["key"]))))
    return joined.select("conv_id", turns.alias("turns")).select("conv_id", chain.alias("seq"), "turns")


def packed_ends(members: DataFrame) -> DataFrame:
    """(seq, first, n, ids): sorted ids of equal sequences, at most PACK a row."""
    def run(batches):
        for b in batches:
            seqs, ids = b.column(0).to_pylist(), b.column(1).to_numpy()
            rows, start = [], 0
            for i in range(1, len(seqs) + 1):
                if i == len(seqs) or seqs[i] != seqs[start] or i - start == PACK:
                    rows.append((seqs[start], int(ids[start]), i - start, ",".join(map(str, ids[start:i].tolist()))))
                    start = i
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.record_batch([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
                                   pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                                  names=["seq", "first", "n", "ids"])

    ordered = members.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return ordered.mapInArrow(run, "seq binary, first long, n long, ids string")


def end_digests(packs: DataFrame) -> DataFrame:
    """(conv_id, n, ends_sha256) per sequence: its smallest id, how many
    conversations it is, and the digest of their ids."""
    def run(batches):
        seq, low, total, digest = None, 0, 0, None
        for b in batches:
            done = []
            for s, first, n, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if digest is not None and s == seq:
                    digest.update(b"," + ids.encode())
                    total += n
                    continue
                if digest is not None:
                    done.append((low, total, digest.hexdigest()))
                seq, low, total, digest = s, first, n, hashlib.sha256(ids.encode())
            yield _ends(done)
        if digest is not None:
            yield _ends([(low, total, digest.hexdigest())])

    ordered = packs.repartition("seq").sortWithinPartitions("seq", "first")
    return ordered.mapInArrow(run, "conv_id long, n long, ends_sha256 string")


def _ends(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                            pa.array(columns[2], pa.string())], names=["conv_id", "n", "ends_sha256"])


# ------------------------------------------------------------------ prefixes
def _lists(turns: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys [turn, 2], lengths, offsets) of a column of turn lists."""
    if isinstance(turns, pa.ChunkedArray):
        turns = turns.combine_chunks()
    flat = turns.flatten()
    data, _ = utf8_column(flat.field("key"))
    offsets = turns.offsets.to_numpy().astype(np.int64)
    return (np.frombuffer(data.tobytes(), np.uint64).reshape(-1, 2),
            flat.field("length").to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0])


def _extended(prefix: np.ndarray, key: np.ndarray) -> np.ndarray:
    """128-bit hashes of prefixes with one more turn."""
    a = mix64(prefix[:, 0] * np.uint64(0x2545F4914F6CDD1D) + key[:, 0])
    b = mix64((prefix[:, 1] ^ key[:, 1]) * np.uint64(0x9E3779B97F4A7C15) + a)
    return np.stack([a, b], axis=1)


def prefix_hashes(keys: np.ndarray, offsets: np.ndarray):
    """(depth, rows, hashes) per depth from 1: the rows with that many turns."""
    sizes = np.diff(offsets)
    prefix = np.ones((len(sizes), 2), np.uint64)
    for d in range(int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > d)
        prefix[rows] = _extended(prefix[rows], keys[offsets[rows] + d])
        yield d + 1, rows, prefix[rows]


def _prefix_rows(sequences: DataFrame, grouped: bool) -> DataFrame:
    """(a, b, depth, conv_id) of every prefix of every sequence; ``grouped``:
    one row per prefix and batch, with the count n and the smallest conv_id."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, _, offsets = _lists(batch.column(1))
            for depth, rows, h in prefix_hashes(keys, offsets):
                n, low = np.ones(len(rows), np.int64), ids[rows]
                if grouped:
                    order = np.lexsort((low, h[:, 1], h[:, 0]))
                    h, low = h[order], low[order]
                    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]).any(axis=1)))
                    n, h, low = np.diff(np.append(new, len(order))), h[new], low[new]
                yield pa.record_batch(
                    [pa.array(h[:, 0].view(np.int64)), pa.array(np.ascontiguousarray(h[:, 1]).view(np.int64)),
                     pa.array(np.full(len(n), depth)), pa.array(low), pa.array(n)],
                    names=["a", "b", "depth", "conv_id", "n"])

    return sequences.select("conv_id", "turns").mapInArrow(run, "a long, b long, depth long, conv_id long, n long")


def upper_nodes(sequences: DataFrame) -> DataFrame:
    """(a, b, depth, node): prefixes (without the root) of more than LARGE
    sequences, each with its smallest conv_id."""
    return _prefix_rows(sequences, grouped=True).groupBy("a", "b", "depth").agg(
        F.sum("n").alias("n"), F.min("conv_id").alias("node")).where(F.col("n") > LARGE).drop("n")


def with_upper(sequences: DataFrame, upper: DataFrame, root: int) -> DataFrame:
    """``sequences`` with ``upper``: the smallest conv_ids of their upper nodes,
    root first. Spark broadcasts the upper nodes if they turn out small."""
    found = _prefix_rows(sequences, grouped=False).select("a", "b", "depth", F.col("conv_id").alias("s_id")).join(
        upper, ["a", "b", "depth"]).groupBy("s_id").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("u"))
    nodes = F.coalesce(F.transform("u", lambda u: u["node"]), F.array().cast("array<long>"))
    return sequences.join(found, F.col("conv_id") == F.col("s_id"), "left").select(
        "conv_id", "n", "ends_sha256", "turns", F.concat(F.array(F.lit(root).cast("long")), nodes).alias("upper"))


def with_shard(sequences: DataFrame, shards: int) -> DataFrame:
    """``sequences`` with ``shard``, dealt by the first node below the upper ones."""
    def run(batches):
        for b in batches:
            keys, _, offsets = _lists(b.column(3))
            wanted = np.diff(b.column(4).offsets.to_numpy())  # depth of the first node that is not an upper one
            wanted = np.minimum(wanted, np.diff(offsets))
            out = np.ones((b.num_rows, 2), np.uint64)
            for depth, rows, h in prefix_hashes(keys, offsets):
                here = wanted[rows] == depth
                out[rows[here]] = h[here]
                if depth >= wanted.max(initial=0):
                    break
            shard = (out[:, 0] % np.uint64(shards)).astype(np.int64)
            yield pa.record_batch([*b.columns, pa.array(shard)], names=[*b.schema.names, "shard"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sequences.schema.fields)
    return sequences.mapInArrow(run, schema + ", shard long")


# ------------------------------------------------------------------ double arrays
class DoubleArray:
    """A trie of edges (parent node, turn id): node 0 is the root, nodes are
    numbered by level. ``slot[node]`` is its place in ``base`` and ``check``."""

    def __init__(self, parent: np.ndarray, code: np.ndarray):
        n = len(parent)  # parent[0], code[0] are the root's and not read
        self.slot = np.zeros(n, np.int64)
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        self.used, self._first_free = np.ones(1, bool), 0
        if n == 1:
            return
        order = np.lexsort((code[1:], parent[1:])) + 1
        owner, start = np.unique(parent[order], return_index=True)
        sizes = np.diff(np.append(start, len(order)))
        place = {}
        for i in np.argsort(-sizes, kind="stable"):
            if sizes[i] == 1:
                break
            children = order[start[i]:start[i] + sizes[i]]
            place[i] = self._fit(code[children])
            self.slot[children] = place[i] + code[children]
        single = np.flatnonzero(sizes == 1)  # any free place does: BASE may be negative
        children = order[start[single]]
        free = np.flatnonzero(~self.used)[:len(single)]
        self._grow(len(self.used) + len(single) - len(free))
        free = np.flatnonzero(~self.used)[:len(single)]
        self.used[free] = True
        self.slot[children] = free
        size = int(self.slot.max()) + 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        bases = np.zeros(len(owner), np.int64)
        bases[list(place)] = list(place.values())
        bases[single] = free - code[children]
        self.base[self.slot[owner]] = bases
        self.check[self.slot[1:]] = self.slot[parent[1:]]

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.append(self.used, np.zeros(max(size, 2 * len(self.used)) - len(self.used), bool))

    def _fit(self, codes: np.ndarray) -> int:
        """The first base at which all children's places are free; after
        TRIES misses one behind all places in use (single children fill the
        gaps later)."""
        while self._first_free < len(self.used) and self.used[self._first_free]:
            self._first_free += 1
        at, tries = self._first_free, 0
        while True:
            tries += 1
            if tries > TRIES:
                at = int(np.flatnonzero(self.used)[-1]) + 1
            self._grow(at + int(codes[-1] - codes[0]) + 1)
            if not self.used[at + codes - codes[0]].any():
                self.used[at + codes - codes[0]] = True
                return at - int(codes[0])
            at += 1

    def child(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states after one more turn; -1 where there is no such node."""
        to = self.base[state] + code
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == state), to, -1)


def trie_edges(codes: np.ndarray, offsets: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """(parent, code) of every node of the sequences' trie, root first, level
    by level."""
    sizes = np.diff(offsets)
    node = np.zeros(len(sizes), np.int64)
    parents, labels, n = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
    for d in range(int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > d)
        edge, which = np.unique(node[rows] * n_codes + codes[offsets[rows] + d], return_inverse=True)
        node[rows] = n + which
        parents.append(edge // n_codes)
        labels.append(edge % n_codes)
        n += len(edge)
    return np.concatenate(parents), np.concatenate(labels)


def shard_nodes(table: pa.Table) -> pa.Table:
    """Node rows of one shard: kind 0 its own nodes, 1 its part of upper ones."""
    ids, n = table.column("conv_id").to_numpy(), table.column("n").to_numpy()
    keys, lengths, offsets = _lists(table.column("turns"))
    upper = table.column("upper").combine_chunks()
    up_offsets, up_nodes = upper.offsets.to_numpy().astype(np.int64), upper.values.to_numpy()
    tops, sizes = np.diff(up_offsets), np.diff(offsets)
    known, codes = np.unique(keys, axis=0, return_inverse=True)
    trie = DoubleArray(*trie_edges(codes.ravel(), offsets, max(len(known), 1)))
    codes = codes.ravel()

    slots = len(trie.check)
    n_convs, low = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    depth, length, shared = (np.zeros(slots, np.int64) for _ in range(3))
    is_upper, ends_here = np.zeros(slots, bool), np.full(slots, -1, np.int64)
    state = np.zeros(len(ids), np.int64)
    for d in range(int(sizes.max(initial=0)) + 1):
        rows = np.flatnonzero(sizes >= d)
        if d:
            at = offsets[rows] + d - 1
            state[rows] = trie.child(state[rows], codes[at])
            length[state[rows]] = lengths[at]
        s = state[rows]
        depth[s] = d
        np.add.at(n_convs, s, n[rows])
        np.minimum.at(low, s, ids[rows])
        ends_here[s[sizes[rows] == d]] = rows[sizes[rows] == d]
        among = rows[tops[rows] > d]
        is_upper[state[among]] = True
        shared[state[among]] = up_nodes[up_offsets[among] + d]
    there = np.flatnonzero(n_convs > 0)
    name = np.where(is_upper, shared, low)
    counted = ~is_upper | (low == shared)  # whether this shard counts what is counted once
    children, leaves = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    inner = there[there != 0]
    np.add.at(children, trie.check[inner], counted[inner])
    leaves[there] = ~is_upper[there] & (children[there] == 0)
    saved = n_convs * length - counted * length
    for d in range(int(depth.max(initial=0)), 0, -1):  # children before parents
        here = inner[depth[inner] == d]
        np.add.at(leaves, trie.check[here], leaves[here])
        np.add.at(saved, trie.check[here], saved[here])
    ends = table.column("ends_sha256").combine_chunks()
    at = ends_here[there]
    parent = name[np.maximum(trie.check[there], 0)]
    return pa.table({
        "kind": pa.array(is_upper[there].astype(np.int32)), "conv_id": pa.array(name[there]),
        "depth": pa.array(depth[there]), "parent_conv_id": pa.array(parent, mask=there == 0),
        "n_convs": pa.array(n_convs[there]), "n_children": pa.array(children[there]),
        "n_leaves": pa.array(leaves[there]), "saved_tokens": pa.array(saved[there]),
        "ends_sha256": ends.take(pa.array(at, mask=at < 0))})


def prefix_trie(spark, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node."""
    with Scratch(spark, "conversation-trie") as scratch:
        lists = scratch.keep(turn_lists(conversations), "lists")
        whole = scratch.keep(rebuilt(lists), "rebuilt")
        ends = end_digests(scratch.keep(packed_ends(whole), "packs"))
        sequences = scratch.keep(
            whole.select(F.col("conv_id").alias("w_id"), "turns").join(ends, F.col("conv_id") == F.col("w_id")).select(
                "conv_id", "n", "ends_sha256", "turns"), "sequences")
        size = sequences.agg(F.min("conv_id").alias("root"), F.sum(F.size("turns")).alias("turns")).first()
        root = size["root"] if size["root"] is not None else 0
        upper = scratch.keep(upper_nodes(sequences), "upper")
        named = scratch.keep(with_upper(sequences, upper, root), "named")
        shards = 1 + (size["turns"] or 0) // SHARD_TURNS
        nodes = scratch.keep(with_shard(named, shards).groupBy("shard").applyInArrow(shard_nodes, _NODE), "nodes")
        merged = nodes.where("kind = 1").groupBy("conv_id", "depth").agg(
            F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
        out = nodes.where("kind = 0").drop("kind").unionByName(merged)
        leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves"))
        return scratch.keep(out.withColumns({
            "n_leaves": leaves, "ends_sha256": F.coalesce("ends_sha256", F.lit(_NONE))}), "result", result=True)

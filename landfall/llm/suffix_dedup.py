"""Removal of repeated 200-byte strings with per-shard suffix arrays.

1. *Anchors.* In each 200-byte window the least-hashed 32-byte string is its
   anchor (winnowing). Equal windows have equal anchors, so only windows whose
   anchor occurs twice or more in the whole table can repeat. Windows with the
   same anchor place form one *context*: the bytes they span.
2. *Shards.* Contexts are dealt by anchor hash, so equal windows meet. Equal
   contexts are pre-aggregated to one with a weight. A shard's contexts,
   concatenated, get a suffix array by Larsson-Sadakane refinement and common
   prefixes by Kasai's walk (one lane per context); neighbours that share 200
   bytes are one class, and a class of weight two or more repeats.
3. *Merging.* An anchor with more than ``GROUP`` different contexts is dealt
   over several shards. Each hands on its sorted window keys, cut into ranges
   by binary search; a merge task looks each shard's keys up in the sorted
   keys of all of them and adds the weights. No task sees the whole group.
4. *Spans.* Repeated windows go back to their texts as byte spans; their
   union is removed.

Texts are keyed by their MD5, so equal texts share spans.

Defined cases: a null or empty text has no bytes, no spans and the digest of
nothing; texts under 200 bytes are never touched; a string that overlaps
itself counts; repeated rows are repeated texts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batch_slices, utf8_column
from .shingles import mix64

WIDTH = 200          # bytes of a repeated string
GRAM = 32            # bytes of an anchor
GROUP = 512          # different contexts of an anchor that one shard takes
SHARD_BYTES = 640 << 10
SLICE_BYTES = 1 << 19
FIRST = 7            # bytes of the first ranks
_POS_BITS = np.uint64(24)  # places inside a slice


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at each place."""
    n = len(data) - 7
    eight = np.empty(n, np.uint64)
    for o in range(8):
        k = (len(data) - o) // 8
        eight[o::8] = data[o:o + 8 * k].view("<u8")[:len(eight[o::8])]
    m = len(data) - GRAM + 1
    h = np.zeros(m, np.uint64)
    for j in range(0, GRAM, 8):
        h = (h ^ eight[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix64(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    n = len(x) - width + 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[width - step:width - step + n])


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(row, anchor hash, first window, last window) of each context; windows
    are counted from the start of their row."""
    empty = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return empty, empty.view(np.uint64), empty, empty
    h = _gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    least = _sliding_min((h >> _POS_BITS << _POS_BITS) | place, WIDTH - GRAM + 1)
    at = (least & ((np.uint64(1) << _POS_BITS) - np.uint64(1))).astype(np.int64)
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), np.maximum(lengths - WIDTH + 1, 0))
    first = np.cumsum(np.maximum(lengths - WIDTH + 1, 0)) - np.maximum(lengths - WIDTH + 1, 0)
    window = np.arange(len(rows)) - first[rows] + offsets[rows]
    at = at[window]
    if not len(at):
        return empty, empty.view(np.uint64), empty, empty
    start = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])))
    stop = np.append(start[1:], len(at)) - 1
    row = rows[start]
    return row, h[at[start]], window[start] - offsets[row], window[stop] - offsets[row]


def _row_slices(batch, column: int):
    """(first row, last row, data, offsets, shift): slices of whole rows, long
    rows in pieces that overlap by a window less one byte."""
    data, offsets = utf8_column(batch.column(column))
    for a, b in batch_slices(offsets, SLICE_BYTES):
        size = offsets[b] - offsets[a]
        if b - a > 1 or size <= 2 * SLICE_BYTES:
            yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], 0
            continue
        for s in range(0, int(size) - WIDTH + 1, SLICE_BYTES):
            piece = data[offsets[a] + s:min(offsets[a] + s + SLICE_BYTES + WIDTH - 1, offsets[b])]
            yield a, b, piece, np.array([0, len(piece)]), s


def anchor_table(texts: DataFrame) -> DataFrame:
    """(text_id, anchor, low, high) per context of (text_id, raw)."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, _, data, offsets, shift in _row_slices(b, 1):
                row, anchor, low, high = anchors(data, offsets)
                yield pa.record_batch(
                    [ids.take(pa.array(row + lo)), pa.array(anchor.view(np.int64)),
                     pa.array((low + shift).astype(np.int32)), pa.array((high + shift).astype(np.int32))],
                    names=["text_id", "anchor", "low", "high"])

    return texts.mapInArrow(run, "text_id binary, anchor long, low int, high int")


def context_table(texts: DataFrame) -> DataFrame:
    """(text_id, low, anchor, digest, body) per candidate context of (text_id,
    raw, contexts); a task gives the body of a digest once, else null."""
    def run(batches):
        for b in batches:
            seen: set[bytes] = set()
            ids, raws = b.column(0), b.column(1)
            out: list[list] = [[], [], [], [], []]
            for i, contexts in enumerate(b.column(2)):
                raw, text_id = raws[i].as_py(), ids[i].as_py()
                for c in contexts.as_py():
                    body = raw[c["low"]:c["high"] + WIDTH]
                    digest = hashlib.blake2b(body, digest_size=16).digest()
                    for column, value in zip(out, (text_id, c["low"], c["anchor"], digest,
                                                   None if digest in seen else body), strict=True):
                        column.append(value)
                    seen.add(digest)
            yield pa.record_batch(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())],
                names=["text_id", "low", "anchor", "digest", "body"])

    return texts.mapInArrow(run, "text_id binary, low int, anchor long, digest binary, body binary")


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes by their first ``depth`` bytes or more, by
    Larsson-Sadakane refinement: ranks double their reach each round, and only
    groups that are still unsorted are sorted again. Suffixes that are equal so
    far share the rank of their group's last place."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(FIRST):
        key = (key << np.uint64(8)) | padded[j:j + n]
    # the last byte tells suffixes that end inside the key from those with zero bytes there
    key = key << np.uint64(8) | np.minimum(np.arange(n, 0, -1), FIRST).astype(np.uint64)
    sa = np.argsort(key)
    rank = np.empty(n, np.int64)
    ends = np.append(np.diff(key[sa]) != 0, True)[:n]
    places = np.flatnonzero(ends)
    rank[sa] = np.repeat(places, np.diff(np.append(-1, places)))
    unsorted = ~(ends & np.append(True, ends[:-1])[:n])
    reach = FIRST
    while reach < depth and unsorted.any():
        where = np.flatnonzero(unsorted)
        members = sa[where]
        key = _pair_keys(rank, members, reach)
        order = np.argsort(key)
        members, key = members[order], key[order]
        sa[where] = members
        change = np.append(np.diff(key) != 0, True)
        last = np.flatnonzero(change)
        rank[members] = np.repeat(where[last], np.diff(np.append(-1, last)))
        unsorted[where] = ~(change & np.append(True, change[:-1]))
        reach *= 2
    return rank


def _pair_keys(rank: np.ndarray, places: np.ndarray, reach: int) -> np.ndarray:
    """(rank here, rank ``reach`` further on) as one number; past the end the
    shorter suffix comes first."""
    n = len(rank)
    ahead = places + reach
    second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, n - ahead)
    return rank[places] * (2 * n + reach + 1) + second + n + reach


def sorted_suffixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The given suffixes ordered by at least their first ``depth`` bytes: the
    last refinement sorts only those asked for."""
    half = FIRST
    while half * 2 < depth:
        half *= 2
    rank = suffix_ranks(text, half)
    return places[np.argsort(_pair_keys(rank, places, half))]


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray,
                    cap: int) -> np.ndarray:
    """Common prefix, up to ``cap``, of each suffix with the one before it in
    ``order``, by text place. Kasai's walk in one lane per run of places
    (``counts`` places from each of ``starts``): if the next place's partner
    would still come before it, it shares at least one byte less with whatever
    does. ``order`` must hold the bytes' order up to ``cap``; ties in any order."""
    n = len(text)
    rank = np.full(n + 1, -1, np.int64)  # places outside ``order`` prove nothing
    rank[order] = np.arange(len(order))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(15, np.uint8)])
    eight = np.empty(n + 8, np.uint64)
    for o in range(8):
        part = eight[o::8]
        part[:] = padded[o:o + 8 * ((len(padded) - o) // 8)].view("<u8")[:len(part)]
    out = np.zeros(n, np.int64)
    by_length = np.argsort(-counts, kind="stable")
    starts, counts = starts[by_length], counts[by_length]
    shared, partner = np.zeros(len(starts), np.int64), np.full(len(starts), n - 1, np.int64)
    for j in range(int(counts[0]) if len(counts) else 0):
        lanes = int(np.searchsorted(-counts, -j, side="left"))  # those longer than j
        at, follows = starts[:lanes] + j, rank[partner[:lanes] + 1]
        proven = (follows >= 0) & (follows < rank[at])
        h = np.where(proven, np.maximum(shared[:lanes] - 1, 0), 0)
        other = before[at]
        most = np.where(other < 0, 0, np.minimum(cap, n - np.maximum(at, other)))
        live = np.flatnonzero(h < most)
        while len(live):
            differ = eight[at[live] + h[live]] ^ eight[other[live] + h[live]]
            equal = differ == 0
            lowest = differ & (~differ + np.uint64(1))
            bytes_ = np.where(equal, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
            h[live] = np.minimum(h[live] + bytes_, most[live])
            live = live[equal & (h[live] < most[live])]
        shared[:lanes], partner[:lanes] = h, np.where(other < 0, n - 1, other)
        out[at] = h
    return out


def window_classes(bodies: list[bytes]):
    """(context, start, class) of every window of the contexts: windows with
    the same class have the same WIDTH bytes. In suffix order."""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.array([len(b) for b in bodies])
    starts, windows = np.cumsum(lengths) - lengths, lengths - WIDTH + 1
    context = np.repeat(np.arange(len(bodies)), windows)
    start = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    order = sorted_suffixes(text, starts[context] + start, WIDTH)
    prefix = common_prefixes(text, order, starts, windows, WIDTH)
    context = np.searchsorted(starts, order, side="right") - 1
    return context, order - starts[context], np.cumsum(prefix[order] < WIDTH)


def _spans(context: np.ndarray, start: np.ndarray):
    """Per context the merged byte spans [from, to) of its repeated windows."""
    if not len(start):
        return context, start, start
    order = np.lexsort((start, context))
    context, start = context[order], start[order]
    head = np.append(True, (context[1:] != context[:-1]) | (start[1:] > start[:-1] + WIDTH))
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(start)) - 1
    return context[first], start[first], start[last] + WIDTH


def _shard(rows, n_shards):
    """Spans of a shard's contexts, or its window keys by range if the anchor
    is dealt over several shards."""
    bodies, weights = [r[2] for r in rows], np.array([r[3] for r in rows], np.int64)
    context, start, classes = window_classes(bodies)
    totals = np.bincount(classes, weights=weights[context]).astype(np.int64)
    if n_shards == 1:
        again = totals[classes] >= 2
        for c, a, b in zip(*(x.tolist() for x in _spans(context[again], start[again])), strict=True):
            yield rows[c][1], [a, b], None, None, None
        return
    _, leader, back = np.unique(classes, return_index=True, return_inverse=True)
    keys = np.array([hashlib.blake2b(bodies[c][s:s + WIDTH], digest_size=16).digest()
                     for c, s in zip(context[leader].tolist(), start[leader].tolist(), strict=True)], "S16")
    order = np.argsort(keys, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_key = np.lexsort((start, context, place[back]))
    context, start, key_of = context[by_key], start[by_key], place[back][by_key]
    keys, sums = keys[order], totals[classes[leader]][order]
    # the ranges end at fixed keys, found by binary search
    limits = np.array([(r * (1 << 32) // n_shards).to_bytes(4, "big") + bytes(12) for r in range(1, n_shards)], "S16")
    cuts = np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])
    for r in range(n_shards):
        lo, hi = cuts[r], cuts[r + 1]
        a, b = np.searchsorted(key_of, [lo, hi])
        if lo == hi:
            continue
        used, local = np.unique(context[a:b], return_inverse=True)
        run = {"keys": keys[lo:hi].tobytes(), "sums": sums[lo:hi].tobytes(),
               "key_of": (key_of[a:b] - lo).astype(np.int64).tobytes(), "context": local.astype(np.int64).tobytes(),
               "start": start[a:b].astype(np.int64).tobytes(), "digests": [rows[c][1] for c in used.tolist()]}
        yield None, None, rows[0][0], r, run


_RUN = pa.struct([("keys", pa.binary()), ("sums", pa.binary()), ("key_of", pa.binary()), ("context", pa.binary()),
                  ("start", pa.binary()), ("digests", pa.list_(pa.binary()))])
_RUN_DDL = ("struct<keys:binary,sums:binary,key_of:binary,context:binary,start:binary,digests:array<binary>>")


def shard_results(contexts: DataFrame) -> DataFrame:
    """Suffix arrays over (anchor, digest, body, n, n_shards, shard) rows that
    are sorted within partitions: (digest, span) or (anchor, range, run)."""
    def emit(rows, n_shards):
        out = list(zip(*_shard(rows, n_shards), strict=True)) or [(), (), (), (), ()]
        return pa.record_batch(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int32())), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int32()), pa.array(out[4], _RUN)], names=["digest", "span", "anchor", "range", "run"])

    def run(batches):
        rows, size, n_shards, last = [], 0, 1, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                group = (r[0], r[5])
                # anchors share a suffix array until it is large; a split anchor has its own
                if rows and group != last and (size >= SHARD_BYTES or n_shards > 1 or r[4] > 1):
                    yield emit(rows, n_shards)
                    rows, size = [], 0
                rows.append(r)
                size, n_shards, last = size + len(r[2]), r[4], group
        if rows:
            yield emit(rows, n_shards)

    return contexts.mapInArrow(run, f"digest binary, span array<int>, anchor long, range int, run {_RUN_DDL}")


def merge_runs(runs: DataFrame) -> DataFrame:
    """(digest, span) of windows that repeat across the shards of an anchor:
    every run's sorted keys are looked up in the sorted keys of all runs."""
    def merge(table: pa.Table) -> pa.Table:
        rows = table.column("run").to_pylist()
        keys = [np.frombuffer(r["keys"], "S16") for r in rows]
        every = np.unique(np.concatenate(keys))
        total = np.zeros(len(every), np.int64)
        places = [np.searchsorted(every, k) for k in keys]
        for r, p in zip(rows, places, strict=True):
            total[p] += np.frombuffer(r["sums"], np.int64)
        digests, spans = [], []
        for r, p in zip(rows, places, strict=True):
            again = (total[p] >= 2)[np.frombuffer(r["key_of"], np.int64)]
            context = np.frombuffer(r["context"], np.int64)[again]
            start = np.frombuffer(r["start"], np.int64)[again]
            for c, a, b in zip(*(x.tolist() for x in _spans(context, start)), strict=True):
                digests.append(r["digests"][c])
                spans.append([a, b])
        return pa.table({"digest": pa.array(digests, pa.binary()), "span": pa.array(spans, pa.list_(pa.int32()))})

    return runs.groupBy("anchor", "range").applyInArrow(merge, "digest binary, span array<int>")


def repeated_spans(scratch: Scratch, texts: DataFrame, group: int = GROUP, result: bool = False) -> DataFrame:
    """(text_id, spans): for each text that has repeated strings, byte spans
    [from, to) that cover them; spans may touch or overlap."""
    found = scratch.keep(anchor_table(texts), "anchors")
    twice = scratch.keep(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
                         "repeated-anchors")
    per_text = scratch.keep(found.join(twice, "anchor").groupBy("text_id").agg(
        F.collect_set(F.struct("low", "high", "anchor")).alias("contexts")), "candidates")
    occurrences = scratch.keep(context_table(texts.join(per_text, "text_id").select("text_id", "raw", "contexts")),
                               "occurrences")
    contexts = scratch.keep(occurrences.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.max("body").alias("body")), "contexts")
    large = scratch.keep(contexts.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > group)
                         .select("anchor", F.ceil(F.col("m") / group).cast("int").alias("n_shards")), "large")
    dealt = contexts.join(large, "anchor", "left").withColumn("n_shards", F.coalesce("n_shards", F.lit(1))).withColumn(
        "shard", F.pmod(F.xxhash64("digest"), F.col("n_shards").cast("long")).cast("int"))
    dealt = (dealt.select("anchor", "digest", "body", "n", "n_shards", "shard")
             .repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "digest"))
    results = scratch.keep(shard_results(dealt), "shards")
    spans = results.where("digest IS NOT NULL").select("digest", "span")
    spans = spans.unionByName(merge_runs(results.where("run IS NOT NULL").select("anchor", "range", "run")))
    spans = scratch.keep(spans, "spans")
    placed = occurrences.select("text_id", "low", "digest").join(spans, "digest").select(
        "text_id", (F.col("low") + F.get("span", F.lit(0))).alias("from"),
        (F.col("low") + F.get("span", F.lit(1))).alias("to"))
    return scratch.keep(placed.groupBy("text_id").agg(F.collect_set(F.struct("from", "to")).alias("spans")),
                        "text-spans", result)


def kept_bytes(raw: bytes | None, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    raw = raw or b""
    kept, removed, runs, at = [], 0, 0, 0
    end = -1
    for s in sorted((s["from"], s["to"]) for s in spans or ()):
        if s[0] > end:
            runs += 1
        if s[1] > max(end, at):
            kept.append(raw[at:max(s[0], at)])
            removed += s[1] - max(s[0], at)
            at = s[1]
        end = max(end, s[1])
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def _with_spans(docs: DataFrame, scratch: Scratch, text, *columns, result: bool = False):
    raw = F.coalesce(text.cast("binary"), F.lit(b""))
    texts = docs.select(F.unhex(F.md5(raw)).alias("text_id"), raw.alias("raw"), *columns)
    spans = repeated_spans(scratch, texts.select("text_id", "raw"), result=result)
    return texts.join(spans, "text_id", "left")


def digests(spark, docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    def run(batches):
        for b in batches:
            rows = []
            for raw, spans in zip(b.column(1), b.column(2), strict=True):
                raw = raw.as_py()
                kept, removed, runs = kept_bytes(raw, spans.as_py())
                rows.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest()))
            out = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.record_batch(
                [b.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept_sha256", T.StringType())])
    with Scratch(spark, "suffix-dedup") as scratch:
        joined = _with_spans(docs, scratch, F.col("text"), "doc_id").select("doc_id", "raw", "spans")
        return scratch.keep(joined.mapInArrow(run, schema), "result", result=True)


def remove_repeats(spark, docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings removed from ``text`` (a character that a
    cut splits goes too); ``n_chars`` follows the text if there is one."""
    def run(batches):
        for b in batches:
            out = []
            for raw, spans in zip(b.column(1), b.column(2), strict=True):
                spans = spans.as_py()
                out.append(kept_bytes(raw.as_py(), spans)[0].decode("utf-8", "ignore") if spans else None)
            yield pa.record_batch([b.column(0), pa.array([x is not None for x in out]), pa.array(out, pa.string())],
                                  names=["row", "cut", "text"])

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    with Scratch(spark, "suffix-stage") as scratch:
        packed = docs.select(whole.alias("row"))
        joined = _with_spans(packed, scratch, F.col("row.text"), "row", result=True).select("row", "raw", "spans")
    schema = T.StructType([T.StructField("row", joined.schema["row"].dataType), T.StructField("cut", T.BooleanType()),
                           T.StructField("text", T.StringType())])
    new = joined.mapInArrow(run, schema)
    out = {c: F.col(f"row.`{c}`") for c in docs.columns}
    for c in out:
        if c.lower() == "text":
            out[c] = F.when(F.col("cut"), F.col("text")).otherwise(out[c])
        elif c.lower() == "n_chars":
            out[c] = F.when(F.col("cut"), F.length("text")).otherwise(out[c]).cast(docs.schema[c].dataType)
    return new.select(*[e.alias(c) for c, e in out.items()])

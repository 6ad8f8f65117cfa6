"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of length 0 to ORDER with symbol
counts. The code length of a byte is ``log2((T + U) / c)`` in the longest
context that has seen it (c times, among T bytes of U kinds), plus an escape
``log2((T + U) / U)`` for every longer context that is known but has not
(method C); a byte never seen costs 8 bits after the last escape. Statistics
are frozen: the language with the shortest exact code of the whole text wins.

The trees are fitted on a hash sample of about TRAIN_BYTES of text per
language (pieces of PIECE bytes, each with the ORDER bytes before it and
learned from once however often it occurs; counts added up in Spark). A tree is
a few sorted arrays, so that a batch of texts walks it at once: the place of the
last k bytes is a child of the place of the k-1 bytes before the last. Trees
share nothing: memory is that of the languages' own strings, about 5 MB each.

Defined cases: a null text and one without a letter are ``und`` with score 0,
and so is every text if nothing could be learned; equal code lengths go to the
smaller language value; a null doc_id is neither held out nor learned from; a
null text or lang is not learned from; repeated rows are learned from once and
each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batch_slices, utf8_column

ORDER = 3
TRAIN_BYTES = 1 << 19   # of text per language, about
PIECE = 1 << 12         # bytes of a text that are drawn together
SLICE_BYTES = 1 << 20
DENSE = 1 << 24         # entries of all tables that are looked up directly; the trees share them
PAD = np.frombuffer(b"\n" * ORDER, np.uint8)  # what stands before each text
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def remainder(doc_id):
    """crc32 of the id as text, modulo 5 (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def padded(data: np.ndarray, offsets: np.ndarray, before: np.ndarray = PAD) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with ``before`` in front of each row, and the new offsets."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    new = offsets + ORDER * np.arange(n + 1)
    out = np.empty(len(data) + ORDER * n, np.uint8)
    front = (new[:-1, None] + np.arange(ORDER)).ravel()
    mask = np.ones(len(out), bool)
    mask[front] = False
    out[front] = np.tile(before, n)
    out[mask] = data[:lengths.sum()]
    return out, new


def gram_counts(texts: DataFrame, pad: bool = True) -> DataFrame:
    """(lang, gram, n): counts of the ORDER + 1 byte strings of (lang, raw);
    without ``pad`` each raw begins with the ORDER bytes before it."""
    def run(batches):
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            data, offsets = utf8_column(b.column(1))
            for lang in sorted(set(langs)):
                total: dict[int, int] = {}
                rows = np.flatnonzero(langs == lang)
                for r in rows:
                    raw = data[offsets[r]:offsets[r + 1]]
                    if pad:
                        raw, _ = padded(raw, np.array([0, len(raw)]))
                    code = np.zeros(len(raw) - ORDER, np.int64)
                    for j in range(ORDER + 1):
                        code = code << 8 | raw[j:len(raw) - ORDER + j]
                    for gram, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True)), strict=True):
                        total[gram] = total.get(gram, 0) + n
                yield pa.record_batch([pa.array([lang] * len(total), pa.string()), pa.array(list(total), pa.int64()),
                                       pa.array(list(total.values()), pa.int64())], names=["lang", "gram", "n"])

    return texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Children:
    """Place of (parent, byte class); 0 where there is none."""

    def __init__(self, keys: np.ndarray, width: int, parents: int, dense: int):
        self.width = width
        if parents * width <= dense:
            self.table = np.zeros(parents * width, np.int32)
            self.table[keys] = np.arange(1, len(keys) + 1)
            self.keys = None
        else:
            self.keys = keys.astype(np.int32) if parents * width < 1 << 31 else keys

    def __call__(self, parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = parent.astype(np.int64) * self.width + symbol
        if self.keys is not None:
            key = key.astype(self.keys.dtype)
        if self.keys is None:
            return self.table[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at + 1, 0)


class ContextTrees:
    """The languages' frozen context trees over a common set of places.

    Level k holds the k-byte strings seen in any language, place 0 standing
    for "none". ``cost[k]`` is the code length of a string's last byte after
    the others, per language; ``escape[k]`` that of leaving it as a context.
    """

    def __init__(self, langs: list[str], lang_of: np.ndarray, grams: np.ndarray, counts: np.ndarray,
                 dense: int | None = None):
        self.langs = langs
        size, dense = len(langs), DENSE if dense is None else dense
        symbols = np.unique(np.concatenate([grams >> 8 * j & 255 for j in range(ORDER + 1)])) if len(grams) else []
        self.classes = np.zeros(256, np.int64)  # class 0: never seen
        self.classes[symbols] = np.arange(1, len(symbols) + 1)
        width = len(symbols) + 1
        strings, seen = [], []  # per level: sorted strings, how often each ends in a language
        for k in range(1, ORDER + 2):
            mask = (1 << 8 * k) - 1
            # contexts at the start of a text are strings that nothing ends in
            unique = np.unique(np.concatenate([grams >> 8 * j & mask for j in range(ORDER + 2 - k)]))
            table = np.zeros((len(unique) + 1, size))
            np.add.at(table, (np.searchsorted(unique, grams & mask) + 1, lang_of), counts)
            strings.append(unique)
            seen.append(table)
        self.children, self.cost, self.escape = [], [], []
        parents = np.zeros(len(strings[0]), np.int64)
        places = 1
        for k in range(1, ORDER + 2):
            unique, table = strings[k - 1], seen[k - 1]
            last = self.classes[unique & 255]
            if k > 1:
                parents = np.searchsorted(strings[k - 2], unique >> 8) + 1
            total, kinds = np.zeros((places, size)), np.zeros((places, size))
            np.add.at(total, parents, table[1:])
            np.add.at(kinds, parents, table[1:] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.escape.append(np.where(total > 0, np.log2((total + kinds) / kinds), 0.0))
                here = np.log2((total + kinds)[parents] / table[1:])
            if k == 1:
                shorter = np.full((len(unique), size), 8.0)
            else:
                shorter = self.cost[-1][np.searchsorted(strings[k - 2], unique & ((1 << 8 * (k - 1)) - 1)) + 1]
            cost = np.where(table[1:] > 0, here, self.escape[-1][parents] + shorter)
            unknown = self.escape[-1][:1] + 8.0 if k == 1 else np.zeros((1, size))
            self.cost.append(np.concatenate([unknown, cost]))
            keys = parents * width + last
            self.children.append(_Children(keys, width, places, dense // 2))
            places = len(unique) + 1

    def code_lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[row, language] bits of padded rows (the padding costs nothing)."""
        symbol = self.classes[raw]
        zero = np.zeros(len(raw), np.int64)
        place, context = [], [zero]
        for k in range(ORDER + 1):
            here = self.children[k](context[-1], symbol)
            place.append(here)
            context.append(np.append(0, here[:-1]))
        counted = np.ones(len(raw), bool)
        counted[(offsets[:-1, None] + np.arange(ORDER)).ravel()] = False
        known = place[ORDER] > 0
        rare = np.flatnonzero(~known & counted)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        for lang in range(len(self.langs)):
            bits = self.cost[ORDER][:, lang][place[ORDER]]
            if len(rare):
                extra, open_ = np.zeros(len(rare)), np.ones(len(rare), bool)
                for k in range(ORDER, -1, -1):
                    found = open_ & ((place[k][rare] > 0) | (k == 0))
                    extra[found] += self.cost[k][:, lang][place[k][rare[found]]]
                    open_ &= ~found
                    extra[open_] += self.escape[k][:, lang][context[k][rare[open_]]]
                bits[rare] = extra
            bits[~counted] = 0.0
            out[:, lang] = np.add.reduceat(bits, offsets[:-1])
        return out


class Forest:
    """One tree per language."""

    def __init__(self, langs: list[str], lang_of: np.ndarray, grams: np.ndarray, counts: np.ndarray):
        self.langs, self.trees = langs, []
        for i in range(len(langs)):
            own = lang_of == i
            self.trees.append(ContextTrees(langs[i:i + 1], np.zeros(own.sum(), np.int64), grams[own], counts[own],
                                           DENSE // len(langs)))

    def code_lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[row, language] bits of padded rows. A byte's code length depends on
        it and the ORDER bytes before: every such string is priced once."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        gram = np.zeros(max(len(raw) - ORDER, 0), np.uint32)
        for j in range(ORDER + 1):
            gram = gram << np.uint32(8) | raw[j:len(raw) - ORDER + j]
        counted = np.ones(len(raw), bool)
        counted[(offsets[:-1, None] + np.arange(ORDER)).ravel()] = False
        counted = np.flatnonzero(counted)
        distinct, which = np.unique(gram[counted - ORDER], return_inverse=True)
        strings = np.stack([distinct >> np.uint32(8 * (ORDER - j)) & np.uint32(255) for j in range(ORDER + 1)], axis=1).astype(np.uint8)
        at = np.arange(len(distinct) + 1) * (ORDER + 1)
        bits = np.zeros(len(raw))
        for i, tree in enumerate(self.trees):
            if len(distinct):
                bits[counted] = tree.code_lengths(strings.ravel(), at)[:, 0][which]
            out[:, i] = np.add.reduceat(bits, offsets[:-1])
        return out


def training_pieces(docs: DataFrame) -> DataFrame | None:
    """(lang, raw): distinct pieces of the documents that may be learned from,
    about TRAIN_BYTES per language, after the ORDER bytes before each."""
    own = docs.where((remainder(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"),
        F.concat(F.lit(PAD.tobytes()), F.col("text").cast("binary")).alias("raw"))
    starts = F.sequence(F.lit(1), F.octet_length("raw") - ORDER, F.lit(PIECE))
    pieces = F.transform(starts, lambda at: F.substring(F.col("raw"), at, F.lit(PIECE + ORDER)))
    # copies count once, so that the rate holds for what can be learned
    distinct = own.select("lang", F.explode(F.transform(pieces, lambda p: F.struct(
        F.xxhash64(p).alias("key"), F.octet_length(p).alias("size")))).alias("p")).groupBy("lang", "p.key").agg(
        F.max("p.size").alias("size"))
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.sum(F.col("size") - ORDER).alias("n")).collect()}
    if not sizes:
        return None
    share = {lang: min(1.0, TRAIN_BYTES / n) for lang, n in sizes.items()}
    rate = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    drawn = F.filter(pieces, lambda p: F.pmod(F.xxhash64(p), F.lit(1 << 30)) / F.lit(float(1 << 30)) < rate)
    # bounded: a task for each TRAIN_BYTES, so that few tasks list the same strings
    return own.select("lang", F.explode(drawn).alias("raw")).distinct().coalesce(len(sizes))


def fit(spark, docs: DataFrame) -> Forest:
    """Context trees of the languages of the documents that may be learned from."""
    pieces = training_pieces(docs)
    if pieces is None:
        return Forest([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    table = gram_counts(pieces, pad=False).toArrow()
    named = table.column("lang").combine_chunks().dictionary_encode()
    langs = sorted(named.dictionary.to_pylist())
    place = np.array([langs.index(x) for x in named.dictionary.to_pylist()], np.int64)
    return Forest(langs, place[named.indices.to_numpy()], table.column("gram").to_numpy(), table.column("n").to_numpy())


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter (of any script)."""
    some = np.append(0, np.cumsum(_ASCII_LETTER[data]))
    out = some[offsets[1:]] > some[offsets[:-1]]
    for r in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        text = data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "ignore")
        out[r] = any(c.isalpha() for c in text)
    return out


def row_code_lengths(trees: Forest, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[row, language] bits; a long row is read in pieces, each after the last
    bytes of the one before."""
    out = np.zeros((len(offsets) - 1, len(trees.langs)))
    for a, b in batch_slices(offsets, SLICE_BYTES):
        if b - a > 1 or offsets[b] - offsets[a] <= 2 * SLICE_BYTES:
            out[a:b] = trees.code_lengths(*padded(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
            continue
        before = PAD
        for s in range(int(offsets[a]), int(offsets[b]), SLICE_BYTES):
            piece = data[s:min(s + SLICE_BYTES, offsets[b])]
            out[a] += trees.code_lengths(*padded(piece, np.array([0, len(piece)]), before))[0]
            before = np.concatenate([before, piece[-ORDER:]])[-ORDER:]
    return out


def predict(docs: DataFrame, trees) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); ``trees`` broadcasts a Forest."""
    def run(batches):
        model = trees.value
        names = np.array([*model.langs, "und"], object)
        for b in batches:
            data, offsets = utf8_column(b.column(2))
            best, score = np.full(b.num_rows, -1), np.zeros(b.num_rows)
            if model.langs and b.num_rows:
                bits = row_code_lengths(model, data, offsets)
                best = bits.argmin(axis=1)
                odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0))
                score = 1.0 / odds.sum(axis=1)
                none = ~_letters(data, offsets)
                best[none], score[none] = -1, 0.0
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names[best].tolist(), pa.string()),
                                   pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("binary").alias("raw")).mapInArrow(
        run, schema)


def identify(spark, docs: DataFrame) -> DataFrame:
    """Languages of all documents, written."""
    with Scratch(spark, "language-id") as scratch:
        # bounded: about TRAIN_BYTES strings per language at each of ORDER + 1 levels
        trees = spark.sparkContext.broadcast(fit(spark, docs))
        return scratch.keep(predict(docs, trees), "result", result=True)

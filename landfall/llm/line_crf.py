"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. Its score is linear in its own
features and those of the lines before and after it; transition scores tie
neighbours. Forward-backward gives each line's probability of being good; the
document's score is their mean, weighted by line length.

The field is fitted on the driver on a bounded hash sample of labelled
documents (about MAX_DOCS of them with about MAX_LINES lines, none over
MAX_TRAIN_BYTES), every line carrying its document's label. Features are counted
on whole batches of bytes.

Defined cases: a null, empty or blank text scores EMPTY_SCORE; a null doc_id
is neither held out nor learned from; labels other than 0 and 1, or null, are
not learned from; without any label every text scores 0.5; lines are what
stands between line feeds; repeated rows score alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batch_slices, utf8_column
from .shingles import Powers, mix64, word_hashes

MAX_DOCS = 4000
MAX_TRAIN_BYTES = 1 << 18
MAX_LINES = 400_000     # of 192 bytes each on the driver
SLICE_BYTES = 1 << 19
THRESHOLD = 0.3
EMPTY_SCORE = 0.0
ROUNDS, STEP, PENALTY = 250, 0.1, 1.0

_BYTES = np.arange(256)
_CLASSES = {
    "symbol": np.isin(_BYTES, list(b"#*$%&|<>")),
    "digit": (_BYTES >= 48) & (_BYTES < 58),
    "upper": (_BYTES >= 65) & (_BYTES < 91),
    "letter": ((_BYTES | 32) >= 97) & ((_BYTES | 32) < 123) | (_BYTES >= 0xC0),
    "shout": _BYTES == 33,
    "point": np.isin(_BYTES, list(b",;:()[]{}\"'/\\=+-_~^@`")),
    "char": (_BYTES & 0xC0) != 0x80,
    "space": np.isin(_BYTES, [32, 9, 10, 11, 12, 13]),
}
_SENTENCE_END = np.isin(_BYTES, list(b".!?\"')"))
OWN = 15                    # features of a line itself
WIDTH = 3 * OWN + 3         # with the lines before and after, first, last, constant


def remainder(doc_id):
    """crc32 of the id as text, modulo 5 (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _repeats(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the same (group, value) stands earlier."""
    order = np.lexsort((value, group))
    same = np.zeros(len(value), bool)
    same[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return same


def line_features(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """(features, lengths, rows) of the lines that hold a word; rows ascend."""
    n = len(data)
    if not n:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0), np.zeros(0, np.int64)
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    start, stop = cuts[:-1], cuts[1:]
    counts = {}
    for name, member in _CLASSES.items():
        total = np.zeros(n + 1, np.int64)
        np.cumsum(member[data], out=total[1:])
        counts[name] = total[stop] - total[start]
    words, at = word_hashes(data, cuts, powers)
    n_words = np.diff(at)
    keep = n_words > 0
    line_of = np.repeat(np.arange(len(start)), n_words)
    adjacent = np.append(False, (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1]))[:len(words)]
    again = _repeats(line_of, words)
    place = (np.arange(len(words)) - at[:-1][line_of]).astype(np.uint64)
    line_hash = np.add.reduceat(mix64(words + place * np.uint64(0x9E3779B97F4A7C15)), at[:-1][keep]) if keep.any() else words
    n_adjacent, n_again = (np.bincount(line_of, weights=x, minlength=len(start))[keep] for x in (adjacent, again))
    c = {k: v[keep].astype(np.float64) for k, v in counts.items()}
    start, stop, n_words = start[keep], stop[keep], n_words[keep].astype(np.float64)
    rows = np.searchsorted(offsets, start, side="right") - 1
    inked = np.maximum(c["char"] - c["space"], 1)
    not_space = ~_CLASSES["space"][data]
    last_ink = np.maximum.accumulate(np.where(not_space, np.arange(n), 0))[stop - 1]
    own = np.zeros((len(start), OWN), np.float32)
    for i, x in enumerate((
            np.log1p(inked) / 5, c["symbol"] / inked, c["symbol"] / inked > 0.02, c["digit"] / inked,
            c["upper"] / np.maximum(c["letter"], 1), c["letter"] / np.maximum(inked, 1), np.log1p(n_words) / 4,
            inked / n_words / 10, _SENTENCE_END[data[last_ink]], n_adjacent / n_words,
            1 - n_again / n_words, _repeats(rows, line_hash), c["shout"] / n_words,
            c["upper"] / n_words, c["point"] / inked)):
        own[:, i] = x
    first = np.append(True, rows[1:] != rows[:-1])[:len(rows)]
    last = np.append(first[1:], True)[:len(rows)]
    out = np.zeros((len(rows), WIDTH), np.float32)
    out[:, :OWN] = own
    out[1:, OWN:2 * OWN] = own[:-1] * ~first[1:, None]
    out[:-1, 2 * OWN:3 * OWN] = own[1:] * ~last[:-1, None]
    out[:, -3], out[:, -2], out[:, -1] = first, last, 1
    return out, c["char"], rows


def forward_backward(scores: np.ndarray, first: np.ndarray, counts: np.ndarray, transition: np.ndarray):
    """(log weights before, after [line, label], log normaliser [chain]) of
    chains of lines: ``counts`` lines from each of ``first``. One step handles
    the same place of all chains that are long enough."""
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    lanes = np.searchsorted(-counts, -np.arange(longest), side="left")
    before, after = np.zeros((len(scores), 2)), np.zeros((len(scores), 2))
    (t00, t01), (t10, t11) = transition
    for t in range(longest):
        at = first[:lanes[t]] + t
        if t:
            a, b = before[at - 1, 0], before[at - 1, 1]
            before[at, 0] = np.logaddexp(a + t00, b + t10)
            before[at, 1] = np.logaddexp(a + t01, b + t11) + scores[at]
        else:
            before[at, 1] = scores[at]
    for t in range(longest - 2, -1, -1):
        at = first[:lanes[t + 1]] + t
        a, b = after[at + 1, 0], after[at + 1, 1] + scores[at + 1]
        after[at, 0] = np.logaddexp(t00 + a, t01 + b)
        after[at, 1] = np.logaddexp(t10 + a, t11 + b)
    total = np.zeros(len(order))
    if len(order):
        ends = first + counts - 1
        total[order] = np.logaddexp(before[ends, 0], before[ends, 1])
    return before, after, total


class LineField:
    """Weights of the line features (standardised) and of the transitions."""

    def __init__(self):
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)
        self.weights, self.transition = np.zeros(WIDTH), np.zeros((2, 2))

    def line_scores(self, features: np.ndarray) -> np.ndarray:
        w = self.weights / self.scale
        return features @ w.astype(np.float32) - float(self.mean @ w)

    def good(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """P(good) of each line given its whole document."""
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])[:len(rows)])
        counts = np.diff(np.append(first, len(rows)))
        scores = self.line_scores(features).astype(np.float64)
        before, after, total = forward_backward(scores, first, counts, self.transition)
        return np.exp(before[:, 1] + after[:, 1] - np.repeat(total, counts))

    def fit(self, features: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> None:
        """Maximum likelihood with an L2 penalty; ``labels`` per line."""
        if not len(rows):
            return
        self.mean, self.scale = features.mean(axis=0, dtype=np.float64), features.std(axis=0, dtype=np.float64)
        self.mean[-1], self.scale[-1] = 0.0, 1.0
        self.scale[self.scale < 1e-6] = 1.0
        x = (features - self.mean) / self.scale
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        counts = np.diff(np.append(first, len(rows)))
        inner = np.setdiff1d(np.arange(len(rows)), first)
        told = np.zeros((2, 2))
        np.add.at(told, (labels[inner - 1], labels[inner]), 1)
        theta = np.zeros(WIDTH + 4)
        momentum, spread = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, ROUNDS + 1):
            transition = theta[WIDTH:].reshape(2, 2)
            scores = x @ theta[:WIDTH]
            before, after, total = forward_backward(scores, first, counts, transition)
            total = np.repeat(total, counts)
            good = np.exp(before[:, 1] + after[:, 1] - total)
            expected = np.zeros((2, 2))
            for i in range(2):
                for j in range(2):
                    expected[i, j] = np.exp(before[inner - 1, i] + transition[i, j] + j * scores[inner]
                                            + after[inner, j] - total[inner]).sum()
            slope = np.concatenate([x.T @ (labels - good), (told - expected).ravel()]) - PENALTY * theta
            slope /= len(first)
            momentum = 0.9 * momentum + 0.1 * slope
            spread = 0.99 * spread + 0.01 * slope ** 2
            theta = theta + STEP * (momentum / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
        self.weights, self.transition = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)


def training_lines(texts: DataFrame) -> DataFrame:
    """(order, label, features) of (order, label, raw): float32 rows per document."""
    def run(batches):
        powers = Powers()
        for b in batches:
            data, offsets = utf8_column(b.column(2))
            out = [line_features(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]), powers)[0]
                   for i in range(b.num_rows)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array([x.tobytes() for x in out], pa.binary())],
                                  names=["order", "label", "features"])

    return texts.mapInArrow(run, "order long, label int, features binary")


def fit(scratch: Scratch, docs: DataFrame, labels: DataFrame) -> LineField:
    """A field fitted on a sample of the labelled documents."""
    docs = docs.select("doc_id", "text")
    told = labels.where((remainder(F.col("doc_id")) != 0) & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("l_id"), F.col("quality").cast("int").alias("l_label"))
    text = F.col("text")
    sized = docs.select("doc_id", (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("lines")).where(
        F.octet_length(text).between(1, MAX_TRAIN_BYTES))
    known = sized.join(told, F.col("doc_id") == F.col("l_id")).groupBy("l_id", "l_label").agg(F.max("lines").alias("lines"))
    known = scratch.keep(known.withColumn("l_order", F.xxhash64("l_id")), "labelled")  # what can be learned from, ids once
    size = known.agg(F.count("*").alias("n"), F.sum("lines").alias("lines")).first()
    share = min(1.0, MAX_DOCS / max(size["n"], 1), MAX_LINES / max(size["lines"] or 1, 1))
    drawn = scratch.keep(known.where(F.pmod(F.hash("l_order"), F.lit(1 << 20)) < share * (1 << 20)).select(
        "l_id", "l_label", "l_order"), "drawn")
    texts = docs.where(F.octet_length(text).between(1, MAX_TRAIN_BYTES)).join(
        F.broadcast(drawn), F.col("doc_id") == F.col("l_id")).select(
        F.col("l_order").alias("order"), F.col("l_label").alias("label"), text.cast("binary").alias("raw"))
    texts = texts.groupBy("order", "label").agg(F.min("raw").alias("raw"))  # of repeated ids the least text
    table = scratch.keep(training_lines(texts), "training-lines").toArrow()
    docs_ = sorted(zip(*(table.column(c).to_pylist() for c in ("order", "label", "features")), strict=True))
    parts = [np.frombuffer(f, np.float32).reshape(-1, WIDTH) for _, _, f in docs_]
    sizes = [len(p) for p in parts]
    field = LineField()
    if parts:
        field.fit(np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes),
                  np.repeat(np.array([label for _, label, _ in docs_]), sizes))
    return field


def document_scores(field: LineField, data: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
    out = np.full(len(offsets) - 1, EMPTY_SCORE)
    for a, b in batch_slices(offsets, SLICE_BYTES):
        features, lengths, rows = line_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], powers)
        if not len(rows):
            continue
        good = field.good(features, rows)
        total = np.bincount(rows, weights=lengths, minlength=b - a)
        some = total > 0
        out[a:b][some] = np.clip((np.bincount(rows, weights=lengths * good, minlength=b - a)[some] / total[some]), 0, 1)
    return out


def quality(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, written."""
    def run(batches):
        powers, field = Powers(), model.value
        for b in batches:
            data, offsets = utf8_column(b.column(2))
            score = document_scores(field, data, offsets, powers)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(score, pa.float64()),
                                   pa.array((score >= THRESHOLD).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    with Scratch(spark, "line-crf") as scratch:
        model = spark.sparkContext.broadcast(fit(scratch, docs, labels))  # a few hundred numbers
        rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("binary").alias("raw"))
        return scratch.keep(rows.mapInArrow(run, schema), "result", result=True)

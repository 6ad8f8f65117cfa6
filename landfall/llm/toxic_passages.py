"""Toxicity by maximum-scoring segments.

Every token carries a log-odds score between toxic and clean documents; a
passage is a maximal-scoring segment of a text's tokens. One linear scan finds
all of them (Ruzzo and Tompa 1999). A passage of score S in a text of n tokens
has the extreme-value expectation E = K n exp(-L S): so many passages as good
would stand in a clean text of that length. Passages with E < 1 are
significant; the document's evidence is the sum of their -ln E, which a
logistic curve turns into a probability.

Scores: a token counts once per token that it follows, on either side, so that
copies and copied passages count once. Its toxic share has a Dirichlet prior
of STRENGTH such counts, whose mean is the share among the other tokens with the
same first four bytes, itself drawn towards the corpus (a token that was never
seen gets its beginning's share). The score is the log-odds against the corpus
less OFFSET, so that scores drift down in clean text.

Learning: a documented, bounded sample of labelled documents (distinct texts of
at most MAX_TEXT_BYTES; per class at most about MAX_DOCS documents and
MAX_BYTES bytes, drawn by the text's hash). Token counts are added up in Spark.
K, L and the curve are fitted on documents that the scores they are measured
with were not learned from (two folds).

Tokens are runs of ASCII letters and non-ASCII bytes, A-Z lower-cased. Texts
are scored whole, long ones in pieces that end between tokens.

Defined cases: a null or empty text, or one without a letter, has no passage
and the score of any text without evidence; a null doc_id is neither held out
nor learned from; labels other than 0 and 1, or null, are not learned from;
without labels of both classes every text scores 0.5; repeated rows score
alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batch_slices, utf8_column
from .shingles import Powers, mix64

MAX_TEXT_BYTES = 1 << 18
MAX_DOCS, MAX_BYTES = 10_000, 8 << 20   # of each class
SLICE_BYTES, PIECE_BYTES = 1 << 19, 1 << 20
STRENGTH, BEGINNING_STRENGTH, OFFSET = 4.0, 4.0, 1.0
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


# ------------------------------------------------------------------ tokens
def _tokens_of(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """(hash, beginning, start, stop) of each token; rows end tokens."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    letter = _LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(letter & (np.append(True, ~letter[:-1]) | edge[:n]))
    stop = np.flatnonzero(letter & (np.append(~letter[1:], True) | edge[1:])) + 1
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:n], out=total[1:])
    h = mix64((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    beginning = np.zeros(len(start), np.uint64)
    for i in range(4):
        here = start + i < stop
        beginning |= np.where(here, _LOWER[data[np.minimum(start + i, n - 1)]], 0).astype(np.uint64) << np.uint64(8 * i)
    return h, beginning, start, stop


def tokens(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """(hash, beginning, start, stop, row offsets) of the tokens of whole rows;
    a single long row in pieces, so that the work arrays stay small."""
    if len(offsets) != 2 or len(data) <= 2 * PIECE_BYTES:
        h, b, start, stop = _tokens_of(data, offsets, powers)
        return h, b, start, stop, np.searchsorted(start, offsets)
    parts, at = [], 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):  # on to the end of the token
            gap = np.flatnonzero(~_LETTER[data[end:end + PIECE_BYTES]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + PIECE_BYTES, len(data))
        h, b, start, stop = _tokens_of(data[at:end], np.array([0, end - at]), powers)
        parts.append((h, b, start + at, stop + at))
        at = end
    h, b, start, stop = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, b, start, stop, np.array([0, len(h)])


# ------------------------------------------------------------------ passages
def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score) in order of place.

    Tokens of one sign in a row are one step, since a maximal segment holds
    whole runs of positive ones. A candidate remembers the last one whose sum
    before it is smaller, so that a look back skips what cannot be joined.
    """
    if not (scores > 0).any():
        return []
    sign = scores > 0
    cuts = np.append(0, np.flatnonzero(sign[1:] != sign[:-1]) + 1)
    after = np.cumsum(np.add.reduceat(scores, cuts))
    before = np.append(0.0, after[:-1])
    ends = np.append(cuts[1:], len(scores))
    first, last, low, high, link = [], [], [], [], []
    for i in np.flatnonzero(sign[cuts]).tolist():
        a, b, left, right = int(cuts[i]), int(ends[i]), float(before[i]), float(after[i])
        while True:
            j = len(first) - 1
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            a, left = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
        first.append(a), last.append(b), low.append(left), high.append(right), link.append(j)
    return [(a, b, r - x) for a, b, x, r in zip(first, last, low, high)]


@dataclass
class Scores:
    """Token scores: by token where it was seen, else by its beginning."""
    token: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    beginning: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    beginning_value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @staticmethod
    def learn(token, beginning, toxic, clean) -> "Scores":
        """From how often each distinct token counts on either side."""
        if not len(token):
            return Scores()
        corpus = max(toxic.sum(), 0.5) / max(toxic.sum() + clean.sum(), 1)
        corpus = min(max(corpus, 1e-3), 1 - 1e-3)
        known, which = np.unique(beginning, return_inverse=True)
        share = toxic / (toxic + clean)
        mass, kinds = np.bincount(which, share), np.bincount(which)
        of_others = (mass[which] - share + BEGINNING_STRENGTH * corpus) / (kinds[which] - 1 + BEGINNING_STRENGTH)
        own = (toxic + STRENGTH * of_others) / (toxic + clean + STRENGTH)
        unseen = (mass + BEGINNING_STRENGTH * corpus) / (kinds + BEGINNING_STRENGTH)

        def score(p):
            return np.log(p / (1 - p)) - np.log(corpus / (1 - corpus)) - OFFSET

        order = np.argsort(token)
        return Scores(token[order], score(own)[order], known, score(unseen))

    def of(self, token: np.ndarray, beginning: np.ndarray) -> np.ndarray:
        if not len(self.token):
            return np.full(len(token), -OFFSET)
        b = np.minimum(np.searchsorted(self.beginning, beginning), len(self.beginning) - 1)
        out = np.where(self.beginning[b] == beginning, self.beginning_value[b], -OFFSET)
        t = np.minimum(np.searchsorted(self.token, token), len(self.token) - 1)
        return np.where(self.token[t] == token, self.value[t], out)


@dataclass
class Calibration:
    """Extreme-value parameters and the logistic curve over the evidence."""
    scale: float = 1.0     # L
    weight: float = 0.01   # K
    slope: float = 0.0
    level: float = 0.0

    def fit_null(self, n: np.ndarray, best: np.ndarray) -> None:
        """Maximum likelihood of K and L from clean texts: ``best`` passage
        scores (0: none) in texts of ``n`` tokens."""
        n, best = n[n > 0].astype(float), best[n > 0]
        some = int((best > 0).sum())
        if some < 2:
            return
        scales = np.exp(np.linspace(np.log(0.05), np.log(10), 400))
        weights = np.array([some / (n * np.exp(-s * best)).sum() for s in scales])
        gain = some * (np.log(weights) + np.log(scales)) - scales * best.sum()
        at = int(np.argmax(gain))
        self.scale, self.weight = float(scales[at]), float(weights[at])

    def evidence(self, n: int, scores) -> list[float]:
        """-ln E of each passage."""
        base = np.log(self.weight * max(n, 1))
        return [self.scale * s - base for s in scores]

    def fit_curve(self, evidence: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> None:
        x = np.stack([evidence, np.ones(len(evidence))], axis=1)
        theta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            slope = x.T @ (weights * (toxic - p)) - 1e-2 * theta
            curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            theta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.level = max(float(theta[0]), 0.0), float(theta[1])

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.level, -500, 500)))


@dataclass
class Model:
    scores: Scores
    calibration: Calibration


def text_passages(data: np.ndarray, offsets: np.ndarray, scores, powers: Powers):
    """Per row (number of tokens, maximal segments, token starts, token stops).
    ``scores`` maps (token, beginning, row of each token) to scores."""
    for a, b in batch_slices(offsets, SLICE_BYTES):
        part, cuts = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        h, beginning, start, stop, at = tokens(part, cuts, powers)
        rows = np.repeat(np.arange(a, b), np.diff(at))
        value = scores(h, beginning, rows)
        for i in range(b - a):
            x, y = at[i], at[i + 1]
            yield (int(y - x), maximal_segments(value[x:y]), start[x:y] - cuts[i], stop[x:y] - cuts[i])


# ------------------------------------------------------------------ learning
def remainder(doc_id):
    """crc32 of the id as text, modulo 3 (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_texts(scratch: Scratch, docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """(label, fold, raw) of the sample, and by label the share of its distinct
    texts that it holds."""
    told = labels.where((remainder(F.col("doc_id")) != 1) & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("label")).groupBy("l_id").agg(F.max("label").alias("label"))
    sized = docs.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes")).where(
        F.col("bytes").between(1, MAX_TEXT_BYTES))
    kinds = scratch.keep(sized.join(told, F.col("doc_id") == F.col("l_id")).groupBy("h", "label").agg(
        F.min("doc_id").alias("rep"), F.max("bytes").alias("bytes")), "kinds")
    sizes = {r["label"]: (r["n"], r["b"]) for r in kinds.groupBy("label").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("b")).collect()}  # two rows
    share = {k: min(1.0, MAX_DOCS / n, MAX_BYTES / b) for k, (n, b) in sizes.items()}
    mixed = F.pmod(F.hash("h"), F.lit(1 << 20)) / float(1 << 20)
    limit = F.when(F.col("label") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    drawn = scratch.keep(kinds.where(mixed < limit).select(F.col("h").alias("k_h"), "label", "rep"), "drawn")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(
        F.broadcast(drawn), (F.col("doc_id") == F.col("rep")) & (F.col("h") == F.col("k_h")))  # at most 2 * MAX_DOCS rows
    fold = F.pmod(F.shiftright("h", 20), F.lit(2)).cast("int")
    return scratch.keep(texts.select("label", fold.alias("fold"), F.col("text").cast("binary").alias("raw")), "texts"), share


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, beginning, t0, c0, t1, c1): after how many different tokens a
    token stands in the toxic and clean documents of each fold. A passage that
    is copied counts once."""
    def run(batches):
        powers = Powers()
        for b in batches:
            label, fold = b.column(0).to_numpy(), b.column(1).to_numpy()
            data, offsets = utf8_column(b.column(2))
            for x, y in batch_slices(offsets, SLICE_BYTES):
                h, beginning, _, _, at = tokens(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x], powers)
                rows = np.repeat(np.arange(x, y), np.diff(at))
                before = np.append(np.uint64(0), h[:-1])[:len(h)]
                before[at[:-1][np.diff(at) > 0]] = 0
                bit = (1 << (2 * fold[rows] + 1 - label[rows])).astype(np.int64)
                order = np.lexsort((before, h))
                h, beginning, before, bit = h[order], beginning[order], before[order], bit[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (before[1:] != before[:-1]))[:len(h)])
                bits = np.bitwise_or.reduceat(bit, first) if len(first) else bit
                yield pa.record_batch([*(pa.array(z[first].view(np.int64)) for z in (h, beginning, before)), pa.array(bits)],
                                      names=["token", "beginning", "before", "bits"])

    pairs = texts.mapInArrow(run, "token long, beginning long, before long, bits long").groupBy(
        "token", "beginning", "before").agg(F.bit_or("bits").alias("bits"))
    return pairs.groupBy("token", "beginning").agg(*[
        F.sum(F.getbit("bits", F.lit(i))).cast("long").alias(c) for i, c in enumerate(("t0", "c0", "t1", "c1"))])


def held_out_passages(spark, texts: DataFrame, folds) -> DataFrame:
    """(label, n, scores) of each text, by the scores of the other fold."""
    known = spark.sparkContext.broadcast(folds)  # bounded by the sample

    def run(batches):
        powers = Powers()
        for b in batches:
            fold = b.column(1).to_numpy()
            data, offsets = utf8_column(b.column(2))

            def scores(h, beginning, rows, fold=fold):
                return np.where(fold[rows] == 0, known.value[1].of(h, beginning), known.value[0].of(h, beginning))

            found = [(n, [s for _, _, s in segments]) for n, segments, _, _ in text_passages(data, offsets, scores, powers)]
            yield pa.record_batch([b.column(0), pa.array([n for n, _ in found], pa.int64()),
                                   pa.array([s for _, s in found], pa.list_(pa.float64()))], names=["label", "n", "scores"])

    return texts.mapInArrow(run, "label int, n long, scores array<double>")


def learn(scratch: Scratch, docs: DataFrame, labels: DataFrame) -> Model:
    """Scores and calibration; all that reaches the driver is bounded by the
    sample."""
    spark = scratch.spark
    texts, share = training_texts(scratch, docs, labels)
    if not share.get(0) or not share.get(1):
        return Model(Scores(), Calibration())
    table = scratch.keep(token_counts(texts), "tokens").toArrow().sort_by("token")
    token, beginning = (table.column(c).to_numpy().view(np.uint64) for c in ("token", "beginning"))
    t0, c0, t1, c1 = (table.column(c).to_numpy() for c in ("t0", "c0", "t1", "c1"))
    folds = []
    for t, c in ((t0, c0), (t1, c1)):
        seen = t + c > 0
        folds.append(Scores.learn(token[seen], beginning[seen], t[seen], c[seen]))
    found = scratch.keep(held_out_passages(spark, texts, folds), "held-out").orderBy("label", "n", "scores").collect()
    calibration = Calibration()
    clean = [r for r in found if r["label"] == 0]
    calibration.fit_null(np.array([r["n"] for r in clean]), np.array([max(r["scores"], default=0.0) for r in clean]))
    evidence = np.array([sum(e for e in calibration.evidence(r["n"], r["scores"]) if e > 0) for r in found])
    toxic = np.array([r["label"] for r in found], float)
    calibration.fit_curve(evidence, toxic, np.where(toxic == 1, 1 / share[1], 1 / share[0]))
    return Model(Scores.learn(token, beginning, t0 + t1, c0 + c1), calibration)


# ------------------------------------------------------------------ scoring
def toxicity(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of every document;
    passages are its significant ones: first and last character (counted from
    0, the last not included), score and expectation E."""
    def run(batches):
        powers, model = Powers(), known.value
        calibration = model.calibration
        for b in batches:
            data, offsets = utf8_column(b.column(2))
            evidence, passages = np.zeros(b.num_rows), []
            rows = text_passages(data, offsets, lambda h, beginning, _: model.scores.of(h, beginning), powers)
            for i, (n, segments, start, stop) in enumerate(rows):
                found = [(x, y, s, e) for (x, y, s), e in zip(
                    segments, calibration.evidence(n, [s for _, _, s in segments])) if e > 0]
                evidence[i] = sum(e for *_, e in found)
                if found:
                    text = data[offsets[i]:offsets[i + 1]]
                    places = np.append(0, np.cumsum((text & 0xC0) != 0x80))
                    found = [{"start": int(places[start[x]]), "stop": int(places[stop[y - 1]]), "score": s,
                              "expected": float(np.exp(-e))} for x, y, s, e in found]
                passages.append(found)
            score = calibration.probability(evidence)
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)),
                 pa.array(passages, _PASSAGES)], names=["doc_id", "held_out", "score", "predicted", "passages"])

    held_out = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("passages", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
            T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])))])
    docs = docs.select("doc_id", "text")
    with Scratch(spark, "toxic-passages") as scratch:
        known = spark.sparkContext.broadcast(learn(scratch, docs, labels.select("doc_id", "toxic")))
        rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("binary").alias("raw"))
        return scratch.keep(rows.mapInArrow(run, schema), "result", result=True)


_PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

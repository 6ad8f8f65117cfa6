"""Quality rules by weak supervision, in DataFrame expressions only.

Rules look at counts of a document and vote good (+1), bad (-1) or abstain
(0). Expectation-maximisation over the distinct vote patterns (at most
``3 ** len(RULES)`` of them, whatever the input) estimates how accurate each
rule is and how common good documents are; the posterior probability of a
document then replaces "must pass every rule".

Everything is counted per row with array functions: no row leaves its task
until its counts are a few numbers.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; without any document the estimates stay at their start values; a
rule that abstains everywhere keeps its start accuracy; repeated rows count
as often as they occur.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, Scratch, let, words_column

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 30
# a rule's accuracy on good and on bad documents (of those where it votes)
START_ACCURACY, START_GOOD = (0.98, 0.5), 0.85
ACCURACY_RANGE = (0.02, 0.999)
GOOD_RANGE = (0.05, 0.95)
KEEP_FROM = 0.5

# rule: (ratio, good when at most, bad when above); None: never votes that way
RULES = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", 0.05, 0.2),
    "symbols_per_character": ("n_symbols / greatest(word_chars, 1)", 0.02, 0.05),
    "repeated_words": ("n_repeat_words / greatest(n_words, 1)", 0.2, 0.4),
    "repeated_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.2, 0.5),
    "long_words": ("word_chars / greatest(n_words, 1)", 9.0, 14.0),
    "upper_case": ("n_upper / greatest(word_chars, 1)", 0.15, 0.4),
    "digits": ("n_digits / greatest(word_chars, 1)", 0.1, 0.3),
    "few_kinds_of_words": ("1 - n_kinds / greatest(n_words, 1)", 0.75, 0.9),
}


def _repeated_words(words):
    """Words inside a 3-word window that occurs twice or more in the text.

    Windows are sorted as (hash, position) pairs; neighbours with equal hashes
    are repeats. Their positions, sorted again, cover at most 3 words each.
    """
    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        places = let(pairs, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: (
            (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))),
            lambda x: x["p"])))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(
                F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda total, x: total + x))

    repeats = lambda w: let(hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(words, repeats))


def statistics(text) -> dict:
    """Count expressions over a text column: what the rules and the base use."""
    body = F.coalesce(text, F.lit(""))
    packed = F.translate(body, WS_CHARS, "")
    words = words_column(text)

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        _repeated_words(w).cast("long").alias("n_repeat_words"),
                        F.size(F.array_distinct(w)).cast("long").alias("n_kinds"))

    def of_lines(lines):
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
    return {
        "words": let(words, of_words),
        "lines": let(lines, of_lines),
        "word_chars": F.length(packed).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_upper": F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("long"),
        "n_digits": (F.length(body) - F.length(F.translate(body, "0123456789", ""))).cast("long"),
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_kinds", "n_upper", "n_digits"]


def counted(docs: DataFrame, keep: list, text: str = "text") -> DataFrame:
    """``keep`` columns and the counts of each document (struct ``c`` holds
    nothing of the text)."""
    raw = docs.select(*keep, F.struct(*[e.alias(n) for n, e in statistics(F.col(text)).items()]).alias("raw"))
    at = {"n_words": "words.n_words", "n_repeat_words": "words.n_repeat_words", "n_kinds": "words.n_kinds",
          "n_lines": "lines.n_lines", "n_dup_lines": "lines.n_dup_lines"}
    return raw.select(*[c for c in raw.columns if c != "raw"],
                      F.struct(*[F.col(f"raw.{at.get(c, c)}").alias(c) for c in COUNTS]).alias("c"))


def _qualified(sql: str) -> str:
    """The rule's ratio over the fields of the struct ``c``."""
    for name in sorted(COUNTS, key=len, reverse=True):
        sql = sql.replace(name, f"c.{name}")
    return sql


def votes() -> list:
    """One vote column per rule, from the counts in ``c``; no word: abstain."""
    out = []
    for name, (ratio, good, bad) in RULES.items():
        value = F.expr(f"double({_qualified(ratio)})")
        out.append(F.when(F.col("c.n_words") == 0, 0).when(value <= good, 1).when(value > bad, -1)
                   .otherwise(0).cast("int").alias(name))
    return out


def base_failed():
    return (F.col("c.n_words") < MIN_WORDS) | (100 * F.col("c.n_repeat_words") > 50 * F.col("c.n_words"))


def posterior(accuracy: dict[str, tuple[float, float]], good: float):
    """P(good | votes) with the estimated parameters, as an expression."""
    score = F.lit(math.log(good / (1 - good)))
    for name, (on_good, on_bad) in accuracy.items():
        score = score + F.when(F.col(name) == 1, math.log(on_good / (1 - on_bad))).when(
            F.col(name) == -1, math.log((1 - on_good) / on_bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def _clamp(value, bounds):
    return F.least(F.greatest(value, F.lit(bounds[0])), F.lit(bounds[1]))


def _share(part, whole, otherwise: float):
    return F.when(whole > 1e-9, part / F.when(whole > 1e-9, whole)).otherwise(F.lit(otherwise))


def _em_round(patterns, state):
    """The next state (share, on_good[], on_bad[]) from the vote patterns
    (votes[], n): posteriors of the patterns, then weighted vote counts."""
    for_good = F.zip_with(state["on_good"], state["on_bad"], lambda g, b: F.log(g / (1 - b)))
    for_bad = F.zip_with(state["on_good"], state["on_bad"], lambda g, b: F.log((1 - g) / b))
    prior = F.log(state["share"] / (1 - state["share"]))

    def score(votes, weights):
        terms = F.zip_with(votes, weights, lambda v, w: F.when(v == 1, w["for_good"]).when(v == -1, w["for_bad"])
                           .otherwise(0.0))
        return F.aggregate(terms, prior, lambda total, x: total + x)

    def posteriors(weights):
        return F.transform(patterns, lambda p: F.struct(
            p["votes"].alias("votes"), p["n"].alias("n"), (1 / (1 + F.exp(-score(p["votes"], weights)))).alias("p")))

    def counted(judged):
        def total(value):
            return F.aggregate(judged, F.lit(0.0), lambda s, x: s + value(x))

        def accuracy(k, sign, weight, start):
            vote = lambda x: F.get(x["votes"], F.lit(k))
            right = total(lambda x: F.when(vote(x) == sign, weight(x)).otherwise(0.0))
            voted = total(lambda x: F.when(vote(x) != 0, weight(x)).otherwise(0.0))
            return _clamp(_share(right, voted, start), ACCURACY_RANGE)

        good = lambda x: x["n"] * x["p"]
        bad = lambda x: x["n"] * (1 - x["p"])
        rules = range(len(RULES))
        return F.struct(
            _clamp(_share(total(good), total(lambda x: x["n"]), START_GOOD), GOOD_RANGE).alias("share"),
            F.array(*[accuracy(k, 1, good, START_ACCURACY[0]) for k in rules]).alias("on_good"),
            F.array(*[accuracy(k, -1, bad, START_ACCURACY[1]) for k in rules]).alias("on_bad"))

    weights = F.zip_with(for_good, for_bad, lambda g, b: F.struct(g.alias("for_good"), b.alias("for_bad")))
    return let(let(weights, posteriors), counted)


def estimate(patterns: DataFrame) -> tuple[dict[str, tuple[float, float]], float]:
    """EM over (one column per rule, ``n``): accuracies per rule, share of good.

    The table has a row per vote pattern, at most ``3 ** len(RULES)``, so it
    fits one row; all rounds are one expression over it.
    """
    rows = patterns.agg(F.collect_list(F.struct(
        F.array(*RULES).alias("votes"), F.col("n").cast("double").alias("n"))).alias("patterns"))
    start = F.struct(F.lit(START_GOOD).alias("share"),
                     *[F.array(*[F.lit(a)] * len(RULES)).alias(n) for n, a in zip(("on_good", "on_bad"), START_ACCURACY, strict=True)])
    state = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start,
                        lambda s, _: _em_round(F.col("patterns"), s))
    last = rows.select(state.alias("state")).first()["state"]
    return dict(zip(RULES, zip(last["on_good"], last["on_bad"], strict=True), strict=True)), last["share"]


def judged(scratch: Scratch, docs: DataFrame, keep: list, text: str = "text", result: bool = False) -> DataFrame:
    """``keep`` columns, counts ``c``, ``base_failed``, ``posterior``, ``kept``;
    ``result``: the counted table outlives ``scratch``."""
    table = scratch.keep(counted(docs, keep, text), "counts", result)
    patterns = scratch.keep(table.select(*votes()).groupBy(*RULES).agg(F.count("*").alias("n"))
                            .coalesce(1), "patterns")
    accuracy, good = estimate(patterns)
    voted = table.select("*", *votes())
    names = [c for c in table.columns]
    return (voted.withColumn("base_failed", base_failed())
            .withColumn("posterior", posterior(accuracy, good))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
            .select(*names, "base_failed", "posterior", "kept"))


def quality_rules(spark, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept for every document."""
    with Scratch(spark, "quality-rules") as scratch:
        out = judged(scratch, docs.select("doc_id", "text"), ["doc_id"])
        return scratch.keep(out.select("doc_id", *[F.col(f"c.{n}").alias(n) for n in COUNTS[:5]],
                                       "base_failed", "kept"), "judged", result=True)


def keep_good(spark, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    with Scratch(spark, "quality-filter") as scratch:
        out = judged(scratch, packed.withColumn("text", F.col("row.text")), ["row"], result=True)
        return out.where("kept").select("row.*")

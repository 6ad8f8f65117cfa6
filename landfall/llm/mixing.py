"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / weight``: ``u`` is a
uniform number hashed from the document's id, ``weight`` its quality weight
(the share of its word characters that are neither digits nor symbols, at
least 0.05). Taking documents of a source by ascending key is a weighted
sample without replacement. A source first gives its complete epochs (whole
copies of itself); the rest of its target is filled by key order up to the
token budget.

Prefix sums never gather a source in one task. A source of ``n`` documents is
cut into about ``sqrt(n)`` key ranges and their sums are added up; only the one
range in which the budget ends is looked into. While it holds more than SORTED
documents (weights far from 1 crowd the keys) it is cut again the same way, so
a task sorts at most SORTED documents of a source, or those with equal keys.

Defined cases: null text and text without a word have size 0 and are taken 0
times; a null source is a source of its own and sorts last; a null doc_id
hashes as an empty id; equal keys are ordered by doc_id and size; repeated
rows (same id, source, size and key) are taken or left together; an empty table gives an empty
result; a source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CHARS, Scratch, count_words

WEIGHT_CYCLE = (3, 1, 2)
MIX_SHARE = 1.5
MAX_EPOCHS = 2
SORTED = 4096
DIGITS_AND_SYMBOLS = "0123456789#*$%&|<>{}[]=_~^"


def quality_weight(text):
    """Share of word characters that are neither digits nor symbols, >= 0.05."""
    body = F.translate(F.coalesce(text, F.lit("")), WS_CHARS, "")
    clean = F.translate(body, DIGITS_AND_SYMBOLS, "")
    return F.greatest(F.lit(0.05), F.length(clean) / F.greatest(F.length(body), F.lit(1)))


def sampling_key(doc_id, text):
    """Efraimidis-Spirakis key: -ln(u) / weight, u from md5 of the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(2 ** 52))
    return -F.log(u) / quality_weight(text)


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets per source from (source, source_size, n_docs): one row each.

    The targets share ``MIX_SHARE`` of all sizes by the cyclic weights, capped
    at ``MAX_EPOCHS`` times the source, the excess reshared until none is
    above. Closed form: with sources ordered by cap / weight, the level is
    the greatest one that stays under its source's cap.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHT_CYCLE]),
                               ((F.row_number().over(by_name) - 1) % len(WEIGHT_CYCLE) + 1).cast("int")),
        "cap": F.col("source_size").cast("double") * MAX_EPOCHS,
        "total": F.sum("source_size").over(everything).cast("double") * MIX_SHARE,
    }).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    leveled = ranked.withColumn("level_here", level).withColumn(
        "level", F.max(F.when(F.col("level_here") <= F.col("ratio"), F.col("level_here"))).over(everything))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(target / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0)
    return (leveled.select("source", "source_size", "n_docs", target.alias("target"),
                           epochs.cast("long").alias("epochs"))
            .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
            .withColumn("n_ranges", F.ceil(F.sqrt(F.col("n_docs"))).cast("long")))


def keyed(docs: DataFrame, row_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, key): what the sampling needs of each document."""
    return docs.select(F.col(row_id).alias("doc_id"), F.col(source).alias("source"),
                       count_words(F.col(text)).alias("size"),
                       sampling_key(F.col(row_id), F.col(text)).alias("key"))


def mix_plan(scratch: Scratch, base: DataFrame, result: bool = False) -> DataFrame:
    """One row per source: m_source, source_size, target, epochs and ``last``,
    the greatest (key, doc_id, size) that the fractional part still takes
    (null: none). ``base`` has the columns of ``keyed``; written tables only.
    """
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # written, so that the planner knows its real size before it may broadcast it
    targets = scratch.keep(source_targets(sizes).withColumnRenamed("source", "m_source"), "mix-targets")
    same_source = F.col("source").eqNullSafe(F.col("m_source"))
    # repeated rows have equal keys and are taken or left together
    tied = (base.where("size > 0").groupBy("source", "key", "doc_id", "size")
            .agg((F.count("*") * F.col("size")).alias("words")))
    ranged = tied.join(targets.select("m_source", "n_ranges", "budget"), same_source).select(
        "source", "key", "doc_id", "size", "words", "budget",
        F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("n_ranges")),
                F.col("n_ranges") - 1).cast("long").alias("range"))
    ranged = scratch.keep(ranged, "mix-ranged")
    over_ranges = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = None  # the last document of the ranges that fit whole
    while True:
        per_range = ranged.groupBy("source", "range").agg(
            F.sum("words").alias("range_words"), F.max(F.struct("key", "doc_id", "size")).alias("top"),
            F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"), F.first("budget").alias("budget"))
        starts = scratch.keep(per_range.withColumn("start", F.coalesce(F.sum("range_words").over(over_ranges), F.lit(0))),
                              "mix-starts")
        fit = starts.where("start + range_words <= budget").groupBy(F.col("source").alias("w_source")).agg(
            F.max("top").alias("last"))
        whole = fit if whole is None else whole.unionByName(fit)
        # at most one range of a source
        ends = scratch.keep(starts.where("start < budget AND start + range_words > budget").select(
            F.col("source").alias("s_source"), F.col("range").alias("s_range"), "start", "low", "high", "n"), "mix-ends")
        near = ranged.join(ends, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range"))).select(
            "source", "key", "doc_id", "size", "words", (F.col("budget") - F.col("start")).alias("budget"), "low", "high", "n")
        largest = ends.where("high > low").agg(F.max("n")).first()[0]
        if largest is None or largest <= SORTED:
            break
        parts = F.ceil(F.sqrt("n"))
        cut = F.when(F.col("high") > F.col("low"), F.least(F.floor(
            (F.col("key") - F.col("low")) / (F.col("high") - F.col("low")) * parts), parts - 1)).otherwise(0)
        ranged = scratch.keep(near.select("source", "key", "doc_id", "size", "words", "budget",
                                          cut.cast("long").alias("range")), "mix-ranged")
    within = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(within), F.lit(0))
    taken = near.withColumn("before", before).where((F.col("budget") - F.col("before")) * 2 >= F.col("words"))
    last = taken.groupBy(F.col("source").alias("w_source")).agg(F.max(F.struct("key", "doc_id", "size")).alias("last"))
    last = last.unionByName(whole).groupBy(F.col("w_source").alias("l_source")).agg(F.max("last").alias("last"))
    plan = targets.join(last, F.col("m_source").eqNullSafe(F.col("l_source")), "left")
    return scratch.keep(plan.select("m_source", "source_size", "target", "epochs", "last"), "mix-plan", result)


def copies():
    """How often the plan takes a row of ``keyed`` joined with ``mix_plan``."""
    part = F.when(F.struct("key", "doc_id", "size") <= F.col("last"), 1).otherwise(0)
    fraction = F.when(F.col("epochs") < MAX_EPOCHS, F.coalesce(part, F.lit(0))).otherwise(0)
    return F.when(F.col("size") > 0, F.col("epochs") + fraction).otherwise(0).cast("long")


def mix(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    base = scratch.keep(keyed(docs), "mix-keys")
    plan = mix_plan(scratch, base)
    return base.join(plan, F.col("source").eqNullSafe(F.col("m_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def mix_documents(spark, docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` repeated as often as it is taken
    (rows that are not taken go), with all its columns."""
    with Scratch(spark, "mixing") as scratch:
        plan = mix_plan(scratch, scratch.keep(keyed(docs), "mix-keys"), result=True)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
        count_words(F.col("row.text")).alias("size"),
        sampling_key(F.col("row.doc_id"), F.col("row.text")).alias("key"))
    taken = rows.join(plan, F.col("source").eqNullSafe(F.col("m_source"))).select(
        "row", F.explode(F.array_repeat(F.lit(1), copies().cast("int"))).alias("copy"))
    return taken.select("row.*")

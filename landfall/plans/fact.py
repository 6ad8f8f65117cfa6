"""The admissions fact.

Rules, in order (each a native expression or a broadcast join):

1. rows without a departure date or an admitted-until text are dropped
   (plain null predicates: Parquet pushes them into the scan), and so are
   texts that cannot be a date (not eight digits: no regular expression);
2. SAS day numbers become dates (days since 1960-01-01); a departure that is
   no date (NaN, junk) drops the row;
3. the admitted-until text must be a real ``MMddyyyy`` date, else the row is
   dropped. It is converted once: rows with a date come first in step 5, and
   what is left without one goes after it;
4. numeric codes are cast exactly (``try_cast``: no ANSI failure on NaN or on
   CSV text such as ``5748517.0``);
5. rows without ``cic_id`` are dropped, one row per ``cic_id`` is kept
   (deterministically);
6. transport mode and visa codes are replaced by their labels (left joins to
   de-duplicated, size-checked lookups; unknown codes give null);
7. columns get their published names, in contract order.

Only the de-duplication shuffles; both lookups are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.contracts import ADMISSIONS_FIELDS, RAW_CASTS
from landfall.functions.cleaning import admitted_until, may_be_admitted_until, sas_day_to_date, to_number
from landfall.operators.quality import DROP_REASONS, reason_metrics
from landfall.operators.relational import keep_first, lookup_left


def cast_raw(raw: DataFrame) -> DataFrame:
    """Cast the raw SAS numbers and texts to their contract types (CSV text
    like ``'5748517.0'`` converts too)."""
    def typed(c: str):
        t = RAW_CASTS[c]
        if isinstance(t, (T.IntegerType, T.LongType)):
            return to_number(c, t.simpleString()).alias(c)
        return F.col(c).try_cast(t).alias(c)
    return raw.select(*[typed(c) if c in RAW_CASTS else F.col(c) for c in raw.columns])


class FactCounts:
    """Where the raw rows went, counted while the fact is computed: pass it to
    one :func:`admissions` and read it after the fact's one action."""

    def __init__(self):
        self.raw, self.kept = Observation(), Observation()

    def reasons(self) -> dict[str, int]:
        """Rows per entry of ``DROP_REASONS``."""
        raw, kept = self.raw.get, self.kept.get["kept"]
        return {r: raw[r] for r in DROP_REASONS[:5]} | {"duplicate_cic_id": raw["valid"] - kept, "kept": kept}


def admissions(raw: DataFrame, mode: DataFrame, visa: DataFrame,
               lookups_bounded: bool = False, lookups_unique: bool = False,
               counts: FactCounts | None = None) -> DataFrame:
    """Build the fact from raw admissions (any subset of the contract columns
    that includes ``cicid``, ``arrdate``, ``depdate``, ``dtaddto``).

    ``mode``: (transport_code, mode); ``visa``: (visa_code, visa).
    ``lookups_bounded``: both lookups are small by construction (skip the
    size check); ``lookups_unique``: their keys are unique (skip the
    de-duplication). ``counts`` observes the rows (the null predicates then
    stay above the scan, which has to see the rows it counts).
    """
    if counts is not None:
        raw = raw.observe(counts.raw, *reason_metrics())
    clean = raw.where(F.col("depdate").isNotNull() & F.col("dtaddto").isNotNull())
    clean = clean.where(may_be_admitted_until("dtaddto") & sas_day_to_date("depdate").isNotNull())
    clean = clean.withColumns({
        "arrdate": sas_day_to_date("arrdate"),
        "depdate": sas_day_to_date("depdate"),
        "dtaddto": admitted_until("dtaddto"),
    })
    typed = cast_raw(clean).where(F.col("cicid").isNotNull())
    # a filter here would be pushed below the conversion and repeat it per row
    valid = typed.withColumn("_no_date", F.col("dtaddto").isNull())
    unique = keep_first(valid, ["cicid"], ["_no_date"]).where(~F.col("_no_date")).drop("_no_date")
    if counts is not None:
        unique = unique.observe(counts.kept, F.count(F.lit(1)).alias("kept"))
    out = unique
    if "i94mode" in out.columns:
        out = lookup_left(out, mode, "i94mode", "transport_code", [("mode", "_mode")],
                          bounded=lookups_bounded, unique=lookups_unique)
    if "i94visa" in out.columns:
        out = lookup_left(out, visa, "i94visa", "visa_code", [("visa", "_visa")],
                          bounded=lookups_bounded, unique=lookups_unique)
    labels = {"i94mode": "_mode", "i94visa": "_visa"}
    return out.select(*[
        F.col(labels.get(r, r)).alias(o) for r, o, _ in ADMISSIONS_FIELDS if r in unique.columns
    ])


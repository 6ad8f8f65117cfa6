"""Relational building blocks: keep-first de-duplication, code unions and
size-checked lookup joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.session import scratch_uri

# Lookups within both bounds are broadcast; beyond them the join shuffles.
DEFAULT_BROADCAST_ROWS = 250_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
               nulls_last: bool = True) -> DataFrame:
    """One row per key: the first by ``order``, then by every other column.

    Deterministic (unlike ``dropDuplicates``): the remaining columns break
    ties, so the same input always yields the same rows. Null key parts
    compare equal, as in ``PARTITION BY``. Nulls sort last in the ``order``
    columns (with ``nulls_last``) and first among the tie-breaking columns.

    Built as ``row_number() OVER (PARTITION BY keys ORDER BY order, rest) = 1``.
    Spark (3.5+) plans this as a *partial* ``WindowGroupLimit`` before the
    shuffle and a final one after it, so every map task keeps only its first
    row per key: a key holding a third of all rows reaches its reducer as
    one row per map task, never as the whole group (measured by
    ``tests/shuffle_evidence.py``). It needs the same map-side sort as
    Spark's ``dropDuplicates`` aggregate, but less work after it.
    """
    keys = list(keys)
    order = list(order)
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"keep_first: unknown columns {missing}")
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    ranking = ([F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first()
                for c in order]
               + [F.col(c).asc_nulls_first() for c in rest])
    rn = "__keep_first_rn"
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*ranking)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key; null parts count (Spark's hash skips nulls)."""
    return F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())])


def keep_first_sieved(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), nulls_last: bool = True,
                      max_rows: int = DEFAULT_BROADCAST_ROWS * 16) -> DataFrame:
    """:func:`keep_first` for wide rows whose keys hardly repeat.

    A first pass over the key columns alone counts 64-bit key hashes; the hashes
    seen twice are the sieve. Only rows that it holds back are sorted and
    shuffled, all others pass as they are. Exact: a false hit (two keys with
    one hash) only does needless work. Hashes of unique keys are the 8 bytes a
    row that still shuffle.

    ``df`` is read three times (key columns; rows on either side of the sieve),
    so it should be a scan with cheap expressions, and deterministic. A sieve
    of more than ``max_rows`` hashes is not broadcast: then this is
    :func:`keep_first`.
    """
    keys = list(keys)
    uri = scratch_uri(df.sparkSession, "repeated-keys")
    seen = df.select(key_hash(keys).alias("__sieve")).groupBy("__sieve").agg(F.count(F.lit(1)).alias("n"))
    seen.where("n > 1").select("__sieve").write.parquet(uri)
    sieve = df.sparkSession.read.schema("__sieve long").parquet(uri)
    if sieve.count() > max_rows:
        return keep_first(df, keys, order, nulls_last)
    hashed = df.withColumn("__sieve", key_hash(keys))
    again = hashed.join(F.broadcast(sieve), "__sieve", "left_semi").drop("__sieve").select(*df.columns)
    alone = hashed.join(F.broadcast(sieve), "__sieve", "left_anti").drop("__sieve").select(*df.columns)
    return alone.unionByName(keep_first(again, keys, order, nulls_last))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key parts are all present."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def union_codes(df: DataFrame, code_cols: Sequence[str], out: str,
                source_col: str = "_src") -> DataFrame:
    """Stack several code columns into one (``UNION ALL`` of one branch per
    column, duplicates kept, null codes dropped) with a single scan.

    ``source_col`` holds the position of the code column the row came from
    (0 for the first), usable as a priority. The output keeps the input column
    order with the first code column replaced by ``out``.
    """
    code_cols = list(code_cols)
    keep = [c for c in df.columns if c not in code_cols]
    stacked = df.select(
        *keep, F.posexplode(F.array(*[F.col(c) for c in code_cols])).alias(source_col, out))
    stacked = stacked.where(F.col(out).isNotNull())
    order: list[str] = []
    for c in df.columns:
        if c == code_cols[0]:
            order.append(out)
        elif c not in code_cols:
            order.append(c)
    return stacked.select(*order, source_col)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Size check before broadcasting: at most ``max_rows`` rows and about
    ``max_bytes`` of data (text length plus 8 bytes per other value).

    Eager: runs one job over ``df`` whose partial aggregates send a single row
    per task, whatever its size.
    """
    width = F.lit(0)
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        else:
            width = width + F.lit(8)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def lookup_left(df: DataFrame, lookup: DataFrame, left_key: str | Column, right_key: str,
                columns: Sequence[tuple[str, str]] | None = None,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                bounded: bool = False, unique: bool = False) -> DataFrame:
    """Left outer equi-join to a lookup table, adding its label columns.

    * The lookup is de-duplicated on its key first, so the join never
      multiplies fact rows (of rows with equal keys the smallest label stays,
      nulls last); ``unique=True`` skips that step for lookups that are unique
      already, such as code lists read from files (the first line wins there).
    * It is broadcast only when its size is known to be small: ``bounded=True``
      (built from a fixed, small list) or it passes :func:`fits_broadcast`.
      Otherwise Spark's shuffle join is used (AQE may still convert it).
    * Unknown and null codes keep the row with null labels.

    ``columns`` maps lookup column -> output name (default: every non-key
    column under its own name).
    """
    if columns is None:
        columns = [(c, c) for c in lookup.columns if c != right_key]
    small = lookup.select(right_key, *[c for c, _ in columns])
    deduped = small if unique else keep_first(small, [right_key], [c for c, _ in columns])
    if bounded or fits_broadcast(small, max_broadcast_rows, max_broadcast_bytes):
        side = F.broadcast(deduped)
    else:
        side = deduped
    side = side.select(F.col(right_key).alias("_lk"),
                       *[F.col(c).alias(o) for c, o in columns])
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return df.join(side, lk == side["_lk"], "left").drop("_lk")


def hot_codes(df: DataFrame, key: str, share: float = 0.02) -> list:
    """The codes (null excepted) that hold more than ``share`` of all rows: at
    most ``1 / share`` of them. One aggregation job with partial counts."""
    counts = df.groupBy(F.col(key).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    gathered = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    if gathered["total"] is None or gathered["most"] <= share * gathered["total"]:
        return []
    return sorted(r["code"] for r in counts.where(
        F.col("code").isNotNull() & (F.col("n") > share * gathered["total"])).collect())


def salted_lookup_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
                       columns: Sequence[tuple[str, str]] | None = None, copies: int = 64, share: float = 0.02,
                       unique: bool = False) -> DataFrame:
    """:func:`lookup_left` for a lookup that is too large to broadcast and rows
    that gather on few codes.

    A shuffle join sends all rows of a code to one task. Here the rows of hot
    codes (:func:`hot_codes`) are dealt over ``copies`` salts, and only those
    codes' lookup rows are repeated that often; rows without a code, which
    match nothing, are dealt too. Rows, columns and labels are those of
    ``lookup_left``.
    """
    if columns is None:
        columns = [(c, c) for c in lookup.columns if c != right_key]
    small = lookup.select(right_key, *[c for c, _ in columns])
    deduped = small if unique else keep_first(small, [right_key], [c for c, _ in columns])
    hot = hot_codes(df, left_key, share)
    code = F.col(left_key)
    is_hot = code.isin(hot) if hot else F.lit(False)
    # the part of the input tells equal rows apart, in every run alike
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns]), F.lit(copies)).cast("int")
    salted = df.withColumn("__salt", F.when(code.isNull() | is_hot, salt).otherwise(0))
    some = F.col(right_key).isin(hot) if hot else F.lit(False)
    repeated = F.explode(F.when(some, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0))))
    side = deduped.select(F.col(right_key).alias("__lk"), *[F.col(c).alias(o) for c, o in columns], repeated.alias("__ls"))
    joined = salted.hint("shuffle_merge").join(side, (code == F.col("__lk")) & (F.col("__salt") == F.col("__ls")), "left")
    return joined.drop("__lk", "__ls", "__salt")


def label_or_other(df: DataFrame, code_col: str, lookup: DataFrame, key: str, label: str,
                   out: str, other: str, bounded: bool = False,
                   unique: bool = False) -> DataFrame:
    """Replace a code by its label; codes missing from the list (and null
    codes) get the catch-all label ``other``."""
    joined = lookup_left(df, lookup, code_col, key, [(label, "_label")], bounded=bounded,
                         unique=unique)
    return joined.withColumn(out, F.coalesce(F.col("_label"), F.lit(other))).drop("_label")

"""Session helpers: a configured local session for tests/bench, and scratch
locations under the shared checkpoint folder.

On a cluster every intermediate table (fixture files, cut lineage, read-back
marts) must live in shared storage. The cluster names that place in
``spark.checkpoint.dir``; we read it from the session and only fall back to a
fresh local folder when the master is local (tests, bench) and it is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "landfall") -> SparkSession:
    """A local session configured the way the library expects.

    AQE is on (partition coalescing and skew handling at runtime), the
    session time zone is pinned to UTC and the UI server stays off.
    """
    n = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1) * 2)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # one task per directory is slower than the listing itself
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(n))
        .config("spark.driver.memory", os.environ.get("LANDFALL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: list[str] = []


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some session types refuse unknown keys
        value = None
    return value or None


def _context(spark: SparkSession):
    """The SparkContext when the session exposes one (not under Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Also makes sure ``DataFrame.checkpoint()`` can be used. A fresh local
    folder is used only when the master is local and nothing is configured.
    """
    sc = _context(spark)
    configured = _conf(spark, "spark.checkpoint.dir")
    if configured is None and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    master = _conf(spark, "spark.master") or (sc.master if sc is not None else "") or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
            "for intermediate tables")
    if not _LOCAL_FALLBACK:
        _LOCAL_FALLBACK.append(tempfile.mkdtemp(prefix="landfall-ckpt-"))
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_FALLBACK[0])
    return _LOCAL_FALLBACK[0]


_SCRATCH: list[str] = []


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location for an intermediate table. It lasts until
    :func:`release_scratch`."""
    uri = f"{checkpoint_root(spark)}/landfall-scratch/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(uri)
    return uri


def delete_uri(spark: SparkSession, uri: str) -> None:
    """Delete a location of any Hadoop file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_FORMER_CASE: list[tuple[SparkSession, str]] = []


def distinguish_case(spark: SparkSession) -> None:
    """Tell column names apart by case in this session, until
    :func:`release_scratch`. A result with names that differ in nothing else
    can neither be written nor read again without."""
    former = spark.conf.get("spark.sql.caseSensitive")
    if former != "true":
        _FORMER_CASE.append((spark, former))
        spark.conf.set("spark.sql.caseSensitive", "true")


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch locations this process has named; returns how many.
    Call it when the DataFrames that read them are no longer needed. Undoes
    :func:`distinguish_case` too."""
    for kept in [x for x in _FORMER_CASE if x[0] is spark]:
        _FORMER_CASE.remove(kept)
        spark.conf.set("spark.sql.caseSensitive", kept[1])
    n = 0
    while _SCRATCH:
        delete_uri(spark, _SCRATCH.pop())
        n += 1
    return n

"""All-or-nothing publishing: a star is seen whole, or the one before it is.

Tables are written to a new version folder. Each write is observed (rows,
fingerprint, nulls per column), so nothing is read again to describe it. When
all tables are there and agree (files hold the rows that were written, with the
contract's types; fact layouts hold the same rows), one manifest is put in
place by a rename that fails if its number is taken. Readers take the manifest
with the highest number. A job that dies earlier leaves a folder that no
manifest names; nothing that is published is ever overwritten.

    <out>/versions/<id>/<table path>/...      tables
    <out>/manifests/00000003.json             the third published star

The rename is atomic on file systems that have one (HDFS, local, ABFS); on an
object store without, publish from one job at a time.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.fingerprint import fingerprint_metrics
from landfall.operators.footers import footer_types
from landfall.plans.marts import read_mart, write_mart
from landfall.session import delete_uri


# Tasks move their own files into place; with version 1 the driver moves all files, one after
# the other, when the job ends. A version folder is not read before its manifest, and a
# task that dies while it moves files is found by the row counts.
COMMITTER = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


class PublishError(RuntimeError):
    """The tables of a version do not fit together; nothing was published."""


@dataclass
class Written:
    """What was seen while a table was written."""
    path: str                          # below the version folder
    partition_columns: list[str]
    columns: list[list[str]]           # [name, type], in contract order
    row_count: int
    hash_a: str
    hash_b: str
    nulls: dict[str, int]


@dataclass
class Manifest:
    number: int
    version: str
    tables: dict[str, Written]
    facts: dict[str, int] = field(default_factory=dict)  # counts a job wants to keep, such as drop reasons

    def uri(self, out: str, table: str) -> str:
        return f"{out.rstrip('/')}/versions/{self.version}/{self.tables[table].path}"

    def schema(self, table: str) -> T.StructType:
        return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in self.tables[table].columns])


# ------------------------------------------------------------------ files
def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def _system(spark: SparkSession, uri: str):
    return _path(spark, uri).getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, uri: str, text: str) -> None:
    out = _system(spark, uri).create(_path(spark, uri), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, uri: str) -> str:
    stream = _system(spark, uri).open(_path(spark, uri))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _names(spark: SparkSession, uri: str) -> list[str]:
    system, path = _system(spark, uri), _path(spark, uri)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def _put(spark: SparkSession, temporary: str, final: str) -> None:
    """Rename that fails when ``final`` exists."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, final).toUri(), spark._jsc.hadoopConfiguration()) if "://" in final else \
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(_path(spark, temporary), _path(spark, final), none)


# ------------------------------------------------------------------ reading
def numbers(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the published manifests, ascending."""
    names = _names(spark, f"{out.rstrip('/')}/manifests")
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def manifest(spark: SparkSession, out: str, number: int | None = None) -> Manifest | None:
    """The published star (the latest one, or ``number``); None without one."""
    found = numbers(spark, out)
    if not found:
        return None
    data = json.loads(_read_text(spark, f"{out.rstrip('/')}/manifests/{number or found[-1]:08d}.json"))
    return Manifest(data["number"], data["version"], {n: Written(**t) for n, t in data["tables"].items()}, data["facts"])


def read_table(spark: SparkSession, out: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the published star, with the types it was published with."""
    found = manifest(spark, out, number)
    if found is None:
        raise PublishError(f"{out}: nothing is published")
    return read_mart(spark, found.uri(out, table), found.schema(table))


# ------------------------------------------------------------------ writing
class Publication:
    """One version being written: ``write`` tables, then ``commit``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.version = uuid.uuid4().hex
        self.tables: dict[str, Written] = {}
        self.facts: dict[str, int] = {}
        self._after = (numbers(spark, out) or [0])[-1]
        self._lock = threading.Lock()

    def uri(self, path: str) -> str:
        return f"{self.out}/versions/{self.version}/{path}"

    def write(self, df: DataFrame, table: str, path: str, partition_columns: Sequence[str]) -> str:
        """Write a table of the version; returns its URI. Empty texts in
        partition columns become null, as which such a partition is read."""
        seen = Observation()
        texts = [c for c in partition_columns if df.schema[c].dataType.simpleString() == "string"]
        df = df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in texts})
        nulls = [(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
        write_mart(df.observe(seen, *fingerprint_metrics(df.columns), *nulls), self.uri(path), partition_columns,
                   options=COMMITTER)
        got = seen.get
        record = Written(path, list(partition_columns), [[f.name, f.dataType.simpleString()] for f in df.schema.fields],
                         got["row_count"], got["hash_a"], got["hash_b"],
                         {c: got[f"nulls_{i}"] for i, c in enumerate(df.columns)})
        with self._lock:
            self.tables[table] = record
        return self.uri(path)

    def validate(self, same_rows: Sequence[str] = ()) -> None:
        """Raise unless the files hold what was written, and the tables in
        ``same_rows`` the same rows."""
        for name, t in self.tables.items():
            types = {f[0]: f[1] for f in t.columns if f[0] not in t.partition_columns}
            rows = 0
            for r in footer_types(self.spark, self.uri(t.path)).collect() if t.row_count else []:  # a row per column and type
                if r["column_name"] is None:
                    rows = r["row_count"]
                elif types.get(r["column_name"], r["actual_type"]) != r["actual_type"]:
                    raise PublishError(f"{name}: {r['column_name']} is {r['actual_type']} in {r['file_count']} files")
            if rows != t.row_count:
                raise PublishError(f"{name}: {t.row_count} rows were written, the files hold {rows}")
        prints = {(self.tables[n].row_count, self.tables[n].hash_a, self.tables[n].hash_b) for n in same_rows}
        if len(prints) > 1:
            raise PublishError(f"{list(same_rows)} hold different rows")

    def commit(self, same_rows: Sequence[str] = ()) -> Manifest:
        """Validate and publish; fails if another star was published meanwhile."""
        self.validate(same_rows)
        done = Manifest(self._after + 1, self.version, self.tables, self.facts)
        final = f"{self.out}/manifests/{done.number:08d}.json"
        temporary = f"{self.out}/versions/{self.version}/manifest.json"
        _write_text(self.spark, temporary, json.dumps(asdict(done) | {"published": int(time.time())}, indent=1))
        _system(self.spark, final).mkdirs(_path(self.spark, f"{self.out}/manifests"))
        if (numbers(self.spark, self.out) or [0])[-1] != self._after:
            raise PublishError(f"{self.out}: another star was published meanwhile")
        try:
            _put(self.spark, temporary, final)
        except Exception as exc:  # noqa: BLE001 - a Java exception
            raise PublishError(f"{self.out}: another star was published meanwhile") from exc
        return done


def retire(spark: SparkSession, out: str, keep: int = 2, orphans: bool = False) -> list[str]:
    """Delete all but the last ``keep`` published stars, manifests first; with
    ``orphans`` also version folders that no manifest names (only when no job
    is writing). Returns the versions deleted."""
    out = out.rstrip("/")
    published = {n: manifest(spark, out, n).version for n in numbers(spark, out)}
    old = sorted(published)[:-keep] if keep else sorted(published)
    for n in old:
        delete_uri(spark, f"{out}/manifests/{n:08d}.json")
    gone = [published[n] for n in old]
    if orphans:
        gone += [v for v in _names(spark, f"{out}/versions") if v not in published.values()]
    for v in gone:
        delete_uri(spark, f"{out}/versions/{v}")
    return gone

"""The SAS source against a second reader (pandas) and against its input."""

import glob
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from landfall import fixtures as fx
from landfall import fixtures_sas
from landfall.contracts import RAW_ADMISSIONS_COLUMNS
from landfall.sources import sas7bdat
from landfall.sources.admissions import load_raw_admissions


def _plain(uri):
    return uri.removeprefix("file://").removeprefix("file:")


def _rows(df):
    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("page_size", [4096, 65536])
def test_admissions_file(spark, packed, page_size):
    raw = fx.raw_admissions(spark, SMALL, full=True).repartition(2)
    uri = fixtures_sas.write_sas(raw, "sas", packed, page_size)
    got = load_raw_admissions(spark, uri, "sas7bdat", options={"partitionBytes": str(4 * page_size)})
    assert got.columns == RAW_ADMISSIONS_COLUMNS
    assert _rows(got) == _rows(raw.select(*RAW_ADMISSIONS_COLUMNS))
    files = glob.glob(_plain(uri) + "/*.sas7bdat")
    assert len(files) == 2 and got.rdd.getNumPartitions() >= (3 if page_size == 4096 else 2)
    second = pd.concat([pd.read_sas(f, encoding="utf-8") for f in files])
    assert len(second) == raw.count()
    mine = got.toPandas()
    for c in RAW_ADMISSIONS_COLUMNS:
        a, b = (sorted(x[c].map(lambda v: "" if v is None or v != v else str(v))) for x in (mine, second))
        assert a == b, c


def test_columns_option_and_errors(spark):
    uri = fixtures_sas.write_sas(fx.raw_admissions(spark, SMALL).coalesce(1), "sas")
    narrow = load_raw_admissions(spark, uri, "sas7bdat", ["cicid", "arrdate", "depdate", "dtaddto"])
    scanned = spark.read.format("sas7bdat").option("columns", "dtaddto,cicid").load(uri)
    assert scanned.columns == ["cicid", "dtaddto"] and narrow.count() == scanned.count() > 0
    with pytest.raises(ValueError, match="missing columns"):
        load_raw_admissions(spark, uri, "sas7bdat")  # the narrow fixture lacks ten columns
    file = glob.glob(_plain(uri) + "/*.sas7bdat")[0]
    with open(file, "rb") as f:
        data = f.read()
    packed = fixtures_sas.write_sas(fx.raw_admissions(spark, SMALL).coalesce(1), "sas", packed=True)
    with open(glob.glob(_plain(packed) + "/*.sas7bdat")[0], "rb") as f:
        binary = f.read().replace(sas7bdat.RUN_LENGTH, sas7bdat.BINARY)
    for name, bad, said in (("cut", data[:-10], "within a page"), ("other", b"x" * 4000, "not a SAS7BDAT"),
                            ("binary", binary, "COMPRESS=BINARY"), ("big", data[:37] + b"\x00" + data[38:], "big-endian")):
        path = f"{_plain(uri)}-{name}.sas7bdat"
        with open(path, "wb") as f:
            f.write(bad)
        with pytest.raises(Exception, match=said):
            spark.read.format("sas7bdat").load(path).count()


def test_empty_file_and_missing_values(spark):
    df = spark.createDataFrame([(1.5, "a  "), (None, None), (float("nan"), ""), (-2.0, "été " + "x" * 40)], "x double, t string")
    for packed in (False, True):
        uri = fixtures_sas.write_sas(df.coalesce(1), "sas", packed)
        sas7bdat.register(spark)
        assert _rows(spark.read.format("sas7bdat").load(uri)) == sorted(
            [(1.5, "a"), (None, None), (None, None), (-2.0, "été " + "x" * 40)], key=repr)
        none = spark.range(3).selectExpr("cast(id AS double) AS x", "cast(id AS string) AS t").where("x > 5").coalesce(1)
        assert spark.read.format("sas7bdat").load(fixtures_sas.write_sas(none, "sas", packed)).collect() == []


def test_run_length_rows():
    rng = np.random.default_rng(1)
    for n in (1, 5, 17, 64, 65, 300, 5000):
        for alphabet in (b" \x00", b" \x00@a", bytes(range(256))):
            row = bytes(rng.choice(np.frombuffer(alphabet, np.uint8), n).repeat(rng.integers(1, 40, n))[:n])
            assert sas7bdat.expand(fixtures_sas.compress(row), n) == row


def test_short_numbers():
    """Numbers stored in fewer than 8 bytes keep their leading bytes."""
    layout = sas7bdat.Layout(0, 0, False, "utf-8", row_length=4)
    value = np.array([3.0, -17.0], "<f8").view(np.uint8).reshape(-1, 8)[:, 4:]
    got = sas7bdat.decode(value.tobytes(), layout, [sas7bdat.Column("x", True, 0, 4)])
    assert got.column(0).to_pylist() == [3.0, -17.0]


def test_rows_are_packed_and_expanded_together(spark, monkeypatch):
    """No row of a well-formed file is expanded alone; the rows of a task are
    dealt over files of FILE_ROWS rows."""
    monkeypatch.setattr(fixtures_sas, "FILE_ROWS", 1000)
    rows = [(float(i % 7) if i % 5 else None, f"text {i}" if i % 3 else None, "x" * (i % 50)) for i in range(2500)]
    df = spark.createDataFrame(rows, "n double, t string, u string").coalesce(1)
    uri = fixtures_sas.write_sas(df, "sas", packed=True)
    assert len(glob.glob(_plain(uri) + "/*.sas7bdat")) == 3
    sas7bdat.register(spark)
    assert _rows(spark.read.format("sas7bdat").load(uri)) == sorted([(n, t, u or None) for n, t, u in rows], key=repr)
    monkeypatch.setattr(sas7bdat, "expand", lambda data, length: pytest.fail("a row was expanded alone"))
    got = []
    for i in range(3):
        file = sorted(glob.glob(_plain(uri) + "/*.sas7bdat"))[i]
        with open(file, "rb") as f:
            data = f.read()
        with sas7bdat.open_uri(file)[0].open_input_file(file) as f:
            layout = sas7bdat.read_layout(f, file)
        block = sas7bdat.block_rows(data[layout.header:], layout)
        got += sas7bdat.decode(block, layout, layout.columns).to_pylist()
    assert [tuple(r.values()) for r in got] == [(n, t, u or None) for n, t, u in rows]


def test_rows_expanded_together_are_those_expanded_alone():
    rng = np.random.default_rng(2)
    for width in (1, 7, 130, 700):
        for alphabet in (b" \x00", b" \x00@a", bytes(range(256))):
            letters = np.frombuffer(alphabet, np.uint8)
            rows = np.array([rng.choice(letters, width).repeat(rng.integers(1, 400 if i % 2 else 3, width))[:width] for i in range(50)])
            data, lengths = fixtures_sas.compress_rows(rows)
            at = np.cumsum(lengths) - lengths
            some = np.frombuffer(data, np.uint8)
            assert (sas7bdat.expand_rows(some, at, lengths, width) == rows).all()
            assert sas7bdat.expand(data[at[9]:at[9] + lengths[9]], width) == rows[9].tobytes()
            bad = some.copy()
            bad[at[30]] = 0x30
            with pytest.raises(sas7bdat.SasFormatError):
                sas7bdat.expand_rows(bad, at, lengths, width)
    # repeated "@" and a byte given by its command, which the fixtures do not write for "@"
    row = np.frombuffer(b"\xd0\x50\x03\x40\x12z\xc2y", np.uint8)
    data, at = np.tile(row, 40), np.arange(40) * len(row)
    alone = sas7bdat.expand(row.tobytes(), 63)
    assert alone == b"@" * 22 + b"z" * 36 + b"y" * 5
    assert (sas7bdat.expand_rows(data, at, np.full(40, len(row)), 63) == np.frombuffer(alone, np.uint8)).all()

"""SAS7BDAT files as a Spark data source (``spark.read.format("sas7bdat")``).

A file is a header, then pages of one fixed size: the first pages describe the
columns, the others hold rows. Since pages stand at known places, a file is
read in ranges of pages, one input partition each (``partitionBytes``, 64 MiB
by default), whatever its size; every task reads the few describing pages
again. Rows are decoded a few MB of pages at a time in numpy; run-length
compressed rows (SAS option COMPRESS=CHAR) are expanded together, one command
of every row at a time.

Numbers become doubles (missing values null; shortened numbers are widened),
texts strings (trailing blanks removed, blank text null). Dates stay what they
are in the file: day numbers. ``columns`` (comma-separated) limits what is
decoded, as Python data sources get no column pruning from Spark.

Paths are opened by Arrow's file systems (local, ``hdfs://``, ``s3://``, ...);
a directory gives all its ``*.sas7bdat`` files, which must have equal columns.

Defined cases: a file without rows gives none; pages of other kinds are
skipped; a file that ends within a page, COMPRESS=BINARY, big-endian files and
files with different columns raise an error that names the file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "sas7bdat"
PARTITION_BYTES = 64 << 20

# Fixed values of the file format (public reverse engineering of SAS7BDAT).
MAGIC = bytes.fromhex("000000000000000000000000c2ea8160b31411cfbd92080009c7318c181f1011")
ROW_SIZE, COLUMN_SIZE = b"\xf7\xf7\xf7\xf7", b"\xf6\xf6\xf6\xf6"
COLUMN_TEXT, COLUMN_NAMES, COLUMN_ATTRIBUTES = b"\xfd\xff\xff\xff", b"\xff\xff\xff\xff", b"\xfc\xff\xff\xff"
COUNTS, FORMATS, COLUMN_LIST = b"\x00\xfc\xff\xff", b"\xfe\xfb\xff\xff", b"\xfe\xff\xff\xff"
DESCRIBING = {ROW_SIZE, COLUMN_SIZE, COLUMN_TEXT, COLUMN_NAMES, COLUMN_ATTRIBUTES, COUNTS, FORMATS, COLUMN_LIST}
PAGE_META, PAGE_DATA, PAGE_MIX, PAGE_AMD, PAGE_META2 = 0x0000, 0x0100, 0x0200, 0x0400, 0x4000
RUN_LENGTH, BINARY = b"SASYZCRL", b"SASYZCR2"
ENCODINGS = {0: "latin-1", 20: "utf-8", 28: "ascii", 29: "latin-1", 30: "iso8859-2", 40: "iso8859-15", 60: "cp1250",
             61: "cp1251", 62: "cp1252"}


@dataclass
class Column:
    name: str
    numeric: bool
    offset: int
    length: int


@dataclass
class Layout:
    """What the header and the describing pages say."""
    header: int
    page: int
    wide: bool                  # 64-bit file
    encoding: str
    row_length: int = 0
    row_count: int = 0
    mix_rows: int = 0
    compression: bytes = b""
    columns: list[Column] = field(default_factory=list)
    first_rows: int = 0         # number of the first page that can hold rows

    @property
    def head(self) -> int:
        """Where a page's own header starts."""
        return 32 if self.wide else 16

    @property
    def pointer(self) -> int:
        return 24 if self.wide else 12


class SasFormatError(ValueError):
    pass


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a location as Spark writes it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def sas_files(uri: str) -> list[str]:
    """The files at a location, as URIs, by name."""
    system, path = open_uri(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [uri]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    names = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(path))
                   if f.is_file and f.base_name.lower().endswith("." + FORMAT))
    return [f"{uri.rstrip('/')}/{n}" for n in names]


def _read(stream, at: int, n: int, uri: str) -> bytes:
    stream.seek(at)
    data = stream.read(n)
    if len(data) != n:
        raise SasFormatError(f"{uri}: ends within a page")
    return data


def _pointers(page: bytes, layout: Layout) -> Iterator[tuple[int, int, int, int]]:
    """(offset, length, compression, kind) of a page's subheaders."""
    count = struct.unpack_from("<H", page, layout.head + 4)[0]
    for i in range(count):
        yield struct.unpack_from("<QQBB" if layout.wide else "<IIBB", page, layout.head + 8 + i * layout.pointer)


def _describe(page: bytes, layout: Layout, texts: list[bytes], names: list[str], places: list[tuple]) -> bool:
    """Take a page's descriptions; returns whether it also holds rows."""
    size, word = (8, "<Q") if layout.wide else (4, "<I")
    rows = False

    def number(at):
        return struct.unpack_from(word, page, at)[0]

    for at, length, compression, kind in _pointers(page, layout):
        if not length or compression == 1:
            continue
        sign = page[at:at + 4]
        if sign == ROW_SIZE:
            layout.row_length, layout.row_count = number(at + 5 * size), number(at + 6 * size)
            layout.mix_rows = number(at + 15 * size)
        elif sign == COLUMN_TEXT:
            block = struct.unpack_from("<H", page, at + size)[0]
            texts.append(page[at + size:at + size + block])
            if len(texts) == 1:
                layout.compression = next((c for c in (RUN_LENGTH, BINARY) if c in texts[0]), b"")
        elif sign == COLUMN_NAMES:
            for i in range((length - 2 * size - 12) // 8):
                text, start, n = struct.unpack_from("<HHH", page, at + size + 8 * (i + 1))
                names.append(texts[text][start:start + n].decode(layout.encoding, "replace").rstrip("\x00 "))
        elif sign == COLUMN_ATTRIBUTES:
            for i in range((length - 2 * size - 12) // (size + 8)):
                entry = at + size + 8 + i * (size + 8)
                places.append((number(entry), *struct.unpack_from("<I", page, entry + size),
                               page[entry + size + 6] == 1))
        elif sign not in DESCRIBING and kind == 1 and compression in (0, 4):
            rows = True
    return rows


def read_layout(stream, uri: str) -> Layout:
    """The layout of an open file."""
    start = _read(stream, 0, 288, uri)
    if start[:32] != MAGIC:
        raise SasFormatError(f"{uri}: not a SAS7BDAT file")
    if start[37] != 1:
        raise SasFormatError(f"{uri}: big-endian files are not read")
    pad = 4 if start[35:36] == b"3" else 0
    header, page = struct.unpack_from("<II", start, 196 + pad)
    layout = Layout(header, page, start[32:33] == b"3", ENCODINGS.get(start[70], "latin-1"))
    total = max(stream.size() - header, 0) // page
    texts, names, places = [], [], []
    for i in range(total):
        data = _read(stream, header + i * page, page, uri)
        kind = struct.unpack_from("<H", data, layout.head)[0] & 0xFF00
        layout.first_rows = i
        if kind in (PAGE_META, PAGE_META2, PAGE_MIX, PAGE_AMD):
            rows = _describe(data, layout, texts, names, places)
        if kind in (PAGE_DATA, PAGE_MIX) or rows:
            break
    if layout.compression == BINARY:
        raise SasFormatError(f"{uri}: COMPRESS=BINARY is not read")
    if len(names) != len(places):
        raise SasFormatError(f"{uri}: {len(names)} column names for {len(places)} columns")
    layout.columns = [Column(n, numeric, offset, length) for n, (offset, length, numeric) in zip(names, places)]
    return layout


def expand(data: bytes, length: int) -> bytes:
    """A run-length compressed row: each command byte copies bytes, or repeats
    one (a given one, ``@``, a blank or a zero)."""
    out, at = bytearray(), 0
    repeated = {0x50: b"@", 0x60: b" ", 0x70: b"\x00", 0xD0: b"@", 0xE0: b" ", 0xF0: b"\x00"}
    while at < len(data):
        command, low = data[at] & 0xF0, data[at] & 0x0F
        at += 1
        if command in (0x00, 0x10, 0x20) or 0x80 <= command <= 0xB0:
            if command in (0x00, 0x10):
                n = (low << 8) + data[at] + 64 + (4096 if command else 0)
                at += 1
            else:
                n = low + (96 if command == 0x20 else command - 0x80 + 1)
            out += data[at:at + n]
            at += n
        elif command in (0x40, 0xC0):
            n = (low << 4) + data[at] + 18 if command == 0x40 else low + 3
            at += command == 0x40
            out += data[at:at + 1] * n
            at += 1
        elif command in (0x50, 0x60, 0x70):
            out += repeated[command] * ((low << 8) + data[at] + 17)
            at += 1
        elif command in repeated:
            out += repeated[command] * (low + 2)
        else:
            raise SasFormatError(f"unknown row compression command {command:#x}")
    if len(out) != length:
        raise SasFormatError(f"a compressed row has {len(out)} bytes, expected {length}")
    return bytes(out)


def _commands() -> np.ndarray:
    """What each command byte says: bytes put out, whether the next byte adds to
    them, bytes of the command, and whether it copies bytes, repeats the byte
    that follows, or is unknown; at last where ``CONSTANTS`` has the byte it
    repeats, else -1."""
    table = np.zeros((256, 7), np.int64)
    for b in range(256):
        command, low = b & 0xF0, b & 0x0F
        if command in (0x00, 0x10):
            row = ((low << 8) + 64 + (4096 if command else 0), 1, 2, 1, 0, 0, -1)
        elif command == 0x20 or 0x80 <= command <= 0xB0:
            row = (low + (96 if command == 0x20 else command - 0x80 + 1), 0, 1, 1, 0, 0, -1)
        elif command == 0x40:
            row = ((low << 4) + 18, 1, 2, 0, 1, 0, -1)
        elif command == 0xC0:
            row = (low + 3, 0, 1, 0, 1, 0, -1)
        elif command in (0x50, 0x60, 0x70):
            row = ((low << 8) + 17, 1, 2, 0, 0, 0, (command - 0x50) >> 4)
        elif command in (0xD0, 0xE0, 0xF0):
            row = (low + 2, 0, 1, 0, 0, 0, (command - 0xD0) >> 4)
        else:
            row = (0, 0, 1, 0, 0, 1, -1)
        table[b] = row
    return table


CONSTANTS = np.frombuffer(b"@ \x00", np.uint8)
SIZES, ADDS, HEADS, COPIES, REPEATS, UNKNOWN, CONSTANT = np.ascontiguousarray(_commands().T)


def expand_rows(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """:func:`expand` of many rows of ``data``, as an array of a row each.

    A step takes the next command of every row that is not at its end. Rows
    whose commands do not fit, and a few rows alone, go through ``expand``."""
    out = np.empty((len(at), width), np.uint8)
    alone = np.ones(len(at), bool)
    if len(at) >= 32:
        known = np.concatenate([data, CONSTANTS])
        ends, row, place = at + lengths, np.arange(len(at)), at.copy()
        filled, alone, taken = np.zeros(len(at), np.int64), np.zeros(len(at), bool), []
        while len(row):
            command = known[place]
            n = SIZES[command] + ADDS[command] * known[place + 1]
            source, constant = place + HEADS[command], CONSTANT[command]
            taken.append((row, filled[row], n, np.where(constant >= 0, len(data) + constant, source), COPIES[command]))
            filled[row] += n
            place = source + REPEATS[command] + COPIES[command] * n
            alone[row] |= (UNKNOWN[command] == 1) | (place > ends[row])
            more = place < ends[row]
            row, place = row[more], place[more]
        alone |= filled != width
        row, offset, n, source, copies = (np.concatenate(x) for x in zip(*taken))
        if alone.any():
            fits = ~alone[row]
            row, offset, n, source, copies = row[fits], offset[fits], n[fits], source[fits], copies[fits]
        total = np.cumsum(n)
        count = np.arange(total[-1] if len(n) else 0)
        within = count - np.repeat(total - n, n)
        out.ravel()[np.repeat(row * width + offset, n) + within] = known[np.repeat(source, n) + within * np.repeat(copies, n)]
    for i in np.flatnonzero(alone):
        out[i] = np.frombuffer(expand(data[at[i]:at[i] + lengths[i]].tobytes(), width), np.uint8)
    return out


def _pieces(page: bytes, layout: Layout) -> list[np.ndarray]:
    """Where a page holds rows: (offset, length, whether it is one compressed row)."""
    kind, blocks, subheaders = struct.unpack_from("<HHH", page, layout.head)
    kind &= 0xFF00
    if kind == PAGE_DATA:
        start = layout.head + 8
        return [np.array([[start, min((blocks - subheaders) * layout.row_length, len(page) - start), 0]])]
    if kind not in (PAGE_META, PAGE_META2, PAGE_MIX, PAGE_AMD):
        return []
    number, pad = ("<u8", 6) if layout.wide else ("<u4", 2)
    pointer = np.dtype([("at", number), ("length", number), ("compression", "u1"), ("kind", "u1"), ("pad", f"V{pad}")])
    p = np.frombuffer(page, pointer, subheaders, layout.head + 8)
    p = p[(p["kind"] == 1) & (p["length"] > 0) & ((p["compression"] == 0) | (p["compression"] == 4))]
    rows = [i for i, at in enumerate(p["at"].tolist()) if page[at:at + 4] not in DESCRIBING]
    p = p[rows] if len(rows) < len(p) else p
    at, length = p["at"].astype(np.int64), p["length"].astype(np.int64)
    out = [np.stack([at, length, (p["compression"] == 4) & (length < layout.row_length)], axis=1)] if len(p) else []
    if kind == PAGE_MIX:
        start = layout.head + 8 + subheaders * layout.pointer
        start += start % 8
        n = min(min(layout.row_count, layout.mix_rows) * layout.row_length, len(page) - start)
        out.append(np.array([[start, n, 0]]))
    return out


def block_rows(data: bytes, layout: Layout) -> bytes | np.ndarray:
    """The rows of whole pages, one after the other."""
    found = []
    for j in range(0, len(data), layout.page):
        for piece in _pieces(data[j:j + layout.page], layout):
            piece[:, 0] += j
            found.append(piece)
    if not found:
        return b""
    at, length, packed = np.concatenate(found).T
    if not packed.any():
        return b"".join([data[i:i + n] for i, n in zip(at.tolist(), length.tolist())])
    whole, width = np.frombuffer(data, np.uint8), layout.row_length
    size = np.where(packed == 1, width, length)
    start = np.cumsum(size) - size
    if (size % width).any():
        raise SasFormatError("a row that is not compressed has another length than the file's rows")
    out = np.empty((size.sum() // width, width), np.uint8)
    rows = packed == 1
    out[start[rows] // width] = expand_rows(whole, at[rows], length[rows], width)
    for i, n, to in zip(at[~rows].tolist(), length[~rows].tolist(), start[~rows].tolist()):
        out.ravel()[to:to + n] = whole[i:i + n]
    return out.ravel()


def _texts(raw: np.ndarray, encoding: str) -> pa.Array:
    """Fixed-width texts without trailing blanks; blank ones are null."""
    n, width = raw.shape
    raw = np.ascontiguousarray(raw)
    if (raw < 128).all():  # the same in every encoding
        kept = np.logical_or.accumulate(((raw != 32) & (raw != 0))[:, ::-1], axis=1)[:, ::-1]
        lengths = kept.sum(axis=1)
        ends = np.zeros(n + 1, np.int32)
        np.cumsum(lengths, out=ends[1:])
        present = pa.array(lengths > 0).buffers()[1]
        return pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(raw[kept]), present)
    values = np.char.rstrip(raw.view(f"S{width}").ravel(), b" \x00")
    distinct, which = np.unique(values, return_inverse=True)
    texts = pa.array([v.decode(encoding, "replace") or None for v in distinct.tolist()], pa.string())
    return texts.take(pa.array(which))


def decode(rows: bytes | np.ndarray, layout: Layout, columns: list[Column]) -> pa.RecordBatch:
    table = np.frombuffer(rows, np.uint8).reshape(-1, layout.row_length)
    out = []
    for c in columns:
        raw = table[:, c.offset:c.offset + c.length]
        if c.numeric:  # the leading bytes of a double; the file is little-endian
            whole = np.zeros((len(table), 8), np.uint8)
            whole[:, 8 - c.length:] = raw
            x = whole.view("<f8").ravel()
            out.append(pa.array(x, mask=np.isnan(x)))
        else:
            out.append(_texts(raw, layout.encoding))
    return pa.record_batch(out, names=[c.name for c in columns])


@dataclass
class PageRange(InputPartition):
    uri: str
    first: int
    count: int


class SasReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.uri = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.names = schema.fieldNames()

    def partitions(self) -> list[InputPartition]:
        out = []
        for uri in sas_files(self.uri):
            system, path = open_uri(uri)
            with system.open_input_file(path) as stream:
                layout = read_layout(stream, uri)
                total = -(-max(stream.size() - layout.header, 0) // layout.page)
            step = max(self.partition_bytes // layout.page, 1)
            out += [PageRange(uri, i, min(step, total - i)) for i in range(layout.first_rows, total, step)]
        return out or [PageRange("", 0, 0)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        system, path = open_uri(partition.uri)
        with system.open_input_file(path) as stream:
            layout = read_layout(stream, partition.uri)
            known = {c.name: c for c in layout.columns}
            missing = [n for n in self.names if n not in known]
            if missing:
                raise SasFormatError(f"{partition.uri}: has no columns {missing}")
            columns = [known[n] for n in self.names]
            step = max((4 << 20) // layout.page, 1)  # a few MB of pages at a time
            for i in range(partition.first, partition.first + partition.count, step):
                n = min(step, partition.first + partition.count - i)
                data = _read(stream, layout.header + i * layout.page, n * layout.page, partition.uri)
                rows = block_rows(data, layout)
                if len(rows):
                    yield decode(rows, layout, columns)


class SasDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        files = sas_files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"{self.options['path']}: no .{FORMAT} file")
        system, path = open_uri(files[0])
        with system.open_input_file(path) as stream:
            columns = read_layout(stream, files[0]).columns
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        types = {c.name: T.DoubleType() if c.numeric else T.StringType() for c in columns}
        return T.StructType([T.StructField(n, types[n]) for n in types if not wanted or n in wanted])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SasReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(SasDataSource)

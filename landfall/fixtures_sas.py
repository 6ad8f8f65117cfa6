"""SAS7BDAT fixtures: a Spark table written as SAS files, one or more per task.

Only what a test input needs: 32-bit little-endian files, doubles and texts of
fixed width, rows plain or run-length compressed. The reader is in
``landfall.sources.sas7bdat``; the tests hold both against a second reader.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.session import scratch_uri
from landfall.sources.sas7bdat import (
    COLUMN_ATTRIBUTES,
    COLUMN_NAMES,
    COLUMN_SIZE,
    COLUMN_TEXT,
    FORMATS,
    MAGIC,
    PAGE_DATA,
    PAGE_META,
    ROW_SIZE,
    RUN_LENGTH,
    open_uri,
)

HEADER, HEAD, POINTER = 1024, 16, 12


def _page(kind: int, parts: list[tuple[bytes, int, int]], size: int, blocks: int = 0) -> bytes:
    """A page of subheaders (bytes, compression, kind), laid from its end."""
    page = bytearray(size)
    struct.pack_into("<HHH", page, HEAD, kind, blocks + len(parts), len(parts))
    end = size
    for i, (data, compression, sort) in enumerate(parts):
        end -= len(data)
        page[end:end + len(data)] = data
        struct.pack_into("<IIBB", page, HEAD + 8 + i * POINTER, end, len(data), compression, sort)
    return bytes(page)


def compress(row: bytes) -> bytes:
    """Runs of blanks and zeros by commands, everything else copied."""
    return compress_rows(np.frombuffer(row, np.uint8).reshape(1, -1))[0]


def compress_rows(rows: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The compressed rows, one after the other, and the length of each."""
    n, width = rows.shape
    flat = np.ascontiguousarray(rows).ravel()
    first = np.ones(flat.size, bool)
    first[1:] = flat[1:] != flat[:-1]
    first[::width] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(starts, append=flat.size)
    if lengths.max() > 273:  # more than one command: by 4000 blanks or zeros, by 18 others
        blank = np.isin(flat[starts], (0, 32))
        piece = np.where(blank, 4000, 18)
        pieces = np.where(blank, (lengths - 1) // 4000, np.maximum((lengths - 256) // 18, 0)) + 1
        run = np.repeat(np.arange(len(starts)), pieces)
        before = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        last = before == pieces[run] - 1
        starts = starts[run] + before * piece[run]
        lengths = np.where(last, lengths[run] - before * piece[run], piece[run])
    value = flat[starts]
    blank = (value == 0) | (value == 32)
    plain = lengths < np.where(blank, 2, 3)
    # copied bytes, 64 at most after a command
    p = np.flatnonzero(np.repeat(plain, lengths))
    number = np.arange(len(p))
    fresh = (np.diff(p, prepend=-2) != 1) | (p % width == 0)
    head = (number - np.maximum.accumulate(np.where(fresh, number, 0))) % 64 == 0
    heads = np.flatnonzero(head)
    size = np.zeros(flat.size, np.int64)
    size[p] = 1 + head
    starts, lengths, value, blank = starts[~plain], lengths[~plain], value[~plain], blank[~plain]
    long_run = lengths >= np.where(blank, 17, 19)
    size[starts] = 2 - blank + long_run
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    out[at[p] + head] = flat[p]
    out[at[p[heads]]] = 0x7F + np.diff(heads, append=len(p))
    at = at[starts]
    for some, command, base, bits in ((blank & long_run, np.where(value == 32, 0x60, 0x70), 17, 8), (blank & ~long_run, np.where(value == 32, 0xE0, 0xF0), 2, 0),
                                      (~blank & long_run, np.full(len(at), 0x40), 18, 4), (~blank & ~long_run, np.full(len(at), 0xC0), 3, 0)):
        place, more = at[some], lengths[some] - base
        out[place] = command[some] + (more >> bits)
        if bits:
            out[place + 1] = more & ((1 << bits) - 1)
    out[at[~blank] + 1 + long_run[~blank]] = value[~blank]
    return out.tobytes(), size.reshape(n, width).sum(axis=1)


def sas_file(names: list[str], widths: list[int | None], rows: np.ndarray, packed: bool, page_size: int) -> bytes:
    """A whole file; ``widths`` holds text widths, None for numbers; ``rows``
    are rows of bytes in column order."""
    row_length = rows.shape[1] if len(rows) else sum(w or 8 for w in widths)
    text = bytearray(2)
    text += (b"\x00" * 10 + (RUN_LENGTH if packed else b" " * 8)) + b"\x00" * 20
    name_at = []
    for n in names:
        name_at.append((len(text), len(n)))
        text += n.encode() + b"\x00" * (-len(n) % 4)
    struct.pack_into("<H", text, 0, len(text))
    size = bytearray(480)
    size[:4] = ROW_SIZE
    per_page = max((page_size - HEAD - 8) // row_length, 1)
    for place, value in ((5, row_length), (6, len(rows)), (9, len(names)), (10, 0)):
        struct.pack_into("<I", size, place * 4, value)
    struct.pack_into("<H", size, 354, 0)
    struct.pack_into("<H", size, 378, 8)
    column_names, attributes, offset = bytearray(12), bytearray(12), 0
    column_names[:4], attributes[:4] = COLUMN_NAMES, COLUMN_ATTRIBUTES
    for (start, n), width in zip(name_at, widths):
        column_names += struct.pack("<HHHH", 0, start, n, 0)
        attributes += struct.pack("<IIHBB", offset, width or 8, 4, 2 if width else 1, 0)
        offset += width or 8
    formats = bytearray(52)
    formats[:4] = FORMATS
    parts = [(bytes(size), 0, 0), (COLUMN_SIZE + struct.pack("<II", len(names), 0), 0, 0),
             (COLUMN_TEXT + bytes(text), 0, 0), (bytes(column_names) + b"\x00" * 8, 0, 0),
             (bytes(attributes) + b"\x00" * 8, 0, 0), *[(bytes(formats), 0, 0)] * len(names)]
    pages = [_page(PAGE_META, parts, page_size)]
    if packed:
        part, free = [], 0
        for i in range(0, len(rows), 8192):
            packed_rows, lengths = compress_rows(rows[i:i + 8192])
            end = 0
            for j, n in enumerate(lengths.tolist(), i):
                end += n
                whole = n >= row_length
                data = rows[j].tobytes() if whole else packed_rows[end - n:end]
                if part and free < len(data) + POINTER:
                    pages.append(_page(PAGE_META, part, page_size))
                    part = []
                free = (page_size - HEAD - 8 if not part else free) - len(data) - POINTER
                part.append((data, 0 if whole else 4, 1))
        if part:
            pages.append(_page(PAGE_META, part, page_size))
    else:
        for i in range(0, len(rows), per_page):
            some = rows[i:i + per_page]
            body = struct.pack("<HHHH", PAGE_DATA, len(some), 0, 0) + some.tobytes()
            pages.append((b"\x00" * HEAD + body).ljust(page_size, b"\x00"))
    head = bytearray(HEADER)
    head[:32] = MAGIC
    head[32:33], head[35:36], head[37], head[39:40], head[70] = b"2", b"2", 1, b"1", 20
    head[84:92], head[92:156], head[156:164] = b"SAS FILE", b"ADMISSIONS".ljust(64), b"DATA    "
    struct.pack_into("<dd", head, 164, 0.0, 0.0)
    struct.pack_into("<III", head, 196, HEADER, page_size, len(pages))
    head[216:224] = b"9.0401M6"
    return bytes(head) + b"".join(pages)


def _text_bytes(column: pa.Array, width: int) -> np.ndarray:
    """The texts in UTF-8, cut or filled with blanks to ``width`` bytes."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    out = np.full((len(column), width), 32, np.uint8)
    lengths = np.minimum(np.diff(ends), width)
    filled = np.arange(width) < lengths[:, None]
    row, place = np.nonzero(filled)
    if len(row):
        out[filled] = np.frombuffer(column.buffers()[2], np.uint8)[ends[row] + place]
    return out


def _row_bytes(batch: pa.RecordBatch, widths: list[int | None]) -> np.ndarray:
    columns = []
    for column, width in zip(batch.columns, widths):
        if width is None:
            x = column.to_numpy(zero_copy_only=False).astype("<f8")
            columns.append(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8))
        else:
            columns.append(_text_bytes(column, width))
    return np.concatenate(columns, axis=1)


FILE_ROWS = 1 << 18  # a task holds the rows of one file at a time


def write_sas(df: DataFrame, name: str, packed: bool = False, page_size: int = 8192) -> str:
    """Write ``df`` (doubles and strings) to a fresh scratch location, one file
    per task and ``FILE_ROWS`` rows, named by both, so that a task that is
    repeated writes the same files again. Returns the URI. Text widths are the
    longest texts."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first() if texts else {}
    widths = [max(longest[f.name] or 1, 1) if f.name in texts else None for f in df.schema.fields]
    names, uri, most = df.columns, scratch_uri(df.sparkSession, name), FILE_ROWS

    def run(batches):
        from pyspark import TaskContext

        task, number, parts = TaskContext.get().partitionId(), 0, []

        def write():
            rows = np.concatenate(parts) if parts else np.zeros((0, sum(w or 8 for w in widths)), np.uint8)
            system, path = open_uri(f"{uri}/part-{task:05d}-{number:05d}.sas7bdat")
            system.create_dir(path.rsplit("/", 1)[0])
            with system.open_output_stream(path) as out:
                out.write(sas_file(names, widths, rows, packed, page_size))
            return pa.record_batch([pa.array([len(rows)])], names=["n"])

        for b in batches:
            rows = _row_bytes(b, widths)
            while sum(map(len, parts)) + len(rows) > most:
                cut = most - sum(map(len, parts))
                parts.append(rows[:cut])
                rows = rows[cut:]
                yield write()
                number, parts = number + 1, []
            parts.append(rows)
        if parts or not number:
            yield write()

    df.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return uri

"""Byte-level BPE encoding and decoding with the tiktoken library.

Ranks come from a local file (``base64-token rank`` per line) that every
executor has under the same path; a worker loads it once. A long text is cut
before encoding at places where the pre-splitting pattern always ends a match,
so that the pieces give exactly the tokens of the whole text and the encoder
never holds more than a piece; text without such a place stays whole.

Safe places: between a letter or digit of any script and following white space,
ASCII or CJK punctuation. A match of letters or digits ends there, and the
pattern looks ahead only inside a run of white space, which the cut leaves whole
on the right.

A run of white space too long for the pattern engine's stack is matched by rule:
at the end of a text the run is one match, before a word all but its last
character are one, and that last one stays with what follows.

Defined cases: null and empty texts have no tokens and decode to no bytes;
bytes that are not UTF-8 are read as U+FFFD; strings of special tokens are
ordinary text; repeated rows give equal rows; an empty table an empty result;
extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_CHARS = 1 << 16
LONG_RUN = 1 << 16  # characters of white space that are matched by rule
_SAFE = re.compile(r"(?<=[^\W_])(?=[\s!-/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])")
_WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # the pattern's \s


@lru_cache(maxsize=4)
def _long_runs(length: int):
    return re.compile(f"{_WHITE}{{{length},}}+")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tokenizer of a rank file, once per worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS):
    """Cut ``text`` at safe places into pieces of at least ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _parts(text: str):
    """(part, whether it is one match) of a text cut at its long runs of white
    space."""
    start = 0
    if len(text) >= LONG_RUN:
        for run in _long_runs(LONG_RUN).finditer(text):
            stop = run.end() - (run.end() < len(text))
            if run.start() > start:
                yield text[start:run.start()], False
            yield text[run.start():stop], True
            start = stop
    if start < len(text):
        yield (text[start:] if start else text), False


def token_ids(enc, text: str):
    """Lists of token ids, one per piece of the text."""
    for part, is_match in _parts(text):
        if is_match:
            yield enc._encode_single_piece(part)
        else:
            for piece in pieces(part):
                yield enc.encode_ordinary(piece)


def _texts(column: pa.Array):
    for raw in column:
        value = raw.as_py()
        yield value.decode("utf-8", "replace") if value is not None else ""


def _raw(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    return docs.select(F.col(row_id).alias("id"), F.col(text).cast("binary").alias("raw"))


def encode(docs: DataFrame, path: str, pattern: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, ids array<int>) of every whole text."""
    def run(batches):
        enc = encoding(path, pattern)
        for b in batches:
            ids = [[i for part in token_ids(enc, t) for i in part] for t in _texts(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[row_id, "ids"])

    schema = T.StructType([T.StructField(row_id, docs.schema[row_id].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return _raw(docs, row_id, text).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, row_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(row_id, bytes binary): the raw bytes of each id list."""
    def run(batches):
        enc = encoding(path, pattern)
        for b in batches:
            raw = [enc.decode_bytes(x.as_py() or []) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(raw, pa.binary())], names=[row_id, "bytes"])

    schema = T.StructType([T.StructField(row_id, tokens.schema[row_id].dataType),
                           T.StructField("bytes", T.BinaryType())])
    return tokens.select(row_id, ids).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes every
    whole text piece by piece, so that only the digests leave the task."""
    def one(enc, names, value):
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for part in token_ids(enc, value):
            if part:
                of_ids.update((b"," if n else b"") + ",".join([names[i] for i in part]).encode())
                of_bytes.update(enc.decode_bytes(part))
                n += len(part)
        return n, of_ids.hexdigest(), of_bytes.hexdigest()

    def run(batches):
        enc = encoding(path, pattern)
        names = [str(i) for i in range(enc.max_token_value + 1)]
        for b in batches:
            rows = [one(enc, names, t) for t in _texts(b.column(1))]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.record_batch(
                [b.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.string())], names=[row_id, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([T.StructField(row_id, docs.schema[row_id].dataType),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return _raw(docs, row_id, text).mapInArrow(run, schema)

"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

``encode`` adds an ``array<int>`` column of ids, ``decode`` turns ids back
into the raw bytes. Both run inside Arrow batches, row by row within a batch,
without any shuffle; the encoder is built once per Python worker from the rank
file, which every node has at ``ranks`` (a parameter).

Long texts are cut at safe boundaries before encoding: between a letter or
digit and a following space or line feed. Every alternative of the pattern
allows white space only at the start of a match, so no match spans such a
point and the text after it is split the same way whether or not something
precedes it. A stretch without a safe boundary stays whole.

Cases: null text encodes like the empty text (no ids); empty ids or null ids
decode to zero bytes; repeated rows are encoded each; other columns are
passed through, and one that already has the output's name is replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, ship_package

#: Texts over this many characters are cut into pieces of about this length.
PIECE_CHARS = 1 << 16
SAFE_BOUNDARY = r"(?<=[\p{L}\p{N}])(?=[ \n])"


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=4)
def _boundary(pattern: str):
    import regex
    return regex.compile(pattern)


def safe_pieces(text: str, size: int = PIECE_CHARS, boundary: str = SAFE_BOUNDARY) -> Iterator[str]:
    """Consecutive pieces of ``text``, each cut at the first safe boundary at
    or after ``size`` characters."""
    start, find = 0, _boundary(boundary).search
    while len(text) - start > size:
        m = find(text, start + size)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:] if start else text


def encode_text(text: str, ranks: str, pattern: str, size: int = PIECE_CHARS) -> np.ndarray:
    """Ids of one text, 4 bytes an id (no list of Python numbers is held)."""
    enc = encoding(ranks, pattern)
    got = [enc.encode_to_numpy(piece, disallowed_special=()) for piece in safe_pieces(text, size)]
    return (got[0] if len(got) == 1 else np.concatenate(got)).astype(np.int32)


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids",
           piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``df`` with ``out`` (array<int>): the ids of each whole text."""
    ship_package(df.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = [encode_text(t.as_py() or "", ranks, pattern, piece_chars) for t in batch]
            ends = np.cumsum([0, *map(len, got)], dtype=np.int64)
            flat = np.concatenate(got) if got else np.empty(0, np.int32)
            del got
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            release()

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` (binary): the raw bytes the ids stand for."""
    ship_package(df.sparkSession)

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            yield pa.array([enc.decode_bytes(x.values.to_numpy().tolist() if x.is_valid else [])
                            for x in batch], pa.binary())

    return df.withColumn(out, raw(F.col(ids)))

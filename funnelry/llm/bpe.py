"""Byte-level BPE encoding and decoding with the tiktoken library and a rank file.

The file is read where the driver runs (its size is fixed: a vocabulary) and broadcast, so
executors need no file of their own. Nothing is trained.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are encoded in pieces of about so many characters.
PIECE_CHARS = 1 << 16
#: White space as the library's pattern knows it.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: White space after something else always begins a new match: no alternative of the pattern
#: goes from a character that is not white space to one that is.
_BOUNDARY = re.compile(rf"\S(?={_SPACE})")
#: The library's matcher gives up within runs of white space of about a million characters.
LONG_RUN = 100_000
_LONG_RUN = re.compile(rf"{_SPACE}{{{LONG_RUN},}}")


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """An encoding without special tokens from the content of a rank file.

    Made anew by each task and gone with it: workers stay for later stages, and what they hold
    then is missing there.
    """
    table = {}
    for line in ranks.splitlines():
        if line.strip():
            token, rank = line.split()
            table[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe boundaries, in pieces of ``size`` characters or somewhat more.

    A text without such a boundary stays whole.
    """
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size - 1)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


def encode(codec: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> np.ndarray:
    """Token ids as little-endian unsigned 32-bit integers."""
    if len(text) <= size:
        return np.asarray(codec.encode_ordinary(text), dtype="<u4")
    return np.concatenate([_piece_ids(codec, p) for p in pieces(text, size)])


def _piece_ids(codec: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text of any form: a long run of white space is one match of the pattern, but
    for its last character where something else follows, which is looked at with it."""
    ids, at = [], 0
    for run in _LONG_RUN.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += codec.encode_ordinary(text[at : run.start()])
        ids += codec._encode_single_piece(text[run.start() : end])
        at = end
    return np.asarray(ids + codec.encode_ordinary(text[at:]), dtype="<u4")


def _broadcast(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def encode_column(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Packed ids (little-endian unsigned 32-bit) of a text column; a null text has none."""
    ranks = _broadcast(spark, path)

    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = encoding(ranks.value, pattern)
        for batch in batches:
            yield pd.Series(
                [b"" if t is None else encode(codec, t).tobytes() for t in batch], dtype=object
            )

    return packed(text)


def decode_column(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """Raw bytes of packed ids; whether they are valid text is not asked."""
    ranks = _broadcast(spark, path)

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = encoding(ranks.value, pattern)
        for batch in batches:
            yield pd.Series(
                [
                    b"" if x is None else codec.decode_bytes(np.frombuffer(x, "<u4").tolist())
                    for x in batch
                ],
                dtype=object,
            )

    return raw(ids)


#: What :func:`coded_column` gives for a text; ``ids`` only where they are asked for.
CODED = {
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
    "ids": T.BinaryType(),
}


def coded_column(
    spark: SparkSession, text: Column, path: str, pattern: str, with_ids: bool = False
) -> Column:
    """A struct with the count and SHA-256 of a text's ids and of the bytes they decode to.

    Encoding and decoding share one worker and one vocabulary, a text at a time, and nothing
    long goes back but the packed ids, if asked for. A null text is coded as an empty one.
    """
    ranks = _broadcast(spark, path)
    names = list(CODED) if with_ids else list(CODED)[:-1]
    schema = T.StructType([T.StructField(n, CODED[n]) for n in names])

    def row(codec: tiktoken.Encoding, text: str) -> tuple:
        ids = encode(codec, text)
        packed, raw = ids.tobytes(), codec.decode_bytes(ids.tolist())
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, raw)]
        return (len(ids), *digests, packed)[: len(names)]

    @F.pandas_udf(schema)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = encoding(ranks.value, pattern)
        for batch in batches:
            yield pd.DataFrame([row(codec, t or "") for t in batch], columns=names)

    return coded(text)

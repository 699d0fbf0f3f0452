"""Operator 2: byte-level BPE encoding and decoding with a local rank file.

Each worker loads the rank file once. A long text is cut at safe boundaries
before it is encoded, so that the splitting regex sees bounded strings; the ids
are those of the uncut text. A long run of blanks is one match of the pattern but
for its last character, which may belong to what follows; as the regex engine
needs a stack for such runs, they are given to the encoder as that one match.
Decoding gives the raw bytes back.

The cuts suit patterns in which blanks only stand at a match's start, and a run
of blanks before other text matches without its last one, as in the pattern of
the local rank files here.

Defined results: a null or empty text has no ids (an empty array) and decodes to
no bytes. Text that looks like a special token is ordinary text. Repeated rows
are encoded each on its own; other columns pass through, and a column of the
output's name is replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import small_batches, text_of

#: Code points after which a long text is cut at the next safe boundary.
PIECE_CHARS = 20_000

# A match never goes on over these places, wherever it began: from a visible
# character to a blank or line end, and between an ASCII letter and a digit.
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f\x85\xa0])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

# White space as the pattern's engine sees it, in runs that are matched apart.
_BLANKS = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}+")


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of text whose encodings, joined, are that of the whole text."""
    start = 0
    while len(text) - start > limit:
        found = _SAFE.search(text, start + limit)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


@functools.cache
def load(rank_file: str, pattern: str):
    """The encoder of a rank file (lines of base64 bytes and rank)."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoder, text: str) -> np.ndarray:
    found, at = [], 0
    for run in _BLANKS.finditer(text):
        # a blank before other text may start the next match
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > at:
            found += [encoder.encode_to_numpy(part, disallowed_special=()) for part in pieces(text[at : run.start()])]
        found.append(np.array(encoder._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
    if at < len(text) or not found:
        found += [encoder.encode_to_numpy(part, disallowed_special=()) for part in pieces(text[at:])]
    return found[0] if len(found) == 1 else np.concatenate(found)


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the token ids of text_col as array<int>."""
    small_batches(df.sparkSession)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        encoder = load(rank_file, pattern)
        found = [encode_text(encoder, text) for text in texts.to_pylist()]
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) for x in found], out=offsets[1:])
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    # declared nondeterministic so that the plan encodes once, however often the ids are used
    return df.withColumn(ids_col, ids.asNondeterministic()(text_of(df, text_col)))


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the raw bytes that the ids stand for (null ids: none)."""
    small_batches(df.sparkSession)

    @F.arrow_udf(T.BinaryType())
    def raw(ids: pa.Array) -> pa.Array:
        encoder = load(rank_file, pattern)
        return pa.array([encoder.decode_bytes(x or []) for x in ids.to_pylist()], pa.binary())

    return df.withColumn(bytes_col, raw(df[ids_col]))


@F.arrow_udf(T.StringType())
def ids_sha256(ids: pa.Array) -> pa.Array:
    """Lowercase hex SHA-256 of ids as little-endian unsigned 32-bit integers."""
    flat, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
    return pa.array([hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])], pa.string())

"""Byte-level BPE encoding and decoding (operator 7).

The tiktoken library encodes with a local rank file.  A long text is first cut
at *safe boundaries*: places where no match of the split pattern can span and
no lookahead can see across, so that the ids of the parts joined equal the ids
of the whole.  Ids are stored as little-endian unsigned 32-bit integers.

Defined results: null or empty text gives no ids (and null stays null in
``decode``); rows with the same doc_id are encoded row by row; other columns
are passed through by ``encode`` and take no part, whatever their names are
(``ids`` may be renamed through ``out``).
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters after which a long text is cut at the next safe boundary.
PART_CHARS = 1 << 16

# A letter or digit, then a blank that starts the next match: matches hold blanks
# only at their start, or are all blanks, and the cut leaves a run of blanks whole.
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text cut at safe boundaries, each part of ``size`` or more characters but the last."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


def encode_text(enc, text: str, size: int = PART_CHARS) -> bytes:
    """Ids as little-endian unsigned 32-bit integers; one part's ids are held as a list at a time."""
    return b"".join(np.asarray(enc.encode_ordinary(p), dtype="<u4").tobytes() for p in parts(text, size))


def decode_ids(enc, raw: bytes, size: int = PART_CHARS) -> bytes:
    ids = np.frombuffer(raw, "<u4")
    return b"".join(enc.decode_bytes(ids[i:i + size].tolist()) for i in range(0, len(ids), size))


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus the binary column ``out`` with the ids of ``text``."""
    kept = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])
    names = [f.name for f in kept]

    def run(batches):
        enc = encoder(rank_file, pattern)
        for b in batches:
            texts = b.column(text)
            ids = pa.array((encode_text(enc, t.as_py() or "") for t in texts), pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), ids], [*names, out])

    return docs.mapInArrow(run, schema)


def decode(coded: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` plus the binary column ``out``: the raw bytes that the ids stand for."""
    kept = [f for f in coded.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])
    names = [f.name for f in kept]

    def run(batches):
        enc = encoder(rank_file, pattern)
        for b in batches:
            raw = pa.array((None if (v := x.as_py()) is None else decode_ids(enc, v) for x in b.column(ids)),
                           pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), raw], [*names, out])

    return coded.mapInArrow(run, schema)

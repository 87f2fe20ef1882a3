"""Byte-level BPE with a local rank file.

The rank file is read once in each Python worker from a path that every executor has. A long text
is cut where a letter or digit is followed by a blank: no match of the split pattern spans such a
place and none looks back over it, so the pieces' ids, one after another, are those of the whole
text, while no single call works on more than about ``piece_chars`` characters (unless a text has
no such place).
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import by_slices

SAFE_CUT = regex.compile(r"[\p{L}\p{N}](?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int) -> Iterator[str]:
    at = 0
    while len(text) - at > most:
        cut = SAFE_CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def encode_text(enc, text: str, most: int) -> np.ndarray:
    """Ids as 32-bit numbers. The encoding has no special tokens, so their strings are ordinary text."""
    parts = [enc.encode_to_numpy(piece, disallowed_special=()) for piece in pieces(text, most)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def ids_array(enc, texts: pa.Array, most: int) -> pa.ListArray:
    ids = [encode_text(enc, t.as_py() or "", most) for t in texts]
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)))


def bytes_array(enc, ids: pa.ListArray) -> pa.BinaryArray:
    rows = (x.values.to_numpy().tolist() if x.is_valid else [] for x in ids)
    return pa.array([enc.decode_bytes(x) for x in rows], pa.binary())


def text_slices(texts: Iterator[pa.Array], work: Callable[[pa.Array], pa.Array]) -> Iterator[pa.Array]:
    """``work`` on about half a megabyte of texts at a time, so that ids and bytes of a whole batch are never held at once."""
    batches = (pa.RecordBatch.from_arrays([batch], ["text"]) for batch in texts)
    return by_slices(batches, "text", lambda part: iter([work(part.column("text"))]))


def encode_column(text: Column, rank_file: str, pattern: str, piece_chars: int = 1 << 16) -> Column:
    """Token ids (array of int) of a text; null gives no ids. Strings of special tokens are ordinary text."""

    @F.arrow_udf("array<int>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_file, pattern)
        return text_slices(texts, lambda part: ids_array(enc, part, piece_chars))

    return encode(text)


def round_trip_column(text: Column, rank_file: str, pattern: str, piece_chars: int = 1 << 16) -> Column:
    """Token ids of a text, as ``encode_column`` gives them, and the bytes that these ids decode to."""

    @F.arrow_udf("struct<ids: array<int>, bytes: binary>")
    def there_and_back(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_file, pattern)

        def work(part: pa.Array) -> pa.Array:
            ids = ids_array(enc, part, piece_chars)
            return pa.StructArray.from_arrays([ids, bytes_array(enc, ids)], ["ids", "bytes"])

        return text_slices(texts, work)

    return there_and_back(text)


def decode_column(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes that the ids stand for, as they are: a cut sequence of ids need not be valid UTF-8."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            yield bytes_array(enc, batch)

    return decode(ids)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text_column: str = "text", ids_column: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of every whole text. Null and empty texts have none; repeated rows stay rows.

    A column of the name ``ids_column`` is replaced. Each row is encoded by itself: no shuffle, nothing kept between rows.
    """
    return docs.withColumn(ids_column, encode_column(F.col(text_column).cast("string"), rank_file, pattern))


def decode_documents(docs: DataFrame, rank_file: str, pattern: str, ids_column: str = "token_ids", bytes_column: str = "decoded") -> DataFrame:
    """``docs`` with the raw bytes of the token ids; null ids give empty bytes, an unknown id stops the job."""
    return docs.withColumn(bytes_column, decode_column(F.col(ids_column), rank_file, pattern))


def round_trip_documents(docs: DataFrame, rank_file: str, pattern: str, text_column: str = "text", ids_column: str = "token_ids", bytes_column: str = "decoded") -> DataFrame:
    """``docs`` with the token ids of every whole text and the bytes decoded from these ids, as ``decode_documents`` after ``encode_documents``.

    Both are done by one worker a task, and the ids do not travel to Python again.
    Columns of the two names are replaced; ``mr_coded`` is reserved.
    """
    coded = docs.withColumn("mr_coded", round_trip_column(F.col(text_column).cast("string"), rank_file, pattern))
    return coded.withColumns({ids_column: F.col("mr_coded.ids"), bytes_column: F.col("mr_coded.bytes")}).drop("mr_coded")

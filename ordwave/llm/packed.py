"""Packed exchange: hashed entries grouped by the top bits of their key.

A task collects entries as numpy arrays and hands them to the shuffle as one
binary row per bucket, so the JVM moves a few large rows and the reducer
works on whole arrays. The number of buckets follows the input's size, which
keeps a bucket's share constant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textnum import U

FLUSH = 700_000          # entries a task collects before it hands them over
BUCKET_BYTES = 2 << 20   # input bytes (compressed) per bucket
LEAST = 64


def input_bytes(df: DataFrame) -> int:
    """Spark's estimate of the input's size (file sizes, for a table)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_bits(df: DataFrame) -> int:
    """log2 of the number of buckets for an input."""
    size = input_bytes(df)
    if size >= 1 << 60:             # Spark has no estimate (rows from Python or an RDD): go by their number
        size = df.count() * 1000
    n = size // BUCKET_BYTES
    return max(LEAST.bit_length() - 1, int(n).bit_length())


def cuts(sorted_keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets present in sorted keys, and the bounds of each."""
    b = (sorted_keys >> U(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
    return b[first], np.append(first, len(b))


def pack(bits: int, keys: np.ndarray, *cols: np.ndarray) -> Iterator[tuple]:
    """(bucket, key bytes, column bytes...) for entries sorted by key."""
    names, at = cuts(keys, bits)
    for k, b in enumerate(names):
        s = slice(at[k], at[k + 1])
        yield (int(b), keys[s].tobytes(), *(c[s].tobytes() for c in cols))


def unpack(col, dtype) -> np.ndarray:
    """The entries of a binary column, back to back."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    return np.frombuffer(b"".join(col.to_pylist()), dtype)


def planes(raw: bytes, width: int) -> bytes:
    """Numbers of ``width`` bytes as all their first bytes, then all their second ones, and so
    on: the high bytes of small or sorted numbers repeat, which the shuffle's codec sees."""
    return np.frombuffer(raw, np.uint8).reshape(-1, width).T.tobytes()


def unplaned(col, dtype) -> np.ndarray:
    """The entries of a binary column of :func:`planes`, back to back."""
    width = np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(np.frombuffer(x, np.uint8).reshape(width, -1).T.tobytes() for x in col.to_pylist()), dtype)


def sizes(col, width: int) -> np.ndarray:
    """Entries in each row of a binary column."""
    return np.array([len(x) // width for x in col.to_pylist()], np.int64)


def most_frequent(rows: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the most frequent ``key, c`` rows, most frequent
    first: all above a count that at most ``bound`` rows pass. The count is
    read off a histogram of fixed size, so no task ranks all rows."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    hist = rows.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect()     # at most 512 rows
    total, least = 0, None
    for r in sorted(hist, key=lambda r: -r["level"]):
        total += r["k"]
        if total > bound:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = rows.where(level >= least).toArrow()
    keys, c = got.column("key").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.lexsort((keys, -c))
    return keys[order], c[order]

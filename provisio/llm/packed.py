"""Packed records: many small keys travel as one binary value per source and bucket.

Shuffling billions of single keys as rows costs more for the rows than for the keys. The
operators on windows and shingles therefore deal documents into groups of bounded size, make the
keys of a group distinct (so a text that a third of all documents share counts once per group),
and send one row per group and bucket whose ``data`` holds the keys of that bucket, sorted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import buckets_for

GROUP_BYTES = 8 << 20  # of text in one group of documents, on average
SCHEMA = "bucket int, source int, data binary"


def text_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def group_count(docs: DataFrame, n_bytes: int) -> int:
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / GROUP_BYTES))


def grouped(docs: DataFrame, n_bytes: int, id_type: str = "bigint", more: list[str] | None = None) -> tuple[DataFrame, int]:
    """``source`` (group number), ``doc_id``, ``text`` and more columns; equal ids or texts alone do not fill a group."""
    groups = group_count(docs, n_bytes)
    dealt = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")), F.lit(groups)).cast("int")
    return docs.select(dealt.alias("source"), F.col("doc_id").cast(id_type).alias("doc_id"), "text", *(more or [])), groups


def bucket_count(docs: DataFrame, n_bytes: float) -> int:
    return buckets_for(docs.sparkSession, n_bytes)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits of a key; the low bits stay free to tell keys of a bucket apart."""
    return ((keys >> W.U(32)) * W.U(buckets) >> W.U(32)).astype(np.int64)


def pack(source: int, bucket: np.ndarray, records: np.ndarray) -> pa.Table:
    """One row per bucket; ``records`` is a structured or plain array, ``bucket`` ascending."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    first = np.concatenate([[0], cut, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
    data = [records[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
    numbers = bucket[first[:-1]] if len(bucket) else np.zeros(0, np.int64)
    return pa.table([pa.array(numbers, pa.int32()), pa.array(np.full(len(data), source), pa.int32()), pa.array(data, pa.binary())], names=["bucket", "source", "data"])


def unpack(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a table of packed rows, and the row each came in."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("data")]
    if not parts:
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def repack(table: pa.Table, records: np.ndarray, row: np.ndarray) -> pa.Table:
    """Records back to the sources of the rows they came in; rows without records vanish."""
    sources = table.column("source").to_numpy()
    order = np.argsort(row, kind="stable")
    records, row = records[order], row[order]
    present, first = np.unique(row, return_index=True)
    ends = np.append(first[1:], len(row))
    data = [records[a:b].tobytes() for a, b in zip(first, ends)]
    bucket = table.column("bucket").to_numpy()
    return pa.table([
        pa.array(bucket[present], pa.int32()), pa.array(sources[present], pa.int32()), pa.array(data, pa.binary()),
    ], names=["bucket", "source", "data"])


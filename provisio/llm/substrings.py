"""Substring deduplication with fixed-block anchors.

A window is a run of ``window`` consecutive words. Every window of 13 words holds a whole block of 7
words that begins at a multiple of 7 in its document. So it is enough to index the non-overlapping
blocks of all documents and to probe them with the rolling 7-word windows of all documents:

1. Anchors: per group of documents, the distinct hashes of all rolling blocks, with a mark on those
   that are an index block. Where a hash is an index block anywhere and occurs twice or more,
   every place of it is an anchor.
2. Extension: only windows around an anchor are looked at further. Their 128-bit keys are
   collected, and for each key the smallest ``doc_id`` that holds it.
3. A window whose key has a smaller ``doc_id`` than its own document is a repeat; adjoining and
   overlapping repeats join to the maximal repeated spans.

Keys travel packed and distinct per group of documents (see ``packed``), so a passage that a third of
all documents share is one record per group, whatever the number of documents. There are no pairs.

Defined results: null and empty texts have no words; windows that repeat only inside their own document
stay; of rows with the same ``doc_id`` none is smaller, so they do not remove each other's
words; rows with a null ``doc_id`` neither remove nor lose words; an empty table gives an empty table;
only ``doc_id`` (a whole number) and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import packed as P
from provisio.llm import words as W
from provisio.llm.store import store

WINDOW = 13
KEY = np.dtype([("k0", "<u8"), ("k1", "<u8"), ("doc", "<i8")])
NOBODY = np.int64(np.iinfo(np.int64).max)
IS_BLOCK, IS_TWICE = np.uint32(1), np.uint32(2)
LOW = W.U(0x3FFFFFFF)


def block_length(window: int) -> int:
    """The longest block of which every window holds a whole aligned one."""
    return (window + 1) // 2


def _short(keys: np.ndarray) -> np.ndarray:
    """30 bits that tell the keys of a bucket apart (a clash only costs a look in the second step)."""
    return ((keys & LOW) << W.U(2)).astype(np.uint32)


def _anchors(window: int, buckets: int):
    block = block_length(window)

    def run(key, table):
        keys, marks = [], []
        for w in W.split(table.column("text")):
            value, at = W.windows(w.hashes(), w.first, block)
            row = np.searchsorted(w.first, at, side="right") - 1
            keys.append(value)
            marks.append((at - w.first[row]) % block == 0)
        keys, marks = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(marks or [np.zeros(0, bool)])
        order = np.argsort(keys)
        keys, marks = keys[order], marks[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        twice = np.diff(np.append(first, len(keys))) > 1
        indexed = np.maximum.reduceat(marks, first) if len(first) else np.zeros(0, bool)
        keys = keys[first]
        records = _short(keys) | np.where(indexed, IS_BLOCK, 0).astype(np.uint32) | np.where(twice, IS_TWICE, 0).astype(np.uint32)
        return P.pack(key[0].as_py(), P.bucket_of(keys, buckets), records)

    return run


def _match(table: pa.Table) -> pa.Table:
    """Per bucket: the hashes that are an index block somewhere and occur twice or more."""
    records, row = P.unpack(table, np.uint32)
    if not len(records):
        return table.slice(0, 0)
    order = np.argsort(records, kind="stable")
    records, row = records[order], row[order]
    short = records >> np.uint32(2)
    first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]]))
    size = np.diff(np.append(first, len(short)))
    found = (np.bitwise_or.reduceat(records, first) & IS_BLOCK > 0) & ((size > 1) | (np.bitwise_or.reduceat(records, first) & IS_TWICE > 0))
    hit = np.repeat(found, size)
    return P.repack(table, short[hit] << np.uint32(2), row[hit])


def _window_keys(w: W.Words, window: int):
    """128-bit key and first word of each window."""
    k0, at = W.windows(w.hashes(0), w.first, window)
    k1, _ = W.windows(w.hashes(1), w.first, window)
    return k0, k1, at


def _extend(window: int, buckets: int, key_buckets: int):
    block = block_length(window)

    def run(key, docs, found):
        data, row = P.unpack(found, np.uint32)
        bucket = found.column("bucket").to_numpy().astype(np.uint64)
        known = np.unique((bucket[row] << W.U(32)) | data.astype(np.uint64)) if len(data) else np.zeros(0, np.uint64)
        ids = docs.column("doc_id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        parts = []
        for w in W.split(docs.column("text")) if len(known) else ():
            value, at = W.windows(w.hashes(), w.first, block)
            own = (P.bucket_of(value, buckets).astype(np.uint64) << W.U(32)) | _short(value).astype(np.uint64)
            anchors = np.zeros(len(w.start) + 1, np.int64)
            anchors[at + 1] = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
            anchors = np.cumsum(anchors)  # anchors before each word
            k0, k1, at = _window_keys(w, window)
            near = anchors[at + window - block + 1] > anchors[at]
            rows = w.lo + np.searchsorted(w.first, at[near], side="right") - 1
            one = np.zeros(int(near.sum()), KEY)
            one["k0"], one["k1"], one["doc"] = k0[near], k1[near], ids[rows]
            parts.append(one[~null[rows]])
        keys = np.concatenate(parts) if parts else np.zeros(0, KEY)
        keys = _smallest(keys)
        return P.pack(key[0].as_py(), P.bucket_of(keys["k0"], key_buckets), keys)

    return run


def _smallest(keys: np.ndarray) -> np.ndarray:
    """One record per key, with the smallest document; ascending by key."""
    keys = keys[np.lexsort((keys["doc"], keys["k1"], keys["k0"]))]
    new = np.ones(len(keys), bool)
    new[1:] = (keys["k0"][1:] != keys["k0"][:-1]) | (keys["k1"][1:] != keys["k1"][:-1])
    return keys[new]


def _first_holder(table: pa.Table) -> pa.Table:
    """Per bucket: every group learns the smallest document of those of its keys that other groups hold too or that it holds itself."""
    keys, row = P.unpack(table, KEY)
    if not len(keys):
        return table.slice(0, 0)
    order = np.lexsort((keys["doc"], keys["k1"], keys["k0"]))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys["k0"][1:] != keys["k0"][:-1]) | (keys["k1"][1:] != keys["k1"][:-1])
    first = np.flatnonzero(new)
    smallest = np.repeat(keys["doc"][first], np.diff(np.append(first, len(keys))))
    told = keys.copy()
    told["doc"] = smallest
    return P.repack(table, told, row)


def _kept(window: int, id_type: str):
    def run(key, docs, holders):
        told, _ = P.unpack(holders, KEY)
        told = told[np.argsort(told["k0"], kind="stable")]  # equal k0 with another k1: looked through below
        ids = docs.column("doc_id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        plain = ids.fill_null(0).to_numpy()
        n = docs.num_rows
        n_words, n_removed = np.zeros(n, np.int64), np.zeros(n, np.int64)
        spans: list[list] = [[] for _ in range(n)]
        texts: list[bytes] = [b""] * n
        for w in W.split(docs.column("text")):
            counts = w.counts
            n_words[w.lo : w.hi] = counts
            gone = np.zeros(len(w.start) + 1, np.int64)
            if len(told):
                k0, k1, at = _window_keys(w, window)
                rows = w.lo + np.searchsorted(w.first, at, side="right") - 1
                place = np.searchsorted(told["k0"], k0)
                holder = np.full(len(k0), NOBODY)
                open_ = np.arange(len(k0))
                while len(open_):  # one round, but for clashes of the first half of the key
                    open_ = open_[place[open_] < len(told)]
                    open_ = open_[told["k0"][place[open_]] == k0[open_]]
                    same = told["k1"][place[open_]] == k1[open_]
                    holder[open_[same]] = told["doc"][place[open_[same]]]
                    open_ = open_[~same]
                    place[open_] += 1
                repeat = at[(holder < plain[rows]) & ~null[rows]]
                np.add.at(gone, repeat, 1)
                np.add.at(gone, repeat + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            cut = np.unique(np.concatenate([edge, w.first]))  # spans end with their document
            removed = np.zeros(len(w.start) + 1, np.int64)
            np.cumsum(gone, out=removed[1:])
            n_removed[w.lo : w.hi] = removed[w.first[1:]] - removed[w.first[:-1]]
            for a, b in zip(cut, cut[1:]):
                if gone[a]:
                    row = int(np.searchsorted(w.first, a, side="right")) - 1
                    spans[w.lo + row].append((int(a - w.first[row]), int(b - w.first[row])))
            raw = w.buf.tobytes()
            for row in range(w.hi - w.lo):
                own = raw[w.offsets[row] : w.offsets[row + 1]].split()
                for a, b in reversed(spans[w.lo + row]):
                    del own[a:b]
                texts[w.lo + row] = b" ".join(own)
        return pa.table([
            docs.column("doc_id"), pa.array(n_words), pa.array(n_removed),
            pa.array([[{"first_word": a, "end_word": b} for a, b in s] for s in spans], pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "spans", "text"])

    return run, f"doc_id {id_type}, n_words long, n_removed long, spans array<struct<first_word:long,end_word:long>>, text string"


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, the repeated spans (word numbers), and the text of the kept words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = P.text_bytes(docs)
    rows, groups = P.grouped(docs, size)
    buckets = P.bucket_count(docs, size * 0.8)  # about 4 bytes for each word of 5 to 6
    key_buckets = P.bucket_count(docs, size)
    anchors = rows.groupBy("source").applyInArrow(_anchors(window, buckets), P.SCHEMA)
    found = store(anchors.groupBy("bucket").applyInArrow(_match, P.SCHEMA), "anchors")
    keys = rows.groupBy("source").cogroup(found.groupBy("source")).applyInArrow(_extend(window, buckets, key_buckets), P.SCHEMA)
    holders = store(keys.groupBy("bucket").applyInArrow(_first_holder, P.SCHEMA), "holders")
    run, schema = _kept(window, "bigint")
    kept = rows.groupBy("source").cogroup(holders.groupBy("source")).applyInArrow(run, schema)
    return kept.withColumn("doc_id", F.col("doc_id").cast(kind)) if kind != "bigint" else kept

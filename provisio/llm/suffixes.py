"""Removal of repeated byte strings by a radix sort of suffixes that stops at a depth.

Suffixes are sorted only through their first ``depth`` bytes (a *window*), by passes over digits, the most
significant first. After each pass a group of one suffix is closed, as nothing can equal it any more; the
others go on to the next digit. Groups left after the last digit are exactly the repeated windows.

Which bytes serve as a digit is free as long as equal windows have equal digits. So that the first pass
need not move every suffix of the corpus, it takes the digit at a synchronising point:

1. The first digit of a window is its smallest ``SEED``-byte gram (by hash). Neighbouring windows share it, so
   some 1.5 digits per 100 suffixes are sent. Windows whose digit is at one place of the corpus only are closed.
2. The second digit is the stretch between two synchronising points, prolonged by ``depth`` bytes: if it
   repeats, so do all windows that start in it. One of the equal stretches, its owner, stays open, so that
   windows elsewhere meet it; in the others all windows are settled as repeated.
3. The third digit is the whole window, of the windows that are still open.

Every pass is one shuffle by the high bits of the digit and a sort inside each bucket. Digits travel
packed, at most twice per group of texts (see ``packed``), so a string that a third of all texts
share is two records per group. Digits are hashes of 64 bits and the bits of the bucket's number, which
grow with the data. Equal texts are one text with a count, sorted once.

Defined results: a null text is empty; bytes are those of UTF-8, so what is kept may begin inside a
character; windows never cross texts; a string that overlaps itself counts; equal texts of ``depth`` bytes or
more are removed whole; shorter texts stay; rows with equal or null ``doc_id`` are rows of their own; an empty
table gives an empty table; a long text is worked on in pieces of ``PIECE`` bytes; only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import packed as P
from provisio.llm import words as W
from provisio.llm.store import store

DEPTH = 200
SEED = 32  # bytes of the first digit
PIECE = 1 << 20  # windows that are worked on at once
FIRST, RUN, LAST = np.dtype("<u4"), np.dtype([("k0", "<u8"), ("k1", "<u8")]), np.dtype("<u8")
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _slide(x: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` neighbours."""
    if len(x) < width:
        return x[:0]
    have = 1
    while 2 * have <= width:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: -(width - have)], x[width - have :]) if have < width else x


def _two_of_each(sorted_: np.ndarray) -> np.ndarray:
    """At most two copies of each value: enough to tell that it repeats."""
    keep = np.ones(len(sorted_), bool)
    keep[2:] = sorted_[2:] != sorted_[:-2]
    return sorted_[keep]


class Piece:
    """The windows that start in bytes ``lo`` to ``hi`` of texts laid end to end, with their first two digits."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, depth: int):
        seed = min(SEED, depth)
        self.lo, self.hi, self.depth = lo, min(lo + PIECE, len(data)), depth
        self.bytes = data[lo : min(self.hi + depth - 1, len(data))]
        a, b = np.searchsorted(offsets, [lo, self.hi - 1], side="right")
        begins, ends = np.maximum(offsets[a - 1 : b], lo) - lo, offsets[a : b + 1] - lo
        room = np.repeat(ends, np.minimum(ends, self.hi - lo) - begins) - np.arange(self.hi - lo)
        grams = W.rolling(self.bytes, seed)
        lead = _slide(grams, depth - seed + 1, np.minimum)
        self.inside = np.zeros(self.hi - lo, bool)  # a whole window of one text starts here
        self.inside[: len(lead)] = room[: len(lead)] >= depth
        self.lead = np.where(self.inside[: len(lead)], lead, W.U(0))
        pad = np.zeros(depth - seed, np.uint64)
        points = np.flatnonzero(_slide(np.concatenate([pad, self.lead, pad]), depth - seed + 1, np.maximum) == grams) if len(lead) else np.zeros(0, np.int64)
        self.seeds = grams[points]
        start = np.unique(np.concatenate([begins, points[points < self.hi - lo]]))
        last = np.minimum(np.append(start[1:], self.hi - lo) - 1, start + room[start] - depth)
        some = last >= start
        self.start, self.last = start[some], last[some]  # first and last window of each stretch

    def runs(self) -> np.ndarray:
        out = np.zeros(len(self.start), RUN)
        for lane, name in enumerate(RUN.names):
            out[name] = W.hash_ranges(self.bytes, self.start, self.last + self.depth, lane)
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Third digit of every window, and the hash that deals it to a bucket."""
        return W.rolling(self.bytes, self.depth), W.rolling(self.bytes, self.depth, 1)

    def cover(self, which: np.ndarray) -> np.ndarray:
        """Windows in the chosen stretches."""
        step = np.zeros(self.hi - self.lo + 1, np.int8)
        step[self.start[which]] += 1  # stretches do not overlap, but one may end where the next begins
        np.add.at(step, self.last[which] + 1, -1)
        return np.cumsum(step[:-1]) > 0


def _pieces(texts, depth: int) -> Iterator[Piece]:
    offsets, data = W.as_bytes(texts)
    for lo in range(0, len(data), PIECE):
        yield Piece(data, offsets, lo, depth)


class Buckets:
    """Bucket numbers of the three digits, one range after the other."""

    def __init__(self, docs: DataFrame, n_bytes: int):
        self.first, self.run, self.last = (P.bucket_count(docs, n_bytes * share) for share in (0.06, 0.25, 0.8))

    def of(self, digit: np.dtype, keys: np.ndarray) -> np.ndarray:
        count, base = {FIRST: (self.first, 0), RUN: (self.run, self.first), LAST: (self.last, self.first + self.run)}[digit]
        return P.bucket_of(keys, count) + base

    def digit(self, bucket: int) -> np.dtype:
        return FIRST if bucket < self.first else RUN if bucket < self.first + self.run else LAST


def _short(keys: np.ndarray) -> np.ndarray:
    """The bits of a first digit below its bucket (a clash only leaves a window open)."""
    return keys.astype(FIRST)


def _sent(source: int, bucket: np.ndarray, records: np.ndarray) -> pa.Table:
    """Packed records, at most two of each, sorted in their bucket."""
    names = records.dtype.names
    order = np.lexsort((*(records[n] for n in reversed(names)), bucket)) if names else np.lexsort((records, bucket))
    bucket, records = bucket[order], records[order]
    keep = np.ones(len(records), bool)
    keep[2:] = (records[2:] != records[:-2]) | (bucket[2:] != bucket[:-2])
    return P.pack(source, bucket[keep], records[keep])


def _first_digits(depth: int, buckets: Buckets):
    def run(key, table):
        seeds, runs = [np.zeros(0, np.uint64)], [np.zeros(0, RUN)]
        for piece in _pieces(table.column("text"), depth):
            seeds.append(piece.seeds)
            runs.append(piece.runs())
        seeds, runs = _two_of_each(np.sort(np.concatenate(seeds))), np.concatenate(runs)
        source = key[0].as_py()
        return pa.concat_tables([
            _sent(source, buckets.of(FIRST, seeds), _short(seeds)), _sent(source, buckets.of(RUN, runs["k0"]), runs)])

    return run


def _repeated(buckets: Buckets):
    def run(key, table):
        """Per bucket: the records that came twice or more, once to each source that sent them; the first source owns a run."""
        digit = buckets.digit(key[0].as_py())
        records, row = P.unpack(table, digit)
        if not len(records):
            return table.slice(0, 0)
        source = table.column("source").to_numpy()[row]
        keys = [records[n] for n in reversed(digit.names)] if digit.names else [records]
        order = np.lexsort((source, *keys))
        records, row, source = records[order], row[order], source[order]
        new = np.ones(len(records), bool)
        new[1:] = records[1:] != records[:-1]
        first = np.flatnonzero(new)
        many = np.repeat(np.diff(np.append(first, len(new))) > 1, np.diff(np.append(first, len(new))))
        other = new.copy()
        other[1:] |= source[1:] != source[:-1]
        told = many & other
        if digit != RUN:
            return P.repack(table, records[told], row[told])
        marked = np.zeros(int(told.sum()), [*RUN.descr, ("owner", "u1")])
        for name in RUN.names:
            marked[name] = records[name][told]
        marked["owner"] = new[told]
        return P.repack(table, marked, row[told])

    return run


OWNED = np.dtype([*RUN.descr, ("owner", "u1")])


class Told:
    """What the buckets told one group of texts."""

    def __init__(self, table: pa.Table, buckets: Buckets):
        bucket = table.column("bucket").to_numpy()
        kinds = [buckets.digit(b) for b in bucket.tolist()]
        part = [table.filter(pa.array([k == d for k in kinds], pa.bool_())) for d in (FIRST, RUN, LAST)]
        short, row = P.unpack(part[0], FIRST)
        place = part[0].column("bucket").to_numpy().astype(np.uint64)[row]
        self.buckets, self.seeds = buckets, np.sort(place << W.U(32) | short.astype(np.uint64))
        runs, _ = P.unpack(part[1], OWNED)
        self.runs = runs[np.lexsort((runs["k1"], runs["k0"]))]
        last, row = P.unpack(part[2], LAST)
        place = part[2].column("bucket").to_numpy()[row]
        order = np.lexsort((place, last))
        self.last, self.place = last[order], place[order]

    def _known(self, lead: np.ndarray) -> np.ndarray:
        own = self.buckets.of(FIRST, lead).astype(np.uint64) << W.U(32) | _short(lead).astype(np.uint64)
        at = np.minimum(np.searchsorted(self.seeds, own), len(self.seeds) - 1)
        return self.seeds[at] == own

    def look(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """Windows that are settled as repeated, and windows still open (an owner's are both)."""
        n = piece.hi - piece.lo
        open_, settled, owned = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
        if len(self.seeds):
            open_[: len(piece.lead)] = piece.inside[: len(piece.lead)]
            open_[open_] = self._known(piece.lead[np.flatnonzero(open_)])
        if len(self.runs):
            runs = piece.runs()
            at = np.minimum(np.searchsorted(self.runs["k0"], runs["k0"]), len(self.runs) - 1)
            same = (self.runs["k0"][at] == runs["k0"]) & (self.runs["k1"][at] == runs["k1"])
            settled = piece.cover(same)
            owned = piece.cover(same & (self.runs["owner"][at] > 0))
        return settled, open_ & (~settled | owned)

    def repeated(self, piece: Piece) -> np.ndarray:
        settled, open_ = self.look(piece)
        at = np.flatnonzero(open_ & ~settled)
        if len(at) and len(self.last):
            key, deal = piece.windows()
            key, deal = key[at], self.buckets.of(LAST, deal[at])
            spot = np.searchsorted(self.last, key)
            rest = np.arange(len(at))
            while len(rest):  # one round, but for equal digits in different buckets
                rest = rest[spot[rest] < len(self.last)]
                rest = rest[self.last[spot[rest]] == key[rest]]
                same = self.place[spot[rest]] == deal[rest]
                settled[at[rest[same]]] = True
                rest = rest[~same]
                spot[rest] += 1
        return settled


def _last_digits(depth: int, buckets: Buckets):
    def run(key, texts, told):
        told, keys, deals = Told(told, buckets), [np.zeros(0, LAST)], [np.zeros(0, np.int64)]
        for piece in _pieces(texts.column("text"), depth) if len(told.seeds) else ():
            at = np.flatnonzero(told.look(piece)[1])
            if len(at):
                digit, deal = piece.windows()
                keys.append(digit[at])
                deals.append(buckets.of(LAST, deal[at]))
        return _sent(key[0].as_py(), np.concatenate(deals), np.concatenate(keys))

    return run


def _cut(depth: int, buckets: Buckets):
    def run(key, texts, told):
        told = Told(told, buckets)
        offsets, data = W.as_bytes(texts.column("text"))
        step = np.zeros(len(data) + 1, np.int32)
        for lo in range(0, len(data), PIECE) if len(told.seeds) or len(told.runs) else ():
            at = lo + np.flatnonzero(told.repeated(Piece(data, offsets, lo, depth)))
            step[at] += 1
            step[at + depth] -= 1
        gone = np.cumsum(step[:-1]) > 0
        edge = np.concatenate([[False], gone, [False]])
        edge = np.flatnonzero(edge[1:] != edge[:-1])
        # A run of removed bytes ends with its text.
        inner = offsets[1:-1][(np.searchsorted(edge, offsets[1:-1], side="right") & 1) == 1]
        inner = np.setdiff1d(inner, edge)
        edge = np.sort(np.concatenate([edge, inner, inner]))
        begin, end = edge[::2], edge[1::2]
        first = np.searchsorted(begin, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        spans = pa.StructArray.from_arrays([pa.array(begin - offsets[row]), pa.array(end - offsets[row])], names=["begin", "end"])
        kept = data[~gone]
        before = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        kept = pa.Array.from_buffers(pa.large_binary(), len(before) - 1, [None, pa.py_buffer(before.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))])
        out = pa.table([
            texts.column("doc_id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), spans).cast(SPANS),
            kept.cast(pa.binary()),
        ], names=["doc_id", "n_bytes", "spans", "kept"])
        return out.filter(pa.array(texts.column("n").to_numpy() == 1))

    return run


SCHEMA = "n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"


def _with_copies(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows whose text (h0, h1) is in ``copies``, whose hot texts are dealt over several tasks.

    A text is hot if it has more than a fixed share of all copies, so the hot ones are few at any size.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = copies.agg(F.sum("n").alias("n")).first()["n"] or 0
    most = total // (4 * parts) + 1
    salts = F.ceil(F.col("n") / most).cast("int")
    hot = copies.filter(F.col("n") > most).select("h0", "h1", salts.alias("salts"))  # below 4 * parts rows
    rows = rows.join(F.broadcast(hot), ["h0", "h1"], "left")
    rows = rows.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts"))).cast("int"))
    dealt = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))).drop("n")
    return rows.join(dealt, ["h0", "h1", "salt"], "left_semi")


def remove_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, n_bytes, the removed spans (byte numbers, maximal) and the bytes that are kept."""
    h0, h1 = F.xxhash64("text").alias("h0"), F.xxhash64(F.lit("second"), "text").alias("h1")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "text", n_bytes.alias("n_bytes"), h0, h1)
    long_ = rows.filter(F.col("n_bytes") >= depth)
    once = long_.groupBy("h0", "h1").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
    texts = store(once, "suffix-texts", "zstd")
    size = P.text_bytes(texts)
    groups = P.group_count(docs, size)
    dealt = texts.select(F.pmod("h0", F.lit(groups)).cast("int").alias("source"), "doc_id", "text", "n")
    buckets = Buckets(docs, size)

    first = dealt.select("source", "text").groupBy("source").applyInArrow(_first_digits(depth, buckets), P.SCHEMA)
    told = store(first.groupBy("bucket").applyInArrow(_repeated(buckets), P.SCHEMA), "suffix-first")
    last = dealt.select("source", "text").groupBy("source").cogroup(told.groupBy("source")).applyInArrow(_last_digits(depth, buckets), P.SCHEMA)
    told = told.unionByName(store(last.groupBy("bucket").applyInArrow(_repeated(buckets), P.SCHEMA), "suffix-last"))

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    cut = dealt.groupBy("source").cogroup(told.groupBy("source")).applyInArrow(_cut(depth, buckets), f"doc_id {doc_type}, {SCHEMA}")
    nothing, all_ = F.array().cast("array<struct<begin:bigint,end:bigint>>"), F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    short = rows.filter(F.col("n_bytes") < depth).select(
        "doc_id", "n_bytes", nothing.alias("spans"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"))
    copies = texts.filter("n > 1").select("h0", "h1", "n")
    whole = _with_copies(long_.drop("text"), copies).select("doc_id", "n_bytes", all_.alias("spans"), F.lit(b"").alias("kept"))
    return cut.unionByName(short).unionByName(whole)

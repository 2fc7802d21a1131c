"""Sharding by size: best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that stays in one shard. Groups, largest first, enter the bin
with the tightest remaining capacity that still holds them; a balanced tree keeps the bins by
remaining capacity, so each step takes logarithmic time.

At scale the packing has two levels. Each task packs its share of the groups into bundles of a
fixed capacity (``1 / BUNDLES`` of a shard), then the bundles, whose number depends on the number
of shards and tasks and not on the rows, are packed into shards of the least capacity that fits.
A group above ``SPLIT_ABOVE`` of a shard would make equal shards impossible; its rows are
dealt into ``CELLS`` cells by a hash of ``doc_id``, and each cell is packed as a group.

Defined results: a null text has no bytes and the checksum 0, and is in one group with empty texts;
rows with the same ``doc_id`` and text are dealt to the same shard and get different slots; an empty
table gives an empty table; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm.store import store

ROW_BYTES = 8  # added to the bytes of each text
BUNDLES = 64  # bundles that make up one shard
CELLS = 64  # parts of a group that is too large for a shard
SPLIT_ABOVE = 1.25  # of the mean shard
SLOT_ROWS = 50_000  # rows that one task numbers


class Bins:
    """Bins by remaining capacity: a treap whose priorities come from the bin number."""

    def __init__(self):
        self.root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _priority(bin_: int) -> int:
        return (bin_ + 1) * 0x9E3779B97F4A7C15 % (1 << 64)

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low if high is None else high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high

    def add(self, room: int, bin_: int) -> None:
        low, high = self._split(self.root, (room, bin_))
        self.root = self._join(self._join(low, [(room, bin_), self._priority(bin_), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) with the least room that holds ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node, above = high, None
        while node[2] is not None:
            above, node = node, node[2]
        if above is None:
            high = node[3]
        else:
            above[2] = node[3]
        self.root = self._join(low, high)
        return node[0]


def best_fit_decreasing(sizes, capacity: int, most: int | None = None) -> np.ndarray | None:
    """Bin of each item; items above the capacity get a bin of their own. None: more than ``most`` bins."""
    sizes = np.asarray(sizes, np.int64)
    out, bins, used = np.empty(len(sizes), np.int64), Bins(), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        found = bins.take(size)
        if found is None:
            if most is not None and used == most:
                return None
            room, bin_, used = capacity, used, used + 1
        else:
            room, bin_ = found
        out[i] = bin_
        if room > size:
            bins.add(room - size, bin_)
    return out


def pack_evenly(sizes, shards: int) -> np.ndarray:
    """Bins 0 to ``shards - 1`` of the least capacity for which best-fit-decreasing needs no more bins."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64)
    low = max(int(sizes.max()), -(-int(sizes.sum()) // shards))
    high, best = 2 * low, None
    while (best := best_fit_decreasing(sizes, high, shards)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if (found := best_fit_decreasing(sizes, middle, shards)) is None:
            low = middle + 1
        else:
            high, best = middle, found
    return best


def shard_by_bytes(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (0, 1, ... without gaps within its shard)."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = store(docs.select(
        "doc_id", (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.md5(body).alias("group"), F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(CELLS)).cast("int").alias("cell"),
    ), "shard-rows")
    cells = store(rows.groupBy("group", "cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-cells")
    whole = cells.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    total, count = whole["bytes"] or 0, whole["n"] or 0
    capacity = max(1, -(-total // shards))
    bundle = max(1, capacity // BUNDLES)
    in_group = Window.partitionBy("group")  # at most CELLS rows each
    items = cells.withColumn("_all", F.sum("bytes").over(in_group)).withColumn(
        "item", F.when(F.col("_all") > SPLIT_ABOVE * capacity, F.col("cell")).otherwise(F.lit(-1))
    )

    def pack(batches):
        """One task: its items into bundles. Groups do not cross tasks, for the window dealt them whole."""
        table = pa.Table.from_batches(list(batches), schema=arrow)
        if not table.num_rows:
            return
        names, cell = table["group"].combine_chunks().dictionary_encode(), table["item"].to_numpy()
        key = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) * (CELLS + 1) + cell + 1
        _, first, item = np.unique(key, return_index=True, return_inverse=True)
        sizes = np.bincount(item, weights=table["bytes"].to_numpy()).astype(np.int64)
        order = np.lexsort((cell[first], table["group"].take(pa.array(first)).to_numpy(zero_copy_only=False)))  # not the order of arrival
        bins = np.empty(len(sizes), np.int64)
        bins[order] = best_fit_decreasing(sizes[order], bundle)
        from pyspark import TaskContext

        ids = bins[item] + (np.int64(TaskContext.get().partitionId()) << 32)
        yield pa.RecordBatch.from_arrays(
            [table["group"].combine_chunks(), table["cell"].combine_chunks(), table["bytes"].combine_chunks(), pa.array(ids)],
            names=["group", "cell", "bytes", "bundle"],
        )

    arrow = pa.schema([("group", pa.string()), ("cell", pa.int32()), ("item", pa.int32()), ("bytes", pa.int64())])
    packed = store(
        items.select("group", "cell", F.col("item").cast("int").alias("item"), "bytes").mapInArrow(pack, "group string, cell int, bytes long, bundle long"),
        "shard-bundles",
    )
    # At most about 2 * shards * BUNDLES bundles, and one more per task.
    bundles = sorted(((r["bytes"], r["bundle"]) for r in packed.groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()), reverse=True)
    bins = pack_evenly([b for b, _ in bundles], shards)
    placed = spark.createDataFrame([(b, int(s)) for (_, b), s in zip(bundles, bins)], "bundle long, shard int")
    cell_shard = packed.join(F.broadcast(placed), "bundle").select("group", "cell", "shard")
    return _with_slots(rows.join(cell_shard, ["group", "cell"]).drop("group", "cell"), count)


def _with_slots(rows: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0; one task numbers one part of a shard."""
    parts = max(1, count // SLOT_ROWS)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)), F.lit(parts)))
    rows = store(rows, "shard-placed")
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_part").orderBy("doc_id", "size", "text_crc32")
    return rows.withColumn("_row", F.row_number().over(inside) - 1).join(starts, ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") + F.col("_start")).cast("long").alias("slot"))

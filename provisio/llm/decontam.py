"""Benchmark decontamination with SimHash windows.

A benchmark item of n words is compared with windows of n words of every document. The similarity of
a window and an item is the weighted Jaccard similarity of their 5-word shingles (as multisets;
rare shingles of the benchmark weigh more). Windows are found by fingerprints:

1. Only windows that share a shingle with an item of their length can be similar to it, so windows are
   laid around shared shingles (a lookup in the items' shingles). Nothing else is skipped.
2. Each such window gets a 64-bit SimHash of its weighted shingles, from running sums.
3. The items' fingerprints are cut into ``RADIUS + 1`` blocks and indexed block by block; two
   fingerprints within the radius agree in a block, so the lookup finds all of them.
4. Candidates are verified by the exact weighted similarity.

Items are dealt into sets of bounded size (``ITEM_BYTES`` of text); each set is broadcast and the
documents are read once per set, without a shuffle. Weights are of the whole benchmark in each set: the
shingles that several items hold, and in how many, go with every set; any other shingle weighs the most. The SimHash distance of windows at the
threshold is about 10 bits, with a deviation of 3; radius 15 then finds some 97 in 100 of them,
and practically all at 0.9 and above.

Defined results: words are compared with A-Z lower-cased; null and empty texts have no windows; an
item with fewer words than a shingle, or a null text, matches nothing; equal items match each on its
own; repeated documents give repeated rows; empty tables give an empty result; only ``doc_id``, ``text``
and ``item_id``, ``text`` are read, and :func:`remove` passes all columns of the documents through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import discard, store, tidy, write

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
ITEM_BYTES = 8 << 20
SCALE = 1 << 10  # weights are whole numbers, so sums in any order are equal


def _bits(values: np.ndarray) -> np.ndarray:
    """64 signs (+1 or -1) per value."""
    return np.unpackbits(W.mix(values).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).reshape(-1)


class Items:
    """One set of benchmark items: shingles, weights and the block index of their fingerprints.

    ``shared`` has the number of items of the whole benchmark, its shingles that several items hold, in order, and
    in how many; without it, this set is the whole benchmark. All other shingles weigh as rare ones.
    """

    def __init__(self, ids: list, texts: list, shingle: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY,
                 shared: tuple[int, np.ndarray, np.ndarray] | None = None):
        self.k, self.radius, self.similarity = shingle, radius, similarity
        kept, found = [], []
        for w in W.split(pa.array(texts, pa.string()), lower=True):
            hashes = w.hashes()
            for row, (a, b) in enumerate(zip(w.first, w.first[1:])):
                if b - a >= shingle:
                    kept.append(ids[w.lo + row])
                    found.append(W.windows(hashes[a:b], np.array([0, b - a]), shingle)[0])
        self.ids, self.shingles = kept, found
        self.n_words = np.array([len(x) + shingle - 1 for x in found], np.int64)
        values, df = np.unique(np.concatenate([np.unique(x) for x in found]), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.values = values
        n_items, self.common, n = shared or (len(found), values[df > 1], df[df > 1])
        self.rare = int(SCALE * (1 + math.log(max(n_items, 1))))
        self.weights = (SCALE * (1 + np.log(n_items / n))).astype(np.int64)
        #: lengths of the items that hold each shingle
        pairs = np.unique(np.array([(np.searchsorted(values, v), n) for x, n in zip(found, self.n_words) for v in np.unique(x)], np.int64).reshape(-1, 2), axis=0)
        self.first, self.lengths = np.searchsorted(pairs[:, 0], np.arange(len(values) + 1)), pairs[:, 1]
        self.prints = np.array([_pack((_bits(x) * self.weigh(x)[:, None]).sum(axis=0)[None])[0] for x in found], np.uint64)
        self.blocks = [(int(e[0]), len(e)) for e in np.array_split(np.arange(64), radius + 1)]
        self.by_length = {}
        for n in np.unique(self.n_words):
            which = np.flatnonzero(self.n_words == n)
            index = []
            for at, bits in self.blocks:
                block = self._block(self.prints[which], at, bits)
                order = np.argsort(block, kind="stable")
                index.append((block[order], which[order]))
            self.by_length[int(n)] = index

    @staticmethod
    def _block(prints: np.ndarray, at: int, bits: int) -> np.ndarray:
        return (prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)

    def weigh(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(shingles), self.rare, np.int64)
        at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
        return np.where(self.common[at] == shingles, self.weights[at], self.rare)

    def within_radius(self, prints: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of fingerprints at most ``radius`` bits apart."""
        out = []
        for (at, bits), (block, which) in zip(self.blocks, self.by_length[n_words]):
            own = self._block(prints, at, bits)
            low, high = np.searchsorted(block, own, side="left"), np.searchsorted(block, own, side="right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            item = which[np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))]
            near = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
            out.append(np.stack([window[near], item[near]], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def similar(self, shingles: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of two multisets of shingles."""
        values, place = np.unique(np.concatenate([shingles, self.shingles[item]]), return_inverse=True)
        a = np.bincount(place[: len(shingles)], minlength=len(values))
        b = np.bincount(place[len(shingles) :], minlength=len(values))
        weight = self.weigh(values)
        return float((np.minimum(a, b) * weight).sum()) / float((np.maximum(a, b) * weight).sum())

    def matches(self, texts) -> list[tuple[int, int, int, float]]:
        """(row, item, first word, similarity) of the best window per text and item."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        if not self.ids:
            return []
        for w in W.split(texts, lower=True):
            value, at = W.windows(w.hashes(), w.first, self.k)
            place = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
            hit = np.flatnonzero(self.values[place] == value)
            if not len(hit):
                continue
            # Every window of an item's length that holds the shared shingle.
            count = self.first[place[hit] + 1] - self.first[place[hit]]
            near = np.repeat(at[hit], count)
            begin = np.repeat(self.first[place[hit]] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            length = self.lengths[begin + np.arange(len(near))]
            lengths = np.unique(np.stack([length, near], axis=1), axis=0)
            row_of = np.searchsorted(w.first, np.arange(len(w.start)), side="right") - 1
            shingle_at = np.full(len(w.start) + 1, -1)
            shingle_at[at] = np.arange(len(at))
            for n in np.unique(lengths[:, 0]):
                spans = lengths[lengths[:, 0] == n, 1]
                starts = np.unique((spans[:, None] - np.arange(n - self.k + 1)[None, :]).reshape(-1))
                starts = starts[starts >= 0]
                starts = starts[starts + n <= w.first[row_of[starts] + 1]]
                held = np.zeros(len(w.start) + 1, np.int64)  # words covered by any window: their shingles are summed
                np.add.at(held, starts, 1)
                np.add.at(held, starts + n - self.k + 1, -1)
                used = np.flatnonzero(np.cumsum(held) > 0)
                own = value[shingle_at[used]]
                sums = np.zeros((len(used) + 1, 64), np.int64)
                np.cumsum(_bits(own) * self.weigh(own)[:, None], axis=0, out=sums[1:])
                first = np.searchsorted(used, starts)
                prints = _pack(sums[first + n - self.k + 1] - sums[first])
                for i, item in zip(*self.within_radius(prints, int(n))):
                    found = self.similar(own[first[i] : first[i] + n - self.k + 1], int(item))
                    if found >= self.similarity:
                        key, new = (w.lo + int(row_of[starts[i]]), int(item)), (found, -int(starts[i] - w.first[row_of[starts[i]]]))
                        best[key] = max(best.get(key, (0.0, 0)), new)
        return [(row, item, -start, sim) for (row, item), (sim, start) in sorted(best.items())]


def shared_shingles(rows: DataFrame, shingle: int = SHINGLE) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of items with a shingle, the shingles that several of them hold, in order, and in how many."""

    def run(batches):
        for batch in batches:
            for w in W.split(batch.column(0), lower=True):
                hashes = w.hashes()
                for a, b in zip(w.first, w.first[1:]):
                    if b - a >= shingle:
                        own = np.unique(W.windows(hashes[a:b], np.array([0, b - a]), shingle)[0]).view(np.int64)
                        # The row without a shingle counts the item.
                        yield pa.RecordBatch.from_arrays([pa.array([None, *own.tolist()], pa.int64())], names=["value"])

    counted = rows.select("text").mapInArrow(tidy(run), "value long").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    found = counted.filter("value is null or n > 1").toArrow()
    value, n = found["value"], found["n"].to_numpy()
    null = value.is_null().to_numpy()
    values = value.filter(pc.is_valid(value)).to_numpy().view(np.uint64)
    order = np.argsort(values)
    return int(n[null].sum()), values[order], n[~null][order]


def item_sets(benchmark: DataFrame, most: int = ITEM_BYTES, **settings) -> Iterator[tuple[Items, bool]]:
    """The benchmark in sets of about ``most`` bytes, dealt by a hash of the item, and whether it is the last set."""
    rows = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    n_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    sets = max(1, math.ceil(n_bytes / most))
    shared = shared_shingles(rows, settings.get("shingle", SHINGLE))
    for number in range(sets):  # bounded pieces of the stated query set, one after the other
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(sets)) == number).orderBy("item_id", "text").collect()
        yield Items([r["item_id"] for r in part], [r["text"] for r in part], shared=shared, **settings), number == sets - 1


def leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document and benchmark item in it: doc_id, item_id, first_word, n_words, similarity."""
    context = docs.sparkSession.sparkContext
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, first_word long, n_words long, similarity double"
    out = None
    for items, last in item_sets(benchmark, **settings):
        shared = context.broadcast(items)

        def run(batches, shared=shared):
            for batch in batches:
                found = shared.value.matches(batch.column(1))
                if found:
                    rows, which, start, similarity = zip(*found)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows)), pa.array([shared.value.ids[i] for i in which]),
                        pa.array(start, pa.int64()), pa.array([int(shared.value.n_words[i]) for i in which]), pa.array(similarity),
                    ], names=["doc_id", "item_id", "first_word", "n_words", "similarity"])

        part = docs.select("doc_id", "text").mapInArrow(tidy(run), schema)
        if not last:  # one set at a time lies in memory
            part = store(part, "leaks")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def remove(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without any benchmark item in them, with all their columns."""
    context, before = docs.sparkSession.sparkContext, None
    text = docs.columns.index("text")
    for items, last in item_sets(benchmark, **settings):
        shared = context.broadcast(items)

        def run(batches, shared=shared):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in shared.value.matches(batch.column(text))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(tidy(run), docs.schema)
        if not last:  # one set at a time lies in memory, and what the set before left goes
            path = write(docs, "decontaminated")
            docs = docs.sparkSession.read.schema(docs.schema).parquet(path)
            shared.destroy()
            if before is not None:
                discard(docs.sparkSession, before)
            before = path
    return docs

"""N-gram Jaccard join by universe partition and pigeonhole.

A document is the set of its distinct word shingles. Sets of sizes a and b with a Jaccard similarity of
at least t differ in at most ``H = (1 - t) / (1 + t) * (a + b)`` elements. Sizes fall into bands; the
scheme of a band (for pairs whose smaller set is in it) hashes the universe into m segments, of which q
also have a one-deletion neighbourhood. Sets that differ in k elements agree in a segment, or differ by one
element in a segment with neighbourhood, if ``m + q > k`` (pigeonhole). So each set is indexed under

* the subset of its elements in each segment, and
* for the q segments, each such subset without one element.

m and q are allocated per band by cost: the signatures of the band's documents against the candidates
that chance agreement would give, so large bands get larger segments with neighbourhoods.

Empty subsets agree for free. A set leaves out its empty signatures when the segments that can
agree by emptiness are too few to be the only ones that agree (``m + q`` minus their worth is still
above its largest possible difference), which loses no pair; a few spare segments make that the rule.

Sets that are equal are one class, represented by the smallest ``doc_id``. Within the documents that
share a signature (of equal sets only one signs), all are compared with one of them; the verified links give components; only documents
that share a signature and are still in different components are then compared with each other, in
blocks that report links and no pairs. Components are exact. A group of copies or close copies costs
comparisons linear in its size; only documents that nearly reach the similarity and do not join are
all compared. All verification is by exact intersection of the sets.

Defined results: A-Z is lower-cased; a text without words is an empty set, linked with nothing;
a text with fewer words than a shingle is one shingle; rows with the same ``doc_id`` are one
node, linked with whatever any of them is linked with; a null ``doc_id`` is linked with nothing and has no
component; an empty table gives an empty table; only ``doc_id`` (a whole number) and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from provisio.llm import packed as P
from provisio.llm import words as W
from provisio.llm.graph import components
from provisio.llm.store import free_names, store, tidy

SHINGLE = 5
PERCENT = 80
BAND = 1.25  # ratio of the sizes in one band
COMMON = 1e-4  # assumed chance that two elements of unrelated documents are equal
BLOCK = 2048  # sets that are compared in one task
COMPARE = 50.0  # cost of a comparison in signatures
RECORD = np.dtype([("sig", "<u4"), ("n", "<u4"), ("doc", "<i8")])
FULL = np.uint32(1)


def most_different(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of sets of these sizes that are similar enough."""
    return (100 - percent) * (a + b) // (100 + percent)


@dataclass(frozen=True)
class Scheme:
    number: int
    low: int  # sizes of the smaller set
    high: int
    reach: int  # largest size of the larger set
    segments: int
    deletions: int  # of them with a one-deletion neighbourhood

    @property
    def worth(self) -> int:
        return self.segments + self.deletions


def allocate(number: int, low: int, high: int, percent: int, documents: float) -> Scheme:
    """Segments and neighbourhoods of a band by cost, given how many documents it holds."""
    reach = 100 * high // percent
    k = most_different(high, reach, percent)
    mean, best = (low + high) / 2, None
    for spare in (0, 1, 2, 3, 4, 6, 8):
        total = k + 1 + spare
        for q in sorted({0, *(total * i // 16 for i in range(9))}):
            m = total - q
            if q > m:
                continue
            size = mean / m
            empty = math.exp(-size)
            weak = (m - q) * empty + q * 2 * empty * (1 + size)
            # Chance that a set must keep its empty signatures: Poisson tail.
            kept = 1 - sum(math.exp(-weak) * weak**i / math.factorial(i) for i in range(spare + 1)) if k else 0.0
            by_chance = empty**2 * COMMON * ((m - q) * size**2 + q * (size**2 + size**3)) + max(kept, 0.0) ** 2 * (m * empty**2 + q * empty**2 * 2 * size)
            cost = documents * ((m - q) + q * (size + 2)) + COMPARE * documents**2 / 2 * by_chance
            if best is None or cost < best[0]:
                best = (cost, m, q)
    return Scheme(number, low, high, reach, best[1], best[2])


def schemes(sizes: dict[int, float], percent: int) -> list[Scheme]:
    """Schemes of all bands up to the largest size; ``sizes``: about how many sets have a size near the key."""
    out, low, top = [], 1, max(sizes, default=0)
    while low <= top:
        high = max(low, math.ceil(low * BAND) - 1)
        documents = sum(n for size, n in sizes.items() if low <= size <= 100 * high // percent)
        out.append(allocate(len(out), low, high, percent, max(documents, 1.0)))
        low = high + 1
    return out


def sets_of(texts, shingle: int):
    """Blocks of (first row, sorted distinct shingles end to end, first index per row)."""
    for w in W.split(texts, lower=True):
        value, row = W.shingles(w.hashes(), w.first, shingle)
        yield (w.lo, *W.distinct_sets(value, row, w.hi - w.lo))


def _digests(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the scrambled elements of each set."""
    out = []
    for lane in (1, 2):
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(W.mix(value + W.U(lane * 0x51ED27)), out=total[1:])
        out.append(W.mix(total[first[1:]] - total[first[:-1]]))
    return out[0], out[1]


def measure(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``n`` (set size) and the digest of the set, per row."""

    def run(batches):
        for batch in batches:
            n, a, b = [], [], []
            for _, value, first in sets_of(batch.column(1), shingle):
                n.append(np.diff(first))
                one, two = _digests(value, first)
                a.append(one.view(np.int64))
                b.append(two.view(np.int64))
            if n:
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.concatenate(x).astype(np.int64)) for x in (n, a, b)]], names=["doc_id", "n", "d0", "d1"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id bigint, n bigint, d0 bigint, d1 bigint")


def signatures(value: np.ndarray, first: np.ndarray, plan: list[Scheme], percent: int):
    """(64-bit signature, is a whole subset, row) of all sets."""
    size = np.diff(first)
    out = []
    for s in plan:
        rows = np.flatnonzero((size >= s.low) & (size <= s.reach))
        if not len(rows):
            continue
        count = size[rows]
        which = np.repeat(np.arange(len(rows)), count)
        element = value[np.repeat(first[rows] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))]
        scrambled = W.mix(element + W.U((s.number + 1) * 0x632BE59BD9B4E019 % (1 << 64)))
        segment = ((scrambled >> W.U(32)) * W.U(s.segments) >> W.U(32)).astype(np.int64)
        place = which * s.segments + segment
        order = np.argsort(place, kind="stable")
        place, scrambled = place[order], scrambled[order]
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        held = np.diff(np.append(begin, len(place)))
        total, spot = np.add.reduceat(scrambled, begin), place[begin]
        tag = W.mix(W.U(s.number << 32) + np.arange(s.segments, dtype=np.uint64) + W.U(1))
        out.append((W.mix(total ^ tag[spot % s.segments]), np.ones(len(spot), bool), rows[spot // s.segments]))
        # Without one element, where more than one is left.
        near = np.repeat((spot % s.segments < s.deletions) & (held > 1), held)
        if near.any():
            whole = np.repeat(total, held)[near] - scrambled[near]
            out.append((W.mix(whole ^ tag[place[near] % s.segments]), np.zeros(int(near.sum()), bool), rows[place[near] // s.segments]))
        # Empty signatures, only of sets whose other segments cannot all differ.
        n_held = np.zeros(len(rows) * s.segments, np.int64)
        n_held[spot] = held
        n_held = n_held.reshape(len(rows), s.segments)
        deletes = np.arange(s.segments) < s.deletions
        weak = np.where(deletes, n_held <= 1, n_held == 0)
        worth = (weak * (1 + deletes)).sum(axis=1)
        partner = np.minimum(100 * count // percent, s.reach)
        most = (100 - percent) * (count + partner) // (100 + percent)
        for i in np.flatnonzero(s.worth - worth <= most):
            at = np.flatnonzero(weak[i])
            out.append((W.mix(tag[at]), n_held[i, at] == 0, np.full(len(at), rows[i])))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _without_copies(value: np.ndarray, first: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets with those emptied that equal a set with a smaller id in the same batch."""
    one, two = _digests(value, first)
    size = np.diff(first)
    order = np.lexsort((ids, two, one, size))
    copy = np.zeros(len(ids), bool)
    copy[order[1:]] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1]) & (size[order][1:] == size[order][:-1])
    keep = np.repeat(~copy, size)
    return value[keep], np.concatenate([[0], np.cumsum(np.where(copy, 0, size))])


def _emit(plan: list[Scheme], shingle: int, percent: int, buckets: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held, rows = [], 0
            for lo, value, first in sets_of(batch.column(1), shingle):
                value, first = _without_copies(value, first, ids[lo : lo + len(first) - 1])
                sig, whole, row = signatures(value, first, plan, percent)
                one = np.zeros(len(sig), RECORD)
                one["sig"] = (sig & W.U(0x7FFFFFFF)).astype(np.uint32) << np.uint32(1) | whole.astype(np.uint32)
                one["n"], one["doc"] = np.diff(first)[row], ids[lo + row]
                held.append((P.bucket_of(sig, buckets), one))
                rows += len(one)
                if rows > 1 << 20:
                    yield from _packed(held)
                    held, rows = [], 0
            yield from _packed(held)

    return run


def _packed(held: list):
    if held:
        bucket, records = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(bucket, kind="stable")
        yield from P.pack(0, bucket[order], records[order]).to_batches()


FOUND = "kind int, a bigint, b bigint, data binary"
MEMBER = np.dtype([("doc", "<i8")])
PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])


def _fits(n: np.ndarray, other, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, other).astype(np.int64) >= percent * np.maximum(n, other).astype(np.int64)


def _candidates(percent: int, folds: int):
    def run(table):
        """Per bucket, packed by the bucket that folds them: pairs with one member of each group, and groups of more.

        A family turns up under many signatures, so in ever more buckets as the data grows; only folded over
        all of them are its pairs and lists counted once.
        """
        source = int(table.column("bucket")[0].as_py())
        records, _ = P.unpack(table, RECORD)
        sig = records["sig"] >> np.uint32(1)
        order = np.lexsort((records["sig"] & FULL ^ FULL, records["doc"], sig))
        records, sig = records[order], sig[order]
        same = np.zeros(len(sig), bool)  # a second record of a document in a group, whole ones come first
        same[1:] = (sig[1:] == sig[:-1]) & (records["doc"][1:] == records["doc"][:-1])
        records, sig = records[~same], sig[~same]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(sig))
        pairs, groups, seen = [np.zeros((0, 2), np.int64)], {}, set()
        whole = np.concatenate([[0], np.cumsum(records["sig"] & FULL)])
        for a, b in zip(first[ends - first > 1], ends[ends - first > 1]):
            if whole[b] == whole[a]:
                continue  # deletions alone: two elements apart
            own = records[a:b]
            full = own["sig"] & FULL
            key = hash((own["doc"].tobytes(), full.tobytes()))
            if key in seen:
                continue
            seen.add(key)
            p = int(np.flatnonzero(full)[0])  # the smallest id with the whole subset
            others = np.flatnonzero(_fits(own["n"], own["n"][p], percent) & (own["doc"] != own["doc"][p]))
            pairs.append(np.sort(np.stack([np.full(len(others), own["doc"][p]), own["doc"][others]], axis=1), axis=1))
            if b - a > 2:
                data = np.ascontiguousarray(own["doc"]).tobytes()
                groups[_name(data)] = data
        found = np.unique(np.concatenate(pairs), axis=0)
        low, high = (np.ascontiguousarray(found[:, i]).view(np.uint64) for i in range(2))
        place = (W.mix(low * W.U(3) + high) % W.U(folds)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        packed = np.zeros(len(found), PAIR)
        packed["a"], packed["b"] = found[order, 0], found[order, 1]
        names = np.array(sorted(groups, key=lambda g: g % folds), np.int64)
        dealt = names % folds
        # Lists lie end to end, each behind its length.
        lists = [np.frombuffer(np.int64(len(groups[g]) // 8).tobytes() + groups[g], "<i8") for g in names.tolist()]
        tables = [P.pack(source, place[order], packed)]
        for fold in np.unique(dealt).tolist():
            own = np.concatenate([x for x, d in zip(lists, dealt) if d == fold])
            tables.append(P.pack(source, np.full(len(own), folds + fold), own))
        return pa.concat_tables(tables)

    return run


def _folded(folds: int):
    def run(table):
        """Per folding bucket: each pair once (kind 0), or each list of members once (kind 1)."""
        if table.column("bucket")[0].as_py() < folds:
            pairs = np.unique(P.unpack(table, PAIR)[0])
            none = pa.nulls(len(pairs), pa.binary())
            return pa.table([pa.array(np.zeros(len(pairs), np.int32)), pa.array(pairs["a"]), pa.array(pairs["b"]), none], names=["kind", "a", "b", "data"])
        groups = {}
        for message in table.column("data"):
            data, at = message.as_buffer(), 0
            numbers = np.frombuffer(data, "<i8")
            while at < len(numbers):
                members = numbers[at + 1 : at + 1 + numbers[at]].tobytes()
                groups[_name(members)] = members
                at += 1 + int(numbers[at])
        return pa.table([
            pa.array(np.ones(len(groups), np.int32)), pa.array(list(groups), pa.int64()), pa.array(np.zeros(len(groups), np.int64)),
            pa.array(list(groups.values()), pa.binary())], names=["kind", "a", "b", "data"])

    return run


def _name(data: bytes) -> int:
    """Number of a group that is the same wherever the group turns up."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact intersection."""

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("y"))
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a bigint, b bigint").distinct()


def _verified_in_slices(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs verified, a slice after the other, so that the sets that travel with them stay a bounded
    share of all sets: the disk for shuffles does not follow the number of candidates."""
    slices = max(1, math.ceil(pairs.count() / (2 * max(sets.count(), 1))))
    links = None
    for number in range(slices):
        own = pairs.filter(F.pmod(F.xxhash64("a", "b", F.lit(7)), F.lit(slices)) == number)
        part = store(verified(own, sets, percent), "sets-links", rows=512)
        links = part if links is None else links.unionByName(part)
    return links


def _sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for _, value, first in sets_of(batch.column(1), shingle):
                out += [value[a:b].tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "elements"])

    chosen = docs.join(ids.hint("merge"), "doc_id", "left_semi")  # the same plan at every size
    return chosen.mapInArrow(tidy(run), "doc_id bigint, elements binary").filter(F.octet_length("elements") > 0)


def _joining_links(doc: np.ndarray, part: np.ndarray, block: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the components of these documents, by exact intersections of their sets.

    Each document asks the postings of its elements how much it has in common with all others at
    once, so no pair is written down; those of the largest component need not ask. With two
    blocks, only documents of different blocks are compared. A link that joins nothing new is left out.
    """
    size = np.array([len(x) for x in sets])
    element, holder = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(element, kind="stable")
    element, holder = element[order], holder[order]
    begin = np.flatnonzero(np.concatenate([[True], element[1:] != element[:-1]]))
    end, values = np.append(begin[1:], len(element)), element[begin]
    two = block.min() != block.max()
    names, part = np.unique(part, return_inverse=True)
    asks = np.flatnonzero(part != np.bincount(part).argmax())
    found = []
    for i in asks:
        other = part != part[i]
        if two:
            other &= block != block[i]
        if not other.any():
            continue
        at = np.searchsorted(values, sets[i])
        count = end[at] - begin[at]
        place = np.repeat(begin[at] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
        common = np.bincount(holder[place], minlength=len(sets))
        for j in np.flatnonzero(other & (100 * common >= percent * (size + size[i] - common))):
            if part[j] != part[i]:
                found.append((int(doc[i]), int(doc[j])))
                part[part == part[j]] = part[i]
    return found


def _join_apart(percent: int):
    def run(table):
        """Columns home, i, j (the unit of work), doc, component, block, elements."""
        unit = [table.column(c).to_numpy() for c in ("home", "i", "j")]
        doc, part, block = (table.column(c).to_numpy() for c in ("doc", "component", "block"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("elements")]
        order = np.lexsort((doc, *unit))
        new = np.concatenate([[True], np.any([u[order][1:] != u[order][:-1] for u in unit], axis=0)])
        found = []
        for which in np.split(order, np.flatnonzero(new)[1:]):
            found += _joining_links(doc[which], part[which], block[which], [sets[i] for i in which], percent)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _members(batches):
    """Members of groups, one row each."""
    for batch in batches:
        own = [np.frombuffer(x.as_buffer(), MEMBER) for x in batch.column(1)]
        if own:
            key = np.repeat(batch.column(0).to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate(own)["doc"])], names=["key", "doc"])


def _late_links(known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one group that the first round left in different components.

    Groups with the same smallest component are one unit of work (the signatures of one family
    of near copies have much the same members). A unit beyond ``BLOCK`` members is dealt into blocks, and
    each pair of blocks is a unit of its own.
    """
    homes = known.groupBy("key").agg(F.min("component").alias("home"), F.max("component").alias("high")).filter("home < high").drop("high")
    members = store(known.join(homes, "key").select("home", "doc", "component").distinct(), "sets-apart")
    blocks = members.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = members.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "home", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc", "component", "block")
    n_bytes = (sets.agg(F.sum(F.octet_length("elements")).alias("n")).first()["n"] or 0) * 2
    bucket = F.pmod(F.xxhash64("home", "i", "j"), F.lit(P.bucket_count(sets, n_bytes))).cast("int")
    full = dealt.join(sets.withColumnRenamed("doc_id", "doc").hint("merge"), "doc").withColumn("bucket", bucket)
    return store(full.groupBy("bucket").applyInArrow(_join_apart(percent), "a bigint, b bigint"), "sets-late-links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id."""
    spark = docs.sparkSession
    measured = store(measure(docs, shingle), "sets-measured")
    real = measured.filter("doc_id is not null and n > 0")
    classes = store(real.groupBy("n", "d0", "d1").agg(F.min("doc_id").alias("class_id")), "sets-classes")
    cells = classes.groupBy(F.floor(F.log("n") * 20).alias("cell")).agg(F.count(F.lit(1)).alias("documents"), F.max("n").alias("n"), F.sum("n").alias("elements")).collect()
    plan = schemes({r["n"]: r["documents"] for r in cells}, percent)
    size = sum(r["elements"] for r in cells)
    buckets = P.bucket_count(docs, size * 0.4 * RECORD.itemsize)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null")
    # Equal sets sign once in the whole table.
    signing = texts.join(classes.select(F.col("class_id").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    packed = signing.mapInArrow(tidy(_emit(plan, shingle, percent, buckets)), P.SCHEMA)
    folds = P.bucket_count(docs, size * 0.05 * RECORD.itemsize)
    met = packed.groupBy("bucket").applyInArrow(_candidates(percent, folds), P.SCHEMA)
    found = store(met.groupBy("bucket").applyInArrow(_folded(folds), FOUND), "sets-candidates")
    pairs = found.filter("kind = 0").select("a", "b")
    groups = found.filter("kind = 1").select(F.col("a").alias("key"), "data")
    members = store(groups.mapInArrow(tidy(_members), "key bigint, doc bigint"), "sets-groups")
    needed = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(
        members.select(F.col("doc").alias("doc_id"))).distinct()
    sets = store(_sets(texts, needed, shingle), "sets")
    links = _verified_in_slices(pairs, sets, percent)
    parts = store(components(links), "sets-parts")

    known = members.join(parts.withColumnRenamed("node", "doc"), "doc", "left")
    known = store(known.select("key", "doc", F.coalesce("component", "doc").alias("component")), "sets-members")
    late = _late_links(known, sets, percent)
    if not late.isEmpty():
        parts = store(components(links.unionByName(late)), "sets-parts")

    # Rows with one doc_id are one node although their sets may be in several classes.
    member = real.join(classes, ["n", "d0", "d1"]).select("doc_id", "class_id")
    split = member.groupBy("doc_id").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).filter("low < high").select("doc_id")
    if not split.isEmpty():
        bound = member.join(split, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
        links = parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(bound)
        parts = store(components(links), "sets-parts")
    named = classes.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "n", "d0", "d1", "class_id", F.coalesce("component", "class_id").alias("component"))
    joined = measured.join(named, ["n", "d0", "d1"], "left")
    has_id = F.col("doc_id").isNotNull()
    return joined.select(
        F.col("doc_id"), F.col("n").alias("n_shingles"), F.when(has_id, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(has_id, F.coalesce("component", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per component, that of the smallest ``doc_id``, with all its columns.

    Of rows with the same ``doc_id`` the one with the smallest text stays (null first; then by the other
    columns of simple type); documents without words stay; rows without id all stay.
    """
    found = near_duplicates(docs, shingle, percent)
    doc, row = free_names(docs, "__doc", "__row")
    stay = found.filter("doc_id = component_id").select(F.col("doc_id").alias(doc)).distinct()
    kept = docs.join(stay, F.col("doc_id").cast("bigint") == F.col(doc), "left_semi")
    simple = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id").orderBy("text", *simple)
    kept = kept.withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1).drop(row)
    return kept.unionByName(docs.filter("doc_id is null"))

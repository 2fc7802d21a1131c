"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. Turns are numbered inside their conversation by a range sort over all turns; the number of a turn in its
   partition is raised by what earlier partitions hold of the same conversation (at most one per partition).
2. Conversations are rebuilt: the first ``h`` turns of the head conversation ``c - c % 5``, then their own later ones.
3. The key of a prefix is the exclusive-or of 128-bit hashes of (position, turn), so it comes from running
   totals in chunks of ``CHUNK`` turns, and the key of the parent is one exclusive-or away. Nodes are the groups of equal keys.
4. Contraction, in rounds of joins over the nodes that are left. *Rake*: all leaves go, and their totals go to
   their parents. *Compress*: of nodes with a single child left, those with a smaller random number than parent
   and child are spliced out, so about a third of each unary chain goes in one round, and no two neighbours. What a
   spliced node held travels with the edge of its child. The rounds grow with the logarithm of the number of
   nodes, also for one chain of all turns.
5. Re-expansion: a spliced node has the total of its child plus what it held. Chains of such references are
   halved by joining them with themselves, then looked up among the raked nodes.

No group is gathered in one task: turns of one conversation are dealt by range and by chunk, members of a node
are counted before the shuffle, the ids that end at a node are joined to pieces of ``PIECE`` ids, which are then
hashed in order, and children of a hot parent look it up in a table of bounded size.

Defined results: turns without a number come first; turns with one number are in the order of the MD5 of
``<bytes of the role>:<role><text>``; null role or text is empty; rows with a null ``conv_id`` belong to no conversation; equal
rows are turns of their own; a conversation without turns after rebuilding is a member of the root only; an
empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm.store import store

FAMILY = 5  # conversations c - c % 5 and on share their first turns
HEADS = 9  # the number of shared turns is below this
CHUNK = 4096  # turns of one conversation in one task
PIECE = 4096  # ids in one piece of text that is hashed
ROOT = (0, 0)


def _local(batches):
    """Number of each turn among those of its conversation in this sorted partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        at = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv))))
        if conv[0] == last:
            at[: first[1] if len(first) > 1 else len(conv)] += seen
        last, seen = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(at), batch.column(1), batch.column(2), pa.array(np.full(len(conv), part, np.int32))],
            names=["conv_id", "i", "digest", "n_bytes", "part"])


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``i`` (from 0, by turn), ``digest`` of role and text, ``n_bytes`` of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"))  # tells equal rows apart, so that a range can split them
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "row"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "n_bytes")
    local = store(ranged.mapInArrow(_local, "conv_id bigint, i bigint, digest binary, n_bytes bigint, part int"), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row at most for each partition: the conversation that an earlier one began.
    begun = pieces.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).filter("before > 0")
    return local.join(F.broadcast(begun), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("i") + F.coalesce("before", F.lit(0))).alias("i"), "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, pos, digest, n_bytes, is_last), and conversations (conv_id, total)."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.select("conv_id", "n", shared.alias("h"), base.alias("base")).join(heads, "base", "left")
    m = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = store(convs.select("conv_id", "n", "base", "h", m.alias("m"), (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "trie-conversations")
    first = turns.filter(F.col("i") < HEADS - 1).withColumnRenamed("conv_id", "base")
    head = convs.select("conv_id", "base", "h", "total").join(first, "base").filter("i < h").select("conv_id", F.col("i").alias("pos"), "digest", "n_bytes", "total")
    chunks = convs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    own = turns.withColumn("chunk", F.floor(F.col("i") / CHUNK)).join(chunks.select("conv_id", "chunk", "h", "m", "total"), ["conv_id", "chunk"])
    tail = own.filter("i >= h").select("conv_id", (F.col("i") - F.col("h") + F.col("m")).alias("pos"), "digest", "n_bytes", "total")
    both = head.unionByName(tail)
    return both.select("conv_id", "pos", "digest", "n_bytes", (F.col("pos") + 1 == F.col("total")).alias("is_last")), convs.select("conv_id", "total")


def prefixes(turns: DataFrame) -> DataFrame:
    """Key (k0, k1) of each prefix of each conversation, and that of its parent (p0, p1)."""
    hashed = turns.withColumn("h0", F.xxhash64("digest", "pos")).withColumn("h1", F.xxhash64("pos", "digest", F.lit(1)))
    hashed = hashed.withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1"))
    starts = sums.select("conv_id", "chunk", F.bit_xor("h0").over(earlier).alias("s0"), F.bit_xor("h1").over(earlier).alias("s1")).filter("chunk > 0")
    running = hashed.withColumn("k0", F.bit_xor("h0").over(inside)).withColumn("k1", F.bit_xor("h1").over(inside))
    keyed = running.join(starts, ["conv_id", "chunk"], "left")
    for lane in "01":
        keyed = keyed.withColumn(f"k{lane}", F.col(f"k{lane}").bitwiseXOR(F.coalesce(f"s{lane}", F.lit(0).cast("long"))))
    return keyed.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "k0", "k1", F.col("k0").bitwiseXOR(F.col("h0")).alias("p0"),
        F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), "n_bytes", "is_last")


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: key, parent's key, depth, smallest member, members, children, bytes of the last text."""
    found = paths.groupBy("k0", "k1", "p0", "p1", "depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n_bytes").alias("n_bytes"))
    no = F.lit(None).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        *[F.lit(x).cast("long").alias(c) for c, x in zip(("k0", "k1"), ROOT)], no.alias("p0"), no.alias("p1"), F.lit(0).cast("long").alias("depth"),
        "n_convs", "conv_id", F.lit(0).cast("long").alias("n_bytes"))
    found = found.unionByName(root)
    children = found.groupBy(F.col("p0").alias("k0"), F.col("p1").alias("k1")).agg(F.count(F.lit(1)).alias("n_children"))
    return found.join(children, ["k0", "k1"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def _random(round_: int, a: Column, b: Column) -> Column:
    return F.xxhash64(a, b, F.lit(round_))


def contract(nodes: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Sum of each value over the subtree of each node: ``k0``, ``k1`` and one column per value.

    ``nodes``: k0, k1, p0, p1 (null for the root), n_children. ``acc_`` columns hold what a node has gathered of its
    subtree, ``add_`` columns what goes to its parent besides (of spliced nodes between them).
    """
    names, zero = list(values), F.lit(0).cast("long")
    acc, add = [f"acc_{n}" for n in names], [f"add_{n}" for n in names]
    active = nodes.select(
        "k0", "k1", "p0", "p1", F.col("n_children").alias("left"), *[values[n].alias(a) for n, a in zip(names, acc)], *[zero.alias(a) for a in add])
    raked, spliced, round_ = [], [], 0
    while True:
        leaf = (F.col("left") == 0) & F.col("p0").isNotNull()
        raked.append(active.filter(leaf).select("k0", "k1", *[F.col(a).alias(n) for n, a in zip(names, acc)]))
        # Rake: leaves give their totals to the parent, which learns how many other children it has, and which if it is one.
        told = active.groupBy(F.col("p0").alias("k0"), F.col("p1").alias("k1")).agg(
            F.sum(F.when(~leaf, 1).otherwise(0)).alias("others"), F.bit_xor(F.when(~leaf, F.col("k0"))).alias("c0"), F.bit_xor(F.when(~leaf, F.col("k1"))).alias("c1"),
            *[F.coalesce(F.sum(F.when(leaf, F.col(a) + F.col(b))), zero).alias(f"got_{n}") for n, a, b in zip(names, acc, add)])
        rest = active.filter(~leaf).join(told, ["k0", "k1"], "left").select(
            "k0", "k1", "p0", "p1", F.coalesce("others", zero).alias("left"), "c0", "c1", *add,
            *[(F.col(a) + F.coalesce(f"got_{n}", zero)).alias(a) for n, a in zip(names, acc)])
        # Compress: a node with one child left goes if its number is below those of both neighbours.
        own = _random(round_, F.col("k0"), F.col("k1"))
        goes = (F.col("left") == 1) & F.col("p0").isNotNull() & (own < _random(round_, F.col("p0"), F.col("p1"))) & (own < _random(round_, F.col("c0"), F.col("c1")))
        rest = rest.withColumn("goes", F.coalesce(goes, F.lit(False)))
        gone = rest.filter("goes").select(
            F.col("c0").alias("k0"), F.col("c1").alias("k1"), F.col("k0").alias("v0"), F.col("k1").alias("v1"), F.col("p0").alias("q0"), F.col("p1").alias("q1"),
            *[F.col(a).alias(f"held_{n}") for n, a in zip(names, acc)], *[F.col(b).alias(f"more_{n}") for n, b in zip(names, add)])
        both = rest.join(gone, ["k0", "k1"], "left")
        has = F.col("v0").isNotNull()
        both = store(both.select(
            "k0", "k1", F.when(has, F.col("q0")).otherwise(F.col("p0")).alias("p0"), F.when(has, F.col("q1")).otherwise(F.col("p1")).alias("p1"),
            "left", "goes", "v0", "v1", *acc,
            *[(F.col(b) + F.coalesce(F.col(f"held_{n}") + F.col(f"more_{n}"), zero)).alias(b) for n, b in zip(names, add)],
            *[(F.col(b) + F.col(f"held_{n}")).alias(f"extra_{n}") for n, b in zip(names, add)]), "trie-round")
        spliced.append(both.filter("v0 is not null").select(
            F.col("v0").alias("k0"), F.col("v1").alias("k1"), F.col("k0").alias("c0"), F.col("k1").alias("c1"), *[F.col(f"extra_{n}").alias(n) for n in names]))
        active = both.filter("not goes").select("k0", "k1", "p0", "p1", "left", *acc, *add)
        round_ += 1
        if active.filter("p0 is not null").isEmpty():
            break
    raked.append(active.select("k0", "k1", *[F.col(a).alias(n) for n, a in zip(names, acc)]))  # the root
    totals, refers = _all(raked), _all(spliced)
    for _ in range(math.ceil(math.log2(round_)) if round_ > 1 else 0):
        ahead = refers.select(F.col("k0").alias("c0"), F.col("k1").alias("c1"), F.col("c0").alias("d0"), F.col("c1").alias("d1"), *[F.col(n).alias(f"far_{n}") for n in names])
        jumped = refers.join(ahead, ["c0", "c1"], "left").select(
            "k0", "k1", F.coalesce("d0", "c0").alias("c0"), F.coalesce("d1", "c1").alias("c1"), *[(F.col(n) + F.coalesce(f"far_{n}", zero)).alias(n) for n in names])
        refers = store(jumped, "trie-refers")
    ends = totals.select(F.col("k0").alias("c0"), F.col("k1").alias("c1"), *[F.col(n).alias(f"far_{n}") for n in names])
    again = refers.join(ends, ["c0", "c1"]).select("k0", "k1", *[(F.col(n) + F.col(f"far_{n}")).alias(n) for n in names])
    return totals.unionByName(again)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _pieces(batches):
    """Runs of equal keys in a sorted partition, as comma-joined ids, ``PIECE`` at most in a row."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        k0, k1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(k0):
            continue
        new = np.concatenate([[True], (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])])
        first = np.flatnonzero(new)
        since = np.arange(len(k0)) - np.repeat(first, np.diff(np.append(first, len(k0))))
        first = np.flatnonzero(since % PIECE == 0)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(k0)).astype(np.int32)), batch.column(2).cast(pa.string()))
        numbers = np.arange(number, number + len(first))
        number += len(first)
        yield pa.RecordBatch.from_arrays([
            pa.array(k0[first]), pa.array(k1[first]), pa.array(np.full(len(first), part, np.int32)), pa.array(numbers),
            pa.compute.binary_join(lists, ",")], names=["k0", "k1", "part", "number", "ids"])


def _hashes(batches):
    """SHA-256 of the pieces of each key, in order, joined by commas."""
    key, state = None, None
    for batch in batches:
        out = []
        for k0, k1, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (k0, k1) != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (k0, k1), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(out)
    if state is not None:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list) -> pa.RecordBatch:
    kinds = [("k0", pa.int64()), ("k1", pa.int64()), ("ends_sha256", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])


def ends_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ids, ascending, joined by commas."""
    none = convs.filter("total = 0").select(*[F.lit(x).cast("long").alias(c) for c, x in zip(("k0", "k1"), ROOT)], "conv_id")
    ends = paths.filter("is_last").select("k0", "k1", "conv_id").unionByName(none)
    ranged = ends.repartitionByRange("k0", "k1", "conv_id").sortWithinPartitions("k0", "k1", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "k0 bigint, k1 bigint, part int, number bigint, ids string")
    dealt = pieces.repartition("k0", "k1").sortWithinPartitions("k0", "k1", "part", "number").select("k0", "k1", "ids")
    return dealt.mapInArrow(_hashes, "k0 bigint, k1 bigint, ends_sha256 string")


def _with_parent(nodes: DataFrame) -> DataFrame:
    """Smallest member of the parent. Parents with a fixed share of all nodes as children are few and broadcast."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = nodes.count() // (4 * parts) + 1
    parents = nodes.filter("n_children > 0").select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") > most).drop("n_children"))  # below 4 * parts rows
    cold = parents.filter(F.col("n_children") <= most).drop("n_children")
    root = nodes.filter("p0 is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    of_hot = nodes.join(hot, ["p0", "p1"]).select(*root.columns)
    of_cold = nodes.filter("p0 is not null").join(hot, ["p0", "p1"], "left_anti").join(cold, ["p0", "p1"]).select(*root.columns)
    return root.unionByName(of_hot).unionByName(of_cold)


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (columns conv_id, turn, role, text)."""
    turns, convs = rebuilt(numbered_turns(rows))
    paths = store(prefixes(turns), "trie-paths")
    nodes = store(nodes_of(paths, convs), "trie-nodes")
    totals = contract(nodes, {
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    full = _with_parent(nodes).join(totals, ["k0", "k1"]).join(ends_of(paths, convs), ["k0", "k1"], "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

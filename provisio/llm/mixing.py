"""Mixing sources to target weights by balanced sampling (cube method).

Every source gets a target number of words. A document of a source with ``target / size = 2.3``
is taken twice for sure and a third time with inclusion probability 0.3. The cube method decides
the fractional part: it moves the probabilities of a few documents at a time along a direction
that changes neither the number of documents nor the number of words, until at most two of a
group are still undecided (flight). The undecided documents of all groups form new groups, and
so on, until one small group per source is left, whose last few documents are rounded to the
nearest total (landing).

Groups are dealt by a hash within a source, so a source with most of the rows is many groups;
a round keeps 2 of ``GROUP`` documents, so three rounds reach 10**11 documents.

Defined results: rows with the same ``doc_id`` (a null one too) are one unit and get the same
number of copies, in the smallest of their sources; null texts have size 0; a source without
words has target 0; an empty table gives an empty table; only ``doc_id``, ``text`` and ``source``
are read. The choice depends on ``doc_id`` and ``seed`` alone, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import free_names, store, tidy

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
GROUP = 4096  # documents of one flight
LANDING = 12  # documents of a source that are rounded together in the end


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size`` (number of words) of every row."""

    def run(batches):
        for batch in batches:
            counts = [w.counts for w in W.split(batch.column(2))]
            size = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size.astype(np.int64))], names=["doc_id", "source", "size"])

    kinds = [docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")]
    return docs.select("doc_id", "source", "text").mapInArrow(tidy(run), f"doc_id {kinds[0]}, source {kinds[1]}, size bigint")


def targets(source_sizes: dict, weights=WEIGHTS, max_repeats: float = MAX_REPEATS, total: float | None = None) -> dict:
    """Words per source: shares of the total by weight, none above ``max_repeats`` times its size."""
    order = sorted(source_sizes, key=lambda s: (s is None, s if s is not None else ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    rest = float(sum(source_sizes.values()) if total is None else total)
    out, free = {}, list(order)
    while free:
        per = rest / sum(weight[s] for s in free)
        full = [s for s in free if per * weight[s] > max_repeats * source_sizes[s]]
        if not full:
            out.update({s: per * weight[s] for s in free})
            break
        for s in full:
            out[s] = float(max_repeats * source_sizes[s])
            rest -= out[s]
        free = [s for s in free if s not in out]
    return out


def flight(size: np.ndarray, chance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities to 0 or 1 without changing their sum or the sum of size * chance.

    Three open documents at a time: the direction (x2 - x3, x3 - x1, x1 - x2) is the null space
    of the two balancing equations. At most two documents stay open.
    """
    chance = chance.astype(float).copy()
    x, order = size.astype(float), np.flatnonzero((chance > 0) & (chance < 1))
    open_: list[int] = []
    at = 0
    while True:
        while len(open_) < 3 and at < len(order):
            open_.append(int(order[at]))
            at += 1
        if len(open_) == 2 and x[open_[0]] == x[open_[1]]:
            move = (1.0, -1.0)
        elif len(open_) < 3:
            return chance
        else:
            a, b, c = open_
            move = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
            if not any(move):
                move = (1.0, -1.0, 0.0)
        up = down = np.inf
        for i, m in zip(open_, move):
            if m:
                up = min(up, (1 - chance[i]) / m if m > 0 else -chance[i] / m)
                down = min(down, chance[i] / m if m > 0 else (chance[i] - 1) / m)
        step = up if rng.random() * (up + down) < down else -down
        for i, m in zip(open_, move):
            chance[i] += step * m
            if chance[i] < 1e-9:
                chance[i] = 0.0
            elif chance[i] > 1 - 1e-9:
                chance[i] = 1.0
        left = [i for i in open_ if 0 < chance[i] < 1]
        if len(left) == len(open_):  # rounding errors left all just inside: settle the nearest
            near = min(open_, key=lambda i: min(chance[i], 1 - chance[i]))
            chance[near] = round(chance[near])
            left = [i for i in open_ if i != near]
        open_ = left


def landing(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Round the few open probabilities so that the words come nearest to the expected words.

    The number of documents counts as little: one document as two hundredths of a mean one.
    """
    left = np.flatnonzero((chance > 0) & (chance < 1))
    x, p = size[left].astype(float), chance[left]
    options = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    words, number = np.abs(options @ x - x @ p), np.abs(options.sum(axis=1) - p.sum())
    out = chance.copy()
    if len(left):
        out[left] = options[np.argmin(words + 0.02 * x.mean() * number)]
    return out


def choose(units: DataFrame, seed: int = 0, group: int = GROUP) -> DataFrame:
    """Settle ``chance`` (strictly between 0 and 1) of every unit to 0 or 1, per ``source``.

    ``units``: doc_id, source, size, chance. Each round flies all groups in parallel and keeps
    the open units; the last round holds one group per source and lands.
    """
    open_ = store(units.withColumn("draw", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))), "mix-open")
    columns = ["doc_id", "source", "size", "chance", "draw"]
    schema = open_.select(*columns).schema
    settled: list[DataFrame] = []
    level = 0
    while True:
        most = open_.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        last = most <= group
        # Groups of a source: as many as its own number of open units asks for.
        deals = open_.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(group)).alias("_deals"))
        one = F.lit(0) if last else F.pmod(F.xxhash64(F.col("draw"), F.lit(level)), F.col("_deals"))
        dealt = (open_ if last else open_.join(deals, F.col("source").eqNullSafe(F.col("_source")))).withColumn("_deal", one)

        def fly(table: pa.Table) -> pa.Table:
            table = table.select(columns).sort_by([("draw", "ascending"), ("size", "ascending")])
            size, chance, draw = (table[c].to_numpy() for c in ("size", "chance", "draw"))
            rng, n = np.random.default_rng(int(draw.sum() * (1 << 32)) + level), max(0, len(size) - LANDING) if last else len(size)
            flown = np.concatenate([flight(size[:n], chance[:n], rng), chance[n:]])
            return table.set_column(3, "chance", pa.array(landing(size, flown) if last else flown))

        flown = store(dealt.groupBy("source", "_deal").applyInArrow(fly, schema), f"mix-{level}")
        done = F.col("chance").isin(0.0, 1.0)
        settled.append(flown.filter(done))
        if last:
            break
        open_, level = flown.filter(~done), level + 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", F.col("chance").cast("long").alias("extra"))


def copies(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, copies.

    The sources themselves, which a mixture names one by one with a weight, fit the driver.
    """
    rows = store(sizes(docs), "mix-sizes")
    units = rows.groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("size").alias("size"))
    totals = {r["source"]: r["size"] for r in units.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    goal = targets(totals, weights, max_repeats)
    spark = docs.sparkSession
    kind = rows.schema["source"].dataType.simpleString()
    rates = [(s, int(totals[s]), float(goal[s]), float(min(max_repeats, goal[s] / totals[s])) if totals[s] else 0.0) for s in totals]
    table = spark.createDataFrame(rates, f"_source {kind}, source_size bigint, target double, rate double")
    rated = units.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn(
        "chance", F.col("rate") - F.floor("rate"))
    rated = store(rated, "mix-units")
    extra = choose(rated.filter("chance > 0").select("doc_id", "source", "size", "chance"), seed)
    settled = (
        rated.drop("size", "source").join(extra.withColumnRenamed("doc_id", "_doc"), F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
        .select(F.col("doc_id").alias("_doc"), "source_size", "target", (F.floor("rate") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"))
    )
    return rows.join(settled, F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc")


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them (0 to ``max_repeats`` times)."""
    doc, times, copy = free_names(docs, "__doc", "__copies", "__copy")
    taken = (
        copies(docs, weights, max_repeats, seed).filter("copies > 0")
        .select(F.col("doc_id").alias(doc), F.col("copies").alias(times)).dropDuplicates([doc])
    )
    joined = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(doc)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])

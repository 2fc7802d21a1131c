"""Language identification with string kernels.

The kernel of two texts is a blended spectrum: for every n it compares which byte n-grams are
present in both (presence, not counts), each n normalised by itself so that long texts do not
win by length, and the parts are averaged. Nyström landmarks turn the kernel into features:
kernel values against a few hundred training texts, whitened by the landmarks' own kernel matrix.
One-versus-rest kernel ridge regression on those features gives a score per language. Scoring is
two matrix products per batch of texts.

``fit`` uses a bounded sample of labelled rows (``sample``, divided equally among the labels) chosen by a
hash of the text; everything else looks at all rows and at whole texts. N-grams are hashed into
``SLOTS`` presence bits, so a text of any length is one row of bits.

Defined results: a null text and a text without a letter are ``und`` with score 0; without any labelled
row everything is ``und``; rows with null labels are not learned from; repeated rows get equal
results; only ``doc_id``, ``text`` and, in ``fit``, the label are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W

SLOTS = {1: 256, 2: 4096, 3: 8192}
BITS = sum(SLOTS.values())
SAMPLE = 2048  # training texts at most
LANDMARKS = 256
RIDGE = 1e-2
UNKNOWN = "und"
ROWS = 256  # texts of one matrix product


def presence(texts) -> np.ndarray:
    """One row of presence bits (0 or 1, uint8) per text; A-Z count as a-z, white space as one blank."""
    offsets, data = W.as_bytes(texts)
    out = np.zeros((len(offsets) - 1, BITS), np.uint8)
    table = W.LOWER.copy()
    table[W.SPACE] = 32
    flat = out.reshape(-1)
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while at < end:  # long texts piece by piece, overlapping by an n-gram
            codes = table[data[at : min(end, at + W.PIECE)]].astype(np.uint32)
            base, gram = row * BITS, np.zeros(len(codes), np.uint32)
            for n, slots in SLOTS.items():
                gram = codes if n == 1 else gram[:-1] * np.uint32(256) + codes[n - 1 :]
                slot = gram if n == 1 else (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(np.log2(slots)))
                flat[base + slot.astype(np.int64)] = 1
                base += slots
            at += max(1, W.PIECE - max(SLOTS) + 1)
    return out


def _parts() -> list[slice]:
    ends = np.cumsum(list(SLOTS.values()))
    return [slice(int(e - s), int(e)) for e, s in zip(ends, SLOTS.values())]


def _normed(bits: np.ndarray) -> np.ndarray:
    """Presence bits scaled so that the dot product of two rows is the kernel."""
    x = bits.astype(np.float32)
    for part in _parts():
        length = np.sqrt(x[:, part].sum(axis=1, keepdims=True))
        x[:, part] /= np.maximum(length, 1) * np.float32(np.sqrt(len(SLOTS)))
    return x


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    landmarks: np.ndarray  # [landmark, bit], normed
    weights: np.ndarray  # [landmark + 1, label]

    def scores(self, bits: np.ndarray) -> np.ndarray:
        kernel = _normed(bits) @ self.landmarks.T
        return kernel @ self.weights[:-1] + self.weights[-1]


def train(bits: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression, one label against the rest, on Nyström features of the first texts of each label."""
    names = tuple(sorted(set(labels)))
    if not names:
        return Model((), np.zeros((0, BITS), np.float32), np.zeros((1, 0), np.float32))
    which = np.array([names.index(x) for x in labels])
    turn = np.array([np.sum(which[:i] == w) for i, w in enumerate(which)])  # landmarks go round the labels
    chosen = np.lexsort((which, turn))[:landmarks]
    x = _normed(bits)
    marks = x[chosen]
    inner = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])  # K_mm ** -1/2 up to a rotation
    features = np.hstack([(x @ marks.T).astype(np.float64) @ whiten, np.ones((len(x), 1))])
    share = np.bincount(which) / len(which)
    balance = 1 / (share[which] * len(names))  # rare labels weigh as much as common ones
    target = np.where(which[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = features.T @ (features * balance[:, None]) + ridge * len(x) * np.diag([*np.ones(features.shape[1] - 1), 0]) + 1e-9 * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (target * balance[:, None]))
    return Model(names, marks, np.vstack([whiten @ solved[:-1], solved[-1:]]).astype(np.float32))


def fit(rows: DataFrame, label: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from at most ``sample`` labelled rows, about equally many of each label.

    The sample is drawn by a hash of the text, so it does not depend on the order of rows, and a text
    with many copies counts once. Only presence bits of the drawn texts reach the driver.
    """
    labelled = rows.filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).cast("string").alias("label"), "text")
    labelled = labelled.withColumn("place", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    counts = {r["label"]: r["count"] for r in labelled.select("label", "place").distinct().groupBy("label").count().collect()}
    if not counts:
        return train(np.zeros((0, BITS), np.uint8), [])
    per_label = max(1, sample // len(counts))
    # A share of the distinct texts that gives twice the wanted number on average, then the smallest hashes of it.
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (2.0 * per_label + 50) / n)))])[F.col("label")]
    drawn = labelled.filter(F.col("place") < share * F.lit(float(1 << 40))).dropDuplicates(["label", "place"])

    def run(batches):
        for batch in batches:
            bits = np.packbits(presence(batch.column(1)), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([b.tobytes() for b in bits], pa.binary())], names=["label", "place", "bits"])

    found = drawn.mapInArrow(run, "label string, place bigint, bits binary").orderBy("place", "label", "bits").limit(4 * sample + 100 * len(counts)).collect()
    taken: dict[str, int] = {}
    use = []
    for r in found:
        if taken.get(r["label"], 0) < per_label:
            taken[r["label"]] = taken.get(r["label"], 0) + 1
            use.append(r)
    bits = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=BITS) for r in use], np.uint8).reshape(len(use), BITS)
    return train(bits, [r["label"] for r in use], landmarks, ridge)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``label`` and ``score`` (0 to 1) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: landmarks times bits

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(1)
            known = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            label, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if m.labels:
                for lo in range(0, len(texts), ROWS):
                    s = m.scores(presence(texts.slice(lo, ROWS))).astype(np.float64)
                    odds = np.exp(4 * (s - s.max(axis=1, keepdims=True)))
                    best = s.argmax(axis=1)
                    label[lo : lo + ROWS] = np.array(m.labels, object)[best]
                    score[lo : lo + ROWS] = 1 / odds.sum(axis=1)
                label[~known], score[~known] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(score)], names=["doc_id", "label", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, label string, score double")

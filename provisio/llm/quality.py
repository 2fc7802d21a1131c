"""Quality rules combined by weak supervision.

Every rule looks at the statistics of one whole text and votes good, bad, or abstains. No rule
decides alone: expectation-maximisation over the votes of all documents estimates how often
each rule is right about good and about bad documents, without labels, and a document is kept
when the posterior probability that it is good reaches a threshold.

The votes of a document are one number, its pattern; there are at most ``3 ** len(RULES)``
patterns whatever the size of the corpus, so EM runs on the counts per pattern.

Defined results: a null or empty text has no words and fails the base rules; rows are judged one
by one, so repeated rows get equal results; an empty table gives an empty table; only ``doc_id``
and ``text`` are read, and :func:`keep` passes all other columns through whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import tidy

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[0xC0:] = True  # and the first byte of any longer character
STOPS = np.zeros(256, bool)
STOPS[list(b".!?")] = True

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_letter_words", "n_stops"]


@dataclass(frozen=True)
class Rule:
    """Votes on a share of two statistics: bad at or beyond ``bad``, good at or beyond ``good``, else abstains.

    The lack of one defect says little about a text, so most rules have no ``good``.
    """

    name: str
    part: str
    whole: str
    bad: float
    good: float | None = None
    high_is_bad: bool = True

    def vote(self, s: dict[str, np.ndarray]) -> np.ndarray:
        part, whole = s[self.part].astype(float), s[self.whole].astype(float)
        share = np.divide(part, whole, out=np.full(len(part), np.nan), where=whole > 0)
        sign = 1.0 if self.high_is_bad else -1.0  # no share (NaN): abstains
        good = np.zeros(len(share), bool) if self.good is None else sign * share <= sign * self.good
        return np.where(sign * share >= sign * self.bad, -1, np.where(good, 1, 0)).astype(np.int64)


#: The production rules.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.10),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.30),
    Rule("capitals", "n_upper", "n_letters", 0.50),
    Rule("letter_words", "n_letter_words", "n_words", 0.80, high_is_bad=False),
    Rule("letter_chars", "n_letters", "word_chars", 0.75, good=0.90, high_is_bad=False),
    Rule("sentence_marks", "n_stops", "n_words", 0.60),
    Rule("long_words", "word_chars", "n_words", 12.0),
)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (row, value) pairs: an equal pair stands before; an equal pair stands anywhere else."""
    key = W.mix(value + W.mix(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    before, other = np.zeros(len(key), bool), np.zeros(len(key), bool)
    before[order[1:]] = same
    other[order[1:]] |= same
    other[order[:-1]] |= same
    return before, other


def text_stats(texts) -> dict[str, np.ndarray]:
    """The statistics of every text of an Arrow column."""
    found: dict[str, list[np.ndarray]] = {k: [] for k in STATS}
    for w in W.split(texts):
        n = len(w.offsets) - 1
        one = {"n_words": w.counts}
        one["word_chars"] = _per_row(w.inside & ~W.CONTINUES[w.buf], w.offsets)
        for name, table in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_letters", LETTER), ("n_stops", STOPS)):
            one[name] = _per_row(table[w.buf], w.offsets)
        letters = np.zeros(len(w.buf) + 1, np.int64)
        np.cumsum(LETTER[w.buf], out=letters[1:])
        one["n_letter_words"] = _per_row(letters[w.end] > letters[w.start], w.first)
        # Lines: from the start of a row or behind a line feed, to the next line feed or the row's end.
        begins = np.union1d(w.offsets[:-1], np.flatnonzero(w.buf == 10) + 1)
        begins = begins[begins < len(w.buf)]
        row = np.searchsorted(w.offsets, begins, side="right") - 1
        ends = np.minimum(np.append(begins[1:], len(w.buf)), w.offsets[row + 1])
        ends = np.where((ends > begins) & (w.buf[np.maximum(ends, 1) - 1] == 10), ends - 1, ends)
        filled = np.searchsorted(w.start, ends) > np.searchsorted(w.start, begins)
        begins, ends, row = begins[filled], ends[filled], row[filled]
        before, _ = _seen_before(W.hash_ranges(w.buf, begins, ends), row)
        one["n_lines"] = np.bincount(row, minlength=n)
        one["n_dup_lines"] = np.bincount(row[before], minlength=n)
        value, at = W.windows(w.hashes(), w.first, WINDOW)
        _, other = _seen_before(value, np.searchsorted(w.first, at, side="right"))
        covered = np.zeros(len(w.start), bool)
        for j in range(WINDOW):
            covered[at[other] + j] = True
        one["n_repeat_words"] = _per_row(covered, w.first)
        for k in STATS:
            found[k].append(np.asarray(one[k], np.int64))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def patterns(s: dict[str, np.ndarray], rules=RULES) -> np.ndarray:
    """The votes of each document as one number in base 3 (digit = vote + 1)."""
    out = np.zeros(len(s["n_words"]), np.int64)
    for i, rule in enumerate(rules):
        out += (rule.vote(s) + 1) * 3**i
    return out


def measure(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed`` and ``pattern`` of every document."""

    def run(batches):
        for batch in batches:
            s = text_stats(batch.column(1))
            columns = [batch.column(0), *[pa.array(s[k]) for k in STATS], pa.array(base_failed(s)), pa.array(patterns(s, rules))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATS, "base_failed", "pattern"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{k} bigint" for k in STATS) + ", base_failed boolean, pattern bigint"
    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


@dataclass(frozen=True)
class Supervision:
    """What EM found: prior, the chance of each vote per class, and the posterior by pattern."""

    prior: float
    votes: np.ndarray  # [rule, class (bad, good), vote (-1, 0, 1)]
    posterior: dict[int, float]

    def accuracy(self) -> np.ndarray:
        """Per rule: chance that a vote that is no abstention is right."""
        right = (1 - self.prior) * self.votes[:, 0, 0] + self.prior * self.votes[:, 1, 2]
        wrong = (1 - self.prior) * self.votes[:, 0, 2] + self.prior * self.votes[:, 1, 0]
        return right / np.maximum(right + wrong, 1e-12)


def expectation_maximisation(counts: dict[int, int], n_rules: int, prior: float = 0.8, accuracy: float = 0.8, weight: float = 0.02, rounds: int = 100) -> Supervision:
    """EM over pattern counts.

    The start and a Beta-like prior of ``weight`` of all documents say that a rule is right with
    chance ``accuracy``; that keeps the two classes from changing names and rules without votes
    at the prior. ``prior`` is the expected share of good documents.
    """
    keys = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(k)] for k in keys], float)
    digits = np.stack([keys // 3**i % 3 for i in range(n_rules)], axis=1).astype(int) if len(keys) else np.zeros((0, n_rules), int)
    start = np.array([[accuracy, 1.0, 1 - accuracy], [1 - accuracy, 1.0, accuracy]]) / 2
    votes = np.repeat(start[None], n_rules, axis=0)
    total, share = n.sum(), prior
    good = np.zeros(len(keys))
    for _ in range(rounds):
        like = np.array([np.prod([votes[i, c, digits[:, i]] for i in range(n_rules)], axis=0) for c in (0, 1)]) if len(keys) else np.zeros((2, 0))
        joint = like * np.array([[1 - share], [share]])
        good = joint[1] / np.maximum(joint.sum(axis=0), 1e-300)
        mass = np.stack([n * (1 - good), n * good])
        share = (mass[1].sum() + weight * total * prior + prior) / (total * (1 + weight) + 1)
        for i in range(n_rules):
            for c in (0, 1):
                seen = np.bincount(digits[:, i], weights=mass[c], minlength=3) + (weight * total + 1) * start[c]
                votes[i, c] = seen / seen.sum()
    return Supervision(float(share), votes, {int(k): float(p) for k, p in zip(keys, good)})


def fit(measured: DataFrame, rules=RULES) -> Supervision:
    """EM over the votes of all measured documents (one count per pattern reaches the driver)."""
    rows = measured.groupBy("pattern").count().collect()
    return expectation_maximisation({r["pattern"]: r["count"] for r in rows}, len(rules))


def posterior(model: Supervision, pattern: Column) -> Column:
    """Posterior probability as an expression; the map has at most ``3 ** rules`` entries."""
    if not model.posterior:
        return F.lit(0.0)
    entries = F.map_from_arrays(
        F.lit(np.array(list(model.posterior), np.int64)), F.lit(np.array(list(model.posterior.values()), np.float64))
    )
    return F.coalesce(F.element_at(entries, pattern), F.lit(0.0))


def judge(measured: DataFrame, model: Supervision, threshold: float = 0.5) -> DataFrame:
    """Add ``posterior`` and ``kept``."""
    good = posterior(model, F.col("pattern"))
    return measured.withColumn("posterior", good).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep(docs: DataFrame, model: Supervision, threshold: float = 0.5, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; one pass and no shuffle."""
    text = docs.columns.index("text")
    good = {k for k, p in model.posterior.items() if p >= threshold}

    def run(batches):
        for batch in batches:
            s = text_stats(batch.column(text))
            yield batch.filter(pa.array(~base_failed(s) & np.isin(patterns(s, rules), list(good))))

    return docs.mapInArrow(tidy(run), docs.schema)

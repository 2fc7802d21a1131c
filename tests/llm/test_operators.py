"""The training-data operators against brute force, round trips and held-out labels, with odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from provisio.llm import decontam, language, lm, mixing, quality, setjoin, sharding, substrings, tokens, warc
from provisio.llm import words as W
from provisio.llm.graph import components
from provisio.llm.queries import END_ID, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copies int, size string, kept int, __x string"


def prose(seed, n, vocabulary_size=60):
    rng = np.random.default_rng(seed)
    return " ".join("w" + "abcdefghij"[int(i) % 10] + "xyz"[int(i) % 3] * (1 + int(i) // 10) for i in rng.integers(0, vocabulary_size, n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 120)
    out = [(0, base), (1, base), (2, base + " tail"), (3, "start " + base), (4, ""), (5, None), (6, " \n\t "), (7, "one"), (8, "one"), (9, "a b c"), (10, "A B c")]
    out += [(11, prose(2, 60) + " " + base[:200]), (12, prose(3, 3000)), (13, "é ü — 中文 #x <b> | 12 don't"), (14, prose(4, 200)), (15, prose(4, 199))]
    out += [(16 + i, prose(100 + i, 80)) for i in range(20)] + [(40 + i, base) for i in range(5)]
    words = base.split()
    for i in range(12):  # close copies, some of them linked only through others
        own = list(words)
        for j in range(i):
            own[(7 * j + 3) % len(own)] = f"edit{j}"
        out.append((60 + i, " ".join(own)))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, None if i % 7 == 0 else "en", None if i == 5 else f"s{i % 3}", None, 1, "x", 2, "y") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_words_match_the_pattern(rows):
    texts = [t for _, t in rows] + ["x" * 70_000 + " y", "a\x0bb\x0cc\x1cd\xa0e"]
    for piece in (64, W.PIECE):
        got = [[] for _ in texts]
        for w in W.split(pa.array(texts), piece=piece):
            raw = w.buf.tobytes()
            for row, a, b in zip(w.rows(), w.start, w.end):
                got[w.lo + row].append(raw[a:b].decode())
        assert got == [words_of(t) for t in texts]


def test_token_files_round_trip(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    manifest = tokens.write_tokens(docs, vocabulary(), END_ID, length=64, rows=4)
    got = {r["doc_id"]: r for r in tokens.read_documents(spark, manifest, with_ids=True).collect()}
    at = 0
    for doc_id, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [END_ID]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], list(r["ids"])) == (at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    name, _, n_ids, sequences = manifest.files[-1]
    file = tokens.SequenceFile(f"{manifest.folder}/{name}.arrows", sequences, 64, 4)
    assert sum(int(file.mask(i).sum()) for i in range(sequences)) == n_ids
    assert sum(int(file.last(i).sum()) for i in range(sequences)) == manifest.files[-1][1]
    assert len(file.ids(sequences - 1)) == 64
    assert tokens.read_documents(spark, tokens.write_tokens(empty, vocabulary(), END_ID)).count() == 0
    twice = docs.filter("doc_id in (1, 7)").union(docs.filter("doc_id = 7")).withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    again = tokens.read_documents(spark, tokens.write_tokens(twice, vocabulary(), END_ID)).collect()
    assert sorted((r["doc_id"] is None, r["start"]) for r in again)[2] == (True, 0)


def test_encoder_equals_the_library():
    coder = tokens.Encoder(vocabulary())
    alphabet = list("aBcéÉßñ×÷'.,!?<|># \n\t\x0b019ąŁ中İ́̇I\xa0ɐ-") + ["<|endoftext|>", "'s", "don't"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)] + [None, ""]
    ids, counts = coder.encode(texts)
    want = [e.ids for e in coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [len(x) for x in want] == list(counts) and [i for x in want for i in x] == ids.tolist()


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words_of(lower(t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_jaccard_join(docs, rows, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.near_duplicates(docs, k, percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_jaccard_join_odd_tables(docs, empty):
    assert setjoin.near_duplicates(empty).count() == 0
    odd = docs.filter("doc_id in (0, 1, 5, 7)").union(docs.filter("doc_id = 0")).union(docs.filter("doc_id = 14").withColumn("doc_id", F.lit(None).cast("bigint")))
    kept = setjoin.keep_one(odd)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "5", "7", "None"]


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        for size in (1, 3, 6, 7, 12, 30, 90):
            plan = setjoin.schemes({size: 1e7, 2 * size: 5.0}, percent)
            for _ in range(40):
                a = set(rng.integers(0, 1 << 60, size).tolist())
                b = set(a)
                for x in list(a)[: rng.integers(0, max(1, size // 5) + 1)]:
                    b.discard(x)
                    b |= set(rng.integers(0, 1 << 60, rng.integers(0, 2)).tolist())
                if not b or 100 * len(a & b) < percent * len(a | b):
                    continue
                value = np.concatenate([np.sort(np.array(list(s), np.uint64)) for s in (a, b)])
                sig, whole, row = setjoin.signatures(value, np.array([0, len(a), len(value)]), plan, percent)
                mine, theirs = (collections.defaultdict(bool) for _ in range(2))
                for s, w, r in zip(sig.tolist(), whole, row):
                    (mine if r == 0 else theirs)[s] |= bool(w)
                assert any(mine[s] or theirs[s] for s in set(mine) & set(theirs))


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 9), (5, 4), (6, 6), (30, 20), (20, 10), (10, 9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 10: 1, 20: 1, 30: 1, 4: 4, 5: 4}


def test_late_links_in_blocks():
    sets = [np.arange(100, dtype=np.uint64) + np.uint64(3 * i) for i in range(6)] + [np.arange(900, 1000, dtype=np.uint64)]
    doc = np.arange(7)
    found = setjoin._joining_links(doc, doc.copy(), np.zeros(7), sets, 85)
    assert len(found) == 5 and {x for p in found for x in p} == set(range(6))
    assert all((a - b) % 2 for a, b in setjoin._joining_links(doc, doc.copy(), doc % 2, sets, 85))


def test_substrings(docs, rows, empty):
    first, want = {}, {}
    for i, t in sorted(rows):
        w = words_of(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    got = substrings.remove_repeats(docs).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in got} == want
    for r in got:
        assert sum(s["end_word"] - s["first_word"] for s in r["spans"]) == r["n_removed"]
    assert substrings.remove_repeats(empty).count() == 0
    twins = docs.filter("doc_id = 0").union(docs.filter("doc_id = 0")).union(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("bigint")))
    assert {r["n_removed"] for r in substrings.remove_repeats(twins).collect()} == {0}


def test_shards(docs, rows, empty):
    got = sharding.shard_by_bytes(docs, 4).collect()
    texts = dict(rows)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows}
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert sharding.shard_by_bytes(empty, 4).count() == 0
    assert len({r["shard"] for r in got if texts[r["doc_id"]] == texts[0]}) == 1


def test_best_fit_decreasing():
    assert sharding.best_fit_decreasing([6, 5, 4, 3, 2], 10).tolist() == [0, 1, 0, 1, 1]
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100, 500)
    bins, rooms = sharding.best_fit_decreasing(sizes, 120), []
    for i in np.argsort(-sizes, kind="stable"):  # plain list instead of the tree
        fits = [b for b, r in enumerate(rooms) if r >= sizes[i]]
        b = min(fits, key=lambda b: (rooms[b], b), default=len(rooms))
        rooms += [120] * (b == len(rooms))
        rooms[b] -= sizes[i]
        assert bins[i] == b
    even = np.bincount(sharding.pack_evenly(sizes, 8), weights=sizes)
    assert even.max() - even.min() <= 0.01 * sizes.sum()


def test_language():
    rng = np.random.default_rng(0)
    kinds = {"x": "aeiou", "y": "ktprs", "z": "éüñöß"}
    texts, labels = zip(*[("".join(rng.choice(list(kinds[k] + " lm"), 80)), k) for _ in range(60) for k in kinds])
    model = language.train(language.presence(pa.array(texts[:90])), list(labels[:90]), landmarks=30)
    told = np.array(model.labels)[model.scores(language.presence(pa.array(texts[90:]))).argmax(axis=1)]
    assert (told == np.array(labels[90:])).mean() > 0.95


def test_language_odd_rows(docs, empty):
    model = language.fit(docs, "lang")
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert got[5]["label"] == got[4]["label"] == got[6]["label"] == "und" and got[5]["score"] == 0
    assert got[0]["label"] == "en" and all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.fit(empty, "lang")
    assert {r["label"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_language_learns_labels_of_copies(spark, monkeypatch):
    """20 texts in 20,000 copies: as many are learned as of labels whose texts are all different."""
    data = [("a", prose(i % 20, 5)) for i in range(20_000)] + [(k, prose(1000 + i, 5)) for i, k in enumerate("bcd" * 300)]
    learned, train = [], language.train
    monkeypatch.setattr(language, "train", lambda bits, labels, *more: learned.extend(labels) or train(bits, labels, *more))
    model = language.fit(spark.createDataFrame(data, "lang string, text string").repartition(4), "lang", sample=40)
    assert model.labels == ("a", "b", "c", "d")
    assert collections.Counter(learned) == dict.fromkeys("abcd", 10)


def test_decontamination_is_free_of_sets(spark):
    """The same leaks, similarities and kept documents however the benchmark is dealt into sets."""
    common = prose(7, 12)
    items = [(i, f"{prose(50 + i, 10)} {common} {prose(80 + i, 10)}") for i in range(12)] + [(20, prose(9, 4)), (21, None), (22, prose(10, 30))]
    data = []
    for i, t in items[:12]:
        for edits in range(6):
            own = t.split()
            for e in range(edits):
                own[e] = f"other{e}"
            data.append((100 * i + edits, f"{prose(300 + i, 20)} {' '.join(own)} {common}"))
    docs = spark.createDataFrame([*data, (-1, None), (-2, "")], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    read = lambda x: sorted(tuple(r) for r in x.collect())
    whole, dealt = read(decontam.leaks(docs, benchmark)), read(decontam.leaks(docs, benchmark, most=300))
    assert len(whole) > 20 and whole == dealt
    kept = read(decontam.remove(docs, benchmark).select("doc_id"))
    assert len(kept) > 5 and kept == read(decontam.remove(docs, benchmark, most=300).select("doc_id"))


def test_decontamination(spark, docs, rows, empty):
    items = [(0, prose(4, 200).split(" ", 60)[0]), (1, " ".join(prose(3, 3000).split()[500:540])), (2, None), (3, "too short"), (4, prose(999, 30)), (5, " ".join(prose(3, 3000).split()[500:540]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(docs, bench).collect()}
    assert set(got) == {(12, 1), (12, 5)} and got[12, 1]["first_word"] == 500 and got[12, 1]["similarity"] == 1.0
    assert decontam.leaks(empty, bench).count() == 0 and decontam.leaks(docs, bench.limit(0)).count() == 0
    kept = decontam.remove(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1


def test_simhash_against_all_windows():
    text = prose(8, 400).split()
    items = [" ".join(text[50:90]), " ".join(text[200:260])]
    changed = list(text)
    changed[70] = "other"
    index = decontam.Items([0, 1], items)
    found = {(item, start) for _, item, start, _ in index.matches(pa.array([" ".join(changed)]))}
    assert (1, 200) in found
    h = next(W.split(pa.array([" ".join(changed)]), lower=True))
    value, _ = W.windows(h.hashes(), h.first, 5)
    best = max(index.similar(value[s : s + 36], 0) for s in range(len(text) - 39))
    assert ((0, 50) in found) == (best >= decontam.SIMILARITY)


def test_mixing(docs, rows, empty):
    mixed = mixing.copies(docs).collect()
    sizes = {i: len(words_of(t)) for i, t in rows}
    taken, goal = collections.Counter(), {}
    for r in mixed:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
        goal[r["source"]] = r["target"]
    assert set(goal) == {None, "s0", "s1", "s2"}
    assert all(abs(taken[s] - goal[s]) <= 0.05 * goal[s] + 5 for s in goal)
    again = {r["doc_id"]: r["copies"] for r in mixing.copies(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in mixed}
    rows_out = mixing.mix(docs)
    assert rows_out.columns == docs.columns and rows_out.count() == sum(again.values())
    assert mixing.mix(empty).count() == 0


def test_targets_and_flight():
    assert mixing.targets({"a": 10, "b": 100, "c": 100}) == {"a": 30.0, "b": 120.0, "c": 60.0}
    rng = np.random.default_rng(2)
    size, chance = rng.integers(1, 1000, 300), np.full(300, 0.4)
    moved = mixing.flight(size, chance, rng)
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert abs((moved * size).sum() - (chance * size).sum()) < 1e-3 and abs(moved.sum() - 120) < 1e-6


def test_mixing_in_rounds(spark):
    units = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 97).alias("size"), F.lit(0.3).alias("chance"))
    got = mixing.choose(units, group=200)
    r = got.join(units, "doc_id").agg(F.count("*").alias("n"), F.sum("extra").alias("k"), F.sum(F.col("extra") * F.col("size")).alias("w")).first()
    assert r["n"] == 3000 and abs(r["k"] - 900) <= 3 and abs(r["w"] - 0.3 * sum(i % 97 for i in range(3000))) < 100


def test_warc(spark):
    long = "é" * 700
    pages = [(1, "http://a", long), (2, None, long), (9, "http://b\r\nx: y", long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", "x")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").select("page_id", "url", F.col("html").cast("binary").alias("payload")).repartition(3)
    got = {r["page_id"]: r for r in warc.archive(table).collect()}
    assert len(got) == len(pages)
    for page, _, html in pages:
        body = (html or "").encode()
        revisit = html == long and page != 9
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 9) if revisit else ("response", None))
        assert r["payload"] is None if revisit else bytes(r["payload"]) == body
    assert warc.archive(table.limit(0)).count() == 0


def test_lm(spark, docs, rows, empty):
    got = lm.score(docs, vocabulary(), F.col("doc_id") % 7 != 2).collect()
    counts = collections.Counter()
    for i, t in rows:
        if i % 7 != 2:
            counts.update([*words_of(lower(t)), None])
    n, v = sum(counts.values()), len(counts)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        own = [*words_of(lower(texts[r["doc_id"]])), None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[x] > 0 for x in own), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in own))
        assert r["score"] < 0
    assert lm.score(empty, vocabulary(), F.lit(True)).count() == 0


def test_lm_ids_are_words_and_shared_ids_hold_exact_counts(docs, rows, empty):
    """A text has one id a word; words that share an id divide its probability by their counts, to a sum of one."""
    size = 60
    encoded, n_ids = lm.encode(docs, F.col("doc_id") % 7 != 2, size)
    texts, shared = dict(rows), int(size * lm.SHARED)
    counts = collections.Counter(x for i, t in rows if i % 7 != 2 for x in words_of(lower(t)))
    ids, got = {}, encoded.collect()
    for r in got:
        own, found = words_of(lower(texts[r["doc_id"]])), np.frombuffer(r["ids"], np.uint16)
        assert len(own) == len(found) and all(ids.setdefault(x, i) == i for x, i in zip(own, found))
    assert len(got) == len(rows) and shared < n_ids <= size and max(ids.values()) < n_ids
    alone = {x for x, i in ids.items() if i >= shared}
    assert len({ids[x] for x in alone}) == len(alone) == n_ids - shared
    assert min(counts[x] for x in alone) > max(counts[x] for x in ids if x not in alone) > 1
    below = collections.Counter()
    for x in counts:
        below[ids[x]] += counts[x] + 1
    for r in got:
        own = [x for x in words_of(lower(texts[r["doc_id"]])) if x not in alone]
        assert r["within"] == pytest.approx(sum(np.log10((counts[x] + 1) / (below[ids[x]] + 1)) for x in own))
    assert lm.encode(empty, F.lit(True), size)[0].count() == 0


def test_lm_learns_more_than_the_unigram_base(spark):
    """Texts walk through words that name the next kind of word; the model must score unseen walks above single words."""
    rng = np.random.default_rng(8)
    texts = [" ".join("abcdefgh"[(i + at) % 8] + str(rng.integers(0, 30)) for at in range(60)) for i in range(400)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lm.score(table, vocabulary(), F.col("doc_id") % 5 != 0).filter("doc_id % 5 = 0").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[1] < got[0] < 0


def test_lm_trains_on_every_window(spark):
    """Every id of every training text is a target once, in each copy, also beyond a million ids."""
    rng = np.random.default_rng(6)
    vocabulary = 500
    texts = [rng.integers(0, vocabulary, n) for n in (0, 1, 23, 24, 25, 64 * 24 - 1, 64 * 24, 5000, *[26_000] * 45)] + [np.arange(30)] * 3
    data = [(i, i, i != 4, x.astype(np.uint16).tobytes()) for i, x in enumerate(texts)]
    encoded = spark.createDataFrame(data, "doc_id long, text_key long, train boolean, ids binary").repartition(5)
    seen, pairs = np.zeros(vocabulary + 1, np.int64), 0
    for r in lm.training_pieces(encoded, vocabulary).collect():
        rows = lm._windows_of(np.frombuffer(r["ids"], np.uint16).astype(np.int32), r["lead"])
        assert len(rows) == r["windows"]
        inputs, targets = rows[:, : lm.SPAN], rows[:, lm.SPAN :]
        seen += np.bincount(targets[targets >= 0], minlength=vocabulary + 1)
        assert ((inputs[:, lm.BACK :] >= 0) == (targets >= 0)).all() and (inputs[1:, : lm.BACK] == inputs[:-1, lm.STEP :]).all()
        assert (inputs[:, lm.BACK + 1 :] == targets[:, :-1])[targets[:, 1:] >= 0].all()
    counts = lm.id_counts(encoded, vocabulary)
    assert counts.sum() > 1_000_000 and (seen == counts).all()


def test_lm_is_normalised_causal_and_window_free():
    """The probabilities of all texts of up to eight of three ids sum to one, but for longer texts; a look ahead would break that."""
    rng = np.random.default_rng(0)
    counts = np.array([1, 2, 1, 8])  # the last id ends a text
    scorer = lm.Scorer(lm.start_weights(), lm.Tables.of(counts, lm.start_share(counts)))
    sums = []
    for n in range(9):
        texts = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T if n else np.zeros((1, 0), np.int64)
        sums.append(float((10 ** scorer.log10(texts.reshape(-1), np.full(len(texts), n))).sum()))
    assert 0 < sums[8] < sums[4] < sums[0] < 1
    left = 1 - sum(sums)
    assert 0 < left < 2 * sums[8] / (1 - sums[8] / sums[7])  # the tail falls as the last two do
    counts = rng.integers(0, 9, 41)
    scorer = lm.Scorer(lm.start_weights(), lm.Tables.of(counts, lm.start_share(counts)))
    prefix = rng.integers(0, 40, 30)
    several = scorer.log10(np.concatenate([prefix, prefix[:5], prefix]), np.array([30, 5, 30]))
    assert several[1] == pytest.approx(scorer.log10(prefix[:5], np.array([5]))[0], rel=1e-4)
    assert several[0] == pytest.approx(several[2], rel=1e-4)


def test_lm_gradient():
    rng = np.random.default_rng(1)
    w = {k: x.astype(np.float64) for k, x in lm.start_weights().items()}
    place, emit = rng.random((2, lm.SPAN, lm.MIX)), rng.random((2, lm.STEP, lm.MIX))
    seen, valid = np.repeat((lm.DISTANCE >= 0)[None], 2, axis=0), np.ones((2, lm.STEP), bool)
    loss, n, g, _ = lm.gradient(w, place, emit, seen, valid)
    for k in w:
        at = tuple(s // 2 for s in w[k].shape)
        moved = {m: x.copy() for m, x in w.items()}
        moved[k][at] += 1e-5
        assert (lm.gradient(moved, place, emit, seen, valid)[0] - loss) / n / 1e-5 == pytest.approx(float(g[k][at]), rel=0.02, abs=1e-5)


def test_lm_training_does_not_depend_on_the_parts_of_a_step(monkeypatch):
    """Gaps lie in some windows; every target counts once, and small parts give the weights of whole steps."""
    rng = np.random.default_rng(2)
    counts = rng.integers(1, 99, 41)
    tables = lm.Tables.of(counts, lm.start_share(counts))
    inputs, targets = rng.integers(0, 41, (700, lm.SPAN)), rng.integers(0, 41, (700, lm.STEP))
    inputs[::9, :5], inputs[5::70, -7:], targets[5::70, -7:] = -1, -1, -1
    found = []
    for part, held in ((lm.BATCH, lm.BATCH), (lm.PART, lm.HELD), (7, 3 * lm.BATCH)):
        monkeypatch.setattr(lm, "PART", part)
        monkeypatch.setattr(lm, "HELD", held)
        found.append(lm.train_share(lm.start_weights(), tables, inputs, targets))
    for w, seen, loss, n in found:
        assert n == (targets >= 0).sum() and loss == pytest.approx(found[0][2], rel=1e-4)
        assert seen.sum(axis=1) == pytest.approx(np.bincount(targets[targets >= 0], minlength=41), rel=1e-4)
        assert seen == pytest.approx(found[0][1], rel=1e-2, abs=1e-2)
        assert lm.flat(w) == pytest.approx(lm.flat(found[0][0]), rel=1e-2, abs=1e-2)


def brute_stats(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics():
    texts = [None, "", "a b c a b c", "x\n\nx\n x\nx\r\n\n", "é#é |\ny", "\n\n", "\nq", prose(1, 500, 5), "a b c\na b c"]
    s = quality.text_stats(pa.array(texts, pa.string()))
    got = list(zip(*(s[k].tolist() for k in quality.STATS[:5])))
    assert got == [brute_stats(t) for t in texts]


def test_quality_verdicts(spark, docs, empty):
    good = [(i, prose(i, 100), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{x}$$$ |" for x in prose(i, 80).split()), 0) for i in range(30)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, kept int")
    measured = quality.measure(table)
    model = quality.fit(measured)
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(measured, model).collect()}
    assert all(judged[i] for i, *_ in good) and not any(judged[i] for i, *_ in bad)
    kept = quality.keep(table, model)
    assert kept.columns == table.columns and kept.count() == len(good)
    nothing = quality.fit(quality.measure(empty))
    assert quality.judge(quality.measure(empty), nothing).count() == 0 and quality.keep(docs, nothing).count() == 0


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline as C

    folder = str(tmp_path)
    texts = [(i, prose(i, 120, 500), "en", f"s{i % 2}", 1) for i in range(40)]
    texts += [(100, texts[3][1], "en", "s0", 1), (101, None, None, None, None), (102, "spam " * 90, "en", "s1", 1), (103, texts[5][1] + " " + prose(7777, 25, 500), "en", "s1", 1)]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, prose(7777, 25, 500))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    stage, current = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, fn in C.STAGES:
        current = fn(spark, current, folder)
        current.write.parquet(f"{folder}/{name}")
        current = spark.read.parquet(f"{folder}/{name}")
        stage[name] = current
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(stage[n].columns == columns for n in list(stage)[:-1])
    ids = {n: sorted(r["doc_id"] for r in d.select("doc_id").collect()) for n, d in stage.items()}
    assert ids["quality"] == [*range(40), 100, 103]
    assert ids["near_duplicates"] in ([*range(40)], [*range(40), 103])
    assert ids["decontaminate"] == [i for i in ids["near_duplicates"] if i != 103]
    assert set(ids["mix"]) <= set(ids["decontaminate"]) and ids["tokens"] == ids["mix"]
    assert sorted(r["doc_id"] for r in C.run(spark, folder).collect()) == ids["tokens"]


def test_a_stage_called_alone_gets_small_batches(spark, docs):
    import corpus_pipeline as C
    from provisio.llm.store import BATCH, settings

    table = spark.range(0, C.BATCH_ROWS + 500, 1, 1).select(F.col("id").alias("doc_id"), F.lit(prose(1, 120, 500)).alias("text"))
    with settings(spark, {BATCH: "10000"}):
        kept = C.quality_stage(spark, table, "")
        sizes = [r["n"] for r in kept.mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long").collect()]
    assert sum(sizes) == C.BATCH_ROWS + 500 and max(sizes) <= C.BATCH_ROWS


def test_workers_give_free_memory_back_after_a_task(monkeypatch):
    from provisio.llm import store

    freed = []
    monkeypatch.setattr(store, "release", lambda: freed.append(1))
    run = store.tidy(lambda batches: (b + 1 for b in batches))
    assert list(run([1, 2])) == [2, 3] and freed == [1]


def test_own_column_names_do_not_clash(docs):
    odd = docs.filter("doc_id in (0, 1, 7, 14)").select("*", *[F.lit(c).alias(c) for c in ("__doc", "__row_", "__Row", "__copies", "__copy")])
    for out in (setjoin.keep_one(odd), mixing.mix(odd)):
        assert out.columns == odd.columns and out.count() > 0
        assert out.filter("__doc <> '__doc' or __copy <> '__copy' or __copies <> '__copies' or __row_ <> '__row_'").count() == 0

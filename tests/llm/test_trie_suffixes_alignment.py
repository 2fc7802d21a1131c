"""Suffix dedup, conversation trie and tokenizer alignment against brute force, with odd rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from provisio.llm import alignment, suffixes, trie
from provisio.llm import words as W
from provisio.llm.queries import QUERIES, vocabulary

DOCS = "doc_id bigint, text string, n bigint, h0 bigint, kept string, spans int, source string"
TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, k0 string, part string"
A_PATH, B_PATH = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base, other = prose(1, 200), prose(2, 300)
    out = [(1, base), (2, base), (2, base), (3, base[:300] + "x" + base[300:]), (4, "x" + base[100:]), (5, other + base[40:260] + prose(3, 20)), (6, "a" * 900),
           (7, None), (8, ""), (None, prose(4, 90)), (None, None), (9, prose(5, 2000)), (10, prose(5, 1500)), (11, "short"), (12, "short"), (13, base[:199]),
           (14, base[:200]), (15, other), (16, prose(6, 120)), (17, prose(6, 120)[1:]), (18, "ab" * 150 + other[:230])]
    return out + [(100 + i, prose(7, 60) + prose(200 + i, 40)) for i in range(30)]


def brute_cut(texts, depth):
    raw = [(t or "").encode() for _, t in texts]
    seen = collections.Counter(r[p : p + depth] for r in raw for p in range(len(r) - depth + 1))
    out = []
    for (doc_id, _), r in zip(texts, raw):
        gone = np.zeros(len(r) + 1, bool)
        for p in range(len(r) - depth + 1):
            if seen[r[p : p + depth]] > 1:
                gone[p : p + depth] = True
        gone[-1] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((doc_id, len(r), [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])], kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("depth, piece", [(200, 1 << 20), (200, 512), (40, 300), (32, 1 << 20), (8, 100)])
def test_suffixes_match_brute_force(spark, texts, depth, piece, monkeypatch):
    rows = [(i, t, 3, 4, "k", 5, "s") for i, t in texts]
    # Pieces shorter than a text: checked in this process, as workers read the module anew.
    monkeypatch.setattr(suffixes, "PIECE", piece)
    frame = spark.createDataFrame(rows, DOCS)
    if piece == 1 << 20:
        got = suffixes.remove_repeats(frame.repartition(4), depth).collect()
        assert sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got), key=str) == brute_cut(texts, depth)
        return
    raw = sorted({t for _, t in texts if t and len(t.encode()) >= depth})
    import pyarrow as pa

    starts = np.zeros(len("".join(raw).encode()), int)
    digits = collections.defaultdict(set)
    for p in suffixes._pieces(pa.array(raw), depth):
        key = p.windows()[0]
        for i in np.flatnonzero(p.inside):
            starts[p.lo + i] += 1
            digits[int(key[i])].add(int(p.lead[i]))
        assert (p.cover(np.ones(len(p.start), bool)) == p.inside).all()  # stretches hold all windows
    sizes = [len(t.encode()) for t in raw]
    want = np.concatenate([np.arange(n, 0, -1) >= depth for n in sizes])
    assert (starts == want).all() and all(len(x) == 1 for x in digits.values())


def test_suffixes_odd_tables(spark, texts):
    empty = spark.createDataFrame([], DOCS)
    assert suffixes.remove_repeats(empty).count() == 0
    one = suffixes.remove_repeats(spark.createDataFrame([(1, "q" * 199 + "é", 0, 0, "", 0, "")], DOCS)).collect()
    assert [(r["n_bytes"], r["spans"], bytes(r["kept"])) for r in one] == [(201, [], ("q" * 199 + "é").encode())]
    hot = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("z " * 150).alias("text"))
    got = suffixes.remove_repeats(hot.union(spark.createDataFrame([(1, prose(9, 100))], "doc_id bigint, text string"))).groupBy("doc_id", "kept").count().collect()
    assert sorted(r["count"] for r in got) == [1, 3000]


def test_rolling_hash_equals_that_of_ranges():
    buf = np.frombuffer(prose(11, 500).encode(), np.uint8)
    at = np.arange(len(buf) - 36)
    for lane in range(2):
        assert (W.rolling(buf, 37, lane) == W.hash_ranges(buf, at, at + 37, lane)).all()
    assert len(W.rolling(buf[:5], 37)) == 0


def test_suffix_query(spark, texts, tmp_path):
    write(spark, tmp_path, "documents", [(i, t, 0, 0, "", 0, "") for i, t in texts], DOCS)
    got = sorted((tuple(r) for r in QUERIES["op11_depth_limited_sort"](spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == sorted(((i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute_cut(texts, 200)), key=str)


def turns_of(seed, convs):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, 12)):
            if rng.random() < 0.9:
                rows.append((c if c % 7 else -c, t if rng.random() < 0.95 else None, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "", None, "é"]) if rng.random() < 0.8 else f"own {c}"))
    rows += [(60, i, "user", f"long {i // 3}") for i in range(40)] + [(65, 0, "u", "same")] * 3 + [(None, 1, "u", "lost")]
    rows += [(c, t, "sys", f"hot {t}") for c in range(200, 260) for t in range(3)]
    return rows


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        full[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed, tmp_path):
    rows = turns_of(seed, 60)
    write(spark, tmp_path, "conversations", [(*r, 1, "x", "y") for r in rows], TURNS)
    got = QUERIES["op12_contracted_trie"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_trie(rows)


def test_trie_odd_tables(spark, monkeypatch):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    monkeypatch.setattr(trie, "CHUNK", 16)  # one long conversation over many chunks, and one that loses all its turns
    rows = [(5, i, "user", f"t{i}") for i in range(300)] + [(3, 0, "u", "gone"), (None, 0, "u", "x")]
    got = trie.prefix_trie(spark.createDataFrame([(*r, 0, "", "") for r in rows], TURNS).repartition(5))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_trie(rows)


def brute_alignment(texts):
    coder = alignment.Coder(A_PATH, B_PATH)
    found, counts = [], collections.Counter()
    for doc_id, text in texts:
        row = (doc_id, [], [], [], [])
        if text:
            both = [(s.encode([" " + text])[0], s.bytes) for s in coder.sides]
            if all(b"".join(t[i] for i in ids) == (" " + text).encode() for ids, t in both):
                a, b = ([(i, int(e)) for i, e in zip(ids, np.cumsum([len(t[i]) for i in ids]))] for ids, t in both)
                common = sorted({e for _, e in a} & {e for _, e in b})
                links = [(i, j) for i, e in a for j, f in b if e == f] if len(a) < 3000 else None
                low, groups = 0, []
                for e in common:
                    groups.append("|".join(",".join(str(i) for i, f in side if low < f <= e) for side in (a, b)))
                    low = e
                row = (doc_id, a, b, groups, links)
                counts.update(links)
        found.append(row)
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted(((d, len(a), len(b), len(g), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, a, b, g, k in found), key=str)


def test_alignment_matches_brute_force(spark, texts, tmp_path, monkeypatch):
    odd = [" ", "a", "▁ x", "a  b\n\n c", "<s> <|endoftext|> <0x41> é中文 ｆ ① 　x", "x\x00y", "  lead trail  ", "don't  's", "  a  b", "tab\tend", "\n"]
    rows = [(i, t) for i, t in texts if t is None or len(t) < 3000] + [(500 + i, t) for i, t in enumerate(odd)]
    write(spark, tmp_path, "documents", [(i, t, 0, 0, "", 0, "") for i, t in rows], DOCS)
    got = QUERIES["op13_token_alignment"](spark, str(tmp_path))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == brute_alignment(rows)
    assert alignment.alignment(spark.createDataFrame([], DOCS), A_PATH, B_PATH).count() == 0


def test_alignment_without_cuts_is_the_same(texts):
    import pyarrow as pa

    coder, whole = alignment.Coder(A_PATH, B_PATH), alignment.Coder(A_PATH, B_PATH)
    whole.cuts = False
    ids, column = pa.array([i for i, _ in texts]), pa.array([t for _, t in texts])
    assert coder.cuts and alignment.align(coder, ids, column, True).equals(alignment.align(whole, ids, column, True))


def test_byte_level_ids_equal_the_library(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    rng = random.Random(8)
    odd = [" " + "".join(rng.choice("ab Zé中'sdt.,!0١ \n\t　\x85\x1c<|endoftext|>ſ") for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    odd += [" <|endoftext|>", " don't we'll I'M", " x y"] + [" " + t for _, t in texts if t]
    ours = alignment.ByteLevel(A_PATH)
    assert ours.encode(odd) == [e.ids for e in library.encode_batch(odd, add_special_tokens=False)]
    assert all(b"".join(ours.bytes[i] for i in ids) == t.encode() for ids, t in zip(ours.encode(odd), odd))

"""Alignment of two tokenizers over all texts, with corpus-wide counts of the id pairs that end together.

One pass over the texts in Arrow columns: the ids of both tokenizers are flattened with their parents (the
document of each token), the bytes of tokens are summed up inside each document, and an Acero hash join of both sides
on (document, end) finds the ends they share. Those ends cut the tokens into groups; a pair of tokens with the
same end is a link. ``Table.group_by`` counts the links of each block of texts by pair of ids, Spark sums these
partial counts and takes the highest of each B id, and each block is told the counts of its own pairs by one
shuffle: a pair that is everywhere is one row for each block, not one for each link.

Texts are cut into chunks before encoding, at a space between two printable ASCII characters. The byte-level
splitter always begins a piece there, and no piece of the other model crosses it (looked up in its vocabulary, else texts stay
whole), so chunks have the ids that they have in the text, and each distinct chunk of a batch is encoded once. Blocks
(about ``BLOCK`` bytes of text) are stored as Arrow IPC messages, so that texts are encoded once and do not travel.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for byte (the
second writes U+2581 for a space), have no tokens: zeros and an empty ``groups``; rows with equal or null ``doc_id``
are rows of their own, and all count; an empty table gives an empty table; only ``doc_id`` and ``text`` are read; a text longer
than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import store

PIECE = 1 << 20  # bytes of text that are aligned at once
BLOCK = 4 << 20  # bytes of text whose links are counted and told together
SPACE = "▁"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


# Fixed value: how byte-level files split a text before merging.
BYTE_LEVEL_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Tokenizer file of the byte-level kind; reads texts with the space that stands before them.

    Entries number the merges in their order, so the file is also a table of ranks, which tiktoken encodes
    several times faster than the library of the file. A special entry has no bytes and never comes from a text.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        split, vocabulary, merges = content["pre_tokenizer"], content["model"]["vocab"], content["model"]["merges"]
        if split != {**split, "type": "ByteLevel", "use_regex": True, "add_prefix_space": False} or content["normalizer"] is not None:
            raise ValueError(f"not a plain byte-level tokenizer: {path}")
        ids = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if ids != sorted(ids):
            raise ValueError(f"entries do not follow the order of merges: {path}")
        special = {t["content"] for t in content["added_tokens"]}
        table = byte_of_character()
        self.bytes = [b""] * (max([*vocabulary.values(), *(t["id"] for t in content["added_tokens"])]) + 1)
        for entry, i in vocabulary.items():
            if entry not in special:
                self.bytes[i] = bytes(table[c] for c in entry)
        ranks = {b: i for i, b in enumerate(self.bytes) if b}
        self.splits_at_spaces = True
        self.encoding = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(c) for c in chunks]


class Pieces:
    """Model file of pieces with byte fallback; adds the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode([c[1:] for c in chunks], num_threads=1)


class Coder:
    """Ids of the distinct chunks of a batch, by both tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = (ByteLevel(a_path), Pieces(b_path))
        self.lengths = [np.array([len(x) for x in s.bytes], np.int64) for s in self.sides]
        self.cuts = all(s.splits_at_spaces for s in self.sides)
        self.size_b = len(self.sides[1].bytes)
        self.kinds = [pa.uint16() if len(s.bytes) <= 1 << 16 else pa.int32() for s in self.sides]  # of stored ids

    def chunks(self, offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Chunks of all texts, a space before each text, and the first chunk of each text."""
        n = len(offsets) - 1
        begins = offsets[:-1] + np.arange(n)
        full = np.full(len(data) + n, 32, np.uint8)
        text = np.ones(len(full), bool)
        text[begins] = False
        full[text] = data
        some = np.diff(offsets) > 0
        starts = np.zeros(len(full), bool)
        starts[begins[some]] = True
        if self.cuts and len(full) > 2:
            ink = (full > 32) & (full < 127)
            starts[1:-1] |= (full[1:-1] == 32) & ink[:-2] & ink[2:] & text[1:-1]
        # The lone space of an empty text belongs to no chunk.
        keep = np.repeat(some, np.diff(offsets) + 1)
        moved = np.concatenate([[0], np.cumsum(keep)])
        full, cut = np.ascontiguousarray(full[keep]), np.flatnonzero(starts[keep])
        ends = np.append(cut, len(full)).astype(np.int32)
        array = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(full)])
        return array, np.searchsorted(cut, moved[np.append(begins, offsets[-1] + n)])

    def encode(self, distinct: list[bytes]) -> tuple[list[pa.ListArray], np.ndarray]:
        """Ids of each chunk by both tokenizers, and whether both give its bytes back."""
        texts, lists, good = [c.decode() for c in distinct], [], np.ones(len(distinct), bool)
        for side in self.sides:
            ids, own = side.encode(texts), side.bytes
            good &= np.fromiter((b"".join([own[i] for i in x]) == c for x, c in zip(ids, distinct)), bool, len(distinct))
            lists.append(pa.array(ids, pa.list_(pa.int32())))
        return lists, good


def _tokens(ids: pa.ListArray, first: np.ndarray, lengths: np.ndarray) -> pa.Table:
    """Columns doc, id, end (in bytes of its document) and total (in bytes of all): flattened lists with segmented sums."""
    flat, chunk = pc.list_flatten(ids), pc.list_parent_indices(ids).to_numpy()
    doc = np.searchsorted(first, chunk, side="right") - 1
    size = pc.take(pa.array(lengths), flat)
    total = pc.cumulative_sum(size).to_numpy()
    begin = np.searchsorted(doc, np.arange(len(first) - 1))
    base = np.where(begin > 0, total[np.maximum(begin, 1) - 1], 0) if len(total) else np.zeros(len(begin), np.int64)
    return pa.table({"doc": doc, "id": flat, "end": total - base[doc] if len(total) else total, "total": total})


def _joined_ids(tokens: pa.Table, ends: np.ndarray) -> pa.Array:
    """Comma-joined ids of the tokens up to each of the ascending common ends."""
    last = np.searchsorted(tokens["total"].to_numpy(), ends, side="right")
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last]).astype(np.int32)), tokens["id"].combine_chunks().cast(pa.string()))
    return pc.binary_join(lists, ",")


def align(coder: Coder, ids: pa.Array, texts: pa.Array, with_groups: bool = False) -> pa.Table:
    """One row per text: doc_id, n_a, n_b, n_groups, groups_sha256, the linked ids a and b (and the groups)."""
    offsets, data = W.as_bytes(texts)
    n = len(offsets) - 1
    chunks, first = coder.chunks(offsets, data)
    chunks = chunks.dictionary_encode()
    (a, b), good = coder.encode(chunks.dictionary.to_pylist())
    place = chunks.indices.to_numpy()
    row = np.repeat(np.arange(n), np.diff(first))
    whole = np.bincount(row[~good[place]], minlength=n) == 0
    place, row = place[whole[row]], row[whole[row]]
    first = np.searchsorted(row, np.arange(n + 1))
    a, b = (_tokens(pc.take(x, pa.array(place)), first, coder.lengths[i]) for i, x in enumerate((a, b)))
    links = a.rename_columns(["doc", "a", "end", "total"]).join(b.select(["doc", "id", "end"]).rename_columns(["doc", "b", "end"]), ["doc", "end"], join_type="inner")
    links = links.sort_by([("total", "ascending"), ("a", "ascending"), ("b", "ascending")])
    doc, total = links["doc"].to_numpy(), links["total"].to_numpy()
    new = np.ones(len(total), bool)
    new[1:] = total[1:] != total[:-1]
    ends, owner = total[new], doc[new]
    pairs = pc.binary_join_element_wise(_joined_ids(a, ends), _joined_ids(b, ends), "|")
    by_doc = np.searchsorted(owner, np.arange(n + 1))
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(by_doc.astype(np.int32)), pairs), ";")
    has = np.diff(by_doc) > 0
    digests = [hashlib.sha256(g.as_buffer()).hexdigest() if h else "" for g, h in zip(groups, has)]
    spots = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
    out = {
        "doc_id": ids, "n_a": np.bincount(a["doc"].to_numpy(), minlength=n), "n_b": np.bincount(b["doc"].to_numpy(), minlength=n),
        "n_groups": np.diff(by_doc), "groups_sha256": pa.array(digests, pa.string()),
        **{c: pa.ListArray.from_arrays(spots, links[c].combine_chunks().cast(kind)) for c, kind in zip("ab", coder.kinds)},
    }
    return pa.table({**out, "groups": groups} if with_groups else out)


def _message(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _read(message) -> pa.Table:
    return pa.ipc.open_stream(message.as_buffer()).read_all()


def _blocks(a_path: str, b_path: str):
    def run(batches):
        coder, part, number, held, size = Coder(a_path, b_path), TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            length = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                before = length[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(length, before + PIECE, side="right")))
                held.append(align(coder, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)))
                size += int(length[hi - 1] - before)
                lo = hi
                if size >= BLOCK:
                    yield _block(part, number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _block(part, number, held)

    return run


def _block(part: int, number: int, held: list[pa.Table]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part << 32 | number]), pa.array([_message(pa.concat_tables(held))], pa.binary())], names=["block", "data"])


def _codes(table: pa.Table, size_b: int) -> np.ndarray:
    """Code of the id pair of each link."""
    a, b = (pc.list_flatten(table[c]).to_numpy().astype(np.int64) for c in "ab")
    return a * size_b + b


def _partial_counts(size_b: int):
    def run(batches):
        for batch in batches:
            for block, message in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = pa.table({"code": _codes(_read(message), size_b)}).group_by("code").aggregate([("code", "count")])
                part = pa.table({"block": np.full(counts.num_rows, block, np.int64), "code": counts["code"], "n": counts["code_count"]})
                yield from part.to_batches(max_chunksize=1 << 16)

    return run


def _finish(size_b: int):
    def run(key, blocks, told):
        order = np.argsort(told["code"].to_numpy())
        known, count, best = (told[c].to_numpy()[order] for c in ("code", "n", "is_best"))
        out = []
        for message in blocks.column("data"):
            table = _read(message)
            at = np.searchsorted(known, _codes(table, size_b))  # every pair of the block was told
            n_links = pc.list_value_length(table["a"]).to_numpy().astype(np.int64)
            ends = np.cumsum(n_links)
            sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)]) for x in (best, count)]
            n_best, count_sum = (x[ends] - x[ends - n_links] for x in sums)
            out.append(pa.table({
                "doc_id": table["doc_id"], "n_a": table["n_a"], "n_b": table["n_b"], "n_groups": table["n_groups"],
                "n_links": n_links, "n_best": n_best, "count_sum": count_sum, "groups_sha256": table["groups_sha256"]}))
        return pa.concat_tables(out)

    return run


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``block`` and ``data``: the alignment of all texts as Arrow IPC messages."""
    return docs.select("doc_id", "text").mapInArrow(_blocks(a_path, b_path), "block bigint, data binary")


def pair_counts(blocks: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """Links by (block, code of the pair), and in all (code, n, is_best: the highest of its B id)."""
    partial = store(blocks.mapInArrow(_partial_counts(size_b), "block bigint, code bigint, n bigint"), "align-partial")
    counts = partial.groupBy("code").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.col("code") % size_b)  # at most as many rows as there are A ids
    return partial, counts.select("code", "n", (F.col("n") == F.max("n").over(of_b)).cast("int").alias("is_best"))


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    size_b = Coder(a_path, b_path).size_b
    blocks = store(aligned_blocks(docs, a_path, b_path), "align-blocks")
    partial, counts = pair_counts(blocks, size_b)
    told = partial.select("block", "code").join(store(counts, "align-counts"), "code")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _finish(size_b), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

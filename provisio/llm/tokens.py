"""Token ids as binary files: Arrow streams of fixed-size-list batches.

The ids of all documents, each closed by an end id, form one long sequence in ascending ``doc_id``
order, cut into sequences of equal length. A file is an Arrow IPC *stream* with the columns

* ``ids``: fixed-size list of unsigned integers (16 bits where the vocabulary fits, else 32),
* ``mask``: fixed-size list of bits, 0 for padding (only behind the last id of a file),
* ``last``: fixed-size list of bits, 1 for the last id of a document.

All record batches of a file have the same number of rows, hence the same size in bytes: the place of
any sequence follows by arithmetic, and :class:`SequenceFile` maps the file and hands out numpy
views of the ids without reading or copying anything else (bits are unpacked for the sequence asked for). Beside each file stands its document index (another
Arrow stream: doc_id, n_tokens).

A task writes one file from one range of ``doc_id`` values, as a stream of bounded memory. Only the
manifest, a row per file, reaches the driver.

Defined results: a null text is empty and gives just the end id; rows with the same ``doc_id``
are encoded one by one in the order of their texts; a null ``doc_id`` comes first; an empty table
writes no file; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import words as W
from provisio.llm.store import BATCH, file_system, settings, tidy
from provisio.session import new_path

LENGTH = 2048  # ids of a sequence
ROWS = 64  # sequences of a batch
MEMORY_RUNS = 1_000_000  # runs whose ids a task remembers (some 50 bytes each)
FILE_BYTES = 64 << 20  # of text behind one file, on average
ENCODE_BYTES = 1 << 19  # of text that are encoded at once
BATCH_ROWS = 2000  # texts that come to a task at once


# Classes of bytes inside a word.
LETTER, SIGN, OTHER = 1, 2, 3
KINDS = np.full(256, OTHER, np.uint8)
KINDS[W.SPACE] = 0
KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = SIGN
KINDS[[c for c in range(128) if chr(c).isalpha()]] = LETTER


class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library.

    ``white_space_splits``: the tokenizer drops white space and case, and encodes runs of letters
    and runs of signs apart. The ids of a text are then those of its runs, and each distinct run
    (found by a 64-bit hash) is encoded by the library once and remembered. Words with anything but Latin
    letters and ASCII signs are one run; texts with "<|", which may begin a special token, go to
    the library whole.
    """

    def __init__(self, path: str, white_space_splits: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.splits = white_space_splits
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending keys, their entry
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, keys: np.ndarray, runs: list[bytes]) -> None:
        found = self._library([r.decode() for r in runs])
        sizes = np.array([len(f) for f in found], np.int64)
        entry = len(self.start) - 1 + np.arange(len(keys))
        self.flat = np.concatenate([self.flat, np.array([i for f in found for i in f], np.uint32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        at = np.searchsorted(self.keys, keys)  # keys come ascending
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, entry)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.place[at], -1)

    def _runs(self, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the runs of all words."""
        kind = KINDS[w.buf]
        lead = np.flatnonzero((w.buf >= 0xC3) & (w.buf <= 0xC9))  # two bytes: U+00C0 to U+027F
        lead = lead[lead + 1 < len(w.buf)]
        second = w.buf[lead + 1]
        signs = (w.buf[lead] == 0xC3) & ((second == 0x97) | (second == 0xB7))
        fine = ~(signs | (w.buf[lead] == 0xC4) & (second == 0xB0))  # the dotted capital I becomes a letter and a mark
        kind[lead[fine]] = kind[lead[fine] + 1] = LETTER
        length = w.end - w.start
        others = np.concatenate([[0], np.cumsum(kind == OTHER)])
        mixed = others[w.end] > others[w.start]
        inside = kind[w.inside]
        inside[np.repeat(mixed, length)] = OTHER
        kind[w.inside] = inside
        begins = np.zeros(len(kind) + 1, bool)
        begins[1:-1] = kind[1:] != kind[:-1]
        begins[w.start] = True
        begins[:-1] &= kind > 0
        begin = np.flatnonzero(begins)
        ends = np.searchsorted(w.end, begin, side="right")
        return begin, np.minimum(np.append(begin[1:], len(kind)), w.end[ends])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow column (or list) end to end, and the number of ids of each text."""
        texts = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string())
        if not self.splits:
            found = self._library([t or "" for t in texts.to_pylist()])
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for w in W.split(texts, lower=True):
            if len(self.keys) > MEMORY_RUNS:
                self._forget()
            begin, end = self._runs(w)
            keys = W.hash_ranges(w.buf, begin, end)
            entry = self._known(keys)
            if len(new := np.flatnonzero(entry < 0)):
                unique, first = np.unique(keys[new], return_index=True)
                raw = w.buf.tobytes()
                self._remember(unique, [raw[begin[i] : end[i]] for i in new[first]])
                entry = self._known(keys)
            size = self.start[entry + 1] - self.start[entry]
            ends = np.concatenate([[0], np.cumsum(size)])
            own = self.flat[np.repeat(self.start[entry] - ends[:-1], size) + np.arange(int(ends[-1]))]
            count = np.diff(ends[np.searchsorted(begin, w.offsets)])
            special = np.flatnonzero((w.buf[:-1] == 60) & (w.buf[1:] == 124))  # "<|"
            if len(special):
                rows = np.unique(np.searchsorted(w.offsets, special, side="right") - 1)
                parts = np.split(own, np.cumsum(count)[:-1])
                for row, found in zip(rows, self._library([texts[w.lo + int(r)].as_py() for r in rows])):
                    parts[row], count[row] = np.array(found, np.uint32), len(found)
                own = np.concatenate(parts)
            ids.append(own)
            counts.append(count)
        return np.concatenate(ids), np.concatenate(counts)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, white_space_splits: bool = True) -> Encoder:
    """The encoder of this worker process."""
    key = (path, white_space_splits)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, white_space_splits)
    return _ENCODERS[key]


def text_pieces(texts: pa.Array, piece: int = W.PIECE):
    """(first, last) rows of slices of a bounded number of bytes."""
    offsets, _ = W.as_bytes(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + piece, side="right")) - 1)
        yield lo, hi
        lo = hi


class SequenceWriter:
    """Writes a stream of ids as equal batches of equal sequences."""

    def __init__(self, sink, dtype, length: int, rows: int):
        if length % 8:
            raise ValueError("the length of a sequence must be a multiple of 8, so that its bits begin with a byte")
        self.dtype, self.length, self.rows = np.dtype(dtype), length, rows
        kinds = {"ids": pa.from_numpy_dtype(self.dtype), "mask": pa.bool_(), "last": pa.bool_()}
        self.schema = pa.schema([(name, pa.list_(pa.field("item", kind, False), length)) for name, kind in kinds.items()])
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.ids, self.last = [], []
        self.held = self.sequences = 0

    def add(self, ids: np.ndarray, last: np.ndarray) -> None:
        self.ids.append(ids.astype(self.dtype))
        self.last.append(last)
        self.held += len(ids)
        if self.held >= self.length * self.rows:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.last)
        step, mask = self.length * self.rows, np.ones(len(ids), bool)
        if last and len(ids) % self.length:
            fill = self.length - len(ids) % self.length
            ids, mask, ends = (np.pad(x, (0, fill)) for x in (ids, mask, ends))
        at = 0
        while len(ids) - at >= step or last and at < len(ids):
            n = min(step, len(ids) - at)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[at : at + n]), type=f.type) for x, f in zip((ids, mask, ends), self.schema)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.sequences += n // self.length
            at += n
        self.ids, self.last, self.held = [ids[at:]], [ends[at:]], len(ids) - at

    def close(self) -> None:
        if self.held:
            self._flush(True)
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of a file; arrays are views of the mapped file.

    The place of the batches follows from the first one: the schema message and then batches of
    the same size, only the last may be shorter.
    """

    def __init__(self, path: str, sequences: int, length: int, rows: int):
        fs, name = file_system(path)
        self.file = pa.memory_map(name) if fs.type_name == "local" else fs.open_input_file(name)
        self.sequences, self.length, self.rows = sequences, length, rows
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.file)) if sequences else None
        self.head = self.file.tell()
        if sequences:
            pa.ipc.read_message(self.file)
            self.step = self.file.tell() - self.head

    def batch(self, number: int) -> pa.RecordBatch:
        self.file.seek(self.head + number * self.step)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    @staticmethod
    def _bits(column: pa.FixedSizeListArray, at: int, n: int) -> np.ndarray:
        packed = np.frombuffer(column.values.buffers()[1], np.uint8)[at // 8 : (at + n) // 8]
        return np.unpackbits(packed, bitorder="little").view(bool)

    def _part(self, number: int) -> tuple[pa.RecordBatch, int]:
        return self.batch(number // self.rows), number % self.rows * self.length

    def ids(self, number: int) -> np.ndarray:
        """A view of the file."""
        batch, at = self._part(number)
        return batch.column(0).values.to_numpy(zero_copy_only=True)[at : at + self.length]

    def mask(self, number: int) -> np.ndarray:
        batch, at = self._part(number)
        return self._bits(batch.column(1), at, self.length)

    def last(self, number: int) -> np.ndarray:
        batch, at = self._part(number)
        return self._bits(batch.column(2), at, self.length)

    def batches(self):
        """(ids, mask) of each batch, flat."""
        for number in range(-(-self.sequences // self.rows)):
            batch = self.batch(number)
            yield batch.column(0).values.to_numpy(zero_copy_only=True), self._bits(batch.column(1), 0, batch.num_rows * self.length)

    def close(self) -> None:
        self.file.close()


@dataclass(frozen=True)
class Manifest:
    """What was written: the folder, the shape, and per file (name, documents, ids, sequences)."""

    folder: str
    length: int
    rows: int
    files: tuple[tuple[str, int, int, int], ...]


def write_tokens(docs: DataFrame, vocabulary_path: str, end_id: int, length: int = LENGTH, rows: int = ROWS, white_space_splits: bool = True, folder: str | None = None) -> Manifest:
    """Encode all documents and write the files, in ascending ``doc_id`` order over the files."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        coder = encoder(vocabulary_path, white_space_splits)
        dtype = np.uint16 if max(coder.vocabulary, end_id + 1) <= 1 << 16 else np.uint32
        fs, base = file_system(folder)
        name, mark = f"part-{context.partitionId():05d}", context.taskAttemptId()
        paths = {kind: (f"{base}/.{name}.{kind}.{mark}", f"{base}/{name}.{kind}") for kind in ("arrows", "docs")}
        out = index = None
        documents = tokens = 0
        for batch in batches:
            for lo, hi in text_pieces(batch.column(1), ENCODE_BYTES):
                ids, counts = coder.encode(batch.column(1).slice(lo, hi - lo))
                closed = np.insert(ids, np.cumsum(counts), end_id)
                last = np.zeros(len(closed), bool)
                last[np.cumsum(counts + 1) - 1] = True
                if out is None:
                    fs.create_dir(base, recursive=True)
                    sinks = {k: fs.open_output_stream(p[0], compression=None) for k, p in paths.items()}
                    out = SequenceWriter(sinks["arrows"], dtype, length, rows)
                    index = pa.ipc.new_stream(sinks["docs"], index_schema(batch))
                out.add(closed, last)
                index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts + 1)], schema=index_schema(batch)))
                documents, tokens = documents + hi - lo, tokens + len(closed)
        if out is not None:
            out.close()
            index.close()
            for kind, sink in sinks.items():
                sink.close()
                fs.move(*paths[kind])
            yield pa.RecordBatch.from_pylist([{"file": name, "documents": documents, "tokens": tokens, "sequences": out.sequences}])

    with settings(spark, {BATCH: str(BATCH_ROWS)}):
        done = ordered.mapInArrow(tidy(run), "file string, documents long, tokens long, sequences long").collect()  # a row per file
    return Manifest(folder, length, rows, tuple(sorted((r["file"], r["documents"], r["tokens"], r["sequences"]) for r in done)))


def index_schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema([("doc_id", batch.schema.field(0).type), ("n_tokens", pa.int64())])


def read_documents(spark, manifest: Manifest, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (and its ids), one task per file."""
    starts, at = [], 0
    for name, _documents, tokens, sequences in manifest.files:
        starts.append((name, at, sequences))
        at += tokens
    folder, length, rows = manifest.folder, manifest.length, manifest.rows

    def run(batches):
        for batch in batches:
            for name, first, sequences in zip(*(c.to_pylist() for c in batch.columns)):
                yield from read_file(name, first, sequences)

    def read_file(name: str, first: int, sequences: int):
        sequence_file = SequenceFile(f"{folder}/{name}.arrows", sequences, length, rows)
        fs, base = file_system(folder)
        held = np.zeros(0, np.uint32)
        pieces = sequence_file.batches()
        with fs.open_input_stream(f"{base}/{name}.docs", compression=None) as source, pa.ipc.open_stream(source) as index:
            for docs in index:
                counts = docs.column(1).to_numpy()
                sums, ids = np.empty(len(counts), np.int64), []
                for i, n in enumerate(counts):
                    parts, have = [held], len(held)
                    while have < n:
                        block, mask = next(pieces)
                        block = block[mask].astype("<u4")
                        parts.append(block)
                        have += len(block)
                    held = np.concatenate(parts) if len(parts) > 1 else held
                    own, held = held[:n], held[n:]
                    sums[i] = zlib.crc32(own.tobytes())
                    if with_ids:
                        ids.append(own)
                begins = first + np.concatenate([[0], np.cumsum(counts)[:-1]])
                first += int(counts.sum())
                columns = [docs.column(0), pa.array(begins.astype(np.int64)), docs.column(1), pa.array(sums)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])
        sequence_file.close()

    listed = spark.createDataFrame(starts, "file string, first long, sequences long").repartition(max(1, len(starts)))
    return listed.mapInArrow(tidy(run), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)

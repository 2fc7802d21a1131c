"""WARC archives: writing, and the normaliser of monolithic gzip archives.

Crawlers and plain ``gzip`` leave archives that are one gzip stream; a record in the middle can
then only be reached by inflating everything before it. The normaliser inflates such a file once,
as a stream, writes every record as a gzip member of its own, and beside the archive an index
with the place of every record, so that a reader inflates just the records it wants.

* :func:`write_monolithic` writes one archive per task, each a single gzip stream.
* :func:`normalise` rewrites each archive in one task of bounded memory and returns the index.
* :func:`read_records` reads records at the places in an index.
* :func:`archive` does all three for a table of pages, with revisit records for equal payloads.

Defined results: a null payload is empty; a null url writes no target URI; pages with the same id are
records of their own, and the response among equal payloads with the same largest id is the one with
the largest url, null first (the others revisit it by the same id, rows equal in both are all responses);
a null id has no id header, comes back null and is revisited by none; an empty table gives no archives and an empty table; only the id, url and payload
columns are read. Files get their final name only when complete, so a repeated task leaves the same files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm.store import file_system
from provisio.session import new_path

MIN_REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # pages carry no time of capture
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNK = 1 << 20
INDEX = "file string, offset long, length long, record_type string, page_id long"


def _one_line(value: str) -> str:
    return "".join(" " if c in "\r\n" else c for c in value)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {_one_line(v)}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str) -> bytes:
    """Response with the whole payload, or revisit of the response with the same payload."""
    digest = hashlib.sha1(payload).digest()
    headers = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
                ("X-Payload-Length", str(len(payload)))]
    if refers_to is None:
        return record("response", headers, HTTP_HEAD + payload)
    headers += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    return record("revisit", headers, HTTP_HEAD)


class Inflated(io.RawIOBase):
    """The inflated bytes of a gzip file of any number of members, read in chunks."""

    def __init__(self, raw):
        self.raw, self.engine, self.ready = raw, zlib.decompressobj(31), b""

    def readable(self):
        return True

    def readinto(self, out) -> int:
        while not self.ready:
            data = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            data = data or self.raw.read(CHUNK)
            if not data:
                if not self.engine.eof:
                    raise EOFError("the gzip stream ends early")
                return 0
            if self.engine.eof:
                self.engine = zlib.decompressobj(31)
            self.ready = self.engine.decompress(data, CHUNK)
        n = min(len(out), len(self.ready))
        out[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


def parse(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers (lower-case names), block and raw bytes of each record of an inflated stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        raw, headers = [line], {}
        while (line := stream.readline()).strip():
            raw.append(line)
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(length := int(headers["content-length"]))
        end = stream.read(4)
        if len(block) < length or end != b"\r\n\r\n":
            raise EOFError("the record ends early")
        yield headers, block, b"".join([*raw, b"\r\n", block, end])


def write_monolithic(pages: DataFrame, folder: str) -> list[str]:
    """Write ``page_id``, ``url``, ``payload`` (binary) and ``refers_to`` as one gzip stream per task."""

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, base = file_system(folder)
        name, engine, out, n = f"part-{context.partitionId():05d}.warc.gz", zlib.compressobj(6, zlib.DEFLATED, 31), None, 0
        for batch in batches:
            columns = [batch.column(c) for c in range(4)]
            for i in range(batch.num_rows):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/.{name}.{context.taskAttemptId()}", compression=None)
                    out.write(engine.compress(record("warcinfo", [("WARC-Date", DATE), ("WARC-Filename", name)], b"format: WARC File Format 1.1\r\n")))
                page_id, url, payload, refers = (c[i].as_py() for c in columns)
                out.write(engine.compress(page_record(page_id, url, payload or b"", refers, f"{name}/{n}")))
                n += 1
        if out is not None:
            out.write(engine.flush())
            out.close()
            fs.move(f"{base}/.{name}.{context.taskAttemptId()}", f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])

    done = pages.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "file string, records long").collect()  # one row per file
    return sorted(f"{folder}/{r['file']}" for r in done)


def normalise(spark, files: list[str], folder: str) -> DataFrame:
    """Rewrite archives record by record into ``folder``; returns the index, which is also written there.

    One task inflates one archive once. It holds one record at a time, whatever the archive's size.
    """

    def run(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, source = file_system(path)
                to, base = file_system(folder)
                to.create_dir(base, recursive=True)
                name, rows, at = path.rpartition("/")[2], [], 0
                with fs.open_input_stream(source, compression=None) as raw, to.open_output_stream(f"{base}/.{name}.{attempt}", compression=None) as out:
                    for headers, _block, whole in parse(io.BufferedReader(Inflated(raw), CHUNK)):
                        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = engine.compress(whole) + engine.flush()
                        out.write(member)
                        page = headers.get("x-page-id")
                        rows.append((f"{folder}/{name}", at, len(member), headers["warc-type"], None if page is None else int(page)))
                        at += len(member)
                to.move(f"{base}/.{name}.{attempt}", f"{base}/{name}")
                for lo in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 10_000]), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                        names=["file", "offset", "length", "record_type", "page_id"],
                    )

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    index = listed.mapInArrow(run, INDEX)
    index.write.parquet(f"{folder}/index")  # the sidecar: places of all records
    return spark.read.parquet(f"{folder}/index")


def read_records(index: DataFrame) -> DataFrame:
    """The records at the given places: headers of interest and payload, each inflated alone."""

    def run(batches):
        opened: dict = {}
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if path not in opened:
                    for f in opened.values():
                        f.close()
                    fs, source = file_system(path)
                    opened = {path: fs.open_input_file(source)}
                opened[path].seek(offset)
                inflated = zlib.decompress(opened[path].read(length), 31)
                headers, block, _ = next(parse(io.BufferedReader(io.BytesIO(inflated))))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = headers.get("warc-payload-digest")
                number = {k: int(headers[k]) if k in headers else None for k in ("x-page-id", "x-payload-length", "x-refers-to-page-id")}
                rows.append((
                    number["x-page-id"], headers["warc-type"], headers.get("warc-target-uri"), number["x-payload-length"],
                    None if digest is None else base64.b32decode(digest.partition(":")[2]).hex(), number["x-refers-to-page-id"],
                    payload if headers["warc-type"] == "response" else None,
                ))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[
                    "page_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"])
        for f in opened.values():
            f.close()

    return index.select("file", "offset", "length").mapInArrow(
        run, "page_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and ``refers_to``: null for a response, else the page it revisits.

    Of equal payloads of at least ``least`` bytes, the largest page_id (ties: smallest url) is the response.
    The lookup of the response is keyed by digest and a salt, so a payload that most pages share is not one task.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("payload"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("_digest", F.sha1("payload")).withColumn("_salt", F.pmod(F.xxhash64(F.col("page_id").cast("string")), F.lit(32)).cast("int"))
    long = F.octet_length("payload") >= least
    winner = F.max(F.struct("page_id", "url")).alias("_best")
    best = rows.filter(long).groupBy("_digest").agg(winner, F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    spread = best.select("_digest", "_best", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_salt"))
    is_best = F.col("page_id").eqNullSafe(F.col("_best.page_id")) & F.col("url").eqNullSafe(F.col("_best.url"))
    return rows.join(spread, ["_digest", "_salt"], "left").select(
        "page_id", "url", "payload", F.when(long & ~is_best, F.col("_best.page_id")).alias("refers_to"))


def archive(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages as records, normalise the archives, and read every page record back."""
    spark = pages.sparkSession
    root = new_path(spark, "warc")
    files = write_monolithic(with_revisits(pages, least), f"{root}/monolithic")
    index = normalise(spark, files, f"{root}/records")
    return read_records(index.filter("record_type != 'warcinfo'"))



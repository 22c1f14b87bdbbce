"""WARC archives, written and read by an index.

Writing: every task writes its records into gzipped WARC files (one member a
record) and returns one index row per record with file, offset, length, URL
and digest; the index is a Parquet table. Only rows of tasks that succeeded are
in the index, so files left by lost tasks are never read. Reading: the index
rows of the wanted records are sorted by file and offset, neighbouring byte
ranges are merged, and tasks fetch one merged range at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import lookup, partitions
from rivulet.session import scratch_path, written

INDEX = ("file string, offset long, length long, url string, payload_digest string, payload_bytes long, "
         "page_id long, record_type string, refers_to long")
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder all tasks share (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, roll_bytes: int = 64 << 20,
                   date: str = "2024-01-01T00:00:00Z", level: int = 2) -> DataFrame:
    """Write one WARC record per row to `folder` (by default a new one in the
    shared checkpoint folder) and return the index (INDEX).

    The payload is the text in UTF-8, a null text an empty payload. Of the rows
    whose payloads are equal and have at least `min_bytes` bytes, the one with
    the largest id is a `response` record and the others are `revisit` records
    that refer to it; all other rows are responses. Several rows with this
    largest id are all responses; a null id is smaller than any other, and if
    all are null all are responses. URLs are percent-encoded where WARC headers
    need it; the index keeps them as given. Further columns are ignored; an
    empty table gives an empty index. A file is closed when it has `roll_bytes`.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    sums = p.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    rows = lookup(p, sums, ["digest"], ["top"], pages.count())
    same = F.coalesce(F.octet_length("payload") >= min_bytes, F.lit(False)) & F.col("top").isNotNull()
    rows = rows.withColumn("refers_to", F.when(same & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")))
    return written(rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        _writer(folder, roll_bytes, date, level), INDEX), "warc-index")


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]-._~"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, roll_bytes: int, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        out, name, at = None, None, 0
        for b in batches:
            rows = []
            for page_id, url, text, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                payload, sha = text.encode(), base64.b32encode(digest).decode()
                z = zlib.compressobj(level, wbits=31)
                data = z.compress(_record(page_id, url, payload, sha, refers_to, date)) + z.flush()
                out.write(data)
                rows.append((name, at, len(data), url, sha, len(payload), page_id,
                             "response" if refers_to is None else "revisit", refers_to))
                at += len(data)
                if at >= roll_bytes:
                    out.close()
                    out = None
            if rows:
                yield _batch(rows, [(c.split()[0], c.split()[1]) for c in INDEX.split(", ")])
        if out is not None:
            out.close()
    run.__doc__ = "index rows of a partition's records; the file is closed before the task ends"
    return run


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], columns: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[t]) for i, (_, t) in enumerate(columns)],
                                      [c for c, _ in columns])


def read_records(selected: DataFrame, folder: str, max_gap: int = 64 << 10, max_run: int = 8 << 20,
                 with_payload: bool = False) -> DataFrame:
    """The records named by index rows (file, offset, length): page_id, url,
    record_type, payload_bytes, payload_digest, refers_to and on demand the
    payload (null for revisits). Ranges of a file less than `max_gap` apart are
    fetched together, up to about `max_run` bytes. A response whose payload
    does not have the length and SHA-1 of its headers raises an error. The
    same record selected twice is returned twice."""
    w = Window.partitionBy("file").orderBy("offset", "length")  # a file holds roll_bytes at most
    before = F.max(F.col("offset") + F.col("length")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.when(before.isNull() | (F.col("offset") - before > max_gap), F.lit(1)).otherwise(F.lit(0))
    runs = selected.select("file", "offset", "length").withColumn("cut", cut).withColumn("run", F.sum("cut").over(w))
    runs = runs.groupBy("file", "run", F.floor(F.col("offset") / max_run).alias("part")).agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))
    # a range is a small row that stands for megabytes, so its size must not decide how many tasks read
    runs = runs.repartition(partitions(selected), "file", "run", "part")
    columns = [("page_id", "long"), ("url", "string"), ("record_type", "string"), ("payload_bytes", "long"),
               ("payload_digest", "string"), ("refers_to", "long")] + [("payload", "binary")] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for b in batches:
            for file, start, end, records in zip(*(b.column(c).to_pylist() for c in ("file", "start", "end", "records"))):
                with fs.open_input_file(f"{root}/{file}") as f:
                    data = f.read_at(end - start, start)
                rows = [_parse(gzip.decompress(data[r["offset"] - start:r["offset"] - start + r["length"]]), with_payload)
                        for r in records]
                yield _batch(rows, columns)

    return runs.select("file", "start", "end", "records").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in columns))


def _parse(record: bytes, with_payload: bool) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    h = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(h["Content-Length"])]
    kind, digest, size = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {h['WARC-Record-ID']}")
    number = {k: int(h[k]) if k in h else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
    out = (number["X-Page-ID"], h.get("WARC-Target-URI"), kind, size, digest, number["X-Refers-To-Page-ID"])
    return (*out, payload) if with_payload else out

"""Line deduplication with two Bloom filters.

The digests of all lines are written once and counted, which sizes the filters:
the `once` filter holds the bits hit at all, the `twice` filter those hit again.
Both lie in segments by digest, so that every segment is built by one task from
a bounded share of the digests. Only lines whose bits are all in the `twice`
filter can occur in two documents; only these suspects are counted exactly and
give their first document. A `twice` filter of bounded size is broadcast; a
larger one stays where it is, and digests are sent to its segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import HOT_SHARE, lookup, null_safe, shared
from rivulet.llm.words import by_bytes
from rivulet.session import written

WHITE = b" \t\n\x0b\x0c\r"
SEGMENT = 1 << 20
BITS_A_LINE = 16
HASHES = 4
BROADCAST_BITS = 1 << 26
HELD = 1 << 18
SAMPLE = 1 << 17


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                        keep: str = "none", min_chars: int = 1, bits: int | None = None,
                        broadcast_bits: int = BROADCAST_BITS) -> DataFrame:
    """`docs` with the lines that repeat in at least `min_docs` documents
    removed from `text_col`, plus n_lines (before) and n_dropped.

    Lines are split at \\n; a line's key is the line stripped of the ASCII white
    space [\\x20\\x09-\\x0D] with A-Z in lower case. Keys shorter than `min_chars`
    code points always stay. keep="none" removes every such line; keep="first"
    leaves the lines of the key's first document (smallest id, then smallest
    text digest; a null id is smallest). Every row counts as a document, also
    a row that repeats another; rows equal in id and text fare alike. A null
    or empty text is one empty line, and a null text stays null. Columns named
    n_lines or n_dropped are replaced, all others stay. Keys are told apart by
    128-bit digests.

    `bits` is the size of each filter, by default BITS_A_LINE for each distinct
    line of a document; a filter that is too small makes more suspects, never
    another result. The `twice` filter is broadcast up to `broadcast_bits` (8 MB
    by default), beyond that digests are shuffled to its segments; digests of
    lines that a sample of SAMPLE rows shows to be hot are suspects without being
    sent anywhere.
    """
    own = F.unhex(F.md5(F.concat(null_safe(F.col(id_col)), F.lit("\x00"), null_safe(F.col(text_col)))))
    rows = docs.select(own.alias("own"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, own binary, line binary"
    digests = written(rows.mapInArrow(_digests(min_chars), schema), "line-digests")
    suspects = written(_suspects(digests, schema, bits, broadcast_bits), "suspects")
    n = suspects.count()
    lines = suspects.groupBy("line").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("id", "own")).getField("own").alias("first")
    ).where(F.col("n_rows") >= min_docs)
    hits = lookup(suspects, lines, ["line"], ["first"], n).where(F.col("first").isNotNull())
    if keep == "first":
        hits = hits.where(F.col("own") != F.col("first"))
    drops = hits.groupBy("own").agg(F.collect_set("line").alias("lines"), F.count(F.lit(1)).alias("n"))
    drops = drops.select("own", "lines", (F.col("n") / F.size("lines")).cast("long").alias("n_rows"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drops = drops.select(F.col("own").alias("__own"), F.col("lines").alias("__lines"), "n_rows")
    out = lookup(docs.select(*names, own.alias("__own")), drops, ["__own"], ["__lines"], n)
    schema = T.StructType(docs.select(*names).schema.fields + [
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return out.select(*names, "__lines").mapInArrow(_cutter(text_col, schema.names), schema)


def line_keys(text: str | None) -> list[bytes]:
    return [x.strip(WHITE).lower() for x in (text or "").encode().split(b"\n")]


def _own_keys(text: str | None, min_chars: int) -> list[bytes]:
    """The distinct keys of a text that may be dropped."""
    return [k for k in dict.fromkeys(line_keys(text))
            if len(k) >= min_chars and (min_chars <= 1 and k or len(k.decode()) >= min_chars)]


def _digest(key: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(key)


def _digests(min_chars: int):
    """One row for each distinct key of a text that may be dropped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in by_bytes(b, "text")):
            row, out = [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                keys = _own_keys(t, min_chars)
                out += map(_digest, keys)
                row += [i] * len(keys)
            if row:
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(at), b.column("own").take(at), pa.array(out, pa.binary())], ["id", "own", "line"])
    return run


def _halves(digests: pa.Array) -> np.ndarray:
    """The two 64-bit halves of each digest: the first names its segment, the
    second its bits there."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 2)


def _slots(half: np.ndarray, width: int) -> np.ndarray:
    """HASHES different bits of a segment for each second half."""
    start, step = half & np.uint64(0xFFFFFFFF), half >> np.uint64(32) | np.uint64(1)
    at = start[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (at % np.uint64(width)).astype(np.int64)


def _are_set(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)


def _edges(*columns: np.ndarray) -> list[tuple[int, int]]:
    """The runs (from, to) of equal values in all columns."""
    n = len(columns[0])
    change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(np.concatenate([[True], change, [True]])).tolist() if n else []
    return list(zip(at[:-1], at[1:]))


def _suspects(digests: DataFrame, schema: str, bits: int | None, broadcast_bits: int) -> DataFrame:
    """The rows of `digests` whose bits are all in the `twice` filter."""
    n = digests.count()
    bits = bits or max(n * BITS_A_LINE, 1)
    width = min(SEGMENT, 1 << max(bits - 1, 63).bit_length())
    segments = -(-bits // width)
    filters = _filters(digests.select("line"), segments, width)
    if segments * width > broadcast_bits:
        return _probed_by_shuffle(digests, filters, schema, n, segments, width)
    parts = {r.segment: bytes(r.bits) for r in filters.collect()}  # broadcast_bits at most

    def joined(parts: dict[int, bytes]) -> np.ndarray:
        out = np.zeros((segments, width // 8), np.uint8)
        for s, packed in parts.items():
            out[s] = np.frombuffer(zlib.decompress(packed), np.uint8)
        return out.ravel()

    table = shared(digests.sparkSession, parts, joined)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = _halves(b.column("line"))
            at = (d[:, 0] % np.uint64(segments)).astype(np.int64)[:, None] * width + _slots(d[:, 1], width)
            yield b.filter(pa.array(_are_set(table(), at)))

    return digests.mapInArrow(probe, schema)


def _filters(lines: DataFrame, segments: int, width: int) -> DataFrame:
    """(segment, bits): the compressed `twice` filter of each segment that has
    lines. A task sends each of its digests once for HELD rows, with a mark if
    it had several, so that a hot line is few rows."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(_halves(b.column(0)))
            n += b.num_rows
            if n >= HELD:
                yield distinct(np.concatenate(held))
                held, n = [], 0
        if n:
            yield distinct(np.concatenate(held))

    def distinct(d: np.ndarray) -> pa.RecordBatch:
        d = d[np.lexsort((d[:, 1], d[:, 0]))]
        runs = np.array(_edges(d[:, 0], d[:, 1]))
        d = d[runs[:, 0]]
        return pa.RecordBatch.from_arrays(
            [pa.array((d[:, 0] % np.uint64(segments)).astype(np.int64)), pa.array(d[:, 1].view(np.int64)),
             pa.array(runs[:, 1] - runs[:, 0] > 1)], ["segment", "half", "again"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None
        for b in batches:
            segment, again = b.column("segment").to_numpy(), b.column("again").to_numpy(zero_copy_only=False)
            half = b.column("half").to_numpy().view(np.uint64)
            for lo, hi in _edges(segment):
                if segment[lo] != now:
                    if now is not None:
                        yield done(now, twice)
                    now, once, twice = segment[lo], np.zeros(width, bool), np.zeros(width, bool)
                at = _slots(half[lo:hi], width)
                bit, count = np.unique(at, return_counts=True)
                twice[bit] |= (count > 1) | once[bit]
                twice[at[again[lo:hi]].ravel()] = True
                once[bit] = True
        if now is not None:
            yield done(now, twice)

    def done(segment: int, twice: np.ndarray) -> pa.RecordBatch:
        packed = zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([packed])], ["segment", "bits"])

    marks = lines.mapInArrow(mark, "segment long, half long, again boolean")
    return marks.repartition("segment").sortWithinPartitions("segment").mapInArrow(build, "segment long, bits binary")


def _probed_by_shuffle(digests: DataFrame, filters: DataFrame, schema: str, n: int, segments: int,
                       width: int) -> DataFrame:
    """The suspects by sending digests to the segments of the filter. The hot
    lines of a sample, at most about HOT_SHARE by their share, are suspects
    anyway and stay out of the shuffle, so that no segment gets a hot group."""
    sample = digests.where(F.rand(11) < min(1.0, SAMPLE / max(n, 1)))
    hot = sample.groupBy("line").count().where(F.col("count") > max(min(n, SAMPLE) / HOT_SHARE, 1)).select("line")
    hot = F.broadcast(written(hot, "hot-lines"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = (_halves(b.column("line"))[:, 0] % np.uint64(segments)).astype(np.int64)
            yield b.append_column("segment", pa.array(at))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for b in batches:
            segment, is_filter = b.column("segment").to_numpy(), b.column("line").is_null().to_numpy(zero_copy_only=False)
            for lo, hi in _edges(segment, is_filter):
                if is_filter[lo]:
                    table = np.frombuffer(zlib.decompress(b.column("bits")[lo].as_py()), np.uint8)
                    continue
                part = b.slice(lo, hi - lo).select(["id", "own", "line"])
                yield part.filter(pa.array(_are_set(table, _slots(_halves(part.column("line"))[:, 1], width))))

    cold = digests.join(hot, "line", "left_anti").select("id", "own", "line").mapInArrow(deal, schema + ", segment long")
    cells = cold.unionByName(filters, allowMissingColumns=True).repartition("segment")
    found = cells.sortWithinPartitions("segment", F.col("line").isNotNull()).mapInArrow(probe, schema)
    return found.union(digests.join(hot, "line", "left_semi").select("id", "own", "line"))


def _cutter(text_col: str, names: list[str]):
    """Removes the lines whose digests are in __lines from each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in by_bytes(b, text_col)):
            at, out, n_lines, n_dropped = b.schema.get_field_index(text_col), [], [], []
            for t, d in zip(b.column(at).to_pylist(), b.column("__lines").to_pylist()):
                n, left = (t or "").count("\n") + 1, t
                if d:
                    gone = set(d)
                    kept = [x for x, k in zip(t.split("\n"), line_keys(t)) if _digest(k) not in gone]
                    left, n_after = "\n".join(kept), len(kept)
                out.append(left)
                n_lines.append(n)
                n_dropped.append(n - n_after if d else 0)
            cols = [pa.array(out, b.column(at).type) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names)
    return run

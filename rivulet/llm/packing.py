"""Sequence packing along a space-filling curve.

Every document's hashed word vector is projected to three dimensions; its
place on a Hilbert curve through that cube is its sort key. A size-weighted
sample of keys gives the splitters of a range partitioning; inside a range the
documents follow the curve, are tokenized and fill sequences one after another.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import partitions, shared
from rivulet.llm.words import Recent, by_bytes, split_words, word_hashes

RANGE_BYTES = 256 << 20  # of text in a range, about, at most
DIMS, BITS, SALT_BITS, BUCKETS = 3, 14, 20, 256
CACHE = 100_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of integer points (n, dims), each
    coordinate below 2^bits: neighbouring distances are neighbouring points."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for d in range(dims):
            up = (x[:, d] & q) != 0
            swap = np.where(up, 0, (x[:, 0] ^ x[:, d]) & (q - 1))
            x[:, 0] ^= np.where(up, q - 1, swap)
            if d:
                x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> level) & 1)
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    """Hilbert keys of texts: signed hashed word counts in BUCKETS dimensions,
    unit length, a fixed Gaussian projection to DIMS, the normal distribution
    function on each, and the curve through the resulting cells. Texts without
    words lie in the middle of the cube."""
    words, idx, off = split_words(texts)
    n = len(off) - 1
    vec = np.zeros(n * BUCKETS)
    if len(idx):
        h = word_hashes(words)[idx]
        row = np.repeat(np.arange(n), np.diff(off))
        sign = np.where(h >> np.uint64(63), 1.0, -1.0)
        vec = np.bincount(row * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), sign, n * BUCKETS)
    vec = vec.reshape(n, BUCKETS)
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-12)
    z = vec @ np.random.default_rng(17).normal(size=(BUCKETS, DIMS))
    share = 1 / (1 + np.exp(-1.702 * z))  # a close form of the normal distribution function
    return hilbert_keys(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


class WordTokenizer:
    """Token ids of texts by a BPE tokenizer that lower-cases, treats
    white-space separated words apart and letter runs apart from other
    characters, and marks the end of every run ("</w>"). Distinct runs are
    encoded once in a Python worker and kept in a bounded cache."""

    MARKS = ".,;:!?"

    def __init__(self, source: str):
        self.source, self.tok = source, None

    def _open(self) -> None:
        """Done once in a Python worker, whose tasks share the object."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(self.source)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.runs = Recent(CACHE, self._encode_runs)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of each text)."""
        words, idx, off = split_words(texts)
        if not len(idx):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.tok is None:
            self._open()
        runs, first, second = self._runs(words)
        ids = list(map(self.runs.of(runs).__getitem__, runs))
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        start = np.cumsum(size, dtype=np.int32) - size
        run = np.stack([first[idx], second[idx]], axis=1).ravel()
        count = size[run]
        end = np.cumsum(count, dtype=np.int64)
        at = np.repeat((start[run] - (end - count)).astype(np.int32), count)
        at += np.arange(end[-1], dtype=np.int32)
        return flat[at], np.concatenate([[0], end])[2 * off]

    def _runs(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct runs and the two that make up each distinct word: letters in
        lower case and closing marks, or the word as it is and nothing."""
        core = pc.utf8_rtrim(words, characters=self.MARKS)
        alone = pc.utf8_is_alpha(core)
        head = pc.if_else(alone, pc.ascii_lower(core), words).dictionary_encode()
        runs = head.dictionary.cast(pa.large_binary()).to_pylist()
        first = head.indices.to_numpy()
        second = np.full(len(words), len(runs), np.int32)  # the empty run
        cut = pc.binary_length(core).to_numpy()
        rows = np.flatnonzero(alone.to_numpy(zero_copy_only=False) & (cut < pc.binary_length(words).to_numpy()))
        tails: dict[bytes, int] = {b"": len(runs)}
        for row, word, n in zip(rows.tolist(), words.take(pa.array(rows)).cast(pa.large_binary()).to_pylist(), cut[rows].tolist()):
            second[row] = tails.setdefault(word[n:], len(runs) + len(tails))
        return runs + list(tails), first, second

    def _encode_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids as little-endian 32-bit numbers. Many letter runs are encoded as
        one text: each ends at the next end-of-word token."""
        out, other = {}, []
        letters = [r for r in runs if r.decode().isalpha() or other.append(r)]  # the empty run is no letters
        for a in range(0, len(letters), 20_000):
            groups = [letters[b:b + 200] for b in range(a, min(a + 20_000, len(letters)), 200)]
            for g, e in zip(groups, self.tok.encode_batch_fast([b" ".join(g).decode() for g in groups],
                                                               add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                end = np.flatnonzero(self.ends[ids]) + 1
                if len(end) != len(g):
                    other += g
                    continue
                data, end = ids.tobytes(), (4 * end).tolist()
                out.update(zip(g, [data[x:y] for x, y in zip([0, *end], end)]))
        for a in range(0, len(other), 5_000):
            part = other[a:a + 5_000]
            for r, e in zip(part, self.tok.encode_batch_fast([r.decode() for r in part], add_special_tokens=False)):
                out[r] = np.array(e.ids, "<u4").tobytes()
        return [out[r] for r in runs]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
         length: int = 4096, sample: int = 4000, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `length` tokens (a power
    of two). One row per piece: (id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset), plus the token ids as `ids` when asked for.

    A document is its token ids (null and empty texts have none) followed by
    `end_id`. Documents are cut wherever a sequence is full, so all sequences of
    a range hold `length` tokens; the last tokens of a range are cut into
    sequences whose lengths are powers of two, and nothing is padded.
    sequence_id is the number of the range times 2^32 plus the number inside it;
    offsets are gapless from 0. Rows with null or repeated ids, equal rows and
    ties on the curve are documents of their own; columns besides the two named
    are ignored; an empty table gives no rows. There are as many ranges as
    shuffle partitions, or one for RANGE_BYTES where that is more; `sample`, or
    eight for each range, bounds the keys that are drawn for the splitters.
    """
    spark, n = docs.sparkSession, partitions(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text.alias("text"),
        F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << SALT_BITS) - 1)).alias("salt"))
    sizes = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text") + 1)).first()
    n = max(n, (sizes[1] or 0) // RANGE_BYTES)  # so that no task grows with the table
    share = min(1.0, max(sample, 8 * n) / max(sizes[0], 1))
    drawn = rows.where(F.pmod(F.xxhash64("id", "salt"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in by_bytes(b, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(s)), s.column("size")], ["key", "size"])

    got = sorted((r.key, r.size) for r in drawn.select(
        "text", "salt", (F.octet_length("text") + 1).cast("long").alias("size")).mapInArrow(
        keyed, "key long, size long").collect())  # about `sample` rows
    bounds = np.zeros(0, np.int64)
    if got:
        key, run = np.array([k for k, _ in got]), np.cumsum([s for _, s in got])
        bounds = key[np.minimum(np.searchsorted(run, run[-1] * np.arange(1, n) / n), len(key) - 1)]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in by_bytes(b, "text"):
                key = _keys(s)
                part = np.searchsorted(bounds, key, side="right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([s.column("id"), s.column("text"), pa.array(key), pa.array(part)],
                                                 ["id", "text", "key", "part"])

    ranged = rows.mapInArrow(placed, "id long, text string, key long, part int")
    ranged = ranged.repartitionById(n, F.col("part")).sortWithinPartitions("part", "key", "id")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = shared(spark, f.read(), WordTokenizer)
    schema = (f"{id_col} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids array<int>" if with_ids else ""))
    return ranged.select("id", "text", "part").mapInArrow(
        _packer(tokenizer, id_col, end_id, length, with_ids), schema)


def _keys(b: pa.RecordBatch) -> np.ndarray:
    return (curve_keys(b.column("text")) << SALT_BITS) | b.column("salt").to_numpy()


def _packer(tokenizer, id_col: str, end_id: int, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer()
        line = _Line(id_col, length, with_ids)
        for b in batches:
            for s in by_bytes(b, "text"):
                part = s.column("part").to_numpy()
                edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    if line.part != part[lo]:
                        if line.part is not None:
                            yield line.end()
                        line.begin(int(part[lo]))
                    ids, off = tok.encode(s.column("text").slice(lo, hi - lo))
                    ids = np.insert(ids, off[1:], end_id)
                    off = off + np.arange(len(off))
                    yield line.add(s.column("id").slice(lo, hi - lo).to_pylist(), ids, off)
        if line.part is not None:
            yield line.end()
    return run


class _Line:
    """The tokens of a range as they arrive, cut into sequences. The open
    sequence waits for more tokens as a list of pieces without a place."""

    def __init__(self, id_col: str, length: int, with_ids: bool):
        self.id_col, self.length, self.with_ids, self.part = id_col, length, with_ids, None

    def begin(self, part: int) -> None:
        self.part, self.open, self.held, self.next = part, [], 0, part << 32

    def add(self, names: list, ids: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
        """Place the documents `names`; returns the pieces of all sequences
        that became full."""
        out = []
        for name, a, b in zip(names, off[:-1].tolist(), off[1:].tolist()):
            at = a
            while at < b:
                n = min(b - at, self.length - self.held)
                self.open.append((name, at - a, ids[at:at + n], b - a))
                self.held += n
                at += n
                if self.held == self.length:
                    self._close(self.open, out)
                    self.open, self.held = [], 0
        return self._batch(out)

    def end(self) -> pa.RecordBatch:
        """Cut what is left into sequences with lengths of powers of two."""
        out = []
        while self.held:
            size = 1 << (self.held.bit_length() - 1)
            now, rest, n = [], [], 0
            for name, start, ids, total in self.open:
                k = min(len(ids), size - n)
                if k:
                    now.append((name, start, ids[:k], total))
                if k < len(ids):
                    rest.append((name, start + k, ids[k:], total))
                n += k
            self._close(now, out)
            self.open, self.held = rest, self.held - size
        return self._batch(out)

    def _close(self, pieces: list, out: list) -> None:
        offset = 0
        for name, start, ids, total in pieces:
            row = (name, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset)
            out.append(row + (ids.astype(np.int32),) if self.with_ids else row)
            offset += len(ids)
        self.next += 1

    def _batch(self, rows: list) -> pa.RecordBatch:
        names = [self.id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
        if self.with_ids:
            names, cols = [*names, "ids"], [*cols, pa.array([r[7] for r in rows], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(cols, names)

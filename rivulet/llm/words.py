"""Words and word shingles of Arrow text columns (used inside tasks).

A word is a maximal run without the ASCII white space ``[\\x20\\x09-\\x0D]``.
All functions work on a whole Arrow batch: splitting and finding the distinct
words happen in Arrow's C++ kernels, the rest in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Returns (distinct words, index of each word occurrence into them,
    offsets: the words of row i are occurrences offsets[i]..offsets[i+1]).
    Null texts have no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(t)
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(off[0], off[-1] - off[0]) if len(off) else lists.values
    off = off - off[0]
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(keep)])
    enc = flat.filter(pa.array(keep)).dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(), at[off]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an unsigned array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: pa.Array, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each distinct word (none is empty): the sum of a random
    value for every (place, byte) of the word, mixed once more. With `lower`
    A-Z count as a-z."""
    a = words.cast(pa.large_binary())
    if not len(a):
        return np.zeros(0, np.uint64)
    _, off, data = a.buffers()
    off = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    size = np.diff(off)
    byte = np.frombuffer(data, np.uint8)[off[0]:off[-1]].astype(np.uint64)
    if lower:
        byte += np.uint64(32) * ((byte >= 65) & (byte <= 90))
    start = off[:-1] - off[0]
    place = (np.arange(len(byte)) - np.repeat(start, size)).astype(np.uint64)
    value = mix((place << np.uint64(8) | byte) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return mix(np.add.reduceat(value, start) + size.astype(np.uint64))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the `size`-word shingles of each
    row (lower-cased A-Z). A text with fewer words gives its whole word
    sequence as one shingle; without words the set is empty."""
    words, idx, off = split_words(texts)
    h = word_hashes(words, lower=True)[idx] if len(idx) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        n = len(h)
        roll = np.full(max(n - size + 1, 0), size, np.uint64)
        for j in range(size):
            roll = mix(roll * np.uint64(0x9E3779B97F4A7C15) + h[j:n - size + 1 + j]) if n >= size else roll
        out = []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(roll[a:b - size + 1]))
            elif b > a:
                s = np.uint64(b - a)
                for w in h[a:b]:
                    s = mix(np.array([s * np.uint64(0x9E3779B97F4A7C15) + w]))[0]
                out.append(np.array([s], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class Recent:
    """Values of the keys met lately, made once as long as they are met again
    soon: there are two generations of about `size` keys, and when the young
    one is full it becomes the old one, which is forgotten."""

    def __init__(self, size: int, make):
        self.size, self.make, self.young, self.old = size, make, {}, {}

    def of(self, keys) -> dict:
        """A mapping that holds all `keys`, until the next call."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        missing = set(keys).difference(self.young)
        known = missing & self.old.keys()
        self.young.update((k, self.old[k]) for k in known)
        new = list(missing - known)
        if new:
            self.young.update(zip(new, self.make(new)))
        return self.young


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Cut a batch into runs of rows with about `limit` bytes of text in
    `column` (one row at least), so that the arrays made from a run stay small."""
    yield from by_size(batch, pc.fill_null(pc.binary_length(batch.column(column)), 0), limit)


def by_size(batch: pa.RecordBatch, size: pa.Array, limit: int):
    """Cut a batch into runs of rows whose sizes add up to about `limit`. What
    Arrow has freed after a run goes back to the system, since several Python
    workers share an executor's memory."""
    run = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    edge = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]])) if len(run) else []
    for a, b in zip(edge[:-1], edge[1:]):
        yield batch.slice(int(a), int(b - a))
        pa.default_memory_pool().release_unused()

"""Spelling variant grouping by finite-state composition.

The vocabulary's minimal acceptor, a transducer that makes exactly one edit,
and the acceptor again are composed; the accepted pairs are the near words.
Before its edit the composed machine reads the same code points on both
sides, so its paths fall apart by the states after the first code points:
such an initial state is a partition, and one with too many words is replaced
by the states one code point further. Paths whose edit lies after the initial
state are enumerated inside the partition; paths that edit on the way there have
nothing but equal code points left, so they meet in a join on (code points
before the edit, code points after it), whose groups are bounded by the alphabet.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.automata import minimal_acceptor, one_edit_pairs
from rivulet.llm.common import partitions
from rivulet.llm.words import by_bytes, split_words
from rivulet.session import written

#: words of a partition of the composition, and code points of the words a task composes at once
PART_WORDS = 20_000
CHUNK_CHARS = 400_000


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5,
                      ratio: int = 5, drop_mod: int = 199, part_words: int | None = None) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    Runs are maximal sequences of [A-Za-z\\u00C0-\\u00FF], A-Z in lower case. A run
    with crc32(`<id>:<run>`) divisible by `drop_mod` loses one code point, the
    one at that number modulo its length (0: none does); a null id is written as
    nothing. Words are the results of at least `min_chars` code points with n >=
    `min_count` occurrences. n_near counts the words at one inserted, deleted
    or replaced code point. The near word of largest n (ties: the smallest in
    code-point order) is the form if its n is at least `ratio` times the word's
    n, else form and form_n are null; root follows forms to the last one.

    Null and empty texts have no words; every row counts, also one that
    repeats an id or another row; other columns are ignored; an empty table
    gives no rows. `part_words` bounds a partition of the composition. `ratio`
    is 2 at least, so that forms grow in n and never lead back.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = written(_counts(docs, id_col, text_col, min_chars, drop_mod).groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= min_count), "words")
    places = written(_initial_states(words, part_words or PART_WORDS), "places")
    found = _early_edits(places).unionByName(_late_edits(places))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    out = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less_n") >= ratio * F.col("n"), F.col("best")).alias("best"))
    out = written(out.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less_n")).alias("form_n")), "forms")
    return out.join(_roots(out), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The runs of letters of every text with A-Z in lower case, as
    `words.split_words` returns words. U+00C0 to U+00FF are the characters
    whose first byte is C3, so all other bytes are made spaces."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(t):
        return split_words(t)
    off = np.frombuffer(t.buffers()[1], np.int64)[t.offset:t.offset + len(t) + 1]
    byte = np.frombuffer(t.buffers()[2] or b"", np.uint8)[off[0]:off[-1]].copy()
    byte[(byte >= 65) & (byte <= 90)] += 32
    wide = byte == 0xC3
    letter = wide | ((byte >= 97) & (byte <= 122))
    letter[1:] |= wide[:-1]
    byte[~letter] = 32
    return split_words(pa.LargeStringArray.from_buffers(len(t), pa.py_buffer((off - off[0]).copy()), pa.py_buffer(byte)))


def _run_crc(runs: pa.Array, run: np.ndarray, row: np.ndarray, ids: list) -> np.ndarray:
    """crc32 of `<id>:<run>` for every occurrence of a run in a row. The
    checksum is linear, so that of a run after a prefix is that of as many zero
    bytes after the prefix, corrected by a number that belongs to the run."""
    size = pc.binary_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.fromiter((zlib.crc32(r) ^ zlib.crc32(bytes(len(r))) for r in runs.cast(pa.large_binary()).to_pylist()),
                      np.int64, len(runs))
    prefix = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
    top = int(size.max()) + 1 if len(size) else 1
    pair, at = np.unique(row * top + size[run], return_inverse=True)
    zeros = np.fromiter((zlib.crc32(bytes(p % top), prefix[p // top]) for p in pair.tolist()), np.int64, len(pair))
    return zeros[at] ^ own[run]


def _counts(docs: DataFrame, id_col: str, text_col: str, min_chars: int, drop_mod: int) -> DataFrame:
    """(word, n), a word once for every stretch of texts that a task reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in by_bytes(b, "text", 4 << 20)):
            runs, at, off = letter_runs(b.column("text"))
            drops = Counter()
            keep = np.ones(len(at), bool)
            if drop_mod and len(at):
                h = _run_crc(runs, at, np.repeat(np.arange(b.num_rows), np.diff(off)), b.column("id").to_pylist())
                keep = h % drop_mod != 0
                gone = np.flatnonzero(~keep)
                for w, x in zip(runs.take(pa.array(at[gone])).to_pylist(), h[gone].tolist()):
                    i = x % len(w)
                    drops[w[:i] + w[i + 1:]] += 1
            n = np.bincount(at[keep], minlength=len(runs))
            long = (n > 0) & (pc.utf8_length(runs).to_numpy(zero_copy_only=False) >= min_chars)
            drops = [(w, k) for w, k in drops.items() if len(w) >= min_chars]
            yield pa.RecordBatch.from_arrays([runs.filter(pa.array(long)).cast(pa.string()), pa.array(n[long], pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in drops], pa.string()),
                                              pa.array([k for _, k in drops], pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long")


def _initial_states(words: DataFrame, limit: int) -> DataFrame:
    """(word, n, early, part): `early` holds the lengths of the word's beginnings
    that are no partition but are split further (0, the empty one, always
    is), `part` is the beginning that names its partition, of at most `limit` words."""
    early, k, live = [], 1, words.select("word")
    while True:
        start = F.substring("word", 1, k)
        big = live.where(F.length("word") >= k).groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > limit).select("start")
        big = written(big, "split")  # one row for over `limit` words
        if big.isEmpty():
            break
        early.append(big)
        live = live.join(big, start == F.col("start"), "left_semi")
        k += 1
    out = words.withColumn("depth", F.lit(0))
    for d, big in enumerate(early, 1):
        out = out.join(big, F.substring("word", 1, d) == F.col("start"), "left").withColumn(
            "depth", F.when(F.col("start").isNotNull(), d).otherwise(F.col("depth"))).drop("start")
    return out.select("word", "n", F.sequence(F.lit(0), "depth").alias("early"),
                      F.expr("substring(word, 1, depth + 1)").alias("part"))


def _early_edits(places: DataFrame) -> DataFrame:
    """(word, n_near, best) from the edits before the initial state. A word
    stands in the group (before, after) of each of its splits with the code point
    it has between them, and with none; the words of a group that have one are
    near each other, and so is the one without, but to those whose code point
    is the next one (they first differ further on)."""
    at = places.select("word", "n", F.explode("early").alias("i"))
    before = F.expr("substring(word, 1, i)")
    held = at.where("length(word) > i").select(before.alias("before"), F.expr("substring(word, i + 2)").alias("after"), "word", "n",
                                               F.expr("substring(word, i + 1, 1)").alias("x"))
    none = at.select(before.alias("before"), F.expr("substring(word, i + 1)").alias("after"), "word", "n", F.lit("").alias("x"))
    groups = held.unionByName(none).groupBy("before", "after").agg(
        F.collect_list(F.struct((-F.col("n")).alias("less_n"), "word", "x")).alias("all")).where(F.size("all") > 1)
    groups = groups.select("all", F.substring("after", 1, 1).alias("next"), F.explode("all").alias("me"))
    near = F.filter("all", lambda o: (o["word"] != F.col("me.word")) & ~(
        ((o["x"] == "") | (F.col("me.x") == "")) & (F.concat(o["x"], F.col("me.x")) == F.col("next"))))
    return groups.select(F.col("me.word").alias("word"), F.transform(near, lambda o: F.struct(o["less_n"], o["word"])).alias("near")) \
        .where(F.size("near") > 0).select("word", F.size("near").cast("long").alias("n_near"), F.array_min("near").alias("best"))


def _late_edits(places: DataFrame) -> DataFrame:
    """(word, n_near, best) from the edits after the initial state: a task
    composes the acceptors of several whole partitions at once."""
    rows = places.select("part", "word", "n").repartition(partitions(places), "part").sortWithinPartitions("part", "word")

    def compose(part: list, word: list, n: np.ndarray) -> pa.RecordBatch:
        block = np.cumsum([0] + [a != b for a, b in zip(part[1:], part)])
        i, j = one_edit_pairs(minimal_acceptor(word, block))
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        by = np.lexsort((j, -n[j], i))  # words of a partition are in their order
        i, j = i[by], j[by]
        me, first, count = np.unique(i, return_index=True, return_counts=True)
        best = pa.StructArray.from_arrays([pa.array(-n[j[first]]), pa.array([word[x] for x in j[first].tolist()], pa.string())],
                                          ["less_n", "word"])
        return pa.RecordBatch.from_arrays([pa.array([word[x] for x in me.tolist()], pa.string()), pa.array(count, pa.int64()), best],
                                          ["word", "n_near", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, word, n, chars = [], [], [], 0
        for b in batches:
            for p, w, k in zip(*(c.to_pylist() for c in b.columns)):
                if chars > CHUNK_CHARS and p != part[-1]:
                    yield compose(part, word, np.array(n, np.int64))
                    part, word, n, chars = [], [], [], 0
                part.append(p)
                word.append(w)
                n.append(k)
                chars += len(w)
        if word:
            yield compose(part, word, np.array(n, np.int64))

    return rows.mapInArrow(run, "word string, n_near long, best struct<less_n:long,word:string>")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. Each round doubles the steps that
    a word's root lies ahead; n grows `ratio`-fold with a step, so there are few."""
    now = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = written(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if nxt.where("moved").isEmpty():
            return now
        now = nxt.drop("moved")

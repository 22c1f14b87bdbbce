"""SentencePiece encoding and decoding by suffix-array matching.

The new words of a batch are laid one after another and indexed by a suffix
array; every vocabulary piece is binary-searched for its occurrences, which
become edges from its first to its last position. The edges, sorted by their
position inside the word, are then relaxed: an edge extends the encoding of
the prefix before it when the prefix's last piece and the edge's piece are
neighbours that byte-pair merging would leave apart, which singles out the
merge result of every prefix.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rivulet.llm.common import shared
from rivulet.llm.words import Recent, by_bytes, by_size

SPACE = "▁"
CACHE = 120_000
INDEX_WORDS = 50_000
PAIR_CACHE = 2_000_000
LONGEST = 2_000


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 0 normal, 1 byte, 2 never in a text (control, unknown)


def load(path: str) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores and kinds of a SentencePiece BPE model with byte fallback,
    identity normalization and a dummy prefix."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.vocab_size()
    kind = [1 if m.is_byte(i) else 2 if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else 0 for i in range(n)]
    return [m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], kind


def _encoder(model: tuple) -> "Encoder":
    return Encoder(Vocabulary(*model))


class Encoder:
    """Token ids of texts, kept as little-endian 32-bit numbers."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.id = {p: i for i, p in enumerate(v.pieces) if v.kinds[i] == 0}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(v.pieces) if v.kinds[i] == 1}
        text = [bytes([int(p[3:5], 16)]) if k == 1 else b"" if k == 2 else p.replace(SPACE, " ").encode()
                for p, k in zip(v.pieces, v.kinds)]
        self.text_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.text_size = np.fromiter(map(len, text), np.int64, len(text))
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.ids = np.array(sorted(self.id.values()), np.int32)
        self.size = np.array([len(v.pieces[i]) for i in self.ids], np.int32)
        self.codes = np.zeros((len(self.ids), int(self.size.max())), np.uint32)
        for row, i in enumerate(self.ids):
            self.codes[row, :self.size[row]] = [ord(c) for c in v.pieces[i]]
        # a character that is in no piece merges with nothing, so a line break ends a word as a space does
        line = "" if any("\n" in p for p in self.id) else "\n"
        self.word = re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + (f"|{line}" if line else ""))
        self.bigrams = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.runs = Recent(CACHE, self._encode_words)
        self.pairs, self.left_apart = np.zeros(0, np.int64), np.zeros(0, bool)  # sorted pairs of pieces already judged

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [self.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = list(set(chain.from_iterable(parts)))
        ends = [self._closing(w) for w in words]
        get = self.runs.of(r for e in ends for r in e if r).__getitem__
        ids = dict(zip(words, [get(a) + get(b) if b else get(a) for a, b in ends]))
        return [np.frombuffer(b"".join(map(ids.__getitem__, p)), "<i4") for p in parts]

    def _closing(self, word: str) -> tuple[str, str]:
        """A word and its closing marks, where no piece holds the two
        characters at the seam, so that merging cannot cross it."""
        core = word.rstrip(".,;:!?")
        if len(core) == len(word) or not core or core[-1] + word[len(core)] in self.bigrams:
            return word, ""
        return core, word[len(core):]

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of token ids laid one after another, without the dummy
        prefix; bytes that are no UTF-8 become U+FFFD."""
        size = self.text_size[ids]
        end = np.cumsum(size)
        at = np.repeat(self.text_start[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
        data, cut = self.text_bytes[at].tobytes(), np.concatenate([[0], end])[offsets].tolist()
        return [data[a + (data[a:a + 1] == b" "):b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]

    def merged(self, word: str) -> list[str]:
        """Byte-pair merging by its definition: the neighbours whose union has
        the highest score are joined, the leftmost first, until none are."""
        s, n = list(word), len(word)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        open_pairs = []

        def offer(i):
            j = right[i]
            k = self.id.get(s[i] + s[j]) if j < n else None
            if k is not None:
                heapq.heappush(open_pairs, (-self.v.scores[k], i, len(s[i]), len(s[j])))

        for i in range(n - 1):
            offer(i)
        while open_pairs:
            _, i, a, b = heapq.heappop(open_pairs)
            j = right[i] if s[i] else n
            if j >= n or len(s[i]) != a or len(s[j]) != b:
                continue  # one of the two has been joined since
            s[i], s[j], right[i] = s[i] + s[j], "", right[j]
            if right[i] < n:
                left[right[i]] = i
                offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [x for x in s if x]

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves the two pieces of each pair apart; a character
        outside the vocabulary (-1) never merges."""
        n = len(self.v.pieces)
        key, back = np.unique(left.astype(np.int64) * n + right, return_inverse=True)
        if len(self.pairs) > PAIR_CACHE:
            self.pairs, self.left_apart = np.zeros(0, np.int64), np.zeros(0, bool)
        at = np.searchsorted(self.pairs, key)
        new = np.ones(len(key), bool)
        if len(self.pairs):
            new = self.pairs[np.minimum(at, len(self.pairs) - 1)] != key
        if new.any():
            fresh = key[new]
            p = self.v.pieces
            ok = [a < 0 or b < 0 or self.merged(p[a] + p[b]) == [p[a], p[b]]
                  for a, b in zip((fresh // n).tolist(), (fresh % n).tolist())]
            self.pairs, self.left_apart = (np.insert(x, at[new], y) for x, y in ((self.pairs, fresh), (self.left_apart, ok)))
            at = np.searchsorted(self.pairs, key)
        out = self.left_apart[at]
        return out[back] | (left < 0) | (right < 0)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        out: list = [None] * len(words)
        # runs of spaces have pieces with equal scores and are merged by definition, as are very long words,
        # which would be relaxed one position after another
        plain = []
        for i, w in enumerate(words):
            if w.startswith(SPACE * 2) or not 1 < len(w) <= LONGEST:
                out[i] = self._ids(self.merged(w))
            else:
                plain.append(i)
        for a in range(0, len(plain), INDEX_WORDS):
            part = plain[a:a + INDEX_WORDS]
            for i, ids in zip(part, self._lattice([words[i] for i in part])):
                out[i] = ids
        return out

    def _ids(self, pieces: list[str]) -> bytes:
        ids = [k for p in pieces for k in ([self.id[p]] if p in self.id else [self.byte[b] for b in p.encode()])]
        return np.array(ids, "<i4").tobytes()

    def _suffixes(self, code: np.ndarray) -> np.ndarray:
        """Positions in the order of the text that begins at each, compared as
        far as the longest piece. Characters are numbered and packed, as many
        as fit into 64 bits, so one sort ranks the beginnings of that length; a
        pair of ranks is a beginning of twice the length."""
        chars, rank = np.unique(code, return_inverse=True)
        bits = max(1, int(len(chars)).bit_length())
        k = min(63 // bits, self.codes.shape[1])
        key, rank = np.zeros(len(code), np.int64), rank.astype(np.int64) + 1
        for j in range(k):
            key <<= bits
            key[:max(len(code) - j, 0)] |= rank[j:]
        while k < self.codes.shape[1]:
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
            key = rank << 32
            key[:max(len(code) - k, 0)] |= rank[k:]
            k *= 2
        return np.argsort(key, kind="stable").astype(np.int32)

    def _occurrences(self, code: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece the range of suffixes that begin with it, by binary
        search one character after another."""
        lo, hi = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(order))
        padded = np.concatenate([code, np.zeros(self.codes.shape[1], np.uint32)])
        for j in range(self.codes.shape[1]):
            act = np.flatnonzero((self.size > j) & (lo < hi))
            want = self.codes[act, j]
            ends = []
            for upper in (False, True):
                a, b = lo[act], hi[act]
                while True:
                    todo = a < b
                    if not todo.any():
                        break
                    m = (a + b) // 2
                    c = padded[order[np.minimum(m, len(order) - 1)] + j]
                    less = (c <= want if upper else c < want) & todo
                    a, b = np.where(less, m + 1, a), np.where(todo & ~less, m, b)
                ends.append(a)
            lo[act], hi[act] = ends
        return lo, np.maximum(hi, lo)

    def _lattice(self, words: list[str]) -> list[bytes]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("\x00".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        order = self._suffixes(code)
        lo, hi = self._occurrences(code, order)
        n = hi - lo
        at = np.repeat((lo - (np.cumsum(n) - n)).astype(np.int32), n) + np.arange(n.sum(), dtype=np.int32)
        pos, piece, length = order[at].astype(np.int32), np.repeat(self.ids, n), np.repeat(self.size, n)
        known = np.zeros(len(code), bool)
        known[pos[length == 1]] = True
        known[(first + size)[:-1]] = True  # separators
        rest = np.flatnonzero(~known)
        pos, piece, length = (np.concatenate(p) for p in (
            (pos, rest.astype(np.int32)), (piece, np.full(len(rest), -1, np.int32)),
            (length, np.ones(len(rest), np.int32))))
        word = np.repeat(np.arange(len(words), dtype=np.int32), size + 1)[pos]
        depth = pos - first.astype(np.int32)[word]
        by = np.argsort(depth.astype(np.uint16) if size.max() < 1 << 16 else depth, kind="stable")
        pos, piece, length, word, depth = (x[by] for x in (pos, piece, length, word, depth))
        via = np.full(len(code) + 1, -1)  # the edge that ends the encoding of each prefix
        torn = np.zeros(len(words), bool)  # words with two ways to a prefix, or none
        edge = np.searchsorted(depth, np.arange(int(size.max()) + 1))
        for d in range(int(size.max())):
            e = np.arange(edge[d], edge[d + 1])
            if d:
                e = e[via[pos[e]] >= 0]
                e = e[self._apart(piece[via[pos[e]]], piece[e])] if len(e) else e
            end = pos[e] + length[e]
            torn[word[e[via[end] >= 0]]] = True
            via[end] = e
        now = first + size
        torn |= via[now] < 0
        got, live = [], np.flatnonzero(~torn)
        now = now[live]
        while len(live):
            e = via[now]
            got.append(np.stack([live, e]))
            now = pos[e]
            go = now > first[live]
            live, now = live[go], now[go]
        w, e = np.concatenate(got[::-1], axis=1) if got else np.zeros((2, 0), np.int64)
        by = np.argsort(w, kind="stable")  # the pieces of a word stay in the order of their positions
        w, e = w[by], e[by]
        data, end = piece[e].astype("<i4").tobytes(), np.cumsum(np.bincount(w, minlength=len(words))).tolist()
        out = [data[4 * a:4 * b] for a, b in zip([0, *end], end)]
        raw = set(w[piece[e] < 0].tolist())  # words with a character outside the vocabulary
        for i in raw | set(np.flatnonzero(torn).tolist()):
            if i in raw:
                mine = e[end[i - 1] if i else 0:end[i]]
                out[i] = self._ids([words[i][a:a + n] for a, n in zip((pos[mine] - first[i]).tolist(), length[mine].tolist())])
            else:
                out[i] = self._ids(self.merged(words[i]))
        return out


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with `ids`, the token ids of every whole text (an array; null and
    empty texts have none). All columns stay, but one named ids is replaced and
    the text goes where it is not to be kept."""
    encoder = shared(docs.sparkSession, load(model_path), _encoder)
    names = [c for c in docs.columns if c != "ids"]
    kept = [c for c in names if keep_text or c != text_col]
    schema = docs.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for b in batches:
            for s in by_bytes(b, text_col, 4 << 20):
                ids = enc.encode_batch(s.column(text_col).to_pylist())
                off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield s.select(kept).append_column("ids", pa.ListArray.from_arrays(off, np.concatenate(ids)))

    return docs.select(*names).mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """`tokens` with the column `to`, the text of the token ids (null ids
    inside an array are skipped, a null array gives an empty text). All columns
    stay, but one named `to` is replaced."""
    encoder = shared(tokens.sparkSession, load(model_path), _encoder)
    names = [c for c in tokens.columns if c != to]
    schema = tokens.select(*names).schema.add(to, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for b in batches:
            for s in by_size(b, pc.fill_null(pc.list_value_length(b.column(ids_col)), 0), 1 << 19):
                lists = s.column(ids_col)
                flat = lists.flatten()  # without the values below null lists
                size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                given = flat.is_valid().to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(given)])[np.concatenate([[0], np.cumsum(size)])]
                ids = flat.drop_null().to_numpy().astype(np.int64)
                yield s.append_column(to, pa.array(enc.decode_batch(ids, ends), pa.string()))

    return tokens.select(*names).mapInArrow(run, schema)

"""Language identification by error-correcting output codes.

Every language has a codeword of bits; for each bit a ridge classifier over
hashed letter n-grams predicts on which side of the bit a text lies. Decoding
chooses the codeword with the smallest weighted hinge loss over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.words import by_bytes

DIM = 2048
UNKNOWN = "und"

# letters keep their bytes (A-Z in lower case), all other ASCII becomes a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """The square roots of the shares of hashed byte bigrams and trigrams."""
    b = np.frombuffer(b" " + text.encode().translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] * np.uint32(0x9E37) + b[1:] * np.uint32(0x85EB)) ^ np.uint32(0x5BD1)
    three = two[:-1] * np.uint32(0x01000193) + b[2:] * np.uint32(0xC2B2AE35)
    use2 = ~((b[:-1] == 32) & (b[1:] == 32))
    use3 = use2[:-1] & (b[1:-1] != 32)
    slot = np.concatenate([(two[use2] * np.uint32(0x27D4EB2F)) >> np.uint32(21),
                           (three[use3] * np.uint32(0x165667B1)) >> np.uint32(21)])
    n = np.bincount(slot, minlength=DIM).astype(np.float32)
    return np.sqrt(n / max(len(slot), 1))


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def codewords(n: int) -> np.ndarray:
    """(n languages, bits) of +1 and -1: every split of the languages in two
    up to seven languages, else the best separated of 200 random codes."""
    if n <= 7:
        cols = [[1] + [1 if s >> i & 1 else -1 for i in range(n - 1)] for s in range((1 << (n - 1)) - 1)]
        return np.array(cols, np.float64).T.reshape(n, -1)
    rng, best = np.random.default_rng(9), (-1, None)
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        gap = int(((bits - code @ code.T) / 2 + bits * np.eye(n)).min())
        if gap > best[0]:
            best = (gap, code)
    return best[1]


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # (DIM + 1, bits)
    trust: np.ndarray  # weight of each bit's loss

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score in 0..1, ambiguous) of feature rows.
        The score is the winner's share of exp(-8 loss); a text is ambiguous
        when the second best loss is less than 0.05 greater."""
        f = np.clip(np.hstack([x, np.ones((len(x), 1))]) @ self.weights, -1.5, 1.5)
        loss = np.maximum(0, 1 - f[:, None, :] * self.code[None]) @ self.trust
        if loss.shape[1] == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(x))
        e = np.exp(-8 * (loss - loss.min(axis=1, keepdims=True)))
        gap = loss[rows, order[:, 1]] - loss[rows, order[:, 0]]
        return order[:, 0], (e / e.sum(axis=1, keepdims=True))[rows, order[:, 0]], gap < 0.05


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample: int = 4000, ridge: float = 1e-3) -> LanguageModel:
    """Fit on at most about `sample` rows with a language and a letter, spread
    evenly over the languages (drawn by a hash of the id)."""
    d = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in d.groupBy(lang_col).count().collect()}  # one row per language
    if not counts:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((DIM + 1, 0)), np.zeros(0))
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        bound = int(min(1.0, sample / len(counts) / n) * (1 << 30))
        share = F.when(F.col(lang_col) == lang, F.lit(bound)).otherwise(share)
    d = d.where(F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 30)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(g, features(t).astype(np.float16).tobytes())
                    for g, t in zip(*(c.to_pylist() for c in b.columns)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])

    got = d.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        run, "lang string, x binary").collect()  # about `sample` rows of 4 KB
    langs = sorted({r.lang for r in got})
    if not langs:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((DIM + 1, 0)), np.zeros(0))
    at = {g: i for i, g in enumerate(langs)}
    cls = np.array([at[r.lang] for r in got])
    code = codewords(len(langs))
    y = code[cls]
    w8 = (1.0 / np.bincount(cls, minlength=len(langs)))[cls] * len(cls) / len(langs)  # languages weigh alike

    def blocks():  # a few hundred rows at a time, so the driver holds no matrix of the whole sample
        for a in range(0, len(got), 250):
            x = np.stack([np.frombuffer(r.x, np.float16) for r in got[a:a + 250]]).astype(np.float64)
            yield slice(a, a + 250), np.hstack([x, np.ones((len(x), 1))])

    gram, right = ridge * len(got) * np.eye(DIM + 1), np.zeros((DIM + 1, code.shape[1]))
    for s, x in blocks():
        gram += (x * w8[s, None]).T @ x
        right += (x * w8[s, None]).T @ y[s]
    weights = np.linalg.solve(gram, right)
    margin = sum((np.sign(x @ weights) == y[s]).sum(axis=0) for s, x in blocks()) / len(got)
    trust = np.maximum(margin - 0.5, 1e-3)
    return LanguageModel(langs, code, weights, trust / trust.sum() if len(trust) else trust)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """`docs` with (lang_pred, score, ambiguous), predicted from the whole text
    alone. Null texts and texts without a letter give `und` with score 0, and
    so does a model that has learned no language. Columns with these names are
    replaced, all others stay."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]

    schema = T.StructType(docs.select(*names).schema.fields + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in by_bytes(b, text_col):
                texts = s.column(text_col).to_pylist()
                n = len(texts)
                lang, score, flag = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                rows = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
                for a in range(0, len(rows), 500):
                    part = rows[a:a + 500]
                    k, score[part], flag[part] = model.predict(np.stack([features(texts[i]) for i in part]))
                    for i, c in zip(part, k.tolist()):
                        lang[i] = model.langs[c]
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(flag)],
                                                 schema.names)

    return docs.select(*names).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text has remainder 2 by 4 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))

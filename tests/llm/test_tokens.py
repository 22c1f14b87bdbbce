import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tables import documents, empty

from rivulet.llm import packing, pieces
from rivulet.llm.queries import tokenizer_path

WORDS, PIECES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def check_packing(got, rows, tokenizer, length):
    """Every id in exactly one piece, sequences gapless and of allowed lengths."""
    want = Counter()
    for i, t in rows:
        want[i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 2)] += 1
    found, seqs = Counter(), {}
    by_doc = {}
    for r in got:
        assert r.length > 0 and len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, n), parts in by_doc.items():
        starts = Counter()
        for r in parts:
            starts[r.start] += 1
        if starts[0] == 1:
            ids = [x for r in sorted(parts, key=lambda r: r.start) for x in r.ids]
            found[i, tuple(ids)] += 1
            assert len(ids) == n
        else:  # equal or repeated rows: all have the same ids here, or are in one piece
            whole = [r for r in parts if r.length == n]
            for r in whole:
                found[i, tuple(r.ids)] += 1
            rest = sorted((r for r in parts if r.length != n), key=lambda r: r.start)
            assert sum(r.length for r in rest) % n == 0
            for k in range(sum(r.length for r in rest) // n):
                found[next(w for w in want if w[0] == i and len(w[1]) == n)] += 1
    assert found == want
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= length and at & (at - 1) == 0
    return seqs


def test_packing_of_awkward_rows(spark, tokenizer):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for length in (4096, 16):
        got = packing.pack(docs, WORDS, length=length, with_ids=True).collect()
        check_packing(got, rows, tokenizer, length)
    assert packing.pack(empty(spark, docs), WORDS).collect() == []


def test_packing_of_sf_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = packing.pack(docs, WORDS, with_ids=True).collect()
    check_packing(got, [tuple(r) for r in docs.collect()], tokenizer, 4096)


def test_word_tokenizer_equals_whole_texts(tokenizer):
    texts = ["Don't it's WE'LL x.y.z 3,14 A1b2 <|endoftext|> <|ENDOFTEXT|>", "é É ΑΣ Σ. naïve... İx ǅ ﬁ", None, "",
             " a b c  d\x85e\x1f", "日本語。ab\x00c", "word, word; word! word? Word. WORD", "x" * 5000]
    tok = packing.WordTokenizer(open(WORDS, encoding="utf-8").read())
    ids, off = tok.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = packing.hilbert_keys(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_similar_texts_have_close_keys():
    base = [" ".join(f"t{g}w{i % 40}" for i in range(200)) for g in range(30)]
    near = [b + " extra" for b in base]
    a, b = packing.curve_keys(pa.array(base)), packing.curve_keys(pa.array(near))
    rng = np.random.default_rng(0)
    assert np.median(np.abs(a - b)) < 0.05 * np.median(np.abs(a - rng.permutation(b)))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library(library):
    rng = np.random.default_rng(2)
    odd = ["", None, " ", "   a b", "Hello  world\n\tx\n\n", "é́ ﬁ", "日本語🎉", "▁x", "a▁▁b", " " * 40 + "x" + " " * 33,
           "a<s>b<0x0A>", "\x00a\x00", "a" * 60 + " bbbbbbb", "http://www.example.com/index.html?x=1&y=2", "\n"]
    rnd = ["".join(rng.choice(list("abcdeinrst hT.\n1,é"), 200)) for _ in range(300)]
    enc = pieces._encoder(pieces.load(PIECES))
    for texts in (odd, rnd):
        got = [x.tolist() for x in enc.encode_batch(texts)]
        assert got == library.encode([t or "" for t in texts])
        assert [enc.decode(x) for x in got] == library.decode(got)
    assert enc.decode(library.piece_to_id(["▁a", "<0xFF>", "b"])) == "a�b"


def test_pieces_of_short_and_long_texts(library):
    for first in ("hello", "cat dog", "a", "x y z", "日本"):
        assert pieces._encoder(pieces.load(PIECES)).encode(first) == library.encode(first)
    warm = pieces._encoder(pieces.load(PIECES))
    warm.encode_batch(["some words to begin with, and many more of them"])
    for t in ("some new words", "tiny", "with b", "q"):
        assert warm.encode(t) == library.encode(t)
    for t in (" " * 100_000 + "x", "ab" * 500_000, "y" * 3000 + "日" * 3000, ("-" * 2500 + " ") * 3):
        assert warm.encode(t) == library.encode(t)


def test_pieces_of_one_short_row(spark, library):
    df = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    got = pieces.decode(pieces.encode(df, PIECES).drop("text"), PIECES).first()
    assert (got.ids, got.text) == (library.encode("hello"), "hello")


def test_pieces_of_tables(spark, library):
    for docs in (documents(spark).selectExpr("*", "1 AS ids"),
                 spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        coded = pieces.encode(docs, PIECES)
        assert coded.columns == [c for c in docs.columns if c != "ids"] + ["ids"]
        back = pieces.decode(coded.withColumnRenamed("text", "was"), PIECES).collect()
        assert len(back) == docs.count()
        for r in back:
            assert r.ids == library.encode(r.was or "")
            assert r.text == (r.was or "")
    assert pieces.encode(empty(spark, documents(spark)), PIECES).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([259, None],)], "ids array<int>")
    assert [r.text for r in pieces.decode(odd, PIECES).collect()] == ["", "", " "]

import pyarrow as pa
from tables import ascii_lower, words

from rivulet.llm.words import by_bytes, shingle_sets, split_words, word_hashes

TEXTS = ["A b a", None, "", "  c\td ", "É é x\u00a0y", "b A", "long " * 50, "\x0b\x0c", "z"]


def test_slices_give_the_words_of_their_rows():
    for typ in (pa.string(), pa.large_string()):
        whole = pa.array(TEXTS, typ)
        for a in range(len(TEXTS)):
            for n in range(1, len(TEXTS) - a + 1):
                w, idx, off = split_words(whole.slice(a, n))
                got = [[w[i].as_py() for i in idx[x:y]] for x, y in zip(off[:-1], off[1:])]
                assert got == [words(t) for t in TEXTS[a:a + n]]


def test_batches_cut_by_size_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["id", "text"])
    for limit in (1, 5, 1000):
        parts = list(by_bytes(batch, "text", limit))
        assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
        cut = [s.tolist() for p in parts for s in shingle_sets(p.column("text"), 2)]
        assert cut == [shingle_sets(pa.array([t]), 2)[0].tolist() for t in TEXTS]
    assert list(by_bytes(batch.slice(0, 0), "text")) == []


def test_lower_case_and_distinct_hashes():
    plain = word_hashes(pa.array(["abc", "ABC", "aBc", "abd", "ab", "cba", "É"]), lower=True)
    assert len(set(plain[:3].tolist())) == 1 and len(set(plain.tolist())) == 5
    assert len(set(word_hashes(pa.array(["abc", "ABC", "aBc"])).tolist())) == 3
    for k in (1, 2, 3):
        for t in TEXTS:
            w = words(ascii_lower(t))
            n = len({tuple(w[i:i + k]) for i in range(len(w) - k + 1)}) if len(w) >= k else min(len(w), 1)
            assert len(shingle_sets(pa.array([t]), k)[0]) == n

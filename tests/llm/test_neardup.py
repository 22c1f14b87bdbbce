import random
from collections import defaultdict

import numpy as np
import pytest
from tables import ascii_lower, documents, empty, words

from rivulet.llm import hyperminhash as H
from rivulet.llm.common import components
from rivulet.llm.neardup import _confirmed, deduplicated, near_duplicates


def shingles(text, k):
    w = words(ascii_lower(text))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent=80):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_matches_brute_force_on_awkward_rows(spark, k):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, k)
    got = near_duplicates(docs, shingle=k).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id), r
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(len(shingles(t, k)))
    assert all(r.n_shingles in texts[r.doc_id] for r in got)


def test_matches_brute_force_on_noisy_copies(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(400)]
    rows, n = [], 0
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(rng.choice([1, 4, 15])):
            w = [x if rng.random() > rng.choice([0, 0.02, 0.05, 0.09]) else rng.choice(vocab) for x in base]
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    want = brute(rows, 2)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_rows_sharing_an_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(7, a), (7, b), (3, a), (9, b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(7, 3), (3, 3), (9, 3)}


def test_second_texts_without_words_link_nothing(spark):
    a = " ".join(f"a{i}" for i in range(30))
    rows = [(i, a + f" z{i}") for i in range(3, 9)] + [(i, t) for i in range(3, 9) for t in (None, "", " \n")]
    rows += [(20, "one two"), (20, None), (21, "one two three"), (21, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == brute(rows, 5)
    cells = spark.createDataFrame([(1, 0, 0, 3, 3), (1, 0, 1, 7, 7)], "cell long, part long, side int, id long, label long")
    docs = spark.createDataFrame([(3, "one"), (7, None)], "id long, text string")
    assert _confirmed(cells, docs, 5, 80).collect() == []


def test_empty_table_and_other_columns(spark):
    docs = documents(spark)
    assert near_duplicates(empty(spark, docs)).collect() == []
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(None) == 2 and ids.count(12) == 2


def test_sf_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()], 2)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=2).collect()} == want


def test_estimates_are_unbiased():
    rng = np.random.default_rng(1)
    for j in (0.0, 0.5, 0.8):
        a, b = [], []
        for _ in range(60):
            x = rng.integers(1, 1 << 62, 2000, dtype=np.uint64)
            common = int(round(2 * 1000 * j / (1 + j)))
            a.append(np.unique(x[:1000]))
            b.append(np.unique(np.concatenate([x[:common], x[1000:2000 - common]])))
        est, _ = H.jaccard_estimate(H.registers(a), H.registers(b), np.full(60, 1000), np.full(60, 1000))
        assert abs(est.mean() - j) < 0.02


def test_small_sets_at_the_threshold_meet():
    """Pairs at exactly 0.8 of up to 60 shingles: the bands miss no more than
    their formula says (3 in 10^6)."""
    rng = np.random.default_rng(9)
    a, b = [], []
    for _ in range(20_000):
        n = int(rng.integers(1, 13)) * 5  # union; 4/5 of it in common
        x = np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64))
        k, cut = len(x) // 5, rng.permutation(len(x))
        a.append(np.sort(x[cut[:len(x) - k // 2]]))
        b.append(np.sort(x[cut[k - k // 2:]]))
    keys = [H.independent_band_keys(s, 42, 6) for s in (a, b)]
    assert ((keys[0] == keys[1]).any(axis=1)).sum() >= 19_998


def test_sets_around_the_small_bound(spark):
    rng, rows = random.Random(8), []
    for g in range(40):  # pairs of 58 to 80 shingles, on both sides of the bound
        base = [f"g{g}w{i}" for i in range(rng.randint(58, 80))]
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(base[:-rng.randint(1, 12)] + ["end"]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 2)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(5, 5), (200, 150), (150, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 150: 150, 200: 150}

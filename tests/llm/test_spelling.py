import random
import re
import zlib
from collections import Counter

import numpy as np
from tables import documents, empty

from rivulet.llm.automata import minimal_acceptor, one_edit_pairs
from rivulet.llm.queries import queries
from rivulet.llm.spelling import spelling_variants


def brute_words(rows, min_chars=6, min_count=5, mod=199):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if mod and h % mod == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=5):
    by = {}  # words that share a text with one code point deleted or left out
    for w in n:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by.setdefault(v, set()).add(w)
    near = {w: set() for w in n}
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if b != a and is_near(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def result(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_composition_equals_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        abc = "abcé"[:rng.randint(1, 4)]
        both = sorted({(rng.randint(0, 2), "".join(rng.choices(abc, k=rng.randint(0, 6)))) for _ in range(rng.randint(1, 60))})
        words = [w for _, w in both]
        i, j = one_edit_pairs(minimal_acceptor(words, np.array([b for b, _ in both])))
        want = [(x, y) for x in range(len(both)) for y in range(x + 1, len(both))
                if both[x][0] == both[y][0] and is_near(words[x], words[y])]
        assert sorted((min(p), max(p)) for p in zip(i.tolist(), j.tolist())) == want


def test_acceptor_is_minimal():
    words = sorted(a + m + e for a in "abc" for m in ("nt", "ntel") for e in ("", "s", "ing"))
    a = minimal_acceptor(words, np.zeros(len(words), np.int64))
    one = minimal_acceptor([w[1:] for w in words if w[0] == "a"], np.zeros(6, np.int64))
    assert len(a.final) == len(one.final) + 1  # the three beginnings share all that follows


def test_variants_with_awkward_texts(spark):
    rng = random.Random(2)
    letters = "abcdeéÀ÷"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(40)]
    vocabulary += [w[:2] + "z" + w[2:] for w in vocabulary] + [w[1:] for w in vocabulary] + ["Q" * 3000, "Q" * 2999, "aaaaaa", "aaaaaaa"]
    weights = [rng.choice((1, 1, 6, 40)) for _ in vocabulary]
    rows = [(rng.choice((None, i, i, 7)), " ".join(rng.choices(vocabulary, weights, k=90)) + rng.choice(("", "\n", "日本x", ".É"))) for i in range(60)]
    rows += [(500 + i, "hotword hotwords hotwird xhotword " * 20) for i in range(30)] + [(1, None), (2, ""), (3, " 12 日 ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS word", "1 AS n", "2 AS part", "'r' AS root")
    for options in ({}, {"part_words": 3}, {"part_words": 3, "drop_mod": 2, "ratio": 2, "min_count": 2}):
        n = brute_words(rows, min_count=options.get("min_count", 5), mod=options.get("drop_mod", 199))
        assert result(spelling_variants(df, **options)) == brute(n, options.get("ratio", 5)), options
    assert spelling_variants(empty(spark, df)).collect() == []
    assert spelling_variants(df.where("text IS NULL OR text = ''")).collect() == []
    docs = documents(spark)
    assert result(spelling_variants(docs, min_count=1)) == brute(brute_words([(r.doc_id, r.text) for r in docs.collect()], min_count=1))


def test_the_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = result(queries()["op11_composed_acceptors"](spark, d))
    assert got == brute(brute_words(rows)) and any(r[1] for r in got)

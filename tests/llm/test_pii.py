import hashlib
import random
import re

from tables import documents, empty

from rivulet.llm.pii import KINDS, base_spans, find_personal_data
from rivulet.llm.queries import queries

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k in KINDS:
        for m in re.finditer(FORMS[k], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if k == "ip" else 0,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[k]:
                out.append((k, *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check_base(rows, got):
    assert len(rows) == len(got)
    want = sorted((str(i), *(sum(k == s[0] for s in brute(t)) for k in KINDS), hashlib.sha256(joined(brute(t)).encode()).hexdigest())
                  for i, t in rows)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want


def test_base_spans_are_the_plain_matches():
    rng = random.Random(5)
    parts = list("ab1234567890") * 2 + ["@", ".", "-", " ", "+", "(", ")", "_", "%", "é", "\n", "255", "4111 1111-1111 1111", "+1 (234) 555-", "x@y.z"]
    for _ in range(4000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert base_spans(t) == brute(t), t
    for t in ("1" * 300_000, "a" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000, "a.b" * 100_000 + "@c", "(1" * 100_000):
        base_spans(t)


def text_of(rng, slot):
    return " ".join(rng.choices(WORDS, k=12)) + " " + slot + " " + " ".join(rng.choices(WORDS, k=12))


WORDS = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]


def contextual(seed=1):
    """Texts in which the words `phone no` and `mail:` stand before values,
    some of them in looser forms, and numbers that are nobody's."""
    rng, rows, want = random.Random(seed), [], {}
    for i in range(60):
        number = f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        loose = i % 4 == 0
        slot = ("Phone no " if i % 2 else "phone NO ") + (number if loose else f"+1 {number}")
        if i % 3 == 0:
            slot += f" mail:u{i}[at]host{i}[dot]org" if i % 12 == 0 else f" mail:u{i}@host{i}.org"
        t = text_of(rng, slot)
        want[i] = []
        if loose:
            want[i].append(("phone", t.index(number), t.index(number) + len(number)))
        if i % 12 == 0:
            a = f"u{i}[at]host{i}[dot]org"
            want[i].append(("email", t.index(a), t.index(a) + len(a)))
        rows.append((i, t))
    for i in range(60, 90):  # clean: the number is a part number
        rows.append((i, text_of(rng, f"part number {rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}")))
        want[i] = []
    # most of what follows `see` is no address, so it vouches for nothing
    rows += [(90 + i, text_of(rng, f"see u{i}@b.com" if i < 6 else f"see u{i}[at]b" if i < 8 else "see word")) for i in range(40)]
    return rows, want


def test_contexts_find_unseen_values(spark):
    rows, want = contextual()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS kind", "1 AS row", "'x' AS value")
    got = find_personal_data(df).collect()
    check_base(rows, got)
    for r in got:
        text = dict(rows)[r.doc_id]
        extra = [s for s in r.spans.split(",") if s and s not in joined(brute(text)).split(",")]
        assert extra == [f"{k}:{a}:{b}" for k, a, b in sorted(want.get(r.doc_id, []), key=lambda s: s[1])], (text, r)
        assert r.n_added == len(extra)
    none = find_personal_data(df, support=1000).collect()
    assert all(r.n_added == 0 for r in none)


def test_found_values_teach_new_patterns(spark):
    """The values that `dial` vouches for vouch for `ring` in the next round."""
    rng = random.Random(3)
    loose = [f"{200 + i}-555-{1000 + i}" for i in range(8)]
    rows = [(i, text_of(rng, f"kindly dial +1 234 555 {1000 + i}")) for i in range(40)]
    rows += [(100 + i, text_of(rng, f"kindly dial {x}")) for i, x in enumerate(loose)]
    rows += [(200 + i, text_of(rng, f"please ring {x}")) for i, x in enumerate(loose)]
    rows += [(300, text_of(rng, "please ring 987-555-4321"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in find_personal_data(df, rounds=1).where("n_added > 0").collect()} == set(range(100, 108))
    assert {r.doc_id for r in find_personal_data(df).where("n_added > 0").collect()} == set(range(100, 108)) | set(range(200, 208)) | {300}


def test_awkward_tables(spark):
    df = documents(spark)
    got = find_personal_data(df).collect()
    check_base([(r.doc_id, r.text) for r in df.collect()], got)
    assert find_personal_data(empty(spark, df)).collect() == []
    long = spark.createDataFrame([(1, "1" * 50_000 + " +1 234 567 8901 " * 500), (1, "x@y.zz " * 3000), (None, "10.0.0.1 " * 2000), (None, None)],
                                 "doc_id long, text string")
    check_base([(r.doc_id, r.text) for r in long.collect()], find_personal_data(long).collect())


def test_the_query_keeps_the_base(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op12_bootstrapped_pii"](spark, d).collect()
    check_base(rows, got)
    text = {i: t for i, t in rows}
    for r in got:
        assert set(joined(brute(text[r.doc_id])).split(",")) <= set(r.spans.split(","))

import hashlib
import re
import zlib
from collections import Counter

import pytest
from tables import documents, empty, words

from rivulet.llm import langid, linededup, quality
from rivulet.llm.linededup import drop_repeated_lines
from rivulet.llm.sharding import shard
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(WHITE).encode().lower()


def brute_lines(rows, min_docs, keep):
    count, first = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            count[k] += 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        for k in {key(x) for x in (t or "").split("\n")}:
            first.setdefault(k, (i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not key(x) or count[key(x)] < min_docs or (keep == "first" and first[key(x)] == (i, t))]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bits", [1 << 26, 1 << 6])
def test_line_dedup_matches_brute_force(spark, keep, bits):
    docs = documents(spark).where("doc_id IS NOT NULL")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = drop_repeated_lines(docs, min_docs=3, keep=keep, bits=bits)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = sorted((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect())
    assert got == sorted(brute_lines(rows, 3, keep))


@pytest.mark.parametrize("bits", [None, 1 << 14, 1 << 6])
def test_line_dedup_with_filters_too_large_to_broadcast(spark, bits, monkeypatch):
    monkeypatch.setattr(linededup, "SEGMENT", 1 << 8)
    monkeypatch.setattr(linededup, "SAMPLE", 40)
    docs = documents(spark).where("doc_id IS NOT NULL").select("doc_id", "text").union(
        spark.range(300).selectExpr("id + 1000", "concat('Hot line\\nown ', id, '\\nby ten ', id div 10)")).repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for keep in ("none", "first"):
        got = drop_repeated_lines(docs, min_docs=3, keep=keep, bits=bits, broadcast_bits=0).collect()
        assert sorted((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got) == sorted(brute_lines(rows, 3, keep))
    assert drop_repeated_lines(empty(spark, docs), broadcast_bits=0).collect() == []


def test_filters_grow_with_the_lines(spark):
    """Of 40 000 lines the repeated ones are all suspects, and few others."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('a', id, '\\nb', id div 4) AS text")
    rows = docs.selectExpr("unhex(md5(text)) AS own", "doc_id AS id", "text")
    digests = rows.mapInArrow(linededup._digests(1), "id long, own binary, line binary").cache()
    try:
        for limit in (1 << 26, 0):
            n = linededup._suspects(digests, "id long, own binary, line binary", None, limit).count()
            assert 20_000 <= n < 20_000 + 400
    finally:
        digests.unpersist()


def test_line_dedup_null_ids_empty_table_and_min_chars(spark):
    docs = documents(spark)
    assert drop_repeated_lines(docs).count() == docs.count()
    assert drop_repeated_lines(empty(spark, docs)).collect() == []
    two = spark.createDataFrame([(1, "ab\néé\nlong line"), (2, "ab\néé\nlong line")], "doc_id long, text string")
    got = drop_repeated_lines(two, min_docs=2, min_chars=3).collect()
    assert [r.text for r in got] == ["ab\néé"] * 2


def test_line_dedup_on_sf_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in drop_repeated_lines(docs, min_docs=2).collect())
    assert got == sorted(brute_lines(rows, 2, "none"))


def statistics(t):
    t = t or ""
    w = words(t)
    win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if words(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_statistics_match_brute_force(spark):
    docs = documents(spark).unionByName(spark.createDataFrame(
        [(50, "a b c a b c\na b c\na b c\n\n\n#1 $x"), (51, "p q r s p q r"), (52, "z z z z z")],
        "doc_id long, text string"), allowMissingColumns=True)
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    docs = docs.unionByName(sf, allowMissingColumns=True).withColumn("copy", F.col("text"))
    for r in quality.text_statistics(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == statistics(r.copy), r.doc_id


def test_rules_learn_a_threshold_and_stay_empty_without_labels(spark):
    rows = [(i, ("clean words here " * (20 + i % 7)) + ("# " * 30 if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)] + [(None, 0), (3, None)],
                                   "doc_id long, quality int")
    stats = quality.text_statistics(docs)
    rules = quality.learn_rules(stats.join(quality.labelled(labels), "doc_id"))
    assert rules.rules and "reject if" in str(rules)
    got = {r.doc_id: r.v for r in stats.select("doc_id", rules.verdict().alias("v")).collect()}
    assert all((got[i] > 0) == (i % 4 == 0) for i in got)
    none = stats.join(quality.labelled(empty(spark, labels)), "doc_id")
    assert quality.learn_rules(none).rules == []
    one = stats.join(quality.labelled(labels.where("quality = 1")), "doc_id")
    assert quality.learn_rules(one).rules == []
    assert quality.text_statistics(empty(spark, docs)).collect() == []


def test_quality_plan_has_no_python(spark):
    docs = documents(spark)
    rules = quality.RuleList([[("symbol_ratio", ">", 0.1), ("word_length", "<=", 9.0)]])
    plan = quality.text_statistics(docs).withColumn("v", rules.verdict())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_shards_are_balanced_gapless_and_group_equal_texts(spark):
    docs = documents(spark)
    rows = [(i, f"text number {i % 200} " * (i % 9 + 1)) for i in range(3000)] + [(9000 + i, "hot copy") for i in range(2000)]
    big = spark.createDataFrame(rows, "doc_id long, text string")
    for df, n in ((big, 16), (docs.where(F.length("text") < 1000), 3)):
        size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
        got = shard(df.withColumn("h", F.xxhash64("text")), size, F.col("h"), n).collect()
        assert len(got) == df.count()
        total, slots, largest = Counter(), {}, 0
        for r in got:
            s = len((r.text or "").encode()) + 1
            total[r.shard] += s
            largest = max(largest, s)
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert max(total.values()) - min(total[i] for i in range(n)) <= 2 * largest
        if n == 16:
            places = {}
            for r in got:
                places.setdefault(r.text, set()).add(r.shard)
            assert sum(len(p) > 1 for p in places.values()) <= n - 1
    assert shard(empty(spark, docs), F.lit(1), F.lit(0)).collect() == []
    same = shard(spark.range(500).select(F.lit(1).alias("k")), F.lit(1), F.lit(0), 4).collect()
    assert Counter(r.shard for r in same) == {i: 125 for i in range(4)}


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(~langid.held_out()))
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs.where(langid.held_out()).collect())
    got = langid.identify(docs.where(langid.held_out()), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    odd = documents(spark)
    out = langid.identify(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    for r in out.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    nothing = langid.learn(empty(spark, odd))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}
    single = langid.learn(odd.where("lang = 'fr'"))
    assert {r.lang_pred for r in langid.identify(odd, single).collect()} == {"und", "fr"}
    assert langid.identify(empty(spark, odd), model).collect() == []


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 12, 30):
        c = langid.codewords(n)
        gaps = [(c[i] != c[j]).sum() for i in range(n) for j in range(i)]
        assert c.shape[0] == n and min(gaps) >= (2 ** (n - 2) if n <= 7 else c.shape[1] // 5)


def test_digest_query_matches(spark):
    from rivulet.llm.queries import queries

    got = queries()["op6_line_bloom"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute_lines(list(docs.items()), 10, "none")}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == want

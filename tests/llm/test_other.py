import base64
import hashlib
from collections import defaultdict

import duckdb
import numpy as np
from tables import empty

from rivulet.llm import warc
from rivulet.llm.ann import grow_tree, nearest, usable
from rivulet.llm.chat import perspectives
from rivulet.llm.queries import oracle_sql, queries


def brute_nearest(rows, mod, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 4
          and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for q, x in ok:
        if q % mod == 0:
            d = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok if i != q)
            out[q] = [(r + 1, i, s) for r, (s, i) in enumerate(d[:k])]
    return out


def test_nearest_with_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(120)]
    rows += [(200 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(30)]  # copies: ties go to smaller ids
    rows += [(500, None), (510, [0.0] * 4), (520, [1.0, None, 0.0, 2.0]), (530, [float("nan"), 1.0, 1.0, 1.0]),
             (540, [float("inf"), 0.0, 0.0, 1.0]), (550, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0]), (560, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS leaf", "1 AS id")
    got = defaultdict(list)
    for r in nearest(df, query_mod=10, recall=1.0, leaf_rows=8, fan=3).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_nearest(rows, 10, 10)
    assert nearest(empty(spark, df)).collect() == []
    few = spark.createDataFrame(rows[:4], df.schema.names[:2])
    assert sorted(r["rank"] for r in nearest(few).collect()) == [1, 2, 3]
    assert usable(df, "vec_id", "embedding")[1] == 4


def test_recall_of_the_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    hit, n = 0, 0
    got = defaultdict(dict)
    for r in queries()["op3_kmeans_tree"](spark, "/root/testdata/sf0.01").collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    at = {i: j for j, i in enumerate(ids)}
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[at[q]]) ** 2).sum(axis=1))
        true = [j for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        assert [got[q][i + 1] for i in range(10)] == sorted(got[q].values(), key=lambda v: (v[1], v[0]))
        assert all(s == d[at[i]] for i, s in got[q].values())
        hit, n = hit + len({i for i, _ in got[q].values()} & set(ids[true])), n + 10
    assert hit >= 0.9 * n


def test_tree_search_visits_every_leaf_once():
    x = np.random.default_rng(6).normal(size=(500, 5))
    tree = grow_tree(np.vstack([x, np.ones((50, 5))]), 4, 10, 5)
    assert sorted(tree.best_bins(x[3], 10_000)) == list(range(tree.leaves()))
    assert tree.best_bins(x[3], 1)[0] == tree.assign(x[3:4])[0]


def pages(spark):
    rows = [(1, "http://a/x?q=1", "<p>one</p>"), (2, "http://a/ü b", "<p>one</p>"), (3, None, None), (4, "", ""),
            (5, "http://a\r\nX: 1", "a\r\n\r\nb"), (9, "http://a/9", "<p>one</p>"), (6, "u", "é" * 50_000),
            (None, "http://n", "null id"), (None, "http://n", "null id"), (7, "u", "null id"), (8, "t", "tie"), (8, "t", "tie")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS digest", "1 AS top")


def expected(rows, min_bytes=0):
    top, out = {}, []
    for i, t in rows:
        if i is not None:
            top[t or ""] = max(i, top.get(t or "", i))
    for i, t in rows:
        b, ref = (t or "").encode(), None
        if len(b) >= min_bytes and (t or "") in top and i != top[t or ""]:
            ref = top[t or ""]
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def test_warc_round_trip(spark, tmp_dir):
    df = pages(spark)
    rows = [(r.page_id, r.html) for r in df.collect()]
    for min_bytes, roll in ((0, 200), (8, 64 << 20)):
        folder = f"{tmp_dir}/{min_bytes}"
        index = warc.write_archives(df, folder, min_bytes=min_bytes, roll_bytes=roll)
        got = warc.read_records(index, folder, max_gap=0, max_run=300, with_payload=True).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) \
            == expected(rows, min_bytes)
        text = defaultdict(set)
        for i, t in rows:
            text[i].add((t or "").encode())
        assert all(bytes(r.payload) in text[r.page_id] for r in got if r.record_type == "response")
        assert {r.url for r in index.collect()} == {r.url for r in df.collect()}
    some = index.where("page_id IN (6, 9)")
    assert sorted(r.page_id for r in warc.read_records(some, folder).collect()) == [6, 9]
    assert warc.write_archives(empty(spark, df), folder).collect() == []
    assert warc.read_records(empty(spark, index), folder).collect() == []


def test_warc_members_stand_alone(spark, tmp_dir):
    import gzip
    import os

    index = warc.write_archives(pages(spark), tmp_dir).collect()
    for r in index:
        with open(os.path.join(tmp_dir, r.file), "rb") as f:
            f.seek(r.offset)
            record = gzip.decompress(f.read(r.length)).decode()
        head, block = record.split("\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and fields["WARC-Type"] == r.record_type
        assert int(fields["Content-Length"]) == len(block.encode()) - 4 and block.endswith("\r\n\r\n")


def test_warc_damage_is_noticed(spark, tmp_dir):
    import pytest

    rec = warc._record(1, "u", b"payload", "WRONG", None, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc._parse(rec, False)


def conversations(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello\nann"), (1, 3, "ann", None), (1, 3, "ann", None),
            (1, 3, "bob", "tie"), (1, None, "cy", "no turn"), (2, 0, "system", "alone"), (3, 0, None, "who"), (3, 1, "  ", "blank"),
            (3, 2, " ann ", "🎉"), (None, 0, "bob", "null conversation"), (None, 1, "ann", "x")]
    rows += [(7, t, ("ann", "bob", "cy")[t % 3], f"turn {t}") for t in range(1000)]
    rows += [(8, t, ("system", "ann", "bob")[min(t, 1 + t % 2)], f"turn {t}") for t in range(66)]
    rows += [(9, None, ("ann", "bob")[t % 2], f"turn {t % 40}") for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "'c' AS key", "'c' AS speaker", "1 AS segment", "2 AS number")


def rendered_dialogues(rows):
    """An independent renderer: {(conversation, speaker): (text, masks)}."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t, (role or "").strip(" ") or None, text or "") for c, t, role, text in rows if c == conv]
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", hashlib.sha256(r[2].encode()).hexdigest()))
        for speaker in {role for _, role, _ in turns if role not in (None, "system")}:
            text, masks = "", []
            for _, role, said in turns:
                name = "assistant" if role == speaker else "system" if role == "system" else f"user ({role or 'unknown'})"
                text += f"<|im_start|>{name}\n"
                if role == speaker:
                    masks.append((len(text), len(text) + len(said) + 10))
                text += f"{said}<|im_end|>\n"
            out[conv, speaker] = text, masks
    return out


def test_perspectives_are_whole_dialogues(spark, monkeypatch):
    from rivulet.llm import chat

    monkeypatch.setattr(chat, "HOT_SHARE", 40)  # large conversations are dealt over parts
    df = conversations(spark)
    got = perspectives(df).collect()
    table = df.select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.number):
        by[r.conv_id, r.speaker].append(r)
    assert all([r.number for r in x] == list(range(len(x))) for x in by.values())
    mine = {k: ("".join(r.rendered for r in x), [(r.mask_start, r.mask_end) for r in x if r.mask_start is not None])
            for k, x in by.items()}
    assert mine == rendered_dialogues(rows)
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(oracle_sql()["op5_perspective_rotation"]).fetchall()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert perspectives(empty(spark, df)).collect() == []


def test_chat_plan_has_no_python(spark):
    plan = perspectives(conversations(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

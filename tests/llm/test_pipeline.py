import re

import corpus_pipeline as pipeline
from tables import documents, words
from test_neardup import brute
from test_text_ops import brute_lines, statistics
from test_tokens import check_packing

from rivulet.session import written

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}

    one = written(pipeline.language_id(spark, docs, SF), "stage")
    kept = {r.doc_id: r for r in one.collect()}
    assert one.columns == list(pipeline.COLUMNS) and set(kept) <= set(before)
    assert all(any(c.isalpha() for c in r.text) for r in kept.values())
    assert len(kept) >= 0.98 * sum(any(c.isalpha() for c in r.text or "") for r in before.values())

    two = written(pipeline.quality_rules(spark, one, SF), "stage")
    good = {r.doc_id for r in two.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, r in kept.items():
        n, _, _, _, rep = statistics(r.text)
        if n < 50 or 2 * rep > n:
            assert i not in good
        elif labels.get(i) == 1:
            assert i in good

    three = written(pipeline.line_dedup(spark, two, SF), "stage")
    rows = [(r.doc_id, r.text) for r in two.collect()]
    want = {i: t for i, t, _, d in brute_lines(rows, 10, "first") if words(t) or not d}
    assert {r.doc_id: r.text for r in three.collect()} == want

    four = written(pipeline.near_dedup(spark, three, SF), "stage")
    comp = brute([(r.doc_id, r.text) for r in three.collect()], 5)
    assert {r.doc_id for r in four.collect()} == {i for i, c in comp.items() if i == c}

    from tokenizers import Tokenizer

    from rivulet.llm.packing import pack
    from rivulet.llm.queries import tokenizer_path

    path = tokenizer_path("word_bpe_49k.json")
    five = pipeline.pack(spark, four, SF)
    with_ids = pack(four, path, with_ids=True).collect()
    check_packing(with_ids, [(r.doc_id, r.text) for r in four.collect()], Tokenizer.from_file(path), 4096)
    final = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in five.collect()}
    assert final == {(r.doc_id, r.start, r.length, r.ids_crc32) for r in with_ids}


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    assert [len(x) for x in pipeline.STAGES] == [2] * 5
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
    assert {f"op{i}" for i in range(1, 14)} == {m[1] for q in entry.queries() if (m := re.match(r"(op\d+)_", q))}


def test_awkward_rows_pass_all_stages(spark):
    docs = documents(spark, extra=False).selectExpr("doc_id", "text", "lang", "'s' AS source", "CAST(length(text) AS LONG) AS n_chars")
    for rows in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES:
            out = stage(spark, rows, SF)
            rows = spark.createDataFrame(out.collect(), out.schema)


def test_near_dedup_leaves_one_row_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a + " omega"), (2, b), (3, b), (None, b), (None, c), (None, c), (4, "one"), (None, "")]
    df = spark.createDataFrame(rows + rows, "doc_id long, text string").repartition(4)
    docs = df.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS LONG) AS n_chars")
    out = pipeline.near_dedup(spark, docs, SF)
    assert out.columns == list(pipeline.COLUMNS)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    # rows without words are linked with nothing
    assert got == sorted([(1, a), (2, b), (None, c), (4, "one"), (None, ""), (None, "")], key=str)

from conftest import rows
from rivulet.functions import text as T
from rivulet.operators import text as TX

# blank lines, leading and trailing spaces, runs of spaces and tabs
LINES = ["", "   tide pool tide", "\t", "crab   tide  pool ", "", "kelp\ttide", "  "]


def test_word_count_golden(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "line string")
    wc = TX.word_count(TX.flat_map_words(df))
    assert rows(wc) == [("crab", 1), ("kelp", 1), ("pool", 2), ("tide", 4)]


def test_top_k_tie_order(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "word string, count long")
    assert [tuple(r) for r in TX.top_k(df, 3, "count", "word").collect()] == [("c", 5), ("a", 3), ("b", 3)]


def test_java_trim_and_blank(spark):
    df = spark.createDataFrame([("\x01 a b \t",), ("   ",), (None,), ("\x00",)], "s string")
    got = df.select(T.java_trim("s").alias("t"), T.not_blank("s").alias("nb")).collect()
    assert [tuple(r) for r in got] == [("a b", True), ("", False), (None, False), ("", False)]


def test_field_count_drops_trailing_empty(spark):
    df = spark.createDataFrame([("1,a,",), ("1,a,b",), ("",), ("a,,b,,",), (",,",)], "s string")
    got = [r[0] for r in df.select(T.field_count("s", ",")).collect()]
    # String.split: trailing empties removed; "" is one field; ",," is 0 fields
    assert got == [2, 3, 1, 3, 0]


def test_lines_split(spark):
    df = spark.createDataFrame([("a\r\nb\n\nc\n",)], "t string")
    assert df.select(T.lines("t")).first()[0] == ["a", "b", "", "c"]


def test_document_words_per_line_trim(spark):
    # a control char at a line edge is trimmed per line, not per document
    df = spark.createDataFrame([("x\x01\n\x01y z",)], "text string")
    got = rows(TX.document_words(df))
    assert got == [("x",), ("y",), ("z",)]


def test_parse_with_rejects(spark):
    from rivulet.functions.parse import parse_with_rejects

    df = spark.createDataFrame([("1577890860000,gate1,3",), ("x,gate2,1",), ("1,gate3",), ("2, gate4 ,4",)],
                               "line string")
    ok, bad = parse_with_rejects(df, "line", [("ts", "bigint"), ("name", "string"), ("n", "int")])
    assert rows(ok) == sorted([(1577890860000, "gate1", 3), (2, "gate4", 4)])
    assert rows(bad) == [("1,gate3",), ("x,gate2,1",)]

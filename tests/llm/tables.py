"""Small tables with the awkward cases every operator has to handle."""

import re

LONG = " ".join(f"w{i % 977} x{i}" for i in range(40_000))
BASE = " ".join(f"alpha{i}" for i in range(60))


def documents(spark, extra=True):
    rows = [
        (1, BASE, "en"), (2, BASE, "en"), (3, BASE + " omega", "en"), (4, BASE.upper(), "fr"), (5, None, None),
        (6, "", "en"), (7, "   \n\t ", None), (8, "one", "en"), (9, "ONE", "en"), (10, "one two", "en"),
        (11, LONG, "en"), (None, BASE, "en"), (None, None, None), (12, "Shared line\nown 12\n shared LINE \n", "en"),
        (12, "Shared line\nown 12\n shared LINE \n", "en"), (13, "shared line", "fr"), (14, "x\x00y é́ 日本🎉", None),
        (15, " ".join(["again and again"] * 40), "en"), (16, "12345 67 !!", "en"), (17, "a\r\nb\x0bc\x85d e", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if extra:  # names that clash with those the operators use
        for c in ("id", "n_rows", "key", "part", "size", "slot", "shard", "n_words", "own", "lines", "component", "score"):
            df = df.selectExpr("*", f"'clash' AS {c}")
    return df


def empty(spark, like):
    return spark.createDataFrame([], like.schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return (text or "").encode().lower().decode()

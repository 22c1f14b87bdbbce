"""Line and word operators: the flatMap / filter / groupBy-sum chain of the
classic word count, as DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import text as T


def explode_lines(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (),
                  line_col: str = "line", number_col: str | None = None) -> DataFrame:
    """One row per line of `text_col` (like reading the blob as a text file).
    With `number_col` the 0-based line number is kept as well."""
    keep_cols = [F.col(c) for c in keep]
    if number_col:
        return df.select(*keep_cols, F.posexplode(T.lines(text_col)).alias(number_col, line_col))
    return df.select(*keep_cols, F.explode(T.lines(text_col)).alias(line_col))


def filter_blank(df: DataFrame, col: str = "line") -> DataFrame:
    """Keep rows whose `col` is neither null nor blank after a JVM trim."""
    return df.where(T.not_blank(col))


def flat_map_words(df: DataFrame, col: str = "line", word_col: str = "word",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """`line.trim().split("\\\\s+")` → one row per word (blank lines dropped
    first, as the reference's programs do)."""
    return filter_blank(df, col).select(*keep, F.explode(T.words(col)).alias(word_col))


def document_words(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Words of every line of a text blob. Each line is trimmed once; the
    trim also removes a line's `\\r` and makes the empty line after a final
    newline blank, so the plain `\\n` split suffices here."""
    lines = docs.select(*keep, F.explode(F.split(F.col(text_col), "\n")).alias("_line"))
    trimmed = lines.select(*keep, T.java_trim("_line").alias("_t")).where(F.length("_t") > 0)
    return trimmed.select(*keep, F.explode(F.split("_t", T.WHITESPACE_RUN)).alias("word"))


def word_count(words: DataFrame, word_col: str = "word", count_col: str = "count") -> DataFrame:
    """`map(w -> (w, 1)).groupBy(0).sum(1)`. The count is a partial
    (map-side) aggregate, so a very common word never concentrates rows."""
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias(count_col))


def top_k(df: DataFrame, k: int, by: str, tie: str, descending: bool = True) -> DataFrame:
    """Global top-k with a deterministic tie order. Plans as
    TakeOrderedAndProject: each task keeps its own k best, the driver merges
    k × tasks rows."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(order, F.col(tie).asc()).limit(k)

"""String column functions with the semantics of the JVM string methods the
reference's programs call (`String.trim`, `String.split`), written as
built-in Spark expressions so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.cols import as_col

# Character classes of the JVM string methods.
# `String.trim` removes every char <= U+0020 at both ends.
TRIM_CHARS = r"[\x00-\x20]"
TRIM_SET = "".join(chr(i) for i in range(0x21))
# `\s` of java.util.regex without UNICODE_CHARACTER_CLASS.
WHITESPACE = r"[ \t\n\x0B\f\r]"
WHITESPACE_RUN = WHITESPACE + "+"


def java_trim(c) -> Column:
    """`String.trim()`: strip chars <= U+0020 from both ends (a character
    set trim, no regex)."""
    return F.btrim(as_col(c), F.lit(TRIM_SET))


def not_blank(c) -> Column:
    col = as_col(c)
    return col.isNotNull() & (F.length(java_trim(col)) > 0)


def java_split(c, regex: str) -> Column:
    """`String.split(regex)`: like Spark `split` but trailing empty strings
    are removed (an all-empty result keeps one empty string only when the
    input itself is empty)."""
    parts = F.split(as_col(c), regex)
    # drop trailing "" elements: keep up to the last non-empty element
    idx = F.array_position(F.reverse(F.transform(parts, lambda x: x != "")), True)
    n = F.size(parts)
    trimmed = F.when(idx == 0, F.array()).otherwise(F.slice(parts, 1, n - idx + 1))
    return F.when(as_col(c) == "", F.array(F.lit(""))).otherwise(trimmed)


def field_count(c, delimiter: str = ",") -> Column:
    """`line.split(delimiter).length` with JVM semantics."""
    import re

    return F.size(java_split(c, re.escape(delimiter)))


def lines(c) -> Column:
    """Split a text blob into lines the way a line-oriented text reader
    does: on `\\n`, with a trailing `\\r` removed; a final empty line after
    the last newline is not a line."""
    body = F.regexp_replace(as_col(c), r"\n\z", "")
    return F.transform(F.split(body, "\n"), lambda x: F.regexp_replace(x, "\r\\z", ""))


def words(c) -> Column:
    """`line.trim().split("\\\\s+")` for one (non-blank) line."""
    return F.split(java_trim(c), WHITESPACE_RUN)

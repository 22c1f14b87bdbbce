"""Parsing and rendering of records: delimited lines, JSON, money, IPv4."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from rivulet.functions.cols import as_col
from rivulet.functions.text import java_split, java_trim

MONEY = "decimal(18,2)"


def split_fields(c, delimiter: str = ",") -> Column:
    """`line.split(delimiter)` with JVM semantics (trailing empties dropped)."""
    return java_split(c, re.escape(delimiter))


def parse_delimited(c, fields: list[tuple[str, str | DataType]], delimiter: str = ",",
                    strict: bool = True, trim: bool = True) -> list[Column]:
    """Typed columns from a delimited line, like `split` + `Integer.parseInt`
    etc. `strict` casts with `cast` (fails the query on a bad number under
    ANSI mode, as the reference's parse does); otherwise `try_cast` gives
    null and the caller can route the row to a reject output."""
    parts = split_fields(c, delimiter)
    out = []
    for i, (name, typ) in enumerate(fields):
        raw = parts.getItem(i)
        if trim:
            raw = java_trim(raw)
        tname = typ if isinstance(typ, str) else typ.simpleString()
        if tname == "string":
            val = raw
        elif strict:
            val = raw.cast(tname)
        else:
            val = raw.try_cast(tname)
        out.append(val.alias(name))
    return out


def money(c) -> Column:
    """Money as decimal(18,2) HALF_UP (cast, never round, before summing)."""
    return as_col(c).cast(MONEY)


def from_json_fields(c, schema: str) -> Column:
    """JSON text → struct; field names must be spelled as in the data."""
    return F.from_json(as_col(c), schema)


def to_json_row(*cols) -> Column:
    """Bean → JSON string."""
    return F.to_json(F.struct(*cols))


def ipv4_to_string(c) -> Column:
    """Unsigned 32-bit int → dotted quad."""
    ip = as_col(c).cast("bigint")
    return F.concat_ws(".", *[(F.shiftright(ip, s).bitwiseAND(255)).cast("string")
                              for s in (24, 16, 8, 0)])


def ipv4_to_long(c) -> Column:
    """Dotted quad → unsigned 32-bit int (null on malformed input)."""
    parts = F.split(as_col(c), r"\.")
    octets = [parts.getItem(i).try_cast("bigint") for i in range(4)]
    value = (octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])
    ok = (F.size(parts) == 4)
    for o in octets:
        ok = ok & o.between(0, 255)
    return F.when(ok, value)


def parse_with_rejects(df, line_col: str, fields: list[tuple[str, str | DataType]],
                       delimiter: str = ","):
    """Lenient parse with a reject output: returns (parsed, rejects). A line
    whose field count is wrong or whose numeric field does not parse goes to
    `rejects` unchanged instead of failing the job. One pass; both outputs
    are filters of the same tagged frame."""
    from rivulet.functions.text import field_count

    typed = parse_delimited(line_col, fields, delimiter, strict=False)
    tagged = df.select("*", *typed, (field_count(line_col, delimiter) == len(fields)).alias("_ok_count"))
    ok = F.col("_ok_count")
    for (name, typ) in fields:
        tname = typ if isinstance(typ, str) else typ.simpleString()
        if tname != "string":
            ok = ok & F.col(name).isNotNull()
    tagged = tagged.withColumn("_ok", ok)
    parsed = tagged.where(F.col("_ok")).select(*[name for name, _ in fields])
    rejects = tagged.where(~F.col("_ok")).select(*df.columns)
    return parsed, rejects

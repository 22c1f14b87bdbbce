"""Chat formatting by perspective rotation, as DataFrame expressions only.

A dialogue is rendered once for every participant: that speaker's turns become
the assistant's, with a mask over their text, all others are named users. The
rendering of a dialogue comes as its turns, one a row, so that no dialogue is too
long: their texts by number, one after another, are the whole rendering, and
masks are places in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import HOT_SHARE, lookup, null_safe
from rivulet.operators.scan import Running, keyed_scan
from rivulet.session import written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", narrator: str = "system") -> DataFrame:
    """One row per (conversation, speaker, number), number counting all turns
    of the conversation from 0: label, rendered (the turn's text in the
    dialogue), mask_start and mask_end (the stretch of the whole rendered
    dialogue, in code points, that the model learns: the speaker's text with
    its closing mark; null for turns of others).

    Every distinct non-blank role except `narrator` is a participant. A turn is
    rendered as OPEN, its label, a line break, its text, CLOSE and a line break;
    the label is `assistant` for the speaker, the narrator's name for the
    narrator and `user (name)` for others, `user (unknown)` for a null or blank
    role. Turns are ordered by turn (null first), then role (null first), then
    the SHA-256 of the text, which is empty for a null text; equal rows are turns
    of their own. A null conversation is one conversation; conversations
    without a participant give no rows; other columns are ignored.

    Turns are numbered, and the lengths before them added up, by scans that
    split a conversation at any place; participants meet the turns of a
    large conversation in as many parts.
    """
    role = F.trim(F.col(role_col))
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.when(role != "", role).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    neutral = _label(F.col("role"), F.lit(None).cast("string"), narrator)
    t = t.select("*", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("row"),
                 F.length(_piece(neutral, F.col("text"))).cast("long").alias("size"))
    t = written(t, "turns")  # the row numbers stay as they are
    rows = t.count()
    order = ["turn", "role", "digest", "row"]
    t = keyed_scan(t, ["conv"], order, [Running(None, "count", "number"), Running("size", "sum", "before", inclusive=False)])
    t = written(t.select("conv", "role", "text", "row", (F.col("number") - 1).alias("number"), F.coalesce("before", F.lit(0)).alias("before")),
                "numbered")
    t = keyed_scan(t, ["conv", "role"], ["number"], [Running(None, "count", "own")])
    return _rotated(t, rows, narrator, conv_col)


def _label(role: Column, speaker: Column, narrator: str) -> Column:
    return F.when(role == speaker, F.lit(ASSISTANT)).when(role == narrator, F.lit(narrator)).otherwise(
        F.concat(F.lit("user ("), F.coalesce(role, F.lit("unknown")), F.lit(")")))


def _piece(label: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), label, F.lit("\n"), text, F.lit(CLOSE), F.lit("\n"))


def _rotated(t: DataFrame, rows: int, narrator: str, conv_col: str) -> DataFrame:
    """Every turn once for each participant of its conversation. A conversation
    of over a thousandth of all rows is dealt over parts, and its
    participants go to all of them."""
    limit = max(rows // HOT_SHARE, HOT_SHARE)
    t = written(t.withColumn("key", null_safe(F.col("conv"))), "own")
    sizes = t.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "parts", (F.col("n_rows") / limit).cast("long") + 1)
    cast = t.where(F.col("role").isNotNull() & (F.col("role") != narrator)).select("key", F.col("role").alias("speaker")).distinct()
    cast = cast.join(sizes, "key").select("key", "speaker", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    dealt = lookup(t, sizes, ["key"], ["parts"], rows).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    j = dealt.join(cast, ["key", "part"])
    label = _label(F.col("role"), F.col("speaker"), narrator)
    # the speaker's own turns before this one have another label than in the neutral rendering
    shift = (F.col("own") - 1) * (len(ASSISTANT) - F.length(F.concat(F.lit("user ("), "role", F.lit(")"))))
    start = F.when(F.col("role") == F.col("speaker"), F.col("before") + shift + len(OPEN) + len(ASSISTANT) + 1)
    j = j.select("conv", "speaker", "number", label.alias("label"), "text", start.cast("long").alias("mask_start"))
    return j.select(F.col("conv").alias(conv_col), "speaker", F.col("number").cast("long").alias("number"), "label",
                    _piece(F.col("label"), F.col("text")).alias("rendered"), "mask_start",
                    (F.col("mask_start") + F.length("text") + len(CLOSE)).alias("mask_end"))

"""A corpus pipeline over `documents`: language ID, quality rules, line
dedup, near-duplicate removal and packing. Every stage takes (spark, docs,
sf_dir); all but the last return the columns of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import langid, linededup, neardup, packing, quality
from rivulet.llm.common import text_batches
from rivulet.llm.queries import read, tokenizer_path
from rivulet.session import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or with an ambiguous language go; a missing
    language is filled in. The model is learned from the documents not held out."""
    text_batches(spark)
    model = langid.learn(docs.where(~langid.held_out()))
    out = langid.identify(docs, model).where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous"))
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned rule go."""
    text_batches(spark)
    labels = quality.labelled(read(spark, sf_dir, "labels"))
    failed = quality.base_failed()
    # written, so that each text's statistics are computed once: not for the sample and for every use in the filter
    stats = written(quality.text_statistics(docs.withColumn("__text", F.col("text")), "__text"), "statistics", compression="zstd")
    # the labelled sample is bounded by its parameter, so it is broadcast
    known = stats.drop(*COLUMNS[1:]).where(~failed).join(F.broadcast(labels), "doc_id")
    rules = quality.learn_rules(written(known, "labelled"))
    return stats.where(~failed & (rules.verdict() == 0)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents stay in the first one only; a
    document left without any word by that goes."""
    text_batches(spark)
    out = linededup.drop_repeated_lines(docs, min_docs=10, keep="first")
    left = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = out.where(left | (F.col("n_dropped") == 0))
    n = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, also where rows
    repeat an id or have none."""
    text_batches(spark)
    return neardup.one_per_group(docs, shingle=5, threshold=0.8).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents in sequences of 4096 tokens."""
    text_batches(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("line dedup", line_dedup),
          ("near-duplicate removal", near_dedup), ("packing", pack)]

# fitted models and sketches have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

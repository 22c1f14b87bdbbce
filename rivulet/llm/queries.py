"""The registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import text_batches

_QUERIES: dict = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            text_batches(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql.strip()
        return fn
    return wrap


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


@query("op10_hyperminhash")
def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 2-word shingles at 0.8."""
    from rivulet.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2, threshold=0.8)


@query("op6_line_bloom", sql="""
WITH k AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
l AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
c AS (SELECT key AS common FROM (SELECT DISTINCT doc_id, key FROM l) WHERE key <> '' GROUP BY key HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN c ON key = common GROUP BY doc_id""")
def op6_line_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents are removed from all of them."""
    from rivulet.llm.linededup import drop_repeated_lines

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_lines(docs, min_docs=10, keep="none", min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_decision_list")
def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents and the verdict of a decision list learned
    from `labels`."""
    from rivulet.llm import quality
    from rivulet.session import written

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    stats = written(quality.text_statistics(docs), "stats")
    failed = quality.base_failed()
    rules = quality.learn_rules(stats.where(~failed).join(quality.labelled(read(spark, sf_dir, "labels")), "doc_id"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & (rules.verdict() == 0)).alias("kept"),
                        rules.verdict().alias("rule"))


@query("op8_sampled_splitters")
def op8_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes; equal texts adjoin."""
    from rivulet.llm.sharding import shard

    text = F.coalesce("text", F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"))
    out = shard(rows, F.col("size"), F.col("text_hash"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op1_hilbert_packing")
def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into 4096-token sequences in Hilbert order."""
    from rivulet.llm.packing import pack

    return pack(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


@query("op9_output_codes")
def op9_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from the rows not held out."""
    from rivulet.llm import langid

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(~langid.held_out()))
    out = langid.identify(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query("op3_kmeans_tree")
def op3_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every hundredth embedding."""
    from rivulet.llm.ann import nearest

    return nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op2_suffix_array_pieces")
def op2_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents and the texts decoded from them."""
    from rivulet.llm import pieces

    path = tokenizer_path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("was"), "text")
    back = pieces.decode(pieces.encode(docs, path, keep_text=False), path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("text", 256).alias("decoded_sha256"), (F.sha2("text", 256) == F.col("was")).alias("round_trip"))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query("op4_indexed_warc", sql=f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages),
h AS (SELECT *, sha1(html) AS hex FROM p),
g AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, i * 5 + 1, 5) AS BIGINT)) AS parts FROM h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(parts, lambda v: substr('{_BASE32}', ((v >> 15) & 31) + 1, 1) ||
    substr('{_BASE32}', ((v >> 10) & 31) + 1, 1) || substr('{_BASE32}', ((v >> 5) & 31) + 1, 1) ||
    substr('{_BASE32}', (v & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM g""")
def op4_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back through the index."""
    from rivulet.llm import warc
    from rivulet.session import scratch_path

    folder = scratch_path(spark, "warc")
    index = warc.write_archives(read(spark, sf_dir, "pages"), folder, min_bytes=0)
    out = warc.read_records(index, folder)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_perspective_rotation", sql="""
WITH t AS (SELECT conv_id, turn, nullif(trim(role), '') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, sha256(text)) - 1 AS number FROM t),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (SELECT n.conv_id, speaker, number, text, role = speaker AS own,
  CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
    ELSE 'user (' || coalesce(role, 'unknown') || ')' END AS label
  FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (SELECT *, '<|im_start|>' || label || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM r),
w AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, speaker ORDER BY number) AS finish FROM p)
SELECT conv_id, speaker, number, label, rendered,
  CASE WHEN own THEN CAST(finish - length(text) - 11 AS BIGINT) END AS mask_start,
  CASE WHEN own THEN CAST(finish - 1 AS BIGINT) END AS mask_end FROM w""")
def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations rendered from every participant's perspective."""
    from rivulet.llm.chat import perspectives

    return perspectives(read(spark, sf_dir, "conversations"))


@query("op13_block_whitening")
def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on the first four components of the fit list."""
    from rivulet.llm.whitening import whiten

    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op11_composed_acceptors")
def op11_composed_acceptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near words, forms and roots of all words of the documents."""
    from rivulet.llm.spelling import spelling_variants

    return spelling_variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_bootstrapped_pii")
def op12_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, found by form and by context."""
    from rivulet.llm.pii import find_personal_data

    return find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))

"""Embedding whitening with distributed block matrices.

The centred rows are indexed into the blocks of a `BlockMatrix`, its transpose
is multiplied by it for the scatter matrix (dimension x dimension, the only
matrix that reaches the driver), whose eigenvectors are found there. A second
block multiplication projects all rows on the whitening matrix.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import lookup, partitions
from rivulet.session import written

#: entries of a block of centred rows, and the largest fixed-point entry
BLOCK_ENTRIES = 1 << 19
LARGEST = 1 << 49


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4,
           scale: int = 256) -> DataFrame:
    """One row per row of `vectors` and component: (id, component from 1, n,
    deviation, whitened, explained, identity_error).

    Every entry c becomes x = floor(scale * c). The components are the unit
    eigenvectors, by falling eigenvalue, of the covariance (divisor n) of the
    n distinct x vectors, the fit list; copies of a vector count once.
    deviation is the exact sum of (n * x - S)^2 over the dimensions, S being
    the fit list's sums (null beyond a long); whitened is the centred row on
    the component over the root of its eigenvalue; explained is the
    eigenvalue's share of the trace; identity_error is the largest absolute
    entry of the whitened fit list's covariance minus the identity.

    Rows take part whose vector is not null, has the most frequent length (not
    0; the longer one in a tie) and holds finite entries only, none with an x
    beyond 2^49, where sums would not be exact. Null and repeated ids are rows
    of their own. Components without variance are left out, so a fit list of
    equal vectors, like an empty table, gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = written(_fixed_point(vectors, id_col, vec_col, scale), "fixed")
    total, dim = _usual_length(rows)
    rows = rows.where(F.size("x") == dim)
    fit = written(rows.groupBy("x").agg(F.count(F.lit(1)).alias("n_rows"))
                  .withColumn("at", F.monotonically_increasing_id()), "fit")
    n = fit.count()
    if not n:
        return _no_rows(spark, id_col)
    sums = _sums(fit)
    centred = F.transform("x", lambda v, i: v - F.array([F.lit(s / n) for s in sums])[i])
    indexed = _indexed(fit.select("at", centred.alias("v")))
    a = _block_matrix(indexed, n, dim)

    splits = max(1, min(partitions(vectors), -(-n // a.rowsPerBlock)))
    scatter = _product(a.transpose(), a, splits).toLocalMatrix().toArray()
    value, vector = np.linalg.eigh(scatter / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, int((value > max(value[0], 0.0) * dim * np.finfo(float).eps).sum()))
    if not k:
        return _no_rows(spark, id_col)
    w = Matrices.dense(dim, k, (vector[:, :k] / np.sqrt(value[:k])).T.ravel().tolist())
    w = BlockMatrix(spark.sparkContext.parallelize([((0, 0), w)], 1), dim, k)
    projected = callMLlibFunc("getIndexedRows", a.multiply(w).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    projected = written(projected.select("index", vector_to_array("vector").alias("w")), "projected")

    deviation = F.aggregate(
        F.zip_with("x", F.array([F.lit(s) for s in sums]), lambda v, s: F.lit(n).cast("decimal(19,0)") * v - s),
        F.lit(0).cast("decimal(38,0)"), lambda t, v: F.try_add(t, F.try_multiply(v, v)).cast("decimal(38,0)"))
    done = fit.join(_indexed(fit.select("at", "x")).select("at", "index"), "at").join(projected, "index").select(
        "x", "n_rows", deviation.try_cast("bigint").alias("deviation"), "w")
    out = lookup(rows.select("id", "x"), done, ["x"], ["deviation", "w"], total)
    share = F.array([F.lit(float(e / value.sum())) for e in value[:k]])
    return out.select(F.col("id").alias(id_col), "deviation", F.posexplode("w").alias("pos", "whitened")).select(
        id_col, (F.col("pos") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", share[F.col("pos")].alias("explained"), F.lit(_identity_error(projected, k)).alias("identity_error"))


def _no_rows(spark: SparkSession, id_col: str) -> DataFrame:
    return spark.createDataFrame([], f"{id_col} long, component int, n long, deviation long, whitened double, "
                                     "explained double, identity_error double")


def _fixed_point(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, x) of the rows whose vector holds finite numbers that fit."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    ok = F.forall("vec", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * scale) < float(LARGEST)), F.lit(False)))
    return v.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(ok).select(
        "id", F.transform("vec", lambda c: F.floor(c * scale)).alias("x"))


def _usual_length(rows: DataFrame) -> tuple[int, int]:
    best = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (best["count"], best["d"]) if best else (0, 0)


def _sums(fit: DataFrame) -> list[int]:
    """The exact sum of every dimension: one row per batch of a task, then
    one row per dimension."""
    def add(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)
                for a in range(0, len(x), 4096):  # 4096 entries below 2^49 cannot overflow
                    yield pa.RecordBatch.from_arrays([pa.array([x[a:a + 4096].sum(axis=0).tolist()], pa.list_(pa.int64()))], ["s"])

    part = fit.select("x").mapInArrow(add, "s array<long>").select(F.posexplode("s").alias("pos", "s"))
    total = part.groupBy("pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("pos")
    return [int(r.s) for r in total.collect()]


def _indexed(fit: DataFrame) -> DataFrame:
    """`fit` with a gapless `index` from 0 instead of the gaps of `at`, whose
    upper bits name the writing task (one small row per task)."""
    part = F.shiftright("at", 33)
    sizes = fit.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    first, starts = 0, []
    for r in sizes:
        starts += [F.lit(r.p), F.lit(first)]
        first += r.n
    return fit.withColumn("index", F.create_map(*starts)[part] + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))


def _block_matrix(indexed: DataFrame, n: int, dim: int) -> BlockMatrix:
    rows = MLUtils.convertVectorColumnsFromML(indexed.select("index", array_to_vector("v").alias("vector")), "vector")
    # all columns lie in one block, so that a block of the product is one dimension x dimension matrix
    return IndexedRowMatrix(rows, n, dim).toBlockMatrix(max(1, BLOCK_ENTRIES // dim), dim)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a x b, the sum over the common dimension made in `splits` tasks: the
    product is a single block, which one task would else build alone."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _identity_error(projected: DataFrame, k: int) -> float:
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = projected.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(got, pairs))

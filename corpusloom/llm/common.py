"""Parts shared by the operators of this package."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage  # noqa: F401  (the operators take it from here)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null stays null."""
    return F.translate(text, _UPPER, _UPPER.lower())


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key belongs to fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int, folds: int = 5
) -> DataFrame:
    """At most ``rows`` labelled training documents: key, text, label.

    Rows of fold 0 are held out. The sample is the rows with the smallest key hash, so it
    depends neither on order nor on partitioning; it is chosen on the narrow label table, and
    only its documents' texts are read. Conflicting or repeated labels of a key: the largest
    counts. Null keys, texts and labels take no part.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("key"), folds) != 0))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(known), "key")  # at most ``rows`` narrow rows


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-1) -> np.ndarray:
    """Penalised logistic regression by damped Newton steps, for a handful of calibration features."""

    def loss(w: np.ndarray) -> float:
        margin = x @ w
        return float(np.logaddexp(0, margin).sum() - y @ margin + penalty / 2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max(initial=0) < 1e-8:
            break
    return w


def drop_step(step: DataFrame) -> None:
    """Delete the written table of a ``cut_lineage`` frame that nothing reads any more."""
    spark = step.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in step.inputFiles()}:
        if "/step-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""Helpers that the operators share: the shared folder, written tables and Arrow batches."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where unset.

    Only a local master may go without the setting; a cluster without it is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="locuslake-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/locuslake/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by written(), once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/locuslake/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `most` bytes of the string column `text`, a row at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i in range(n):
            if held and held + sizes[i] > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(sizes[i])
        yield batch.slice(start)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(df: DataFrame, column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def taking_part(vectors: DataFrame, *more: str) -> DataFrame:
    """(vec_id, x array<double>, *more) of the rows that take part; native. Doubles keep every finite component."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    d = vectors.where("vec_id is not null and size(embedding) > 0").where(F.coalesce(fine, F.lit(False)))
    return d.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("x"), *more)


LARGE = float(1 << 40)  # from this size on, components are Python's integers


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python's integers where a component is large: those are whole numbers already."""
    if not x.size or float(np.abs(x).max()) * scale < LARGE:
        return np.floor(x * scale).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 1 << 53 else math.floor(Fraction(v) * scale) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def far_scores(scores: list[int]) -> tuple[pa.Array, pa.Array]:
    """(scores as longs, digits of those that no long holds): the longs stop at their ends, the digits are null for all others."""
    digits = [None if -(1 << 63) <= s < 1 << 63 else str(s) for s in scores]
    return pa.array([s if t is None else (1 << 63) - 1 if s > 0 else -(1 << 63) for s, t in zip(scores, digits, strict=True)], pa.int64()), pa.array(digits, pa.string())


def score_order() -> list[Column]:
    """Highest first, by columns score and exact_score of far_scores: beyond the longs, more digits, then larger digits, are
    larger scores above and smaller ones below."""
    far, above = F.struct(F.length("exact_score"), F.col("exact_score")), F.col("score") > 0
    return [F.desc("score"), F.when(above, far).desc_nulls_last(), F.when(~above, far).asc_nulls_first()]

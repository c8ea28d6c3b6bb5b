"""Tables that a stage writes for the next one, as such workflows keep files between their steps."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); a local one where a local master has none."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="locuslake-"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/locuslake-files/{uuid.uuid4().hex}/{name}"
    if not _made:
        atexit.register(swept)
    _made.append((spark, path))
    return path


#: Folders that scratch() has given out, in this session.
_made: list[tuple[SparkSession, str]] = []


def _deleted(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def swept() -> int:
    """Delete every table and file that stages have made so far, once no result is read any more; how many there were.

    A program that ends normally does so by itself.
    """
    n = len(_made)
    while _made:
        spark, folder = _made.pop()
        if spark.sparkContext._jsc is not None:
            _deleted(spark, folder.rsplit("/", 1)[0])
    return n


def stored(df: DataFrame, name: str, most: int = 0) -> DataFrame:
    """df written as Parquet and read again: what follows starts from the files and repeats nothing.

    With `most`, no file has more rows. Spark counts a small file as 4 MB when it fills a task's 128 MB, so that a task then reads about 32 of them at most.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", most).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables made by stored(), once nothing reads them any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/locuslake-files/" in folder:
                _deleted(df.sparkSession, folder)


def parts(df: DataFrame, part_rows: int = 250_000) -> int:
    """Of how many parts of about `part_rows` rows df consists; it is read for that."""
    return max(1, -(-df.count() // part_rows))

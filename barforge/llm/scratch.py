"""Tables written to the folder that the cluster shares, to cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one, which only a local session may have."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        found = "file://" + tempfile.mkdtemp(prefix="barforge-")
        spark.conf.set("spark.checkpoint.dir", found)
        _written.append((spark, found))
    return found.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return it as read back."""
    return read(df.sparkSession, write(df, name))


def write(df: DataFrame, name: str) -> str:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    keep(spark, path)
    df.write.parquet(path)
    return path


@contextmanager
def passing(spark: SparkSession):
    """A ``table`` whose folders go at the end: for steps that nothing later reads."""
    paths: list[str] = []

    def passing_table(df: DataFrame, name: str) -> DataFrame:
        paths.append(write(df, name))
        return read(spark, paths[-1])

    try:
        yield passing_table
    finally:
        for path in paths:
            delete(spark, path)


def keep(spark: SparkSession, path: str) -> None:
    """``path`` stays for as long as this program runs."""
    _written.append((spark, path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table that no later step reads."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _written[:] = [x for x in _written if x[1] != path]


@atexit.register
def _sweep() -> None:
    for spark, path in _written[:]:
        try:
            delete(spark, path)
        except Exception:  # the session has ended
            pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

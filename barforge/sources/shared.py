"""Tables in the folder that the cluster shares: what several plans read is made once and survives lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one, which only a local session may have."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        found = "file://" + tempfile.mkdtemp(prefix="barforge-")
        spark.conf.set("spark.checkpoint.dir", found)
        _written.append((spark, found))
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    """A new folder for ``name``, removed when this program ends."""
    made = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, made))
    return made


def table(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written as Parquet and read back."""
    at = path(rows.sparkSession, name)
    rows.write.parquet(at)
    return rows.sparkSession.read.parquet(at)


def delete(spark: SparkSession, at: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(at)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _sweep() -> None:
    for spark, at in _written:
        try:
            delete(spark, at)
        except Exception:  # the session has ended
            pass


def numbered(rows: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """Adds ``name``, counting rows from 0 in an order that should be total.

    Ranges of rows are sorted and counted apart and numbered on from the counts of the ranges
    before, so no task sees all rows; the driver gets a count for each range.
    """
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place within a partition
    placed = table(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": own}), "numbered")
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    base = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return placed.join(F.broadcast(base), "__part").withColumn(name, (F.col("__at") + F.col("__base")).cast("long")).drop("__part", "__at", "__base")

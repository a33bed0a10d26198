"""Trade tapes: the declared schema, readers of raw files, and tapes made from other tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", T.FloatType()),
        T.StructField("qty", T.FloatType()),
        T.StructField("quoteQty", T.FloatType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("isBuyerMaker", T.BooleanType()),
        T.StructField("isBestMatch", T.BooleanType()),
    ]
)
_RAW = "trade_id long, price float, qty float, quoteQty float, time long, isBuyerMaker string, isBestMatch string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tape of ``events``: one symbol per event type; quoteQty in exact hundredths."""
    k = F.get_json_object("props", "$.k").cast("int") + 1
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("time"),
        F.col("value").cast("double").alias("price"),
        k.cast("double").alias("qty"),
        (F.round(F.col("value") * 100) * k).cast("double").alias("quoteQty"),
        (F.col("user_id") % 2 == 0).alias("isBuyerMaker"),
    )


def trades_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tape of ``lineitem``: one symbol per return flag, ordered by a key of five columns."""
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").alias("time"),
        F.struct(*keys).alias("seq"),
        (F.col("l_extendedprice").cast("double") / F.col("l_quantity").cast("double")).alias("price"),
        F.col("l_quantity").cast("double").alias("qty"),
        F.col("l_extendedprice").cast("double").alias("quoteQty"),
    )


def epoch_to_timestamp(value: Column) -> Column:
    """Epoch of unknown unit: 16 digits or more are microseconds, 13 or more milliseconds, else seconds."""
    digits = F.length(F.abs(value).cast("string"))
    micros = F.when(digits >= 16, value).when(digits >= 13, value * 1000).otherwise(value * 1_000_000)
    return F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz")


def epoch_by_magnitude(value: Column) -> Column:
    """The same by size: over 1e18 nanoseconds, over 1e15 microseconds, over 1e12 milliseconds, else seconds."""
    micros = F.when(value > 10**18, F.floor(value / 1000)).when(value > 10**15, value).when(value > 10**12, value * 1000).otherwise(value * 1_000_000)
    return F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz")


def is_true(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)) == "true", F.lit(False))


def normalise(raw: DataFrame, keep: str | None = None) -> DataFrame:
    """Raw string and epoch columns to :data:`TRADE_SCHEMA`, and ``keep``; a missing best-match flag is false."""
    best = is_true(F.col("isBestMatch")) if "isBestMatch" in raw.columns else F.lit(False)
    time = F.col("time") if isinstance(raw.schema["time"].dataType, T.TimestampNTZType) else epoch_to_timestamp(F.col("time"))
    return raw.select(
        F.col("trade_id").cast("long").alias("trade_id"),
        *[F.col(c).cast("float").alias(c) for c in ("price", "qty", "quoteQty")],
        time.alias("time"),
        is_true(F.col("isBuyerMaker").cast("string")).alias("isBuyerMaker"),
        best.alias("isBestMatch"),
        *([keep] if keep else []),
    )


#: Names that header lines use for the columns of the schema.
ALIASES = {"id": "trade_id", "trade_id": "trade_id", "tradeid": "trade_id", "price": "price", "qty": "qty", "quantity": "qty", "quote_qty": "quoteQty", "quoteqty": "quoteQty", "time": "time", "timestamp": "time", "is_buyer_maker": "isBuyerMaker", "isbuyermaker": "isBuyerMaker", "is_best_match": "isBestMatch", "isbestmatch": "isBestMatch"}
_NAMES = [f.split()[0] for f in _RAW.split(", ")]


def read_csv(spark: SparkSession, path: str, best_match: bool = True, header: bool = False) -> DataFrame:
    """CSV trades of 7 columns (spot) or 6 (futures); malformed rows are dropped.

    With a header, columns are found by their names, in any order; one that is missing is null.
    """
    if header:
        raw = spark.read.option("header", True).csv(path)
        found = {ALIASES[c.strip().lower()]: c for c in raw.columns if c.strip().lower() in ALIASES}
        kinds = {f.split()[0]: f.split()[1] for f in _RAW.split(", ")}
        raw = raw.select(*[(F.col(f"`{found[c]}`").try_cast(kinds[c]) if c in found else F.lit(None).cast(kinds[c])).alias(c) for c in _NAMES])
        return normalise(raw.where("trade_id is not null and time is not null and price is not null and qty is not null"))
    schema = _RAW if best_match else _RAW.rsplit(",", 1)[0]
    return normalise(spark.read.schema(schema).option("mode", "DROPMALFORMED").csv(path))


def _header(line: str) -> list[str]:
    """Columns of a file by its first line: by name where it is a header, else by place."""
    cells = [c.strip() for c in line.strip().split(",")]
    return [ALIASES.get(c.lower(), c) for c in cells] if cells[0] and not cells[0].lstrip("-").isdigit() else _NAMES[: len(cells)]


def read_zips(spark: SparkSession, path: str, keep_source: bool = False) -> DataFrame:
    """Zipped CSV trades, an archive to a task; rows that do not parse are left out.

    Columns are found by the names in a header line, or by their places. Of an archive with two
    files, both are read where their sizes differ by a tenth or more, and trades of the second
    whose id the first has are left out (a task holds the first one's ids); else the first alone.
    ``keep_source`` adds ``source``, the archive's path.
    """

    def unzip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    entries = sorted((e for e in archive.infolist() if e.filename.endswith(".csv")), key=lambda e: e.filename)
                    if len(entries) > 1 and abs(entries[0].file_size - entries[1].file_size) < 0.1 * max(e.file_size for e in entries):
                        entries = entries[:1]
                    seen = np.empty(0, np.int64)
                    for entry in entries:
                        with archive.open(entry) as lines:
                            names = _header(lines.readline().decode())
                        own = [np.empty(0, np.int64)]
                        with archive.open(entry) as lines:
                            for chunk in pd.read_csv(lines, header=None, names=names, dtype=str, chunksize=200_000):
                                out = chunk.reindex(columns=_NAMES)
                                for c in ("trade_id", "time", "price", "qty", "quoteQty"):
                                    out[c] = pd.to_numeric(out[c], errors="coerce")
                                out = out.dropna(subset=["trade_id", "time", "price", "qty"]).astype({"trade_id": "int64", "time": "int64", "price": "float32", "qty": "float32", "quoteQty": "float32"})
                                out = out[~np.isin(out["trade_id"].to_numpy(), seen)]
                                if len(entries) > 1:
                                    own.append(out["trade_id"].to_numpy())
                                flags = {c: out[c].astype(object).where(out[c].notna(), None) for c in ("isBuyerMaker", "isBestMatch")}
                                yield out.assign(**flags, source=np.full(len(out), source, object))
                        seen = np.concatenate([seen, *own])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    rows = files.select("path", "content").mapInPandas(unzip, _RAW + ", source string")
    trades = normalise(rows, keep="source")
    return trades if keep_source else trades.drop("source")


def checksums(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``path, sha256`` of each file, to be joined with the published sums."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))

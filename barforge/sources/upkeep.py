"""Keeping tapes: dates, gaps, duplicates, appends, packing and audits."""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from barforge.sources import tape


def calendar(spark: SparkSession, start: str, end: str, step: str = "1 day") -> DataFrame:
    """``date`` from start to end, both included, by ``1 day`` or ``1 month``."""
    return spark.sql(f"SELECT explode(sequence(date'{start}', date'{end}', interval {step})) AS date")


def missing_dates(found: DataFrame, date: str, step: str = "1 day", weekdays: bool = False) -> DataFrame:
    """Dates between the first and the last of ``found`` that it lacks; months by their first day."""
    have = found.select((F.col(date) if step == "1 day" else F.trunc(date, "month")).cast("date").alias("date")).distinct()
    span = have.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a is not null")
    wanted = span.select(F.explode(F.expr(f"sequence(a, b, interval {step})")).alias("date"))
    gaps = wanted.join(have, "date", "left_anti")
    return gaps.where(F.dayofweek("date").between(2, 6)) if weekdays else gaps


def completeness(found: DataFrame, date: str, step: str = "1 month") -> DataFrame:
    """One row: expected and missing periods, and the share that is there in percent."""
    unit = "month" if step == "1 month" else "day"
    have = found.select(F.trunc(date, unit).cast("date").alias("d") if unit == "month" else F.col(date).cast("date").alias("d")).distinct()
    n = have.agg(F.count("*").alias("found"), F.min("d").alias("a"), F.max("d").alias("b"))
    expected = F.expr(f"cast(size(sequence(a, b, interval {step})) as bigint)")
    return n.select(expected.alias("expected"), (expected - F.col("found")).alias("missing"), F.round(100.0 * F.col("found") / expected, 4).alias("percent"))


def daily_gaps(found: DataFrame, date: str) -> DataFrame:
    """Runs of missing days: the last day before, the first after, and days between.

    Days are few next to rows, so the window runs over distinct days.
    """
    days = found.select(F.col(date).cast("date").alias("d")).distinct().withColumn("y", F.lit(0))
    after = F.lead("d").over(Window.partitionBy("y").orderBy("d"))
    return days.select(F.col("d").alias("before"), after.alias("after")).where("datediff(after, before) > 1").withColumn("days", F.datediff("after", "before") - 1)


def deduplicate(trades: DataFrame, *order: str, key: str = "trade_id") -> DataFrame:
    """The first row of each ``key`` by ``order``, kept by a partial aggregation rather than a sort."""
    rest = [c for c in trades.columns if c != key]
    first = trades.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return first.select(key, "__r.*").select(*trades.columns)


def append_new(target: DataFrame, fresh: DataFrame, time: str = "time") -> DataFrame:
    """Rows of ``fresh`` after the last time of ``target`` (all of them if it is empty)."""
    last = target.agg(F.max(time)).first()[0]
    return fresh if last is None else fresh.where(F.col(time) > F.lit(last))


def pack(trades: DataFrame, path: str, files: int, time: str = "time", rows_per_file: int = 50_000_000, codec: str = "zstd") -> None:
    """Time-ordered Parquet files of bounded size."""
    ordered = trades.repartitionByRange(files, time).sortWithinPartitions(time)
    ordered.write.option("maxRecordsPerFile", rows_per_file).option("compression", codec).parquet(path)


def write_bars(bars: DataFrame, path: str) -> None:
    """Bars, a folder for each parameter set."""
    bars.write.mode("append").partitionBy("params").parquet(path)


def write_jdbc(bars: DataFrame, url: str, kind: str, sample: str, table: str = "dollar_bars", **options: str) -> None:
    """Append bars to a database table with the type and sample they are of."""
    tagged = bars.drop("start_time").withColumns({"type": F.lit(kind), "sample_date": F.current_date().cast("string"), "sample": F.lit(sample)})
    tagged.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def audit(trades: DataFrame) -> DataFrame:
    """One row of file predicates: counts, null times, prices and quantities over 0, hours spanned."""
    bad = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return trades.agg(
        F.count("*").alias("n"),
        bad(F.col("time").isNull()).alias("null_times"),
        bad(~(F.col("price") > 0)).alias("bad_prices"),
        bad(~(F.col("qty") > 0)).alias("bad_qtys"),
        F.round((F.unix_seconds(F.max("time").cast("timestamp")) - F.unix_seconds(F.min("time").cast("timestamp"))) / 3600, 4).alias("hours"),
    )


def month_edges(trades: DataFrame, time: str = "time") -> DataFrame:
    """Each month with its first and last day on tape, and whether its start or end is missing."""
    day = F.to_date(time)
    months = trades.groupBy(F.trunc(day, "month").alias("month")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return months.withColumns({"start_missing": F.col("first_day") > F.col("month"), "end_missing": F.col("last_day") < F.last_day("month")})


def file_label(name: Column) -> Column:
    """Bar type in a file name: imbalance, standard, run or other."""
    low = F.lower(name)
    return F.when(low.contains("imbalance"), "imbalance").when(low.contains("standard"), "standard").when(low.contains("run"), "run").otherwise("other")


def split_fractions(rows: DataFrame, order: str, train: float, validation: float, key: str = "symbol") -> DataFrame:
    """``part``: train, validation or test by position within a key, bounds rounded down."""
    w = Window.partitionBy(key)
    at, n = F.row_number().over(w.orderBy(order)) - 1, F.count("*").over(w)
    a, b = F.floor(n * train), F.floor(n * train) + F.floor(n * validation)
    return rows.withColumn("part", F.when(at < a, "train").when(at < b, "validation").otherwise("test"))


def codec_sizes(spark: SparkSession, rows: DataFrame, folder: str, codecs: tuple[str, ...] = ("snappy", "gzip", "zstd", "lz4", "none")) -> DataFrame:
    """``codec, bytes, write_s, read_s``: the rows written and read with each codec, one job after another."""
    import time

    out = []
    for codec in codecs:
        path, began = f"{folder}/{codec}", time.perf_counter()
        rows.write.mode("overwrite").option("compression", codec).parquet(path)
        wrote = time.perf_counter()
        spark.read.parquet(path).write.format("noop").mode("overwrite").save()
        read = time.perf_counter()
        size = spark.read.format("binaryFile").load(f"{path}/*.parquet").agg(F.sum("length")).first()[0]
        out.append((codec, int(size or 0), wrote - began, read - wrote))
    return spark.createDataFrame(out, "codec string, bytes long, write_s double, read_s double")


def pending(wanted: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Files that the manifest does not list as done, so a stopped ingest takes up where it was."""
    return wanted.join(manifest.where("state = 'completed'").select(key), key, "left_anti")


#: Folders of an archive's markets.
MARKETS = {"spot": "spot", "um": "futures/um", "cm": "futures/cm"}


def archive_urls(dates: DataFrame, base: str, symbol: str, monthly: bool = False, market: str | None = None) -> DataFrame:
    """``date, url`` of the archives of a symbol under a base address; fetching them is left to the caller.

    ``market`` (spot, um or cm) adds the folders in which published archives of that market lie.
    """
    stamp = F.date_format("date", "yyyy-MM" if monthly else "yyyy-MM-dd")
    folder = f"{MARKETS[market]}/{'monthly' if monthly else 'daily'}/trades/" if market else ""
    return dates.select("date", F.concat(F.lit(f"{base.rstrip('/')}/{folder}{symbol}/{symbol}-trades-"), stamp, F.lit(".zip")).alias("url"))


def verified(files: DataFrame, sums: DataFrame) -> DataFrame:
    """``path, state`` of files ``(path, sha256)`` against published lines ``value`` of a sum and a file name.

    ``completed`` where the sums agree, ``failed`` where they differ, ``pending`` without a published one.
    """
    cells = F.split(F.trim("value"), r"\s+\*?")
    told = sums.select(F.lower(cells[0]).alias("__sum"), F.element_at(cells, -1).alias("__name")).where("__sum <> ''").dropDuplicates(["__name"])
    own = files.withColumn("__name", F.element_at(F.split("path", "/"), -1))
    state = F.when(F.col("__sum").isNull(), "pending").when(F.lower("sha256") == F.col("__sum"), "completed").otherwise("failed")
    return own.join(told, "__name", "left").select("path", state.alias("state"))


def convert(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """Archives at ``source`` written as Parquet to ``target``: trades read, and trades counted again in what was written.

    Raises if the two differ. The first count is taken while rows are written, without another pass.
    """
    counted = Observation()
    tape.read_zips(spark, source).observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    read, written = counted.get["n"], spark.read.parquet(target).count()
    if read != written:
        raise ValueError(f"{read} trades read, {written} written to {target}")
    return read, written


def pack_by_size(trades: DataFrame, path: str, size: int, most: int, **options) -> int:
    """``pack`` into as many files as keep each under ``most`` bytes, of trades that take ``size``; cast to the schema, in its order.

    Packed files take nine tenths of what they are made of. Returns the number of files.
    """
    files = max(1, ceil(0.9 * size / most))
    ready = trades.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in tape.TRADE_SCHEMA.fields])
    pack(ready, path, files, **options)
    return files


def load_bars(spark: SparkSession, path: str, params: str | float | None = None) -> DataFrame:
    """Bars written by ``write_bars``, of one parameter set if given: other folders are not read."""
    bars = spark.read.parquet(path)
    return bars if params is None else bars.where(F.col("params") == params)


def write_experiment(folder: str, stats: DataFrame, about: dict) -> None:
    """Statistics as CSV and facts as JSON in a folder of their own."""
    stats.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/statistics")  # a row for each feature
    stats.sparkSession.createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").write.mode("overwrite").text(f"{folder}/metadata")


def experiments(spark: SparkSession, root: str) -> DataFrame:
    """``folder`` and the facts of every experiment under ``root``."""
    found = spark.read.json(f"{root}/*/metadata")
    return found.withColumn("folder", F.regexp_extract(F.input_file_name(), "([^/]+)/metadata/", 1))

"""Triple-barrier labels and overlap-aware sample weights."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def vertical_barriers(events: DataFrame, bars: DataFrame, minutes: int) -> DataFrame:
    """``t1``: event time plus ``minutes``, null where that is after the symbol's last bar."""
    last = bars.groupBy("symbol").agg(F.max("time").alias("__last"))
    t1 = F.col("time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return events.join(last, "symbol").withColumn("t1", F.when(t1 <= F.col("__last"), t1)).drop("__last")


def triple_barrier(events: DataFrame, bars: DataFrame, pt: float, sl: float, minutes: int) -> DataFrame:
    """Adds ``t_pt, t_sl, ret, max_drawdown, label, meta_label`` to ``events (symbol, time, trgt, side, t1)``.

    Barriers are ``close ± trgt * multiple`` in price units; the first bar from the event to ``t1``, both
    included, that reaches one decides, the profit side first within a bar; else the last bar's
    return counts and the label is 0. Events without ``t1`` or entry bar get 0. An event meets bars by
    time buckets of ``minutes``, two at most, so the join is an equi-join that grows with the bars in reach.
    """
    width = minutes * 60
    bucket = lambda t: F.floor(F.unix_seconds(t.cast("timestamp")) / width)
    own = events.select("symbol", "time", "trgt", "side", "t1")
    entry = bars.select("symbol", "time", F.col("close").alias("__entry"))
    live = own.where("t1 is not null").join(entry, ["symbol", "time"])
    spread = live.withColumn("__b", F.explode(F.sequence(bucket(F.col("time")), bucket(F.col("t1")))))
    path = bars.select(F.col("symbol"), F.col("time").alias("__t"), F.col("close").alias("__c")).withColumn("__b", bucket(F.col("__t")))
    hit = spread.join(path, ["symbol", "__b"]).where("__t between time and t1")
    side, c = F.col("side"), F.col("__c")
    up, down = F.col("__entry") + F.col("trgt") * pt * side, F.col("__entry") - F.col("trgt") * sl * side
    won = F.when(side == 1, c >= up).otherwise(c <= up)
    lost = F.when(side == 1, c <= down).otherwise(c >= down)
    ret = (c / F.col("__entry") - 1) * side
    judged = hit.withColumns({"__kind": F.when(won, 1).when(lost, -1), "__ret": ret})
    first = judged.groupBy("symbol", "time").agg(
        F.min_by(F.struct("__t", "__kind", "__ret"), F.when(F.col("__kind").isNotNull(), F.col("__t"))).alias("f"),
        F.max_by("__ret", "__t").alias("__end"),
    )
    out = own.join(first, ["symbol", "time"], "left")
    label = F.coalesce(F.col("f.__kind"), F.lit(0))
    return out.select(
        *own.columns,
        F.when(label == 1, F.col("f.__t")).alias("t_pt"),
        F.when(label == -1, F.col("f.__t")).alias("t_sl"),
        F.coalesce(F.when(label != 0, F.col("f.__ret")).otherwise(F.col("__end")), F.lit(0.0)).alias("ret"),
        F.lit(0.0).alias("max_drawdown"),
        label.alias("label"),
        (label == 1).cast("int").alias("meta_label"),
    )


def uniqueness(events: DataFrame) -> DataFrame:
    """Adds ``uniqueness``: 1 over the number of the symbol's intervals that overlap ``[time, t1]``, itself included.

    An interval without ``t1`` has 1 and is not seen by others. The count is that of starts up to
    ``t1`` less that of ends before ``time``: two running sums over sorted times, no pairs.
    """
    whole = events.where("t1 is not null")
    marks = lambda at, kind, first: whole.select("symbol", F.col(at).alias("at"), F.lit(kind).alias("kind"), F.lit(first).alias("first"), "time", "t1")
    running = Window.partitionBy("symbol").orderBy("at", "first").rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def counted(points: str, asks: str, strict: bool, name: str) -> DataFrame:
        rows = marks(points, 1, 1 if strict else 0).unionByName(marks(asks, 0, 0 if strict else 1))
        return rows.withColumn(name, F.sum("kind").over(running)).where("kind = 0").select("symbol", "time", "t1", name).distinct()

    started = counted("time", "t1", False, "__started")
    ended = counted("t1", "time", True, "__ended")
    counts = started.join(ended, ["symbol", "time", "t1"])
    return events.join(counts, ["symbol", "time", "t1"], "left").withColumn("uniqueness", F.coalesce(1 / (F.col("__started") - F.col("__ended")), F.lit(1.0))).drop("__started", "__ended")


def decay(rate: float, time: str = "time") -> Column:
    """``rate`` to the whole days that lie between an event and the symbol's last one."""
    last = F.max(time).over(Window.partitionBy("symbol"))
    seconds = F.unix_seconds(last.cast("timestamp")) - F.unix_seconds(F.col(time).cast("timestamp"))
    return F.pow(F.lit(rate), F.floor(seconds / 86400))


def half_life_decay(days: float, time: str = "time") -> Column:
    last = F.max(time).over(Window.partitionBy("symbol"))
    return F.exp(-log(2) / days * (F.unix_seconds(last.cast("timestamp")) - F.unix_seconds(F.col(time).cast("timestamp"))) / 86400)


def sample_weights(events: DataFrame, rate: float) -> DataFrame:
    """Adds ``uniqueness`` and ``weight``: uniqueness by decay, not normalised."""
    return uniqueness(events).withColumn("weight", F.col("uniqueness") * decay(rate))

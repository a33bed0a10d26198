"""Column expressions over a tape that is ordered by ``seq`` within a symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("seq")


def with_side(trades: DataFrame, compat: bool = True, single: bool = False, reset_rows: int | None = None) -> DataFrame:
    """``side`` by the tick rule: 1 or -1 as the price moved, unmoved prices carry it on, 1 at first.

    ``compat`` gives 1 for a fall, the sign that existing bars were made with; otherwise 1 is a rise.
    ``single`` compares prices in single precision. ``reset_rows`` starts anew after so many rows of a
    symbol, as files do that were made in chunks.
    """
    order = by_symbol()
    if reset_rows:
        trades = trades.withColumn("__chunk", F.floor((F.row_number().over(order) - 1) / reset_rows))
        order = Window.partitionBy("symbol", "__chunk").orderBy("seq")
    now = F.col("price").cast("float") if single else F.col("price")
    before = F.lag(now).over(order)
    fell, rose = (1, -1) if compat else (-1, 1)
    move = F.when(before > now, fell).when(before < now, rose)
    carried = F.last("__move", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return trades.withColumn("__move", move).withColumn("side", F.coalesce(carried, F.lit(1)).cast("byte")).drop("__move", "__chunk")


def with_net(trades: DataFrame, single: bool = False) -> DataFrame:
    """``net``: notional signed by side, in single precision first if asked."""
    quote = F.col("quoteQty").cast("float") if single else F.col("quoteQty")
    return trades.withColumn("net", (quote * F.col("side")).cast("double"))

"""Queries over tapes and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.functions.ticks import with_net, with_side
from barforge.operators import bars as B
from barforge.operators.series import indexed
from barforge.sources import tape, upkeep

THRESHOLD = 500_000.0
IMBALANCE = {"init_ticks": 20, "alpha_ticks": 0.5, "alpha_imbalance": 0.5, "reset_hours": 24.0}
LEGACY = {"init_volume": 500_000.0, "init_dif": 1.0, "alpha_volume": 0.5, "alpha_imbalance": 0.5}
GRID = (250_000.0, 500_000.0, 1_000_000.0)

TAPE = """
tape AS (
  SELECT event_id AS seq, event_type AS symbol, ts AS time, value::DOUBLE AS price, user_id,
         (json_extract(props, '$.k')::INT + 1)::DOUBLE AS qty,
         (round(value * 100) * (json_extract(props, '$.k')::INT + 1))::DOUBLE AS quoteQty
  FROM events
), moved AS (
  SELECT *, CASE WHEN lag(price) OVER w > price THEN 1 WHEN lag(price) OVER w < price THEN -1 END AS mv
  FROM tape WINDOW w AS (PARTITION BY symbol ORDER BY seq)
), carried AS (
  SELECT *, coalesce(last_value(mv IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) AS side FROM moved
), sided AS (SELECT *, quoteQty * side AS net, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS rn FROM carried)
"""
HOURS = TAPE + """, hourly AS (
  SELECT symbol, date_trunc('hour', time) AS time, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) AS close, sum(qty) AS volume, sum(quoteQty) AS usd, sum(CASE WHEN side > 0 THEN net ELSE 0 END) AS buy
  FROM sided GROUP BY symbol, date_trunc('hour', time)
), bars AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time) - 1 AS idx FROM hourly)
"""
_BAR_SQL = """symbol, bar, min(seq) AS start_seq, max(seq) AS end_seq, max(time) AS end_time, arg_min(price, seq) AS open, max(price) AS high,
         min(price) AS low, arg_max(price, seq) AS close, sum(net) AS theta, sum(CASE WHEN side > 0 THEN net ELSE 0 END) AS buy,
         sum(abs(net)) AS usd, sum(qty) AS qty, count(*) AS ticks, count(*) FILTER (side > 0) AS ticks_buy"""
_BAR_COLUMNS = ["symbol", "bar_id", "start_seq", "end_seq", "end_time", "open", "high", "low", "close", "theta", "buy", "usd", "qty", "ticks", "ticks_buy"]
_BAR_OUT = "symbol, bar::BIGINT AS bar_id, start_seq, end_seq, end_time, open, high, low, close, theta, buy, usd, qty, ticks, ticks_buy"


def sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_net(with_side(tape.trades_from_events(spark, sf_dir)))


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by the hour with ``idx``, the input of series and feature queries."""
    rows = sided(spark, sf_dir).groupBy("symbol", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("time")).agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.sum("qty").alias("volume"),
        F.sum("quoteQty").alias("usd"),
        F.sum(F.when(F.col("side") > 0, F.col("net")).otherwise(0.0)).alias("buy"),
    )
    return indexed(rows, "time")


def tick_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sided(spark, sf_dir).select("symbol", "seq", F.col("side").cast("int").alias("side"), "net")


def net_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sided(spark, sf_dir).groupBy("symbol", F.col("side").cast("int").alias("side")).agg(F.sum("net").alias("net"), F.sum("qty").alias("qty"), F.count("*").alias("ticks"))


def time_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_id") % 3 == 0, micros).when(F.col("event_id") % 3 == 1, F.expr("unix_micros(cast(ts as timestamp)) div 1000")).otherwise(F.expr("unix_micros(cast(ts as timestamp)) div 1000000"))
    return tape.table(spark, sf_dir, "events").withColumn("raw", raw.cast("long")).select("event_id", tape.epoch_to_timestamp(F.col("raw")).alias("time"), tape.epoch_by_magnitude(F.col("raw")).alias("time2"))


def dedupe_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("long").alias("trade_id"), F.col("l_partkey").cast("long").alias("l_partkey"), F.col("l_suppkey").cast("long").alias("l_suppkey"))
    return upkeep.deduplicate(rows, "l_partkey", "l_suppkey")


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of every order."""
    return tape.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))


def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.missing_dates(_order_days(spark, sf_dir), "day", weekdays=True)


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.completeness(_order_days(spark, sf_dir), "day")


def daily_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.daily_gaps(_order_days(spark, sf_dir), "day")


def append_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("time"), F.col("l_quantity").cast("double").alias("qty"))
    fresh = upkeep.append_new(rows.where("time < date'1996-01-01'"), rows)
    return fresh.groupBy(F.trunc("time", "month").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("qty"), 2).alias("qty"))


def audit_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.audit(tape.trades_from_events(spark, sf_dir))


def month_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.month_edges(_order_days(spark, sf_dir), "day")


def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.split_fractions(hour_bars(spark, sf_dir), "time", 0.6, 0.25).groupBy("symbol", "part").agg(F.count("*").alias("n"), F.min("time").alias("first"), F.max("time").alias("last"))


def dollar_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.standard_bars(sided(spark, sf_dir), THRESHOLD).select(*_BAR_COLUMNS)


def imbalance_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.imbalance_bars(sided(spark, sf_dir), **IMBALANCE).select(*_BAR_COLUMNS, F.round("ewma_t", 6).alias("ewma_t"), F.round("ewma_imbalance", 4).alias("ewma_imbalance"))


def imbalance_bars_v0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.legacy_imbalance_bars(sided(spark, sf_dir), **LEGACY).select(*_BAR_COLUMNS, F.round("threshold", 2).alias("threshold"))


def bar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bar_grid(sided(spark, sf_dir), list(GRID)).groupBy("params", "symbol").agg(F.count("*").alias("bars"), F.sum("usd").alias("usd"), F.max("end_seq").alias("last_seq"))


def bar_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sided(spark, sf_dir).select("symbol", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("end_time"), F.col("seq").alias("bar_id"), *[F.col("price").alias(c) for c in ("open", "high", "low", "close")], "qty", F.abs("net").alias("usd"), F.when(F.col("side") > 0, F.col("net")).otherwise(0.0).alias("buy"))
    return B.collapse(rows).withColumn("log_close", F.round("log_close", 6))


def bar_gap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = B.standard_bars(sided(spark, sf_dir), THRESHOLD)
    gap = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.lag(F.unix_micros(F.col("end_time").cast("timestamp"))).over(Window.partitionBy("symbol").orderBy("bar_id"))) / 60e6
    rows = made.withColumn("gap", gap)
    return rows.groupBy("symbol").agg(F.count("*").alias("bars"), F.countDistinct(F.to_date("end_time")).alias("days"), *[F.round(x, 4).alias(n) for n, x in (("mean_gap", F.avg("gap")), ("median_gap", F.median("gap")), ("std_gap", F.stddev_samp("gap")), ("min_gap", F.min("gap")), ("max_gap", F.max("gap")))])


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the second tape, whose order is a key of five columns; amounts in hundredths."""
    rows = tape.trades_from_lineitem(spark, sf_dir).withColumn("quoteQty", F.round(F.col("quoteQty") * 100))
    rows = with_net(with_side(rows)).select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "price", "qty", "side", "net", F.col("seq").alias("key"))
    numbered = rows.withColumn("seq", F.row_number().over(Window.partitionBy("symbol").orderBy("key")).cast("long"))
    return B.standard_bars(numbered, 5_000_000_000.0).select("symbol", "bar_id", "start_seq", "end_seq", "usd", "ticks")


_FOLD_BARS = """, f AS (
  SELECT symbol, rn, 0 AS bar, quoteQty AS acc, quoteQty >= {t} AS done FROM sided WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.rn, f.bar + CASE WHEN f.done THEN 1 ELSE 0 END, CASE WHEN f.done THEN 0 ELSE f.acc END + t.quoteQty,
         CASE WHEN f.done THEN 0 ELSE f.acc END + t.quoteQty >= {t}
  FROM f JOIN sided t ON t.symbol = f.symbol AND t.rn = f.rn + 1
), closed AS (SELECT symbol, bar FROM f WHERE done), made AS (
  SELECT {bar} FROM f JOIN sided USING (symbol, rn) JOIN closed USING (symbol, bar) GROUP BY symbol, bar
)"""
_DOLLAR = "WITH RECURSIVE " + TAPE + _FOLD_BARS.format(t=THRESHOLD, bar=_BAR_SQL)

QUERIES = {f.__name__: f for f in (tick_side, net_volume, time_unit, dedupe_trades, missing_days, missing_months, daily_gaps, append_filter, audit_trades, month_edges, time_split, dollar_bars, imbalance_bars, imbalance_bars_v0, bar_grid, bar_collapse, bar_gap_stats, lineitem_bars)}
_DAYS = "days_of AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)"
ORACLES = {
    "tick_side": f"WITH {TAPE} SELECT symbol, seq, side, net FROM sided",
    "net_volume": f"WITH {TAPE} SELECT symbol, side, sum(net) AS net, sum(qty) AS qty, count(*) AS ticks FROM sided GROUP BY symbol, side",
    "time_unit": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS time, time AS time2 FROM events""",
    "dedupe_trades": "SELECT (l_orderkey * 100 + l_linenumber)::BIGINT AS trade_id, arg_min(l_partkey, (l_partkey, l_suppkey))::BIGINT AS l_partkey, arg_min(l_suppkey, (l_partkey, l_suppkey))::BIGINT AS l_suppkey FROM lineitem GROUP BY 1",
    "missing_days": f"WITH {_DAYS}, s AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS date FROM days_of) SELECT date FROM s WHERE date NOT IN (SELECT d FROM days_of) AND dayofweek(date) BETWEEN 1 AND 5",
    "missing_months": f"WITH {_DAYS}, m AS (SELECT DISTINCT date_trunc('month', d)::DATE AS d FROM days_of), e AS (SELECT datediff('month', min(d), max(d)) + 1 AS expected, count(*) AS n FROM m) SELECT expected::BIGINT AS expected, (expected - n)::BIGINT AS missing, round(100.0 * n / expected, 4)::DOUBLE AS percent FROM e",
    "daily_gaps": f'WITH {_DAYS}, n AS (SELECT d AS "before", lead(d) OVER (ORDER BY d) AS "after" FROM days_of) SELECT "before", "after", (datediff(\'day\', "before", "after") - 1)::INT AS days FROM n WHERE datediff(\'day\', "before", "after") > 1',
    "append_filter": "SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n, round(sum(l_quantity::DOUBLE), 2) AS qty FROM lineitem WHERE l_shipdate::DATE > (SELECT max(l_shipdate::DATE) FROM lineitem WHERE l_shipdate::DATE < DATE '1996-01-01') GROUP BY 1",
    "audit_trades": f"WITH {TAPE} SELECT count(*) AS n, count(*) FILTER (time IS NULL) AS null_times, count(*) FILTER (NOT coalesce(price > 0, false)) AS bad_prices, count(*) FILTER (NOT coalesce(qty > 0, false)) AS bad_qtys, round((floor(epoch(max(time))) - floor(epoch(min(time)))) / 3600, 4) AS hours FROM tape",
    "month_edges": f"WITH {_DAYS} SELECT date_trunc('month', d)::DATE AS month, min(d) AS first_day, max(d) AS last_day, min(d) > date_trunc('month', d)::DATE AS start_missing, max(d) < last_day(date_trunc('month', d)::DATE) AS end_missing FROM days_of GROUP BY date_trunc('month', d)::DATE, last_day(date_trunc('month', d)::DATE), date_trunc('month', d)",
    "time_split": f"WITH {HOURS}, s AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM bars) SELECT symbol, CASE WHEN idx < floor(n * 0.6::DOUBLE) THEN 'train' WHEN idx < floor(n * 0.6::DOUBLE) + floor(n * 0.25::DOUBLE) THEN 'validation' ELSE 'test' END AS part, count(*) AS n, min(time) AS first, max(time) AS last FROM s GROUP BY ALL",
    "dollar_bars": f"{_DOLLAR} SELECT {_BAR_OUT} FROM made",
    "imbalance_bars": f"""WITH RECURSIVE {TAPE}, f AS (
  SELECT symbol, rn, 0 AS bar, time AS t0, net AS theta, 1 AS ticks, true AS warm, 0::DOUBLE AS et, 0::DOUBLE AS ei, time, 1 >= {IMBALANCE['init_ticks']} AS done FROM sided WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, bar, t0, theta, ticks, warm, et, ei, time, CASE WHEN warm THEN ticks >= {IMBALANCE['init_ticks']} ELSE abs(theta) >= et * ei END FROM (
    SELECT t.symbol, t.rn, f.bar + f.done::INT AS bar, CASE WHEN f.done THEN t.time ELSE f.t0 END AS t0, CASE WHEN f.done THEN 0 ELSE f.theta END + t.net AS theta,
           CASE WHEN f.done THEN 0 ELSE f.ticks END + 1 AS ticks,
           CASE WHEN f.done THEN epoch_ms(f.time) - epoch_ms(f.t0) > 3600000 * {IMBALANCE['reset_hours']} ELSE f.warm END AS warm,
           CASE WHEN NOT f.done THEN f.et WHEN f.warm THEN f.ticks ELSE f.et + {IMBALANCE['alpha_ticks']} * (f.ticks - f.et) END AS et,
           CASE WHEN NOT f.done THEN f.ei WHEN f.warm THEN abs(f.theta) / f.ticks ELSE f.ei + {IMBALANCE['alpha_imbalance']} * (abs(f.theta) / f.ticks - f.ei) END AS ei, t.time
    FROM f JOIN sided t ON t.symbol = f.symbol AND t.rn = f.rn + 1)
), closed AS (
  SELECT symbol, bar, CASE WHEN warm THEN ticks ELSE et + {IMBALANCE['alpha_ticks']} * (ticks - et) END AS ewma_t,
         CASE WHEN warm THEN abs(theta) / ticks ELSE ei + {IMBALANCE['alpha_imbalance']} * (abs(theta) / ticks - ei) END AS ewma_imbalance FROM f WHERE done
), made AS (SELECT {_BAR_SQL.replace('max(time)', 'max(sided.time)').replace('sum(net)', 'sum(sided.net)').replace('count(*) AS ticks', 'count(*) AS ticks')} FROM (SELECT symbol, rn, bar FROM f) JOIN sided USING (symbol, rn) JOIN (SELECT symbol, bar FROM closed) USING (symbol, bar) GROUP BY symbol, bar)
SELECT {_BAR_OUT}, round(ewma_t::DOUBLE, 6) AS ewma_t, round(ewma_imbalance::DOUBLE, 4) AS ewma_imbalance FROM made JOIN closed USING (symbol, bar)""",
    "imbalance_bars_v0": f"""WITH RECURSIVE {TAPE}, g AS (SELECT *, CASE WHEN side > 0 THEN net ELSE 0 END AS b FROM sided), f AS (
  SELECT symbol, rn, 0 AS bar, net AS theta, abs(net) AS usd, b AS buy, {LEGACY['init_volume']}::DOUBLE AS ev, {LEGACY['init_dif']}::DOUBLE AS ed, abs(net) >= {LEGACY['init_volume'] * abs(LEGACY['init_dif'])} AS done FROM g WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, bar, theta, usd, buy, ev, ed, abs(theta) >= ev * abs(ed) FROM (
    SELECT t.symbol, t.rn, f.bar + f.done::INT AS bar, CASE WHEN f.done THEN 0 ELSE f.theta END + t.net AS theta, CASE WHEN f.done THEN 0 ELSE f.usd END + abs(t.net) AS usd,
           CASE WHEN f.done THEN 0 ELSE f.buy END + t.b AS buy,
           CASE WHEN NOT f.done THEN f.ev WHEN f.ed = 1 THEN f.usd ELSE f.ev + {LEGACY['alpha_volume']} * (f.usd - f.ev) END AS ev,
           CASE WHEN NOT f.done THEN f.ed WHEN f.ed = 1 THEN abs(2 * f.buy / f.usd - 1) ELSE f.ed + {LEGACY['alpha_imbalance']} * (abs(2 * f.buy / f.usd - 1) - f.ed) END AS ed
    FROM f JOIN g t ON t.symbol = f.symbol AND t.rn = f.rn + 1)
), states AS (
  SELECT symbol, bar, arg_max(CASE WHEN NOT done THEN ev WHEN ed = 1 THEN usd ELSE ev + {LEGACY['alpha_volume']} * (usd - ev) END, rn) AS v,
         arg_max(CASE WHEN NOT done THEN ed WHEN ed = 1 THEN abs(2 * buy / usd - 1) ELSE ed + {LEGACY['alpha_imbalance']} * (abs(2 * buy / usd - 1) - ed) END, rn) AS d FROM f GROUP BY symbol, bar
), made AS (SELECT {_BAR_SQL} FROM (SELECT symbol, rn, bar FROM f) JOIN sided USING (symbol, rn) GROUP BY symbol, bar)
SELECT {_BAR_OUT}, round(v * abs(d), 2) AS threshold FROM made JOIN states USING (symbol, bar)""",
    "bar_grid": "WITH RECURSIVE " + TAPE + f""", g AS (SELECT s.*, p.params FROM sided s, (SELECT unnest([{', '.join(map(str, GRID))}])::DOUBLE AS params) p), f AS (
  SELECT params, symbol, rn, 0 AS bar, quoteQty AS acc, seq, quoteQty >= params AS done FROM g WHERE rn = 1
  UNION ALL
  SELECT t.params, t.symbol, t.rn, f.bar + f.done::INT, CASE WHEN f.done THEN 0 ELSE f.acc END + t.quoteQty, t.seq, CASE WHEN f.done THEN 0 ELSE f.acc END + t.quoteQty >= t.params
  FROM f JOIN g t ON t.symbol = f.symbol AND t.params = f.params AND t.rn = f.rn + 1)
SELECT params, symbol, count(*) AS bars, sum(acc) AS usd, max(seq) AS last_seq FROM f WHERE done GROUP BY params, symbol""",
    "bar_collapse": f"""WITH {HOURS} SELECT symbol, time AS end_time, open, high, low, close, volume AS total_volume, usd AS total_volume_usd, buy AS total_volume_buy_usd, round(ln(close), 6) AS log_close
FROM (SELECT *, max(time) OVER (PARTITION BY symbol) AS l FROM bars) WHERE time < l""",
    "bar_gap_stats": f"""{_DOLLAR}, g AS (SELECT *, (epoch_us(end_time) - lag(epoch_us(end_time)) OVER (PARTITION BY symbol ORDER BY bar)) / 60e6 AS gap FROM made)
SELECT symbol, count(*) AS bars, count(DISTINCT end_time::DATE) AS days, round(avg(gap), 4) AS mean_gap, round(median(gap), 4) AS median_gap, round(stddev_samp(gap), 4) AS std_gap, round(min(gap), 4) AS min_gap, round(max(gap), 4) AS max_gap FROM g GROUP BY symbol""",
    "lineitem_bars": """WITH RECURSIVE t AS (
  SELECT l_returnflag AS symbol, round(l_extendedprice::DOUBLE * 100) AS q, sum(round(l_extendedprice::DOUBLE * 100)) OVER w AS c, row_number() OVER w AS rn
  FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING)
), f AS (
  SELECT symbol, 0 AS bar_id, 1::BIGINT AS start_seq, min(rn) AS end_seq, min(c) AS c, min(c) AS usd FROM t WHERE c >= 5000000000 GROUP BY symbol
  UNION ALL
  SELECT f.symbol, f.bar_id + 1, f.end_seq + 1, min(t.rn), min(t.c), min(t.c) - f.c FROM f JOIN t ON t.symbol = f.symbol AND t.c >= f.c + 5000000000 GROUP BY f.symbol, f.bar_id, f.end_seq, f.c
)
SELECT symbol, bar_id::BIGINT AS bar_id, start_seq, end_seq, usd, (end_seq - start_seq + 1)::BIGINT AS ticks FROM f""",
}

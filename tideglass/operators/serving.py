"""Serving queries: the questions that a front end asks, as functions from tables and parameters to a table.

bars: symbol, timestamp, open, high, low, close, volume. features: symbol, timestamp and indicators. rows: symbol, price, volume,
change_percent (the latest of each symbol). portfolio: what `market.portfolio` gives. Limits are the questions' own and are cut to
their maximum; a start or end time of 0 counts as absent, symbols are compared in upper case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
# What a crypto instrument's symbol contains one of.
CRYPTO = ("BTC", "ETH", "BNB", "SOL", "ADA", "DOGE", "XRP", "MATIC")


def is_crypto(symbol: Column) -> Column:
    return symbol.rlike("|".join(CRYPTO))


def _of(df: DataFrame, symbol: str | None) -> DataFrame:
    return df if not symbol else df.where(c("symbol") == symbol.upper())


def ohlcv(bars: DataFrame, symbol: str | None = None, start_time: int = 0, end_time: int = 0, limit: int = 100) -> DataFrame:
    """Bars within both times, the newest first; ties by symbol, then tick_id where there is one."""
    out = _of(bars, symbol)
    if start_time:
        out = out.where(c("timestamp") >= start_time)
    if end_time:
        out = out.where(c("timestamp") <= end_time)
    return out.orderBy(F.desc("timestamp"), "symbol", *(F.desc(x) for x in bars.columns if x == "tick_id")).limit(min(limit, 1000))


def features(rows: DataFrame, symbol: str | None = None, limit: int = 100) -> DataFrame:
    return _of(rows, symbol).orderBy(F.desc("timestamp"), "symbol").limit(min(limit, 1000))


def since(rows: DataFrame, timestamp: int) -> DataFrame:
    """What is newer than `timestamp`, the oldest first: what a live feed sends next."""
    return rows.where(c("timestamp") > timestamp).orderBy("timestamp", "symbol")


def symbols(bars: DataFrame) -> DataFrame:
    return bars.select("symbol").where(c("symbol").isNotNull()).distinct().orderBy("symbol")


def stats(bars: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: how many bars and feature rows, symbols, and the latest time."""
    per = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.max("timestamp").alias("latest"))
    both = per.select("bars", F.lit(1).alias("symbols"), "latest", F.lit(0).alias("features")).unionByName(
        rows.agg(F.count(F.lit(1)).alias("features")).select(F.lit(0).alias("bars"), F.lit(0).alias("symbols"), F.lit(None).cast("bigint").alias("latest"), "features")
    )
    return both.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("bars", "symbols", "features")), F.max("latest").alias("latest"))


def latest(bars: DataFrame, rows: DataFrame, symbol: str | None = None) -> DataFrame:
    """The latest bar of each symbol, or of one with its latest features beside it."""
    back = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    one = lambda df: _of(df, symbol).withColumn("__r", F.row_number().over(back)).where(c("__r") == 1).drop("__r")
    if not symbol:
        return one(bars)
    return one(bars).join(one(rows).withColumnRenamed("timestamp", "features_timestamp"), "symbol", "left")


def leaderboard(rows: DataFrame, category: str = "all", sort_by: str = "volume", limit: int = 50) -> DataFrame:
    """rank and row; category: all, crypto or stocks; by volume, price or change_percent (missing as 0), else by symbol."""
    crypto = is_crypto(c("symbol"))
    kept = rows.where(crypto) if category == "crypto" else rows.where(~crypto) if category == "stocks" else rows
    order: list[Column] = [F.coalesce(c(sort_by), F.lit(0)).desc()] if sort_by in ("volume", "price", "change_percent") else []
    top = kept.orderBy(*order, "symbol").limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order, "symbol")))


def symbol_row(rows: DataFrame, symbol: str) -> DataFrame:
    return _of(rows, symbol).limit(1)


def top_movers(rows: DataFrame, limit: int = 10) -> DataFrame:
    """side (gainer or loser), place and row; only rows with a change."""
    known = rows.where(c("change_percent").isNotNull())
    gain = known.orderBy(F.desc("change_percent"), "symbol").limit(limit).withColumns({"side": F.lit("gainer"), "place": F.row_number().over(Window.orderBy(F.desc("change_percent"), "symbol"))})
    lose = known.orderBy("change_percent", "symbol").limit(limit).withColumns({"side": F.lit("loser"), "place": F.row_number().over(Window.orderBy("change_percent", "symbol"))})
    return gain.unionByName(lose)


def search(rows: DataFrame, query: str, limit: int = 20, column: str = "symbol") -> DataFrame:
    return rows.where(F.upper(column).contains(query.upper())).orderBy(column).limit(limit)


def live(bars: DataFrame, rows: DataFrame, symbol: str, limit: int = 10) -> DataFrame:
    """The newest rows of a symbol as nested records; missing numbers are 0, a missing signal is HOLD."""
    zero = lambda x: F.coalesce(F.nanvl(c(x).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(x)
    numbers = [x for x, t in rows.dtypes if t in ("double", "float") and x not in bars.columns]
    both = _of(bars, symbol).orderBy(F.desc("timestamp")).limit(min(limit, 100)).join(rows.select("symbol", "timestamp", *numbers, *(["signal"] if "signal" in rows.columns else [])), ["symbol", "timestamp"], "left")
    signal = F.coalesce(c("signal").cast("string"), F.lit("HOLD")) if "signal" in rows.columns else F.lit("HOLD")
    return both.select("timestamp", "symbol", F.struct(*(zero(x) for x in ("open", "high", "low", "close", "volume"))).alias("ohlcv"), F.struct(*(zero(x) for x in numbers)).alias("indicators") if numbers else F.lit(None).alias("indicators"), signal.alias("signal")).orderBy(F.desc("timestamp"))


def sharpe_of_values(values: DataFrame, initial: float = 10000.0, most: int = 100, risk_free: float = 0.02) -> DataFrame:
    """symbol, sharpe_ratio from the first `most` portfolio values (symbol, timestamp, portfolio_value) of each symbol; the return
    of the first is against `initial`. 0 below two returns, a deviation of 0 counts as 0.001."""
    w = Window.partitionBy("symbol").orderBy("timestamp")
    first = values.withColumn("n", F.row_number().over(w)).where(c("n") <= most).withColumn("before", F.coalesce(F.lag("portfolio_value").over(w), F.lit(initial)))
    agg = first.groupBy("symbol").agg(F.avg((c("portfolio_value") - c("before")) / c("before")).alias("m"), F.stddev_pop((c("portfolio_value") - c("before")) / c("before")).alias("s"), F.count(F.lit(1)).alias("k"))
    ratio = F.round((c("m") * 252 - risk_free) / (F.when(c("s") == 0, 0.001).otherwise(c("s")) * F.sqrt(F.lit(252.0))), 4)
    return agg.select("symbol", F.when(c("k") < 2, 0.0).otherwise(ratio).alias("sharpe_ratio"))


def trading_stats(portfolio: DataFrame, values: DataFrame, symbol: str, initial: float = 10000.0) -> DataFrame:
    """The portfolio's row of a symbol, its Sharpe ratio recomputed where it is 0; without a row, the starting record."""
    spark = portfolio.sparkSession
    row = _of(portfolio, symbol).join(sharpe_of_values(_of(values, symbol), initial).withColumnRenamed("sharpe_ratio", "recomputed"), "symbol", "left")
    row = row.withColumn("sharpe_ratio", F.when(c("sharpe_ratio") == 0, F.coalesce("recomputed", F.lit(0.0))).otherwise(c("sharpe_ratio"))).select("symbol", "cash", "position", "portfolio_value", "pnl", "total_trades", "sharpe_ratio")
    start = spark.range(1).select(F.lit(symbol.upper()).alias("symbol"), F.lit(initial).alias("cash"), F.lit(0.0).alias("position"), F.lit(initial).alias("portfolio_value"), F.lit(0.0).alias("pnl"), F.lit(0).alias("total_trades"), F.lit(0.0).alias("sharpe_ratio"))
    return row.unionByName(start.join(row.select("symbol"), "symbol", "left_anti"))


def trading_history(portfolio: DataFrame, symbol: str | None = None, limit: int = 50) -> DataFrame:
    """symbol, place, action, price: the different trades of each log in the order in which they were first seen, at most 500; without
    a trade there is no row."""
    logged = _of(portfolio, symbol).where(c("trade_log") != "")
    trades = logged.select("symbol", F.posexplode(F.array_distinct(F.split("trade_log", ";"))).alias("place", "t"))
    parts = F.split("t", "@", 2)
    return trades.where(c("place") < min(limit, 500)).select("symbol", "place", parts[0].alias("action"), parts[1].cast("double").alias("price"))


def sanitise(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Numbers rounded, null and NaN as 0; columns that begin with `_` are dropped."""
    out = rows.drop(*(x for x in rows.columns if x.startswith("_")))
    return out.withColumns({x: F.round(F.coalesce(F.nanvl(c(x), F.lit(0.0)), F.lit(0.0)), digits) for x, t in out.dtypes if t == "double"})


def replay_order(rows: DataFrame, at: str, key: str) -> DataFrame:
    """rows in the order of a replay: by time, and within one time in a fixed random order of keys."""
    return rows.orderBy(at, F.xxhash64(key, at), key)


def json_tail(lines: DataFrame, last: int = 100) -> DataFrame:
    """Of lines (shard, line_no, symbol, timestamp, ...) the last `last` of each shard, and of these each symbol's newest row."""
    back = Window.partitionBy("shard").orderBy(F.desc("line_no"))
    tail = lines.withColumn("__r", F.row_number().over(back)).where(c("__r") <= last)
    newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"), "shard", "line_no")
    return tail.withColumn("__r", F.row_number().over(newest)).where(c("__r") == 1).drop("__r")

"""Market operators: projections, statistics, windows, latest rows, leaderboards, signals and portfolios.

Ticks here are what `market_ticks` gives: usable, with a symbol and a price that is a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions import indicators as ind
from tideglass.functions.scalars import md5_partition, price_change
from tideglass.operators.ticks import DAY_MS, div, period_start, usable_ticks

c = F.col
SHARD_MS = 3_600_000


def good(column: str) -> Column:
    return c(column).isNotNull() & ~F.isnan(column)


#: Sums are taken over decimals of twelve places, so that the result doesn't depend on the order of rows; a group with a value that is too
#: great for that is summed in doubles.
PLACES, PRODUCT = "decimal(28,12)", ("decimal(24,12)", "decimal(13,0)")


def _exact(decimal: Column, plain: Column, over=lambda x: x) -> Column:
    """The sum of `decimal`, which is null where it overflows, or else that of the doubles `plain`."""
    whole = over(F.count(decimal)) == over(F.count(plain))
    return F.coalesce(F.when(whole, over(F.try_sum(decimal)).cast("double")), over(F.sum(plain)))


def exact_mean(x: Column) -> Column:
    """The mean, whatever the order of rows; NaN counts as null."""
    value = F.when(~F.isnan(x), x)
    return _exact(value.try_cast(PLACES), value) / F.count(value)


def market_ticks(ticks: DataFrame, *columns: str) -> DataFrame:
    return usable_ticks(ticks, "price", *columns).where(c("symbol").isNotNull() & good("price"))


def enrich(ticks: DataFrame) -> DataFrame:
    """All columns, the event time as a timestamp, spread, mid_price and price_range. Null in, null out; NaN in a double is null."""
    clean = {f.name: F.when(~F.isnan(f.name), c(f.name)) for f in ticks.schema.fields if f.dataType.typeName() in ("double", "float")}
    return ticks.withColumns(clean).withColumns({
        "event_time": F.timestamp_millis("event_ms"),
        "spread": c("ask") - c("bid"),
        "mid_price": (c("ask") + c("bid")) / 2,
        "price_range": c("high") - c("low"),
    })


def stats(ticks: DataFrame, key: str = "symbol") -> DataFrame:
    """count, avg, max, min price, total volume (nulls as 0), price_range and avg_volume by key; partial on the map side."""
    out = ticks.groupBy(key).agg(
        F.count(F.lit(1)).alias("count"), exact_mean(c("price")).alias("avg_price"), F.max("price").alias("max_price"), F.min("price").alias("min_price"), F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume")
    )
    return out.withColumns({"price_range": c("max_price") - c("min_price"), "avg_volume": c("total_volume") / c("count")})


def latest(ticks: DataFrame, key: str = "symbol", n: int = 1) -> DataFrame:
    """The last n rows of each key by event time and tick_id, with `place` 1 to n; all but n rows stay behind on the map side."""
    back = Window.partitionBy(key).orderBy(F.desc("event_ms"), F.desc("tick_id"))
    return ticks.withColumn("place", F.row_number().over(back)).where(c("place") <= n)


def daily_bars(ticks: DataFrame, width: int = DAY_MS) -> DataFrame:
    """symbol, start, open, high, low, close, volume of each period of `width` ms."""
    at = F.struct("event_ms", "tick_id")
    return ticks.groupBy("symbol", period_start(c("event_ms"), width).alias("start")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.coalesce(F.sum("volume"), F.lit(0)).alias("volume")
    )


def tick_pieces(ticks: DataFrame, *emas: int, rsi: bool = False, signal: bool = False) -> DataFrame:
    """symbol, series: the prices of each symbol as steps for the indicators."""
    return ind.pieces(ticks, "symbol", ("event_ms", "tick_id"), "price", emas, rsi, signal)


def bar_series(bars: DataFrame) -> DataFrame:
    """symbol, series of all bars: as many as the calendar has days."""
    return ind.recent(bars, "symbol", ["start"], ["open", "high", "low", "close", "volume"])


def trailing(ticks: DataFrame, width_ms: int = 300_000, shard_ms: int = SHARD_MS) -> DataFrame:
    """symbol, event_ms, tick_id, sma, vwap over the trailing window of each tick, its lower edge included; vwap is 0 without volume.

    A symbol is cut into shards of time; rows within `width_ms` before a border also go to the next shard as its past, so that a
    hot symbol's window runs in many tasks."""
    home = div(c("event_ms"), shard_ms)
    spread_ = ticks.select("symbol", "event_ms", "tick_id", "price", F.coalesce("volume", F.lit(0)).alias("volume"), home.alias("home"), F.explode(F.sequence(home, div(c("event_ms") + width_ms, shard_ms))).alias("shard"))
    w = Window.partitionBy("symbol", "shard").orderBy("event_ms").rangeBetween(-width_ms, 0)
    over = lambda x: x.over(w)
    volume = F.sum("volume").over(w)
    mean = _exact(c("price").try_cast(PLACES), c("price"), over) / F.count(F.lit(1)).over(w)
    value = _exact(F.try_multiply(c("price").try_cast(PRODUCT[0]), c("volume").try_cast(PRODUCT[1])), c("price") * c("volume"), over)
    out = spread_.select("symbol", "event_ms", "tick_id", "home", "shard", mean.alias("sma"), F.when(volume != 0, value / volume).otherwise(0.0).alias("vwap"))
    return out.where(c("home") == c("shard")).drop("home", "shard")


def sliding_rollup(ticks: DataFrame, width_ms: int = 300_000, hop_ms: int = 60_000) -> DataFrame:
    """symbol, window_start, avg_price, total_volume of sliding windows; aggregated by hop first, so only sums are copied."""
    hops = ticks.groupBy("symbol", period_start(c("event_ms"), hop_ms).alias("hop")).agg(F.try_sum(c("price").try_cast(PLACES)).alias("d"), F.count(c("price").try_cast(PLACES)).alias("k"), F.sum("price").alias("p"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("volume"), F.lit(0)).alias("v"))
    starts = F.sequence(c("hop") - (width_ms - hop_ms), c("hop"), F.lit(hop_ms).cast("bigint"))
    wide = hops.withColumn("window_start", F.explode(starts))
    return wide.groupBy("symbol", "window_start").agg((F.coalesce(F.when(F.sum("k") == F.sum("n"), F.try_sum("d").cast("double")), F.sum("p")) / F.sum("n")).alias("avg_price"), F.sum("v").alias("total_volume"))


def changes(ticks: DataFrame) -> DataFrame:
    """Each symbol's latest row with change and change_percent against the row before."""
    two = latest(ticks, n=2)
    before = F.max(F.when(c("place") == 2, c("price")))
    now = lambda x: F.max(F.when(c("place") == 1, c(x))).alias(x)
    rows = two.groupBy("symbol").agg(now("price"), now("volume"), now("event_ms"), before.alias("previous"))
    change, percent = price_change(c("price"), c("previous"))
    return rows.withColumns({"change": change, "change_percent": percent})


def leaderboard(rows: DataFrame, by: str, limit: int = 50) -> DataFrame:
    """The first `limit` rows by `by` (missing as 0), with their rank; ties by symbol."""
    top = rows.withColumn("__by", F.coalesce(by, F.lit(0))).orderBy(F.desc("__by"), "symbol").limit(limit)
    # At most `limit` rows are ranked here.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("__by"), "symbol"))).drop("__by")


def breadth(rows: DataFrame) -> DataFrame:
    """One row: total volume, mean price and how many symbols gained, lost and stood."""
    return rows.agg(
        F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"), F.round(F.avg("price"), 2).alias("avg_price"),
        F.count_if(c("change_percent") > 0).alias("gainers"), F.count_if(c("change_percent") < 0).alias("losers"), F.count_if(c("change_percent") == 0).alias("unchanged"),
    )


def features(ticks: DataFrame, mode: str = "series") -> DataFrame:
    """Each symbol's indicators, signals and trade type at its latest tick.

    mode `series`: the signal line is EMA-9 over the series of MACD, and RSI is smoothed over its last five. mode `reference`:
    both are taken over the one latest row, so the signal line equals MACD and the smoothed RSI never fills and is 0."""
    emas = (6, 10, 12, 13, 20, 26, 50)
    base = tick_pieces(ticks, *emas, rsi=True, signal=mode == "series")
    base = base.withColumns({f"ema_{n}": ind.long_ema(c("series"), n) for n in emas} | {"rsi": ind.rsi_wilder_seeded(c("series"))})
    if mode == "series":
        base = base.withColumn("s", ind.signal_series(c("series"))).select("*", "s.macd_signal", "s.rsi_smoothed").drop("s")
    last = latest(ticks).select("symbol", "price", "high", "low", "event_ms")
    rows = base.drop("series").join(last, "symbol").withColumn("macd", c("ema_12") - c("ema_26"))
    if mode == "reference":
        rows = rows.withColumns({"macd_signal": c("macd"), "rsi_smoothed": F.lit(0.0)})
    rows = rows.withColumns({"bull_power": c("high") - c("ema_13"), "bear_power": c("low") - c("ema_13")})
    p, macd, line, rsi = c("price"), c("macd"), c("macd_signal"), c("rsi_smoothed")
    long_entry = (c("ema_20") > c("ema_50")) & (p > c("ema_20")) & (macd < line) & (rsi > 50) & (c("bull_power") > 0) & (c("bear_power") < 0)
    long_exit = (c("ema_20") < c("ema_50")) & (p < c("ema_20"))
    short_entry = (c("ema_6") < c("ema_10")) & (p < c("ema_6")) & (macd > line) & (rsi < 40)
    short_exit = (c("ema_6") > c("ema_10")) & (p > c("ema_6"))
    signal = F.when(long_entry, 1).when(short_entry, -1).when(long_exit | short_exit, 0).otherwise(99)
    kind = F.when(long_entry, "long_entry").when(short_entry, "short_entry").when(long_exit, "long_exit").when(short_exit, "short_exit").otherwise("hold")
    return rows.withColumns({"signal": signal, "trade_type": kind})


def action_of(macd: Column) -> tuple[Column, Column, Column]:
    """The declared approximation: signal line and histogram as parts of MACD, and the action, which is then MACD's sign."""
    line = macd * 0.9
    return line, macd - line, F.when(macd > line * 1.05, "BUY").when(macd < line * 0.95, "SELL").otherwise("HOLD")


def crossover(macd: Column, line: Column, before: Column) -> Column:
    return F.when((macd > line) & (before <= line), "BUY").when((macd < line) & (before >= line), "SELL").otherwise("HOLD")


def portfolio(bars: DataFrame, mode: str = "series", cash: float = 10000.0) -> DataFrame:
    """symbol, current_price, cash, position, total_trades, trade_log, portfolio_value, pnl, pnl_percentage, sharpe_ratio over daily closes.

    series: trades where MACD (12, 26) of the closes changes its sign. reference: the price never reaches the state, so nothing trades."""
    s = bar_series(bars).withColumn("v", ind.prices(c("series"), "close"))
    if mode == "reference":
        state = F.struct(F.lit(cash).alias("cash"), F.lit(0.0).alias("position"), F.lit(0).alias("trades"), F.expr("cast(array() as array<string>)").alias("log"))
    else:
        state = ind.macd_trading(c("v"), cash)
    rows = s.withColumn("t", state).select("symbol", F.get("v", F.size("v") - 1).alias("current_price"), c("t.cash").alias("cash"), c("t.position").alias("position"), c("t.trades").alias("total_trades"), F.array_join("t.log", ";").alias("trade_log"))
    rows = rows.withColumn("portfolio_value", c("cash") + c("position") * c("current_price")).withColumn("pnl", c("portfolio_value") - cash)
    gain = c("pnl") / cash
    return rows.withColumns({"pnl_percentage": gain * 100, "sharpe_ratio": F.when(gain == 0, 0.0).otherwise(F.round(gain * 252 / 0.16, 4))})


def sharpe(bars: DataFrame, risk_free: float = 0.02) -> DataFrame:
    """symbol, sharpe_ratio of the daily returns of closes: population deviation, 0.001 where that is 0; 0 below two returns."""
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("start"))
    returns = bars.withColumn("r", F.when(before != 0, (c("close") - before) / before))
    agg = returns.groupBy("symbol").agg(F.avg("r").alias("m"), F.stddev_pop("r").alias("s"), F.count("r").alias("n"))
    spread_ = F.when(c("s") == 0, 0.001).otherwise(c("s"))
    ratio = F.round((c("m") * 252 - risk_free) / (spread_ * F.sqrt(F.lit(252.0))), 4)
    return agg.select("symbol", F.when(c("n") < 2, 0.0).otherwise(ratio).alias("sharpe_ratio"))


def quotes(ticks: DataFrame, kind: str) -> DataFrame:
    """Messages of an asset class from raw quotes (symbol, price, volume, event_ms): what each producer derives."""
    sent = ticks.select(c("event_ms").alias("timestamp"), "symbol", "price", "volume")
    if kind == "stock":
        cents = lambda by: F.round(c("price").cast("decimal(28,12)") * F.lit(by).cast("decimal(5,4)"), 2).cast("double")
        return sent.withColumns({"bid": cents("0.9995"), "ask": cents("1.0005"), "partition": md5_partition(c("symbol"), 3)})
    if kind == "crypto":
        return sent.withColumn("symbol", F.regexp_replace("symbol", "-USD$", ""))
    if kind == "commodity":
        return sent.withColumn("contract_month", F.date_format(F.date_from_unix_date(div(c("timestamp"), DAY_MS).cast("int")), "yyyy-MM"))
    return sent.select("timestamp", F.regexp_replace("symbol", "=X$", "").alias("pair"), F.round("price", 5).alias("rate"), "volume")

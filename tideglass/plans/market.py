"""Market queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass.functions import indicators as ind
from tideglass.functions.scalars import md5_partition
from tideglass.operators import drift as dr
from tideglass.operators import market as m
from tideglass.operators import serving as sv
from tideglass.operators.ticks import usable_ticks
from tideglass.plans.core_queries import USABLE
from tideglass.plans.registry import registry
from tideglass.sources.tables import table

c = F.col
QUERIES, ORACLE, query = registry()

TICKS = f"""{USABLE}, m AS (SELECT * FROM usable WHERE sym IS NOT NULL AND price IS NOT NULL AND NOT isnan(price))"""
LAST = f"""{TICKS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) AS place, lead(price) OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) AS previous FROM m),
  last AS (SELECT *, CASE WHEN previous IS NULL OR previous = 0 THEN 0.0 ELSE round(price - previous, 2) END AS change, CASE WHEN previous IS NULL OR previous = 0 THEN 0.0 ELSE round((price - previous) / previous * 100, 2) END AS change_percent FROM ranked WHERE place = 1)"""
BARS = f"""{TICKS}, bars AS (SELECT sym AS symbol, et - et % 86400000 AS start, arg_min(price, (et, tick_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (et, tick_id)) AS close, CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume FROM m GROUP BY 1, 2)"""
SERIES = f"""{TICKS}, ser AS (SELECT sym AS symbol, list(price ORDER BY et, tick_id) AS v FROM m GROUP BY 1)"""
BAR_SERIES = f"""{BARS}, ser AS (SELECT symbol, list({{'o': open, 'h': high, 'l': low, 'c': close}} ORDER BY start) AS b, list(close ORDER BY start) AS v FROM bars GROUP BY 1)"""


def ema_sql(values: str, n: int) -> str:
    return f"list_reduce({values}, lambda e, p: p * (2::DOUBLE / {n + 1}) + e * (1 - 2::DOUBLE / {n + 1}))"



def _ticks(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return m.market_ticks(table(spark, folder, "ticks"), "volume", *columns)


@query(f"""WITH {USABLE} SELECT tick_id, sym AS symbol, CASE WHEN NOT isnan(price) THEN price END AS price, volume, bid, ask, high, low, open, partition, make_timestamp(et * 1000) AS event_time, ask - bid AS spread, (ask + bid) / 2 AS mid_price, high - low AS price_range
  FROM (SELECT * REPLACE (CASE WHEN NOT isnan(bid) THEN bid END AS bid, CASE WHEN NOT isnan(ask) THEN ask END AS ask, CASE WHEN NOT isnan(high) THEN high END AS high, CASE WHEN NOT isnan(low) THEN low END AS low, CASE WHEN NOT isnan(open) THEN open END AS open) FROM usable)""")
def enrich_ticks(spark, folder):
    ticks = usable_ticks(table(spark, folder, "ticks"), "price", "volume", "bid", "ask", "high", "low", "open", "partition")
    return m.enrich(ticks).drop("event_ms", "time")


@query(f"WITH {TICKS} SELECT et AS timestamp, sym AS symbol, open, high, low, price AS close, volume FROM m")
def ohlcv_projection(spark, folder):
    return _ticks(spark, folder, "open", "high", "low").select(c("event_ms").alias("timestamp"), "symbol", "open", "high", "low", c("price").alias("close"), "volume")


@query(f"WITH {USABLE} SELECT tick_id, make_timestamp(et * 1000) AS event_time FROM usable")
def event_time_cast(spark, folder):
    return usable_ticks(table(spark, folder, "ticks"), symbol=False).select("tick_id", F.timestamp_millis("event_ms").alias("event_time"))


def _sum(x: str, over: str = "", kind: str = "DECIMAL(28,12)") -> str:
    """The exact sum as a double: text keeps all digits on the way in and out."""
    return f"CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS {kind})) {over} AS VARCHAR) AS DOUBLE)"


_MEAN = f"{_sum('price')} / count(*)"
_STATS = f"count(*) AS count, {_MEAN} AS avg_price, max(price) AS max_price, min(price) AS min_price, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume, max(price) - min(price) AS price_range, CAST(coalesce(sum(volume), 0) AS DOUBLE) / count(*) AS avg_volume"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({x: F.round(x, 6) for x in columns})


@query(f"WITH {TICKS} SELECT sym AS symbol, {_STATS} FROM m GROUP BY 1")
def symbol_stats(spark, folder):
    return m.stats(_ticks(spark, folder))


@query(f"WITH {TICKS} SELECT partition AS partition_id, count(*) AS message_count, {_MEAN} AS avg_price, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume FROM m GROUP BY 1")
def partition_stats(spark, folder):
    out = m.stats(_ticks(spark, folder, "partition"), "partition")
    return out.select(c("partition").alias("partition_id"), c("count").alias("message_count"), "avg_price", "total_volume")


@query(f"WITH {TICKS}, e AS (SELECT sym AS symbol, price, CASE WHEN NOT isnan(ask - bid) THEN ask - bid END AS spread, CASE WHEN NOT isnan(ask + bid) THEN (ask + bid) / 2 END AS mid FROM m) SELECT symbol, count(*) AS count, {_MEAN} AS avg_price, {_sum('spread')} / count(spread) AS avg_spread, {_sum('mid')} / count(mid) AS avg_mid_price FROM e GROUP BY 1")
def symbol_spread_stats(spark, folder):
    rows = m.enrich(_ticks(spark, folder, "bid", "ask", "high", "low"))
    mean = lambda x: m.exact_mean(c(x)).alias(f"avg_{x}")
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("count"), *map(mean, ("price", "spread", "mid_price")))


@query("SELECT ticker, CAST(md5_number(ticker) % 3 AS INTEGER) AS partition_id FROM cik_map")
def symbol_partition_md5(spark, folder):
    return table(spark, folder, "cik_map").select("ticker", md5_partition(c("ticker"), 3).alias("partition_id"))


@query("SELECT CAST(md5_number(upper(trim(symbol))) % 3 AS INTEGER) AS partition_id, count(*) AS messages, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share FROM ticks GROUP BY 1")
def partition_distribution(spark, folder):
    parts = table(spark, folder, "ticks").groupBy(md5_partition(F.upper(F.trim("symbol")), 3).alias("partition_id")).agg(F.count(F.lit(1)).alias("messages"))
    # Three rows are left here.
    return parts.withColumn("share", F.round(F.lit(100.0) * c("messages") / F.sum("messages").over(Window.partitionBy()), 4))


@query(f"WITH {LAST} SELECT sym AS symbol, tick_id, et AS event_ms, price, volume FROM last")
def latest_per_symbol(spark, folder):
    return m.latest(_ticks(spark, folder)).select("symbol", "tick_id", "event_ms", "price", "volume")


@query(f"WITH {TICKS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) AS place FROM m), s AS (SELECT sym AS symbol, list(price ORDER BY et, tick_id) AS v FROM m WHERE volume IS NOT NULL GROUP BY 1) SELECT r.sym AS symbol, r.price, round({ema_sql('s.v', 12)}, 6) AS ema_12, round({ema_sql('s.v', 26)}, 6) AS ema_26 FROM ranked r LEFT JOIN s ON s.symbol = r.sym WHERE r.place = 1")
def latest_with_features(spark, folder):
    ticks = _ticks(spark, folder)
    series = m.tick_pieces(ticks.where(c("volume").isNotNull()), 12, 26)
    feats = series.select("symbol", *(F.round(ind.long_ema(c("series"), n), 6).alias(f"ema_{n}") for n in (12, 26)))
    return m.latest(ticks).select("symbol", "price").join(feats, "symbol", "left")


@query(f"WITH {TICKS} SELECT et AS timestamp, tick_id, sym AS symbol, price AS close, volume FROM m WHERE sym = 'WIFUQ' AND et BETWEEN 1757900000000 AND 1759900000000 ORDER BY et DESC, tick_id DESC LIMIT 100")
def ohlcv_range_filter(spark, folder):
    rows = _ticks(spark, folder).withColumnRenamed("event_ms", "timestamp")
    return sv.ohlcv(rows, "wifuq", 1757900000000, 1759900000000).select("timestamp", "tick_id", "symbol", c("price").alias("close"), "volume")


@query(f"WITH {TICKS} SELECT DISTINCT sym AS symbol FROM m ORDER BY 1")
def distinct_symbols(spark, folder):
    return _ticks(spark, folder).select("symbol").distinct().orderBy("symbol")


@query(f"WITH {TICKS} SELECT count(*) AS rows, count(*) FILTER (volume > 0) AS traded_rows, count(DISTINCT sym) AS symbols, max(et) AS latest_ms FROM m")
def market_overview(spark, folder):
    t = _ticks(spark, folder).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("volume") > 0).alias("t"), F.max("event_ms").alias("e"))
    return t.agg(F.sum("n").alias("rows"), F.sum("t").alias("traded_rows"), F.count("symbol").alias("symbols"), F.max("e").alias("latest_ms"))


@query(f"WITH {TICKS} SELECT et AS event_ms, tick_id, sym AS symbol, price FROM m WHERE et > 1762000000000 ORDER BY et, tick_id")
def new_since(spark, folder):
    return _ticks(spark, folder).where(c("event_ms") > 1762000000000).select("event_ms", "tick_id", "symbol", "price").orderBy("event_ms", "tick_id")


def _board(by: str) -> str:
    return f"WITH {LAST} SELECT sym AS symbol, price, volume, change_percent, row_number() OVER (ORDER BY coalesce({by}, 0) DESC, sym) AS rank FROM last QUALIFY rank <= 50"


def _leader(spark, folder, by: str) -> DataFrame:
    return m.leaderboard(m.changes(_ticks(spark, folder)), by).select("symbol", "price", "volume", "change_percent", c("rank").cast("bigint").alias("rank"))


@query(_board("volume"))
def leaderboard_volume(spark, folder):
    return _leader(spark, folder, "volume")


@query(_board("price"))
def leaderboard_price(spark, folder):
    return _leader(spark, folder, "price")


@query(_board("change_percent"))
def leaderboard_change(spark, folder):
    return _leader(spark, folder, "change_percent")


@query(f"WITH {LAST} SELECT sym AS symbol, price, change, change_percent FROM last ORDER BY change_percent DESC, sym LIMIT 10")
def top_gainers(spark, folder):
    return m.changes(_ticks(spark, folder)).orderBy(F.desc("change_percent"), "symbol").limit(10).select("symbol", "price", "change", "change_percent")


@query(f"WITH {LAST} SELECT sym AS symbol, price, change, change_percent FROM last ORDER BY change_percent, sym LIMIT 10")
def top_losers(spark, folder):
    return m.changes(_ticks(spark, folder)).orderBy("change_percent", "symbol").limit(10).select("symbol", "price", "change", "change_percent")


@query(f"WITH {LAST} SELECT CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume, round(avg(price), 2) AS avg_price, count(*) FILTER (change_percent > 0) AS gainers, count(*) FILTER (change_percent < 0) AS losers, count(*) FILTER (change_percent = 0) AS unchanged FROM last")
def market_breadth(spark, folder):
    return m.breadth(m.changes(_ticks(spark, folder)))


@query(f"WITH {LAST} SELECT sym AS symbol, price, previous, change, change_percent FROM last")
def price_change(spark, folder):
    return m.changes(_ticks(spark, folder)).select("symbol", "price", "previous", "change", "change_percent")


@query("SELECT ticker, company_name FROM cik_map WHERE upper(ticker) LIKE '%QU%' ORDER BY ticker LIMIT 20")
def symbol_search(spark, folder):
    return sv.search(table(spark, folder, "cik_map"), "qu", column="ticker").select("ticker", "company_name")


@query(f"WITH {TICKS} SELECT sym AS symbol, CASE WHEN regexp_matches(sym, '{'|'.join(sv.CRYPTO)}') THEN 'crypto' ELSE 'stocks' END AS asset_class, count(*) AS n FROM m GROUP BY 1, 2")
def asset_class_filter(spark, folder):
    kind = F.when(sv.is_crypto(c("symbol")), "crypto").otherwise("stocks")
    return _ticks(spark, folder).groupBy("symbol", kind.alias("asset_class")).agg(F.count(F.lit(1)).alias("n"))


_EMAS = (6, 10, 12, 13, 20, 26, 50)


@query(f"WITH {SERIES} SELECT symbol, {', '.join(f'round({ema_sql("v", n)}, 6) AS ema_{n}' for n in _EMAS)} FROM ser")
def ema_all(spark, folder):
    s = m.tick_pieces(_ticks(spark, folder), *_EMAS)
    return s.select("symbol", *(F.round(ind.long_ema(c("series"), n), 6).alias(f"ema_{n}") for n in _EMAS))


@query(f"WITH {SERIES} SELECT symbol, round({ema_sql('v', 12)} - {ema_sql('v', 26)}, 6) AS macd FROM ser")
def macd(spark, folder):
    s = m.tick_pieces(_ticks(spark, folder), 12, 26)
    return s.select("symbol", F.round(ind.long_ema(c("series"), 12) - ind.long_ema(c("series"), 26), 6).alias("macd"))


@query(f"WITH {SERIES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) AS place FROM m) SELECT ser.symbol AS symbol, round(high - {ema_sql('v', 13)}, 6) AS bull_power, round(low - {ema_sql('v', 13)}, 6) AS bear_power FROM ser JOIN ranked ON ranked.sym = ser.symbol WHERE place = 1")
def elder_ray(spark, folder):
    ticks = _ticks(spark, folder, "high", "low")
    f = m.features(ticks, "reference")
    return f.select("symbol", F.round("bull_power", 6).alias("bull_power"), F.round("bear_power", 6).alias("bear_power"))


_SEEDED = "CASE WHEN s.n < 13 THEN s.{k} + {x} WHEN s.n = 13 THEN (s.{k} + {x}) / 14 ELSE {x} * (1::DOUBLE / 14) + s.{k} * (1 - 1::DOUBLE / 14) END"
_RUNNING = "CASE WHEN s.n < 14 THEN (s.{k} * (s.n - 1) + {x}) / s.n ELSE (s.{k} * 13 + {x}) / 14 END"


def _rsi_sql(rule: str, start: str, empty: str) -> str:
    """Values become structs like the state, as the fold wants one type; x is the value in them."""
    up, down = "greatest(x.last - s.last, 0)", "greatest(s.last - x.last, 0)"
    step = f"{{'last': x.last, 'g': {rule.format(k='g', x=up)}, 'l': {rule.format(k='l', x=down)}, 'n': s.n + 1}}"
    return f"WITH {SERIES}, r AS (SELECT symbol, list_reduce(list_transform(v, lambda p: {{'last': p, 'g': 0::DOUBLE, 'l': 0::DOUBLE, 'n': {start}}}), lambda s, x: {step}) AS z FROM ser) SELECT symbol, round({empty}, 6) AS rsi FROM r"


@query(_rsi_sql(_SEEDED, "0", "CASE WHEN z.n < 14 THEN 50 WHEN z.l = 0 THEN 100 ELSE 100 - 100 / (1 + z.g / z.l) END"))
def rsi_wilder_seeded(spark, folder):
    s = m.tick_pieces(_ticks(spark, folder), rsi=True)
    return s.select("symbol", F.round(ind.rsi_wilder_seeded(c("series")), 6).alias("rsi"))


@query(_rsi_sql(_RUNNING, "1", "CASE WHEN z.n < 2 OR z.l = 0 THEN 50 ELSE 100 - 100 / (1 + z.g / z.l) END"))
def rsi_running(spark, folder):
    s = m.tick_pieces(_ticks(spark, folder), rsi=True)
    return s.select("symbol", F.round(ind.rsi_running(c("series")), 6).alias("rsi"))


@query(f"WITH {SERIES} SELECT symbol, round(CASE WHEN len(v) >= 5 THEN list_sum(v[-5:]) / 5 ELSE 0 END, 6) AS sma FROM ser")
def sma_last5(spark, folder):
    s = ind.recent(_ticks(spark, folder), "symbol", ["event_ms", "tick_id"], ["price"], keep=5)
    return s.select("symbol", F.round(ind.sma_last(ind.prices(c("series"))), 6).alias("sma"))


_TRAIL = "OVER (PARTITION BY sym ORDER BY et RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW)"


@query(f"WITH {TICKS} SELECT tick_id, sym AS symbol, {_sum('price', _TRAIL)} / count(*) {_TRAIL} AS sma FROM m")
def sma_5min(spark, folder):
    return m.trailing(_ticks(spark, folder)).select("tick_id", "symbol", "sma")


@query(f"WITH {TICKS}, z AS (SELECT *, coalesce(volume, 0) AS vol FROM m) SELECT tick_id, sym AS symbol, CASE WHEN sum(vol) {_TRAIL} <> 0 THEN CAST(CAST(sum(CAST(CAST(price AS VARCHAR) AS DECIMAL(24,12)) * CAST(vol AS DECIMAL(13,0))) {_TRAIL} AS VARCHAR) AS DOUBLE) / CAST(sum(vol) {_TRAIL} AS DOUBLE) ELSE 0 END AS vwap FROM z")
def vwap_5min(spark, folder):
    return m.trailing(_ticks(spark, folder)).select("tick_id", "symbol", "vwap")


@query(f"WITH {TICKS} SELECT sym AS symbol, w AS window_start, {_MEAN} AS avg_price, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume FROM (SELECT *, unnest(generate_series(et - et % 60000 - 240000, et - et % 60000, 60000)) AS w FROM m) GROUP BY 1, 2")
def sliding_rollup_5m_1m(spark, folder):
    return m.sliding_rollup(_ticks(spark, folder))


@query(f"WITH {TICKS} SELECT sym AS symbol, count(*) AS count, min(et) AS first_ms, max(et) AS last_ms, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume, round(CAST(coalesce(sum(volume), 0) AS DOUBLE) / count(*), 6) AS avg_volume FROM m GROUP BY 1")
def window_metadata(spark, folder):
    total = F.coalesce(F.sum("volume"), F.lit(0))
    return _ticks(spark, folder).groupBy("symbol").agg(F.count(F.lit(1)).alias("count"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"), total.alias("total_volume"), F.round(total / F.count(F.lit(1)), 6).alias("avg_volume"))


@query(f"WITH {BARS} SELECT symbol, start, open, high, low, close, volume FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY start DESC) <= 500")
def historical_bars(spark, folder):
    back = Window.partitionBy("symbol").orderBy(F.desc("start"))
    return m.daily_bars(_ticks(spark, folder)).withColumn("n", F.row_number().over(back)).where(c("n") <= 500).drop("n")


def _bars(spark, folder) -> DataFrame:
    return m.bar_series(m.daily_bars(_ticks(spark, folder)))


_HA = "(x.o + x.h + x.l + x.c) / 4"


@query(f"WITH {BAR_SERIES}, r AS (SELECT symbol, list_reduce(list_transform(b, lambda x: {{'o': x.o, 'c': {_HA}}}), lambda s, x: {{'o': (s.o + s.c) / 2, 'c': x.c}}) AS z FROM ser) SELECT symbol, z.o AS ha_open, z.c AS ha_close FROM r")
def heikin_ashi_c(spark, folder):
    z = _bars(spark, folder).withColumn("z", ind.heikin_ashi_pair(c("series")))
    return z.select("symbol", "z.ha_open", "z.ha_close")


@query(f"""WITH {BAR_SERIES}, r AS (SELECT symbol, b[-1] AS e, list_reduce(list_transform(b, lambda x: {{'o': (x.o + x.c) / 2, 'c': {_HA}}}), lambda s, x: {{'o': (s.o + s.c) / 2, 'c': x.c}}) AS z FROM ser)
SELECT symbol, (z.o + z.c) / 2 AS ha_open, z.c AS ha_close, greatest(e.h, (z.o + z.c) / 2, z.c) AS ha_high, least(e.l, (z.o + z.c) / 2, z.c) AS ha_low FROM r""")
def heikin_ashi_a(spark, folder):
    z = _bars(spark, folder).withColumn("z", ind.heiken_ashi_updated(c("series")))
    return z.select("symbol", "z.*")


def _dmi_sql(n: int) -> str:
    up, down = "(x.h - s.h)", "(s.l - x.l)"
    keep = f"(CASE WHEN s.n < {n} THEN 1 ELSE 1 - 1::DOUBLE / {n} END)"
    gap = lambda k: f"(CASE WHEN s.c <> 0 THEN abs(x.{k} - s.c) ELSE 0 END)"
    step = f"{{'h': x.h, 'l': x.l, 'c': x.c, 'p': s.p * {keep} + CASE WHEN {up} > {down} AND {up} > 0 THEN {up} ELSE 0 END, 'm': s.m * {keep} + CASE WHEN {down} > {up} AND {down} > 0 THEN {down} ELSE 0 END, 't': s.t * {keep} + greatest(x.h - x.l, {gap('h')}, {gap('l')}), 'n': s.n + 1}}"
    return f"""WITH {BAR_SERIES}, r AS (SELECT symbol, list_reduce(list_transform(b, lambda x: {{'h': x.h, 'l': x.l, 'c': x.c, 'p': 0::DOUBLE, 'm': 0::DOUBLE, 't': 0::DOUBLE, 'n': 0}}), lambda s, x: {step}) AS z FROM ser)
SELECT symbol, round(CASE WHEN z.n >= {n} AND z.t <> 0 THEN 100 * z.p / z.t ELSE 0 END, 6) AS plus_di, round(CASE WHEN z.n >= {n} AND z.t <> 0 THEN 100 * z.m / z.t ELSE 0 END, 6) AS minus_di FROM r"""


def _dmi(spark, folder, n: int) -> DataFrame:
    z = _bars(spark, folder).withColumn("z", ind.dmi(c("series"), n))
    return z.select("symbol", F.round("z.plus_di", 6).alias("plus_di"), F.round("z.minus_di", 6).alias("minus_di"))


@query(_dmi_sql(14))
def dmi_14(spark, folder):
    return _dmi(spark, folder, 14)


@query(_dmi_sql(63))
def dmi_63(spark, folder):
    return _dmi(spark, folder, 63)


@query(f"""WITH {BAR_SERIES}, t AS (SELECT symbol, len(b) AS n, list_transform(b[-25:], lambda x: x.h) AS h, list_transform(b[-25:], lambda x: x.l) AS l FROM ser)
SELECT symbol, round(CASE WHEN n < 2 THEN 0 ELSE 100 * (25 - (len(h) - list_position(h, list_max(h)))) / 25::DOUBLE - 100 * (25 - (len(l) - list_position(l, list_min(l)))) / 25::DOUBLE END, 6) AS aroon FROM t""")
def aroon_25(spark, folder):
    return _bars(spark, folder).select("symbol", F.round(ind.aroon_oscillator(c("series")), 6).alias("aroon"))


@query(f"""WITH {BAR_SERIES}, r AS (SELECT symbol, list_reduce(list_transform(b, lambda x: {{'e': x.h - x.l, 'b': 0::DOUBLE}}), lambda s, x: {{'e': x.e * (2::DOUBLE / 11) + s.e * (1 - 2::DOUBLE / 11), 'b': s.e}}) AS z FROM ser)
SELECT symbol, round(CASE WHEN z.b = 0 THEN 0 ELSE 100 * (z.e - z.b) / z.b END, 6) AS chaikin FROM r""")
def chaikin_vol(spark, folder):
    return _bars(spark, folder).select("symbol", F.round(ind.chaikin_volatility(c("series")), 6).alias("chaikin"))


def _signals_sql(mode: str, tail: str = "") -> str:
    emas = ", ".join(f"{ema_sql('v', n)} AS e{n}" for n in _EMAS)
    smooth = "x.last * (2::DOUBLE / {n}) + s.{k} * (1 - 2::DOUBLE / {n})"
    a, b = smooth.format(n=13, k="a"), smooth.format(n=27, k="b")
    up, down = "greatest(x.last - s.last, 0)", "greatest(s.last - x.last, 0)"
    g, low = _SEEDED.format(k="g", x=up), _SEEDED.format(k="l", x=down)
    rsi = f"CASE WHEN s.n < 13 THEN 50::DOUBLE WHEN ({low}) = 0 THEN 100::DOUBLE ELSE 100 - 100 / (1 + ({g}) / ({low})) END"
    step = f"{{'a': {a}, 'b': {b}, 's': (({a}) - ({b})) * 0.2::DOUBLE + s.s * 0.8::DOUBLE, 'last': x.last, 'g': {g}, 'l': {low}, 'n': s.n + 1, 'r': list_concat([{rsi}], s.r)[1:5]}}"
    start = "{'a': p, 'b': p, 's': 0::DOUBLE, 'last': p, 'g': 0::DOUBLE, 'l': 0::DOUBLE, 'n': 0, 'r': [50::DOUBLE]}"
    line = f"list_reduce(list_transform(v, lambda p: {start}), lambda s, x: {step})" if mode == "series" else "NULL"
    sig, smoothed = ("z.s", "CASE WHEN len(z.r) >= 5 THEN list_sum(z.r) / 5 ELSE 0 END") if mode == "series" else ("e12 - e26", "0::DOUBLE")
    le = "e20 > e50 AND price > e20 AND macd < macd_signal AND rsi_smoothed > 50 AND high - e13 > 0 AND low - e13 < 0"
    se = "e6 < e10 AND price < e6 AND macd > macd_signal AND rsi_smoothed < 40"
    lx, sx = "e20 < e50 AND price < e20", "e6 > e10 AND price > e6"
    return f"""WITH {SERIES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) AS place FROM m),
  f AS (SELECT ser.symbol AS symbol, price, high, low, {emas}, {line} AS z FROM ser JOIN ranked ON ranked.sym = ser.symbol WHERE place = 1), q AS (SELECT *, e12 - e26 AS macd, {sig} AS macd_signal, {smoothed} AS rsi_smoothed FROM f)
SELECT symbol, price, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal, round(rsi_smoothed, 6) AS rsi_smoothed, CASE WHEN {le} THEN 1 WHEN {se} THEN -1 WHEN ({lx}) OR ({sx}) THEN 0 ELSE 99 END AS signal,
  CASE WHEN {le} THEN 'long_entry' WHEN {se} THEN 'short_entry' WHEN {lx} THEN 'long_exit' WHEN {sx} THEN 'short_exit' ELSE 'hold' END AS trade_type FROM q{tail}"""


def _signals(spark, folder, mode: str) -> DataFrame:
    f = m.features(_ticks(spark, folder, "high", "low"), mode)
    return _rounded(f.select("symbol", "price", "macd", "macd_signal", "rsi_smoothed", "signal", "trade_type"), "macd", "macd_signal", "rsi_smoothed")


@query(_signals_sql("series"))
def trade_signals(spark, folder):
    return _signals(spark, folder, "series")


@query(_signals_sql("reference"))
def trade_signals_reference(spark, folder):
    return _signals(spark, folder, "reference")


@query("SELECT * FROM (" + _signals_sql("reference") + ") WHERE trade_type <> 'hold'")
def trading_signals_only(spark, folder):
    return _signals(spark, folder, "reference").where(c("trade_type") != "hold")


@query(f"WITH {SERIES}, z AS (SELECT symbol, {ema_sql('v', 12)} - {ema_sql('v', 26)} AS x FROM ser) SELECT symbol, round(x, 6) AS macd, round(x * 0.9, 6) AS macd_signal, round(x - x * 0.9, 6) AS macd_histogram, CASE WHEN x > x * 0.9 * 1.05 THEN 'BUY' WHEN x < x * 0.9 * 0.95 THEN 'SELL' ELSE 'HOLD' END AS action FROM z")
def macd_action(spark, folder):
    s = m.tick_pieces(_ticks(spark, folder), 12, 26).select("symbol", (ind.long_ema(c("series"), 12) - ind.long_ema(c("series"), 26)).alias("macd"))
    line, rest, action = m.action_of(c("macd"))
    return _rounded(s.select("symbol", "macd", line.alias("macd_signal"), rest.alias("macd_histogram"), action.alias("action")), "macd", "macd_signal", "macd_histogram")


_LINE = f"list_reduce(list_transform(v, lambda p: {{'a': p, 'b': p, 's': 0::DOUBLE}}), lambda s, x: {{'a': x.a * (2::DOUBLE / 13) + s.a * (1 - 2::DOUBLE / 13), 'b': x.a * (2::DOUBLE / 27) + s.b * (1 - 2::DOUBLE / 27), 's': ((x.a * (2::DOUBLE / 13) + s.a * (1 - 2::DOUBLE / 13)) - (x.a * (2::DOUBLE / 27) + s.b * (1 - 2::DOUBLE / 27))) * 0.2::DOUBLE + s.s * 0.8::DOUBLE}})"


@query(f"""WITH {SERIES}, z AS (SELECT symbol, {_LINE} AS z, CASE WHEN len(v) > 1 THEN {ema_sql('v[:-2]', 12)} - {ema_sql('v[:-2]', 26)} END AS y FROM ser), q AS (SELECT symbol, z.a - z.b AS x, y, z.s AS line FROM z)
SELECT symbol, round(x, 6) AS macd, round(line, 6) AS macd_signal, round(y, 6) AS macd_before, CASE WHEN x > line AND y <= line THEN 'BUY' WHEN x < line AND y >= line THEN 'SELL' ELSE 'HOLD' END AS action FROM q""")
def macd_crossover(spark, folder):
    """The action of MACD crossing its signal line, EMA-9 of the series of MACD."""
    s = m.tick_pieces(_ticks(spark, folder), 12, 26, signal=True).select("symbol", ind.signal_series(c("series")).alias("s")).select("symbol", "s.macd", "s.macd_signal", "s.macd_before")
    return _rounded(s.withColumn("action", m.crossover(c("macd"), c("macd_signal"), c("macd_before"))), "macd", "macd_signal", "macd_before")


_START = "{'a': p, 'b': p, 'p': p, 'cash': 10000::DOUBLE, 'pos': 0::DOUBLE, 'st': 0, 'n': 0, 'log': ['']}"


def _portfolio_sql() -> str:
    a, b = "(x.p * (2::DOUBLE / 13) + s.a * (1 - 2::DOUBLE / 13))", "(x.p * (2::DOUBLE / 27) + s.b * (1 - 2::DOUBLE / 27))"
    now = f"(CASE WHEN {a} > {b} THEN 1 WHEN {a} < {b} THEN -1 ELSE 0 END)"
    buy, sell = f"(s.st = -1 AND {now} = 1 AND s.cash > 0 AND x.p > 0)", f"(s.st = 1 AND {now} = -1 AND s.pos > 0)"
    log = f"list_concat(s.log, CASE WHEN {buy} THEN [printf('BUY@%.2f', x.p)] WHEN {sell} THEN [printf('SELL@%.2f', x.p)] ELSE [] END)"
    step = f"{{'a': {a}, 'b': {b}, 'p': x.p, 'cash': CASE WHEN {buy} THEN 0 WHEN {sell} THEN s.pos * x.p ELSE s.cash END, 'pos': CASE WHEN {buy} THEN s.cash / x.p WHEN {sell} THEN 0 ELSE s.pos END, 'st': CASE WHEN {now} = 0 THEN s.st ELSE {now} END, 'n': s.n + CASE WHEN {buy} OR {sell} THEN 1 ELSE 0 END, 'log': {log}}}"
    return f"""WITH {BAR_SERIES}, r AS (SELECT symbol, v[-1] AS last, list_reduce(list_transform(v, lambda p: {_START}), lambda s, x: {step}) AS z FROM ser),
  portfolio AS (SELECT symbol, last AS current_price, z.cash AS cash, z.pos AS position, z.n AS total_trades, z.log[2:] AS logs, z.cash + z.pos * last AS value FROM r)"""


_VALUES = "symbol, current_price, round(cash, 6) AS cash, round(position, 6) AS position, total_trades, array_to_string(logs[-10:], ';') AS trade_log, round(value, 6) AS portfolio_value, round(value - 10000, 6) AS pnl, round((value - 10000) / 10000 * 100, 6) AS pnl_percentage, CASE WHEN value = 10000 THEN 0 ELSE round((value - 10000) / 10000 * 252 / 0.16, 4) END AS sharpe_ratio"


def _portfolio(spark, folder, mode: str) -> DataFrame:
    return _rounded(m.portfolio(m.daily_bars(_ticks(spark, folder)), mode), "cash", "position", "portfolio_value", "pnl", "pnl_percentage")


@query(_portfolio_sql() + f" SELECT {_VALUES} FROM portfolio")
def portfolio_series(spark, folder):
    return _portfolio(spark, folder, "series")


@query(f"WITH {BARS} SELECT symbol, arg_max(close, start) AS current_price, 10000.0::DOUBLE AS cash, 0.0::DOUBLE AS position, 0 AS total_trades, '' AS trade_log, 10000.0::DOUBLE AS portfolio_value, 0.0::DOUBLE AS pnl, 0.0::DOUBLE AS pnl_percentage, 0.0::DOUBLE AS sharpe_ratio FROM bars GROUP BY 1")
def portfolio_reference(spark, folder):
    return _portfolio(spark, folder, "reference")


@query(_portfolio_sql() + " SELECT symbol, round(current_price, 2) AS current_price, round(value, 2) AS portfolio_value, round(value - 10000, 2) AS pnl, total_trades FROM portfolio")
def trading_all_latest(spark, folder):
    p = m.portfolio(m.daily_bars(_ticks(spark, folder)))
    return p.select("symbol", *(F.round(x, 2).alias(x) for x in ("current_price", "portfolio_value", "pnl")), "total_trades")


@query(_portfolio_sql() + " SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY seen) - 1 AS INTEGER) AS place, split_part(t, '@', 1) AS action, CAST(split_part(t, '@', 2) AS DOUBLE) AS price FROM (SELECT symbol, t, min(i) AS seen FROM (SELECT symbol, unnest(logs[-10:]) AS t, generate_subscripts(logs[-10:], 1) AS i FROM portfolio) GROUP BY 1, 2)")
def trading_history(spark, folder):
    return sv.trading_history(m.portfolio(m.daily_bars(_ticks(spark, folder))))


@query(f"WITH {BARS} SELECT symbol, max(start) AS timestamp FROM bars GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
def serve_features(spark, folder):
    return sv.features(_serving(spark, folder)[1]).select("symbol", "timestamp")


@query(f"WITH {LAST} SELECT sym AS symbol, price, change FROM last WHERE sym = 'WIFUQ'")
def serve_symbol(spark, folder):
    return sv.symbol_row(m.changes(_ticks(spark, folder)), "wifuq").select("symbol", "price", "change")


@query(f"""WITH {BARS}, r AS (SELECT symbol, (close - lag(close) OVER w) / lag(close) OVER w AS r FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY start)), z AS (SELECT symbol, avg(r) AS m, stddev_pop(r) AS s, count(r) AS n FROM r GROUP BY 1)
SELECT symbol, CASE WHEN n < 2 THEN 0 ELSE round((m * 252 - 0.02) / (CASE WHEN s = 0 THEN 0.001 ELSE s END * sqrt(252)), 4) END AS sharpe_ratio FROM z""")
def sharpe_by_symbol(spark, folder):
    return m.sharpe(m.daily_bars(_ticks(spark, folder)))


@query(f"""WITH {BARS} SELECT DISTINCT symbol FROM (SELECT symbol FROM bars UNION ALL SELECT DISTINCT upper(trim(symbol)) FROM rolling_features WHERE symbol IS NOT NULL) ORDER BY 1""")
def trading_symbols(spark, folder):
    stats_ = _ticks(spark, folder).select("symbol")
    feats = table(spark, folder, "rolling_features").where(c("symbol").isNotNull()).select(F.upper(F.trim("symbol")).alias("symbol"))
    return stats_.union(feats).distinct().orderBy("symbol")


@query()
def live_nested(spark, folder):
    """Nested latest rows; structs have no plain SQL form here."""
    f = m.features(_ticks(spark, folder, "high", "low"), "series")
    zero = lambda x: F.coalesce(F.nanvl(c(x), F.lit(0.0)), F.lit(0.0)).alias(x)
    return f.select("symbol", c("event_ms").alias("timestamp"), F.struct(zero("price"), zero("high"), zero("low")).alias("ohlcv"), F.struct(*(zero(f"ema_{n}") for n in _EMAS), zero("rsi"), zero("macd")).alias("indicators"), F.coalesce("trade_type", F.lit("HOLD")).alias("signal"))


@query(f"WITH {TICKS} SELECT et AS timestamp, sym AS symbol, price, volume, CAST(round(CAST(CAST(price AS VARCHAR) AS DECIMAL(28,12)) * 0.9995, 2) AS DOUBLE) AS bid, CAST(round(CAST(CAST(price AS VARCHAR) AS DECIMAL(28,12)) * 1.0005, 2) AS DOUBLE) AS ask, CAST(md5_number(sym) % 3 AS INTEGER) AS partition FROM m")
def quote_stock(spark, folder):
    return m.quotes(_ticks(spark, folder), "stock")


@query(f"WITH {TICKS} SELECT et AS timestamp, sym AS symbol, price, volume, strftime(make_timestamp(et * 1000), '%Y-%m') AS contract_month FROM m")
def quote_commodity(spark, folder):
    return m.quotes(_ticks(spark, folder), "commodity")


@query(f"WITH {TICKS} SELECT et AS timestamp, regexp_replace(sym, '=X$', '') AS pair, round(price, 5) AS rate, volume FROM m")
def quote_forex(spark, folder):
    return m.quotes(_ticks(spark, folder), "forex")


@query(f"WITH {TICKS} SELECT et AS timestamp, regexp_replace(sym, '-USD$', '') AS symbol, price, volume FROM m")
def quote_crypto(spark, folder):
    return m.quotes(_ticks(spark, folder), "crypto")


def _serving(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Daily bars and the latest features of each symbol, as the serving functions take them."""
    ticks = _ticks(spark, folder, "high", "low")
    bars = m.daily_bars(ticks).withColumnRenamed("start", "timestamp")
    feats = m.features(ticks, "reference").withColumn("timestamp", c("event_ms") - F.pmod(c("event_ms"), F.lit(86_400_000).cast("bigint"))).drop("high", "low", "price", "event_ms")
    return bars, feats


@query(f"WITH {BARS} SELECT symbol, start AS timestamp, close FROM bars WHERE symbol = 'WIFUQ' AND start >= 1757900000000 ORDER BY start DESC, symbol LIMIT 20")
def serve_ohlcv(spark, folder):
    return sv.ohlcv(_serving(spark, folder)[0], "wifuq", 1757900000000, 0, 20).select("symbol", "timestamp", "close")


@query(f"WITH {BARS} SELECT symbol, start AS timestamp, close FROM bars WHERE symbol = 'WIFUQ' ORDER BY start DESC LIMIT 1")
def serve_latest(spark, folder):
    return sv.latest(*_serving(spark, folder), "wifuq").select("symbol", "timestamp", "close")


@query(f"WITH {BARS} SELECT count(*) AS bars, count(DISTINCT symbol) AS symbols, max(start) AS latest, count(DISTINCT symbol) AS features FROM bars")
def serve_stats(spark, folder):
    return sv.stats(*_serving(spark, folder))


@query(f"WITH {LAST} SELECT sym AS symbol, price, CAST(row_number() OVER (ORDER BY coalesce(price, 0) DESC, sym) AS INTEGER) AS rank FROM last WHERE NOT regexp_matches(sym, '{'|'.join(sv.CRYPTO)}') QUALIFY rank <= 10")
def serve_leaderboard(spark, folder):
    return sv.leaderboard(m.changes(_ticks(spark, folder)), "stocks", "price", 10).select("symbol", "price", "rank")


@query(f"WITH {LAST} SELECT * FROM (SELECT 'gainer' AS side, sym AS symbol, change_percent, CAST(row_number() OVER (ORDER BY change_percent DESC, sym) AS INTEGER) AS place FROM last) WHERE place <= 5 UNION ALL SELECT * FROM (SELECT 'loser', sym, change_percent, CAST(row_number() OVER (ORDER BY change_percent, sym) AS INTEGER) AS place FROM last) WHERE place <= 5")
def serve_top_movers(spark, folder):
    return sv.top_movers(m.changes(_ticks(spark, folder)), 5).select("side", "symbol", "change_percent", "place")


@query(f"WITH {LAST} SELECT sym AS symbol, price FROM last WHERE contains(sym, 'QU') ORDER BY sym LIMIT 20")
def serve_search(spark, folder):
    return sv.search(m.changes(_ticks(spark, folder)), "qu").select("symbol", "price")


@query()
def serve_live(spark, folder):
    """Nested rows; structs have no plain SQL form here."""
    return sv.live(*_serving(spark, folder), "wifuq")


@query(_portfolio_sql() + " SELECT symbol, round(cash, 6) AS cash, round(position, 6) AS position, round(value, 6) AS portfolio_value, total_trades FROM portfolio WHERE symbol = 'WIFUQ'")
def serve_trading_stats(spark, folder):
    bars = m.daily_bars(_ticks(spark, folder))
    values = bars.select("symbol", c("start").alias("timestamp"), c("close").alias("portfolio_value"))
    return _rounded(sv.trading_stats(m.portfolio(bars), values, "wifuq").select("symbol", "cash", "position", "portfolio_value", "total_trades"), "cash", "position", "portfolio_value")


@query(f"""WITH {BARS}, v AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY start), 10000) AS before, row_number() OVER (PARTITION BY symbol ORDER BY start) AS n FROM bars), z AS (SELECT symbol, avg((close - before) / before) AS m, stddev_pop((close - before) / before) AS s, count(*) AS k FROM v WHERE n <= 100 GROUP BY 1)
SELECT symbol, CASE WHEN k < 2 THEN 0 ELSE round((m * 252 - 0.02) / (CASE WHEN s = 0 THEN 0.001 ELSE s END * sqrt(252)), 4) END AS sharpe_ratio FROM z""")
def sharpe_of_values(spark, folder):
    bars = m.daily_bars(_ticks(spark, folder))
    return sv.sharpe_of_values(bars.select("symbol", c("start").alias("timestamp"), c("close").alias("portfolio_value")))


@query(f"WITH {USABLE} SELECT tick_id, round(CASE WHEN price IS NULL OR isnan(price) THEN 0 ELSE price END, 6) AS price, round(CASE WHEN high IS NULL OR isnan(high) THEN 0 ELSE high END, 6) AS high FROM usable")
def sanitise_numbers(spark, folder):
    return sv.sanitise(usable_ticks(table(spark, folder, "ticks"), "price", "high", symbol=False).select("tick_id", "price", "high", c("time").alias("_time")))


@query(f"WITH {TICKS}, l AS (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY et DESC, tick_id DESC) AS r FROM m WHERE partition IS NOT NULL) SELECT sym AS symbol, tick_id FROM l WHERE r <= 100 QUALIFY row_number() OVER (PARTITION BY sym ORDER BY et DESC, tick_id DESC) = 1")
def jsonl_tail(spark, folder):
    """Shards are partitions, lines are ticks in order of event time."""
    t = _ticks(spark, folder, "partition").where(c("partition").isNotNull())
    order = F.struct("event_ms", "tick_id")
    lines = t.select(c("partition").alias("shard"), order.alias("line_no"), "symbol", order.alias("timestamp"), "tick_id")
    return sv.json_tail(lines).select("symbol", "tick_id")


_HIST = f"""{TICKS}, h AS (SELECT sym AS symbol, CAST(floor(price / 0.5) AS BIGINT) AS bin, count(*) FILTER (et < 1760000000000) AS a, count(*) FILTER (et >= 1760000000000) AS b FROM m GROUP BY 1, 2),
  w AS (SELECT *, sum(a) OVER r AS ca, sum(b) OVER r AS cb, sum(a) OVER k AS na, sum(b) OVER k AS nb, count(*) OVER k AS k FROM h WINDOW r AS (PARTITION BY symbol ORDER BY bin ROWS UNBOUNDED PRECEDING), k AS (PARTITION BY symbol))"""


@query(f"""WITH {_HIST} SELECT symbol, CAST(max(na) AS BIGINT) AS n_a, CAST(max(nb) AS BIGINT) AS n_b, round(max(CASE WHEN na > 0 AND nb > 0 THEN abs(ca / na - cb / nb) END), 6) AS ks,
  round(sum(CASE WHEN na > 0 AND nb > 0 THEN (b + 1) / (nb + k) * ln(((b + 1) / (nb + k)) / ((a + 1) / (na + k))) END), 6) AS kl FROM w GROUP BY 1""")
def drift_ks_kl(spark, folder):
    """Drift of each symbol's prices after an instant against those before."""
    rows = _ticks(spark, folder).withColumn("later", c("event_ms") >= 1760000000000)
    return _rounded(dr.drift(dr.histograms(rows, "symbol", "price", "later", 0.5), "symbol"), "ks", "kl")

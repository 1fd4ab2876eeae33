"""Queries that run as streams over the stored tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import clean_symbol, event_ms
from tideglass.plans.registry import registry
from tideglass.session import shared_folder
from tideglass.sources.market import replay_steps, table_stream
from tideglass.sources.tables import table
from tideglass.streaming import sinks, stateful

c = F.col
QUERIES, ORACLE, query = registry()

RAW = """WITH r AS (SELECT *, upper(trim(symbol)) AS sym, CASE WHEN timestamp BETWEEN 1000000000 AND 9999999999 THEN timestamp * 1000 WHEN timestamp BETWEEN 1000000000000 AND 9999999999999 THEN timestamp
    WHEN timestamp BETWEEN 1000000000000000 AND 9999999999999999 THEN timestamp // 1000 WHEN timestamp >= 1000000000000000000 THEN timestamp // 1000000 END AS et FROM ticks),
  m AS (SELECT * FROM r WHERE et <= time AND sym <> '' AND price IS NOT NULL AND NOT isnan(price))"""



#: Batches that the queries of this module replay the table in.
STEPS = 12


def _stream(spark, folder) -> DataFrame:
    """All deliveries of ticks with a usable time, a symbol and a price, in STEPS batches in order of arrival."""
    path = f"{shared_folder(spark)}/tideglass/arrivals-{uuid.uuid4().hex}"
    t = table(spark, folder, "ticks")
    replay_steps(t, "time", f"{path}/ticks.parquet", STEPS)
    t = table_stream(spark, path, "ticks", t.schema, 1)
    t = t.withColumn("symbol", clean_symbol(c("symbol"))).withColumn("event_ms", event_ms(c("timestamp")))
    return t.where((c("event_ms") <= c("time")) & c("symbol").isNotNull() & c("price").isNotNull() & ~F.isnan("price"))


def _last(rows: DataFrame, key: str) -> DataFrame:
    back = Window.partitionBy(key).orderBy(F.desc("batch"))
    return rows.withColumn("__r", F.row_number().over(back)).where(c("__r") == 1).drop("__r", "batch")


@query(f"{RAW} SELECT sym AS symbol, count(*) AS count, max(price) AS max_price, min(price) AS min_price, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume FROM m GROUP BY 1")
def stream_stats(spark, folder):
    stats = _stream(spark, folder).groupBy("symbol").agg(F.count(F.lit(1)).alias("count"), F.max("price").alias("max_price"), F.min("price").alias("min_price"), F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"))
    return _last(sinks.to_table(stats), "symbol")


@query(f"{RAW} SELECT sym AS symbol, count(*) AS count, round(avg(price), 6) AS avg_price, max(price) AS max_price, min(price) AS min_price, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume FROM m GROUP BY 1")
def stream_changelog(spark, folder):
    """What stands after all changes."""
    rows = sinks.to_table(stateful.stats_changelog(_stream(spark, folder).select("symbol", "price", "volume")))
    key = ["symbol", "count", "avg_price", "max_price", "min_price", "total_volume"]
    return rows.groupBy(*key).agg(F.sum("diff").alias("standing")).where(c("standing") > 0).select(*key)


@query(f"""{RAW}, w AS (SELECT sym AS symbol, unnest(generate_series(et - et % 60000 - 240000, et - et % 60000, 60000)) AS window_start, volume FROM m)
SELECT symbol, window_start, CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume, count(*) AS count FROM w WHERE window_start + 300000 <= (SELECT max(et) FROM m) - 21600000 GROUP BY 1, 2""")
def stream_sliding(spark, folder):
    """Windows that the watermark has passed; it waits for longer than any feed here holds rows back."""
    at = _stream(spark, folder).withColumn("at", F.timestamp_millis("event_ms")).withWatermark("at", "6 hours")
    w = at.groupBy("symbol", F.window("at", "5 minutes", "1 minute")).agg(F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"), F.count(F.lit(1)).alias("count"))
    return sinks.to_table(w.select("symbol", F.unix_millis("window.start").alias("window_start"), "total_volume", "count"), "append").drop("batch")


#: Rows by the mark of their key: the greatest event time among rows that came strictly earlier.
MARKED = f"""{RAW}, k AS (SELECT *, max(et) OVER (PARTITION BY {{key}} ORDER BY time RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM m WHERE {{key}} IS NOT NULL)"""
_EMA = "round(list_reduce(v, lambda e, p: p * (2::DOUBLE / {a}) + e * (1 - 2::DOUBLE / {a})), 6)"


@query(f"{MARKED.format(key='sym')}, s AS (SELECT sym AS symbol, list(price ORDER BY et, tick_id, price) AS v FROM k WHERE mark IS NULL OR et >= mark - 900000 GROUP BY 1) SELECT symbol, {_EMA.format(a=13)} AS ema_12, {_EMA.format(a=27)} AS ema_26 FROM s")
def stream_ema(spark, folder):
    rows = _last(sinks.to_table(stateful.stream_ema(_stream(spark, folder).select("symbol", "time", "event_ms", "tick_id", "price"))), "symbol")
    return rows.withColumns({x: F.round(x, 6) for x in ("ema_12", "ema_26")})


@query(f"{RAW} SELECT sym AS symbol, et // 86400000 AS day, arg_max(price, (et, tick_id)) AS price FROM m GROUP BY 1, 2")
def stream_upsert(spark, folder):
    """The latest price of each symbol and day, by upserts."""
    out = sinks.UpsertTable(spark, f"{shared_folder(spark)}/tideglass/upsert-{uuid.uuid4().hex}", ["symbol", "day"], "at")
    place = F.struct("event_ms", "tick_id")

    def sink(rows: DataFrame, batch: int) -> None:
        day = F.call_function("div", c("event_ms"), F.lit(86_400_000).cast("bigint")).alias("day")
        out(rows.groupBy("symbol", day).agg(F.max_by("price", place).alias("price"), F.max(place).alias("at")), batch)

    sinks.run_available(_stream(spark, folder).select("symbol", "event_ms", "tick_id", "price"), sink, "append")
    return out.read().select("symbol", "day", "price")


@query(f"""{MARKED.format(key='partition')}, j AS (SELECT *, et - et % 300000 AS p, CASE WHEN et - et % 300000 + 300000 <= mark AND et < mark - 900000 THEN 1 ELSE 0 END AS late FROM k)
SELECT partition, p AS period_start, count(*) FILTER (late = 0) AS count, arg_min(price, (et, tick_id, price)) FILTER (late = 0) AS first, arg_max(price, (et, tick_id, price)) FILTER (late = 0) AS last,
  max(price) FILTER (late = 0) AS high, min(price) FILTER (late = 0) AS low, CASE WHEN count(*) FILTER (late = 0) > 0 THEN CAST(coalesce(sum(volume) FILTER (late = 0), 0) AS BIGINT) END AS volume, sum(late)::BIGINT AS too_late FROM j GROUP BY 1, 2""")
def stream_k_slack_periods(spark, folder):
    """What the K-slack machine has published in the end: each period's final row, and how many rows came too late for it."""
    place = sinks.checkpoint_folder(spark)
    stream = stateful.k_slack_stream(_stream(spark, folder).select("partition", "time", "event_ms", "tick_id", "price", "volume"))
    rows = sinks.to_table(stream, checkpoint=place).drop("batch").unionByName(stateful.open_periods(spark, place))
    one = lambda x: F.max(F.when(c("kind") == "final", c(x))).alias(x)
    late = F.coalesce(F.sum(F.when(c("kind") == "too_late", c("count"))), F.lit(0)).alias("too_late")
    out = rows.groupBy("partition", "period_start").agg(F.coalesce(F.sum(F.when(c("kind") == "final", c("count"))), F.lit(0)).alias("count"), *map(one, ("first", "last", "high", "low", "volume")), late)
    return out.withColumn("volume", F.coalesce("volume", F.when(c("count") > 0, F.lit(0))))


@query(f"""{MARKED.format(key='partition')}, j AS (SELECT *, et - et % 300000 AS p FROM k WHERE mark IS NULL OR et - et % 300000 + 300000 > mark OR et >= mark - 900000), e AS (SELECT partition, max(et) AS top, max(et) FILTER (time < latest) AS settled FROM (SELECT *, max(time) OVER (PARTITION BY partition) AS latest FROM m) GROUP BY 1)
SELECT DISTINCT partition, p AS period_start FROM j JOIN e USING (partition) WHERE p + 300000 <= top AND (settled IS NULL OR p + 300000 > settled - 900000)""")
def stream_k_slack_open(spark, folder):
    """The periods that have ended but aren't final when the stream ends: each was published provisionally before."""
    place = sinks.checkpoint_folder(spark)
    stream = stateful.k_slack_stream(_stream(spark, folder).select("partition", "time", "event_ms", "tick_id", "price", "volume"))
    rows = sinks.to_table(stream, checkpoint=place)
    last = rows.groupBy("partition", "period_start").agg(F.count_if(c("kind") == "final").alias("finals"), F.count_if(c("kind") == "provisional").alias("versions"))
    return last.where((c("finals") == 0) & (c("versions") > 0)).select("partition", "period_start")


@query("SELECT symbol AS key, CAST(md5_number(symbol) % 3 AS INTEGER) AS partition, count(*) AS messages FROM ticks WHERE symbol IS NOT NULL GROUP BY 1, 2")
def kafka_rows(spark, folder):
    """Messages as the Kafka sink takes them, counted."""
    sent = sinks.kafka_rows(table(spark, folder, "ticks").where(c("symbol").isNotNull()).select("symbol", "price"), "stocks")
    return sent.groupBy("key", "partition").agg(F.count("value").alias("messages"))

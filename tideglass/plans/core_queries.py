"""Queries of the core's training-data operators (problems 1 to 5 and 7) and the SQL that they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions.timeparse import read_time
from tideglass.operators import flatten, grid, lateness, outliers, trailing, zones
from tideglass.operators.ticks import usable_ticks
from tideglass.plans.registry import Query
from tideglass.session import materialise
from tideglass.sources.tables import table


def p1_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every period of every symbol and day, missing ones filled."""
    ticks = usable_ticks(table(spark, folder, "ticks"), "price")
    return grid.regular_grid(ticks, "symbol", "event_ms", "price")


def p1_series(spark: SparkSession, folder: str) -> DataFrame:
    """What of the grid doesn't rest on the regression: which periods there are, and what was observed in them."""
    return p1_grid(spark, folder).where(F.col("is_missing") | (F.col("filled") == F.col("observed"))).drop("filled").withColumn("observed", F.round("observed", 6))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The missing periods; each has been filled."""
    return p1_grid(spark, folder).where(F.col("is_missing") & F.col("filled").isNotNull()).select("symbol", "period_start")


def _quoted(spark: SparkSession, folder: str) -> DataFrame:
    """The usable ticks with prices, quotes and volumes, written out: several branches use them."""
    ticks = usable_ticks(table(spark, folder, "ticks"), "price", "volume", "bid", "ask").drop("time")
    return materialise(ticks, "quoted-ticks")


def p2_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable tick with its flags."""
    return outliers.flag_ticks(_quoted(spark, folder))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.flagged_ticks(_quoted(spark, folder)).select("tick_id")


def _released(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    ticks = usable_ticks(table(spark, folder, "ticks"), "partition", *columns, symbol=False)
    ticks = ticks.where(F.col("partition").isNotNull())
    return lateness.k_slack(materialise(ticks, "arrived-ticks"), "partition", "event_ms", "time")


def p3_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Provisional and final aggregates of each partition and period."""
    return lateness.period_aggregates(_released(spark, folder, "price", "volume"), "partition", "event_ms", "price", "volume", "tick_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _released(spark, folder).where(F.col("outcome") != "on_time").select("tick_id", "outcome")


def _filing_tables(spark: SparkSession, folder: str, several: bool = False) -> dict[str, DataFrame]:
    return flatten.filing_tables(table(spark, folder, "form4"), table(spark, folder, "form4_raw"), several)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    transactions = _filing_tables(spark, folder)["transactions"]
    return zones.rewritten(table(spark, folder, "news"), table(spark, folder, "news_sources"), table(spark, folder, "ticks"), transactions)


def p4_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The zone of each source, estimated without looking at what is declared."""
    c = F.col
    known = table(spark, folder, "news_sources").select("source", "date_order")
    read = table(spark, folder, "news").join(known, "source").withColumn("read", read_time(c("published_at"), c("date_order")))
    bare = read.where(c("read.zone").isNull()).select("source", c("read.local").alias("local"), "time", F.lit(None).cast("string").alias("declared"))
    return zones.estimate_zones(bare, "source", "local", "time", "declared")


def p5_trailing(spark: SparkSession, folder: str) -> DataFrame:
    """Totals and averages of the trailing 7 and 30 days of each symbol and day."""
    return trailing.trailing_days(trailing.live_windows(table(spark, folder, "rolling_features")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_trailing(spark, folder).where((F.col("volume_7d") == 0) & (F.col("volume_30d") != 0)).select("symbol", "day_utc")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.children(_filing_tables(spark, folder, several=True))


def p7_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of transactions, with its key and position."""
    return _filing_tables(spark, folder)["transactions"]


def p7_filings(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of filings, persons and addresses inlined."""
    return _filing_tables(spark, folder)["filing"]


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_series, p1_grid, p2_found, p2_flags, p3_found, p3_periods, p4_found, p4_zones, p5_found, p5_trailing, p7_found, p7_transactions, p7_filings)}

USABLE = """
  usable AS (
    SELECT *, nullif(upper(trim(symbol)), '') AS sym FROM (
      SELECT *, CASE WHEN timestamp BETWEEN 1000000000 AND 9999999999 THEN timestamp * 1000
                     WHEN timestamp BETWEEN 1000000000000 AND 9999999999999 THEN timestamp
                     WHEN timestamp BETWEEN 1000000000000000 AND 9999999999999999 THEN timestamp // 1000
                     WHEN timestamp >= 1000000000000000000 THEN timestamp // 1000000 END AS et
      FROM ticks QUALIFY row_number() OVER (PARTITION BY tick_id ORDER BY time) = 1)
    WHERE et <= time)"""


def _level(name: str) -> str:
    """The spikes of one column: the two measures of departure against the day's exact median move."""
    return f"""
  v_{name} AS (SELECT tick_id, sym, et // 86400000 AS day, {name} AS v, row_number() OVER w AS i, count(*) OVER (PARTITION BY sym, et // 86400000) AS n,
      abs({name} - lag({name}) OVER w) AS move,
      median({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS before,
      median({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS after,
      median({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS before5,
      median({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS after5,
      min({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS lo3,
      max({name}) OVER (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS hi3
    FROM usable WHERE {name} IS NOT NULL AND NOT isnan({name}) AND sym IS NOT NULL WINDOW w AS (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id)),
  w_{name} AS (SELECT *, max(lo3) OVER x AS opened, min(hi3) OVER x AS closed,
      max(v) OVER (PARTITION BY sym, day ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS hi_end, min(v) OVER (PARTITION BY sym, day ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS lo_end,
      min(v) OVER (PARTITION BY sym, day ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lo_rest, max(v) OVER (PARTITION BY sym, day ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi_rest
    FROM v_{name} WINDOW x AS (PARTITION BY sym, day ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
  s_{name} AS (SELECT tick_id FROM w_{name} JOIN (SELECT sym, day, median(move) AS m FROM v_{name} GROUP BY 1, 2) USING (sym, day)
    WHERE i > 1 AND i < n AND m > 0 AND greatest(
      least(greatest(least(v - before, v - after), least(v - before5, v - after5)), v - greatest(opened, CASE WHEN n - i < 3 THEN lo_rest ELSE opened END)),
      least(greatest(least(before - v, after - v), least(before5 - v, after5 - v)), least(closed, CASE WHEN n - i < 3 THEN hi_rest ELSE closed END) - v)) > 20 * m)"""


def _stuck(name: str, same: str, known: str) -> str:
    return f"""
  r_{name} AS (SELECT tick_id, sym, day, same, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY sym, day ORDER BY et, tick_id) AS run FROM (
    SELECT tick_id, sym, et, et // 86400000 AS day, coalesce({same}, false) AS same FROM usable WHERE {known} AND sym IS NOT NULL WINDOW w AS (PARTITION BY sym, et // 86400000 ORDER BY et, tick_id))),
  k_{name} AS (SELECT tick_id FROM (SELECT *, count(*) OVER (PARTITION BY sym, day, run) AS n FROM r_{name}) WHERE same AND n >= 12)"""


_KNOWN = "bid IS NOT NULL AND NOT isnan(bid) AND ask IS NOT NULL AND NOT isnan(ask)"
_MARKED = f"""{USABLE},
  marked AS (SELECT *, max(et) OVER (PARTITION BY partition ORDER BY time RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM usable WHERE partition IS NOT NULL),
  judged AS (SELECT *, et - et % 300000 AS period_start, CASE WHEN et - et % 300000 + 300000 <= mark THEN CASE WHEN et < mark - 900000 THEN 'too_late' ELSE 'corrects' END ELSE 'on_time' END AS outcome FROM marked)"""

_GOOD = "price IS NOT NULL AND NOT isnan(price)"

_LIVE = """
  live AS (SELECT upper(trim(symbol)) AS symbol, window_start, sum(diff * coalesce(total_volume, 0)) AS volume,
      CASE WHEN sum(diff) FILTER (avg_price IS NOT NULL AND NOT isnan(avg_price)) = 1 THEN sum(diff * CAST(avg_price AS DECIMAL(20,8))) FILTER (avg_price IS NOT NULL AND NOT isnan(avg_price)) END AS price
    FROM (SELECT DISTINCT * FROM rolling_features) WHERE trim(symbol) <> '' AND window_start IS NOT NULL GROUP BY 1, 2 HAVING sum(diff) = 1),
  daily AS (SELECT symbol, CAST(floor(epoch(window_start) / 86400) AS BIGINT) AS day, sum(volume) AS volume, count(*) AS n_windows, sum(price) AS prices, count(price) AS n_prices FROM live GROUP BY 1, 2),
  days AS (SELECT symbol, unnest(generate_series(min(day), max(day))) AS day FROM daily GROUP BY 1),
  dense AS (SELECT symbol, day, coalesce(volume, 0) AS volume, coalesce(n_windows, 0) AS n_windows, coalesce(prices, 0) AS prices, coalesce(n_prices, 0) AS n_prices FROM days LEFT JOIN daily USING (symbol, day)),
  rolled AS (SELECT *, strftime(DATE '1970-01-01' + CAST(day AS INTEGER), '%Y-%m-%d') AS day_utc,
      sum(volume) OVER w7 AS v7, sum(volume) OVER w30 AS v30, count(*) OVER w7 AS d7, count(*) OVER w30 AS d30, sum(prices) OVER w7 AS p7, sum(prices) OVER w30 AS p30, sum(n_prices) OVER w7 AS n7, sum(n_prices) OVER w30 AS n30
    FROM dense WINDOW w7 AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""


_FLAGS = f"""{USABLE}, {", ".join(_level(x) for x in ("price", "bid", "ask"))},
  {_stuck("price", "price = lag(price) OVER w", _GOOD)}, {_stuck("quote", "bid = lag(bid) OVER w AND ask = lag(ask) OVER w", _KNOWN)},
  volumes AS (SELECT sym, median(volume) AS m FROM usable GROUP BY 1), volume_spikes AS (SELECT tick_id FROM usable JOIN volumes USING (sym) WHERE volume > 100 * m),
  impossible AS (SELECT tick_id FROM usable WHERE sym IS NOT NULL AND ((price <= 0 AND NOT isnan(price)) OR (bid <= 0 AND NOT isnan(bid)) OR (ask <= 0 AND NOT isnan(ask)) OR volume < 0 OR (bid > ask AND NOT isnan(bid))))"""


def _raw_kind(kind: str) -> str:
    return f"""
    SELECT source_file, '{kind}' AS child_kind, CAST(pos AS INTEGER) AS child_pos FROM (
      SELECT source_file, e, generate_subscripts(e, 1) - 1 AS pos, unnest(e) AS x FROM (
        SELECT source_file, CASE json_type(p, '$.{kind}') WHEN 'ARRAY' THEN CAST(json_extract(p, '$.{kind}') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(p, '$.{kind}')] ELSE [] END AS e FROM raw))
    WHERE json_type(x) <> 'NULL'"""


def _own_kind(kind: str) -> str:
    return f"""
    SELECT source_file, '{kind}' AS child_kind, CAST(pos AS INTEGER) AS child_pos FROM (
      SELECT source_file, generate_subscripts({kind}, 1) - 1 AS pos, unnest({kind}) AS x FROM own WHERE len({kind}) > 0) WHERE x IS NOT NULL"""


_PERSON = "$.reporting_person.{}"
_RAW_ADDRESS = " OR ".join(f"json_extract_string(p, '$.reporting_person.address.{x}') IS NOT NULL" for x in ("street", "city", "state", "zip"))
_OWN_ADDRESS = " OR ".join(f"reporting_person.address.{x} IS NOT NULL" for x in ("street", "city", "state", "zip"))

ORACLE: dict[str, str] = {
    "p1_found": f"""WITH {USABLE},
  periods AS (SELECT DISTINCT sym AS symbol, et - et % 300000 AS p FROM usable WHERE {_GOOD} AND sym IS NOT NULL),
  spans AS (SELECT symbol, min(p) AS a, max(p) AS b FROM periods GROUP BY symbol, p // 86400000)
SELECT symbol, period_start FROM (SELECT symbol, unnest(generate_series(a, b, 300000)) AS period_start FROM spans) AS g
WHERE NOT EXISTS (SELECT 1 FROM periods AS q WHERE q.symbol = g.symbol AND q.p = g.period_start)""",
    "p1_series": f"""WITH {USABLE},
  periods AS (SELECT sym AS symbol, et - et % 300000 AS p, count(*) AS n, avg(price) AS v FROM usable WHERE {_GOOD} AND sym IS NOT NULL GROUP BY 1, 2),
  grid AS (SELECT symbol, unnest(generate_series(min(p), max(p), 300000)) AS p FROM periods GROUP BY symbol, p // 86400000)
SELECT symbol, strftime(make_timestamp(p * 1000), '%Y-%m-%d') AS day_utc, p AS period_start, coalesce(n, 0) AS n_readings, n IS NULL AS is_missing, round(v, 6) AS observed FROM grid LEFT JOIN periods USING (symbol, p)""",
    "p2_found": f"""WITH {_FLAGS}
SELECT tick_id FROM impossible UNION SELECT tick_id FROM volume_spikes
UNION SELECT tick_id FROM s_price UNION SELECT tick_id FROM s_bid UNION SELECT tick_id FROM s_ask UNION SELECT tick_id FROM k_price UNION SELECT tick_id FROM k_quote""",
    "p2_flags": f"""WITH {_FLAGS}, f AS (SELECT sym AS symbol, tick_id, tick_id IN (SELECT tick_id FROM impossible) AS impossible, tick_id IN (SELECT tick_id FROM k_price UNION ALL SELECT tick_id FROM k_quote) AS stuck,
  tick_id IN (SELECT tick_id FROM s_price) AS spike_price, tick_id IN (SELECT tick_id FROM s_bid) AS spike_bid, tick_id IN (SELECT tick_id FROM s_ask) AS spike_ask, tick_id IN (SELECT tick_id FROM volume_spikes) AS spike_volume FROM usable WHERE sym IS NOT NULL)
SELECT *, impossible OR stuck OR spike_price OR spike_bid OR spike_ask OR spike_volume AS flagged FROM f""",
    "p3_found": f"WITH {_MARKED} SELECT tick_id, outcome FROM judged WHERE outcome <> 'on_time'",
    "p3_periods": f"""WITH {_MARKED}
SELECT partition, period_start, count(*) FILTER (outcome = 'on_time') AS provisional_count,
  arg_min(price, (et, tick_id)) FILTER (outcome = 'on_time' AND {_GOOD}) AS provisional_first, arg_max(price, (et, tick_id)) FILTER (outcome = 'on_time' AND {_GOOD}) AS provisional_last,
  CAST(coalesce(sum(volume) FILTER (outcome = 'on_time'), 0) AS BIGINT) AS provisional_volume,
  count(*) FILTER (outcome = 'corrects') AS corrections, count(*) FILTER (outcome = 'too_late') AS too_late, count(*) FILTER (outcome <> 'too_late') AS final_count,
  arg_min(price, (et, tick_id)) FILTER (outcome <> 'too_late' AND {_GOOD}) AS final_first, arg_max(price, (et, tick_id)) FILTER (outcome <> 'too_late' AND {_GOOD}) AS final_last,
  max(price) FILTER (outcome <> 'too_late' AND {_GOOD}) AS final_high, min(price) FILTER (outcome <> 'too_late' AND {_GOOD}) AS final_low,
  CAST(coalesce(sum(volume) FILTER (outcome <> 'too_late'), 0) AS BIGINT) AS final_volume
FROM judged GROUP BY partition, period_start""",
    "p4_zones": "SELECT source, CASE zone_name WHEN 'Europe/Paris' THEN 'Europe/Berlin' ELSE zone_name END AS zone_name FROM news_sources WHERE source IN (SELECT source FROM news)",
    "p5_found": f"WITH {_LIVE} SELECT symbol, day_utc FROM rolled WHERE v7 = 0 AND v30 <> 0",
    "p5_trailing": f"""WITH {_LIVE} SELECT symbol, day_utc, CAST(volume AS BIGINT) AS volume, n_windows,
  CAST(v7 AS BIGINT) AS volume_7d, CAST(v7 AS DOUBLE) / d7 AS avg_volume_7d, CASE WHEN n7 > 0 THEN CAST(p7 AS DOUBLE) / n7 END AS avg_price_7d,
  CAST(v30 AS BIGINT) AS volume_30d, CAST(v30 AS DOUBLE) / d30 AS avg_volume_30d, CASE WHEN n30 > 0 THEN CAST(p30 AS DOUBLE) / n30 END AS avg_price_30d FROM rolled""",
    "p7_found": f"""WITH own AS (SELECT *, filing_metadata.source_file AS source_file FROM form4 QUALIFY row_number() OVER (PARTITION BY filing_metadata.source_file ORDER BY parsed_timestamp DESC) = 1),
  raw AS (SELECT *, json_extract_string(p, '$.filing_metadata.source_file') AS source_file FROM (SELECT TRY_CAST(payload AS JSON) AS p FROM form4_raw WHERE json_valid(payload) AND payload LIKE '{{%') QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY CAST(p AS VARCHAR)) = 1),
  more AS (SELECT p, source_file FROM raw WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM own))
SELECT source_file, 'reporting_person' AS child_kind, CAST(0 AS INTEGER) AS child_pos FROM own WHERE reporting_person.name IS NOT NULL OR reporting_person.officer_title IS NOT NULL OR len(list_filter(reporting_person.relationship_to_issuer, lambda x: x IS NOT NULL)) > 0 OR {_OWN_ADDRESS}
UNION ALL SELECT source_file, 'address', CAST(0 AS INTEGER) FROM own WHERE {_OWN_ADDRESS}
UNION ALL {_own_kind("transactions")} UNION ALL {_own_kind("derivative_transactions")}
UNION ALL SELECT source_file, 'reporting_person', CAST(0 AS INTEGER) FROM more WHERE json_extract_string(p, '$.reporting_person.name') IS NOT NULL OR json_extract_string(p, '$.reporting_person.officer_title') IS NOT NULL OR json_extract_string(p, '$.reporting_person.relationship_to_issuer[0]') IS NOT NULL OR json_type(p, '$.reporting_person.relationship_to_issuer') = 'VARCHAR' OR {_RAW_ADDRESS}
UNION ALL SELECT source_file, 'address', CAST(0 AS INTEGER) FROM more WHERE {_RAW_ADDRESS}
UNION ALL {_raw_kind("transactions").replace("FROM raw)", "FROM more)")} UNION ALL {_raw_kind("derivative_transactions").replace("FROM raw)", "FROM more)")}""",
}

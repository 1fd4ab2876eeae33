"""What a tick is: symbol and event time in one form, one row per tick_id, usable or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_MS = 300_000
DAY_MS = 86_400_000


def clean_symbol(symbol: Column) -> Column:
    """Trimmed and in upper case; null where nothing is left."""
    text = F.upper(F.trim(symbol))
    return F.when(text != "", text)


def event_ms(stamp: Column) -> Column:
    """Epoch ms from seconds, ms, microseconds or nanoseconds, told apart by the number of digits; anything else is null."""
    return (
        F.when(stamp.between(10**12, 10**13 - 1), stamp)
        .when(stamp.between(10**9, 10**10 - 1), stamp * 1000)
        .when(stamp.between(10**15, 10**16 - 1), _div(stamp, 1000))
        .when(stamp.between(10**18, 9_223_372_036_854_775_807), _div(stamp, 1_000_000))
    )


def _div(a: Column, by: int) -> Column:
    """Whole-number division; through doubles nanoseconds would lose digits."""
    return F.call_function("div", a, F.lit(by).cast("bigint"))


def div(a: Column, by: int) -> Column:
    """Whole-number division towards minus infinity, for times before 1970 too."""
    return _div(a - F.pmod(a, F.lit(by).cast("bigint")), by)


def period_start(ms: Column, width: int = PERIOD_MS) -> Column:
    return ms - F.pmod(ms, F.lit(width).cast("bigint"))


def one_per_id(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key by `order`; rows without key are dropped.

    As a ranked window with limit 1, each map task keeps one row per key before the shuffle, so copies of one key, however
    many, never meet in one task."""
    rank = "__rank"
    w = Window.partitionBy(key).orderBy(*order)
    return df.where(F.col(key).isNotNull()).withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def usable_ticks(ticks: DataFrame, *columns: str, symbol: bool = True) -> DataFrame:
    """symbol, event_ms, tick_id, time and `columns` of the usable ticks: of each tick_id the row with the smallest `time`,
    if its timestamp stands for a time and isn't after `time`.

    Ties on `time` are settled by timestamp, then by the other columns that are kept, nulls first. Rows with a null tick_id or
    time don't count. A symbol that is null or blank comes out null; symbol=False leaves the column out."""
    kept = [*(["symbol"] if symbol else []), *(c for c in columns if c not in ("tick_id", "time", "timestamp", "symbol"))]
    thin = ticks.select("tick_id", "time", "timestamp", *kept).where(F.col("time").isNotNull())
    first = one_per_id(thin, "tick_id", *(F.col(c) for c in ("time", "timestamp", *kept)))
    named = [clean_symbol(F.col(c)).alias(c) if c == "symbol" else F.col(c) for c in kept]
    return first.withColumn("event_ms", event_ms(F.col("timestamp"))).where(F.col("event_ms") <= F.col("time")).select("event_ms", "tick_id", "time", *named)

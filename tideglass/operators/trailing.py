"""Rolling totals over trailing periods (problem 5).

The changelog is netted to live windows, those to days; each source's calendar is generated from its first to its last day
(the entity-calendar product, made per source by `sequence` from each day to the next with windows), and trailing sums are windows over a fixed number of rows. After
the daily aggregate a source has one row per day, however many rows it had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import clean_symbol


#: Prices are summed as decimals, so that the result doesn't depend on the order of rows.
PRICE = "decimal(20,8)"


def live_windows(changes: DataFrame) -> DataFrame:
    """symbol, window_start, volume, avg_price of the windows whose `diff` sums to 1, after dropping rows equal in all columns.

    volume is the sum of diff * total_volume with null as 0; avg_price the sum of diff * avg_price, null where the row that
    stands has none. Symbols are trimmed and in upper case; windows with a null or blank
    symbol or a null start don't count."""
    priced = F.col("avg_price").isNotNull() & ~F.isnan("avg_price")
    net = (
        changes.distinct()
        .withColumn("symbol", clean_symbol(F.col("symbol")))
        .where(F.col("symbol").isNotNull() & F.col("window_start").isNotNull())
        .groupBy("symbol", "window_start")
        .agg(
            F.sum("diff").alias("standing"),
            F.sum(F.col("diff") * F.coalesce("total_volume", F.lit(0))).alias("volume"),
            F.sum(F.when(priced, F.col("diff"))).alias("priced"),
            F.sum(F.when(priced, F.col("diff") * F.col("avg_price").cast(PRICE))).alias("price"),
        )
    )
    return net.where(F.col("standing") == 1).select("symbol", "window_start", "volume", F.when(F.col("priced") == 1, F.col("price")).alias("avg_price"))


def trailing_days(windows: DataFrame, periods: tuple[int, ...] = (7, 30)) -> DataFrame:
    """From live windows: symbol, day_utc, volume, n_windows and for each n of `periods` volume_nd, avg_volume_nd (per day),
    avg_price_nd (mean over the live windows that have a price), one row for every day from a symbol's first to its last."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("window_start").cast("timestamp")) / 86400).cast("int"))
    daily = windows.groupBy("symbol", day.alias("day")).agg(
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n_windows"), F.sum("avg_price").alias("price_sum"), F.count("avg_price").alias("n_prices")
    )
    # Each day with windows also brings the days without any up to the next: the calendar needs no second reading and no join.
    following = F.lead("day").over(Window.partitionBy("symbol").orderBy("day"))
    last = F.coalesce(F.date_sub("following", 1), F.col("home"))
    dense = daily.withColumn("following", following).withColumnRenamed("day", "home").withColumn("day", F.explode(F.sequence("home", last)))
    dense = dense.withColumns({x: F.when(F.col("day") == F.col("home"), F.col(x)) for x in ("volume", "n_windows", "price_sum", "n_prices")})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = [F.col("symbol"), F.date_format("day", "yyyy-MM-dd").alias("day_utc"), zero("volume").alias("volume"), zero("n_windows").alias("n_windows")]
    for n in periods:
        w = Window.partitionBy("symbol").orderBy("day").rowsBetween(1 - n, 0)
        volume, days = F.sum(zero("volume")).over(w), F.count(F.lit(1)).over(w)
        prices = F.sum(zero("n_prices")).over(w)
        out += [
            volume.alias(f"volume_{n}d"),
            (volume / days).alias(f"avg_volume_{n}d"),
            F.when(prices > 0, F.sum(F.coalesce("price_sum", F.lit(0).cast(PRICE))).over(w).cast("double") / prices).alias(f"avg_price_{n}d"),
        ]
    return dense.select(*out)

"""Mixed notations of time and missing zones (problem 4).

Times without zone are local to their source. The zone is estimated by alignment with the time of ingestion: for each source
and candidate zone, whose offset history Spark's time zone data gives, a published time that lies after its arrival is a
violation, and a long wait counts as a part of one. The zone of least cost is chosen; a declared zone is given up only if the
evidence against it is strong. Rows are first counted by source, quarter of an hour of
their local clock and of their wait, which loses nothing; the zones are tried on the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.timeparse import instant, iso_ms, read_date, read_time, to_utc
from tideglass.operators.ticks import div, event_ms, one_per_id

# Zones of the larger exchanges, one of those that keep the same clock.
CANDIDATE_ZONES = (
    "UTC", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Sao_Paulo", "Europe/London",
    "Europe/Berlin", "Europe/Moscow", "Asia/Dubai", "Asia/Kolkata", "Asia/Hong_Kong", "Asia/Tokyo", "Australia/Sydney", "Pacific/Auckland",
)
DAY_MICROS = 86_400_000_000
QUARTER_MICROS = 900_000_000


def estimate_zones(local_times: DataFrame, source: str, local: str, arrival_ms: str, declared: str, candidates: tuple[str, ...] = CANDIDATE_ZONES, strong: float = 5.0) -> DataFrame:
    """source, zone_name of every source with a time without zone.

    local: microseconds of the local clock; declared: the zone that the source is said to use, or null. A violation costs 1, a
    wait of a day or more a half, shorter waits in proportion. The declared zone stands unless another costs less by `strong`
    and by a tenth of the rows. Equal costs go to the declared zone, then to the first
    candidate."""
    c = F.col
    # Offsets are whole quarters of an hour and change at whole quarters, so rows of one quarter of the local clock whose arrival lies in one
    # quarter after it share every violation; only their number and the rests of their waits are needed.
    quarter = lambda x: div(x, QUARTER_MICROS)
    base = c(arrival_ms) * 1000 - c(local)
    bare = local_times.where(c(local).isNotNull() & c(source).isNotNull())
    counted = bare.select(c(source).alias("source"), c(declared).alias("declared"), (quarter(c(local)) * QUARTER_MICROS).alias("local"), quarter(base).alias("q"), (base - quarter(base) * QUARTER_MICROS).alias("rest"))
    counted = counted.groupBy("source", "declared", "local", "q").agg(F.count(F.lit(1)).alias("n"), F.sum("rest").alias("rests"))
    zones = F.array_distinct(F.array_compact(F.concat(F.array(*(F.lit(z) for z in candidates)), F.array(c("declared")))))
    tried = counted.select("*", F.posexplode(zones).alias("turn", "zone_name"))
    least = c("q") * QUARTER_MICROS + c("local") - to_utc(c("local"), c("zone_name"))  # the wait of each row but for its rest
    cost = F.when(least < 0, c("n") * 1.0).when(least >= DAY_MICROS, c("n") * 0.5).otherwise((c("n") * least + c("rests")) * (0.5 / DAY_MICROS))
    costs = tried.groupBy("source", "zone_name").agg(F.min("turn").alias("turn"), F.sum(F.coalesce(cost, F.lit(0.0))).alias("cost"), F.sum("n").alias("n"), F.max(F.coalesce(c("declared") == c("zone_name"), F.lit(False))).alias("said"))
    # A source has one row per candidate here.
    slack = F.when(c("said"), F.greatest(F.lit(strong), c("n") * 0.1)).otherwise(0.0)
    best = Window.partitionBy("source").orderBy(c("cost") - slack, F.desc("said"), "turn", "zone_name")
    return costs.withColumn("place", F.row_number().over(best)).where(c("place") == 1).select("source", "zone_name")


def news_times(news: DataFrame, sources: DataFrame) -> DataFrame:
    """news_id, symbol, published_at, published_us (epoch microseconds, null if unusable), one row per news_id, of the delivery with
    the smallest `time`. Sources that aren't declared get an estimated zone and read all-digit dates month first."""
    c = F.col
    one = one_per_id(news.select("news_id", "time", "symbol", "published_at", "source"), "news_id", *(c(x) for x in ("time", "published_at", "source", "symbol")))
    known = sources.select("source", c("zone_name").alias("declared"), "date_order").dropDuplicates(["source"])
    read = one.join(known, "source", "left").withColumn("read", read_time(c("published_at"), c("date_order")))
    bare = read.where(c("read.zone").isNull()).select("source", c("read.local").alias("local"), "time", "declared")
    zones = estimate_zones(bare, "source", "local", "time", "declared")
    return read.join(zones, "source", "left").select("news_id", "symbol", "published_at", instant(c("read"), c("zone_name")).alias("published_us"))


def _floor_ms(us: Column) -> Column:
    return F.call_function("div", us - F.pmod(us, F.lit(1000).cast("bigint")), F.lit(1000).cast("bigint"))


def normal_news(news: DataFrame, sources: DataFrame) -> DataFrame:
    """news_id, symbol, published_at, published_ms: published_at cut to whole ms of epoch, null if it stands for no time."""
    return news_times(news, sources).select("news_id", "symbol", "published_at", _floor_ms(F.col("published_us")).alias("published_ms"))


def normal_ticks(ticks: DataFrame) -> DataFrame:
    """tick_id, timestamp, event_ms, one row per tick_id (the delivery with the smallest `time`)."""
    c = F.col
    one = one_per_id(ticks.select("tick_id", "time", "timestamp"), "tick_id", c("time"), c("timestamp"))
    return one.select("tick_id", "timestamp", event_ms(c("timestamp")).alias("event_ms"))


def normal_dates(transactions: DataFrame) -> DataFrame:
    """source_file, position, transaction_date, normal_date (null if it stands for no date) of rows of the table `transactions`."""
    date = F.date_format(read_date(F.col("transaction_date")), "yyyy-MM-dd")
    return transactions.select("source_file", "position", "transaction_date", date.alias("normal_date"))


def rewritten(news: DataFrame, sources: DataFrame, ticks: DataFrame, transactions: DataFrame) -> DataFrame:
    """src, row_key, normal_form of every value that stands for a definite time but isn't yet in the one form of its column."""
    c = F.col
    n = normal_news(news, sources).where(c("published_ms").isNotNull() & ~c("published_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z\z"))
    t = normal_ticks(ticks).where(c("event_ms").isNotNull() & (c("event_ms") != c("timestamp")))
    d = normal_dates(transactions).where(c("normal_date").isNotNull() & (c("normal_date") != c("transaction_date")))
    row = lambda src, key, form: (F.lit(src).alias("src"), key.cast("string").alias("row_key"), form.alias("normal_form"))
    return (
        n.select(*row("news", c("news_id"), iso_ms(c("published_ms"))))
        .unionByName(t.select(*row("ticks", c("tick_id"), iso_ms(c("event_ms")))))
        .unionByName(d.select(*row("form4", F.concat_ws("#", "source_file", "position"), c("normal_date"))))
    )

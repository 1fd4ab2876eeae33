from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tideglass.functions.timeparse import instant, iso_ms, read_date, read_time
from tideglass.operators.zones import estimate_zones, normal_news, rewritten

CASES = [
    ("2025-10-06T18:04:48Z", "UTC", "MDY", "2025-10-06T18:04:48.000Z"),
    ("2025-10-06T18:04:48.123456Z", "UTC", "MDY", "2025-10-06T18:04:48.123Z"),
    (" 2025-10-06T18:04:48.5z\n", "UTC", "MDY", "2025-10-06T18:04:48.500Z"),
    ("2025-10-06 14:04:48.250 -04:00", "Asia/Tokyo", "MDY", "2025-10-06T18:04:48.250Z"),
    ("2025-10-06T23:34:48+0530", "UTC", "MDY", "2025-10-06T18:04:48.000Z"),
    ("20251006T180448Z", "Asia/Tokyo", "MDY", "2025-10-06T18:04:48.000Z"),
    ("Mon, 06 Oct 2025 18:04:48 GMT", "Asia/Tokyo", "MDY", "2025-10-06T18:04:48.000Z"),
    ("Mon, 06 Oct 2025 19:04:48 BST", "UTC", "MDY", "2025-10-06T18:04:48.000Z"),
    ("Mon, 06 Oct 2025 14:04:48 -0400", "UTC", "MDY", "2025-10-06T18:04:48.000Z"),
    ("Oct 6, 2025 2:04 PM ET", "UTC", "MDY", "2025-10-06T18:04:00.000Z"),
    ("Nov 6, 2025 12:04 AM ET", "UTC", "MDY", "2025-11-06T05:04:00.000Z"),
    ("Oct 7, 2025 5:04 AM AEDT", "UTC", "MDY", "2025-10-06T18:04:00.000Z"),
    ("6 Oct 2025, 14:04", "America/New_York", "MDY", "2025-10-06T18:04:00.000Z"),
    ("10/06/2025 2:04 PM", "America/New_York", "MDY", "2025-10-06T18:04:00.000Z"),
    ("06/10/2025 19:04", "Europe/London", "DMY", "2025-10-06T18:04:00.000Z"),
    ("06.10.2025 20:04", "Europe/Berlin", "DMY", "2025-10-06T18:04:00.000Z"),
    ("2025/10/06 13:04:48", "America/Chicago", "MDY", "2025-10-06T18:04:48.000Z"),
    ("1759773888", "UTC", "MDY", "2025-10-06T18:04:48.000Z"),
    ("1759773888123", "UTC", "MDY", "2025-10-06T18:04:48.123Z"),
    ("1759773888123456789", "UTC", "MDY", "2025-10-06T18:04:48.123Z"),
    ("2025-10-26 01:30:00", "Europe/London", "DMY", "2025-10-26T00:30:00.000Z"),  # occurs twice: the earlier instant
    ("2025-03-30 01:30:00", "Europe/London", "DMY", "2025-03-30T01:30:00.000Z"),  # skipped: forward by the skip
    *((bad, "UTC", "MDY", None) for bad in ("", "  ", "n/a", "-", "just now", "yesterday", "0000-00-00T00:00:00Z", "2025-02-30T00:00:00Z", "2025-10-06T25:00:00Z", "13/13/2025 10:00", "12345", "2025-10-06T18:04:48 XYZ", None)),
]


def test_times(spark):
    df = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(CASES)], "i int, t string, zone string, o string")
    out = df.withColumn("r", read_time(F.col("t"), F.col("o"))).select("i", F.call_function("div", instant(F.col("r"), F.col("zone")), F.lit(1000).cast("bigint")).alias("ms"))
    got = {r.i: r.f for r in out.select("i", iso_ms(F.col("ms")).alias("f")).collect()}
    assert {CASES[i][0]: f for i, f in got.items()} == {x[0]: x[3] for x in CASES}


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Sydney"])
def test_local_times_equal_zoneinfo(spark, zone):
    start = datetime(2025, 9, 1)
    times = [start + timedelta(minutes=37 * k) for k in range(0, 4000)]
    df = spark.createDataFrame([(t.strftime("%Y-%m-%d %H:%M:%S"),) for t in times], "t string")
    got = {r.t: r.us for r in df.select("t", instant(read_time(F.col("t"), F.lit("MDY")), F.lit(zone)).alias("us")).collect()}
    for t in times:
        local = t.replace(tzinfo=ZoneInfo(zone), fold=0)
        assert got[t.strftime("%Y-%m-%d %H:%M:%S")] == int(local.astimezone(timezone.utc).timestamp()) * 1_000_000


def test_dates(spark):
    cases = {
        "2025-10-06": "2025-10-06", " 2025-10-06 ": "2025-10-06", "10/06/2025": "2025-10-06", "9/6/25": "2025-09-06", "10-06-2025": "2025-10-06", "20251006": "2025-10-06", "06-OCT-2025": "2025-10-06", "Oct 6, 2025": "2025-10-06",
        "October 06, 2025": "2025-10-06", "2025-10-06-05:00": "2025-10-06", "2025-10-06T00:00:00": "2025-10-06", "2025-10-06T23:00:00.000-04:00": "2025-10-06", "00/00/0000": None, "N/A": None, "see footnote": None, "": None, "13/40/2025": None,
        "2025-02-30": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: str(r.d) if r.d else None for r in df.select("t", read_date(F.col("t")).alias("d")).collect()} == cases


def _arrivals(zone, n=60):
    out = []
    for k in range(n):
        at = datetime(2025, 9, 8, 13, tzinfo=timezone.utc) + timedelta(hours=23 * k, seconds=k)
        local = at.astimezone(ZoneInfo(zone)).replace(tzinfo=timezone.utc)
        out.append((int(local.timestamp()) * 1_000_000, int(at.timestamp() * 1000) + 30_000 + (k % 9 == 0) * 7_200_000))
    return out


def test_zones_are_estimated_from_arrivals(spark):
    zones = ["America/New_York", "Europe/London", "Asia/Kolkata", "Australia/Sydney", "UTC"]
    data = [(z, a, b, None) for z in zones for a, b in _arrivals(z)]
    data += [("wrong", a, b, "Asia/Tokyo") for a, b in _arrivals("America/Chicago")]  # strong evidence against what is said
    data += [("few", a, b, "Europe/Paris") for a, b in _arrivals("Europe/London", 2)]  # too little evidence
    df = spark.createDataFrame([*data, (None, 1, 1, None), ("x", None, 1, None)], "source string, local bigint, time bigint, declared string").selectExpr("*", "'?' AS zone_name", "1 AS turn")
    got = {r.source: r.zone_name for r in estimate_zones(df, "source", "local", "time", "declared").collect()}
    assert got == {z: z for z in zones} | {"wrong": "America/Chicago", "few": "Europe/Paris"}


def test_estimate_agrees_with_declared_zones(spark, small):
    from tideglass.sources.tables import table

    for folder in (small, "/root/testdata/sf0.01"):
        n = normal_news(table(spark, folder, "news"), table(spark, folder, "news_sources"))
        late = n.join(table(spark, folder, "news").groupBy("news_id").agg(F.min("time").alias("time")), "news_id").where("published_ms > time")
        assert late.count() == 0


def test_rewritten_keys_and_forms(spark):
    news = spark.createDataFrame([(1, "2025-10-06T18:04:48.123456Z", "s", 1, "A"), (2, "2025-10-06T18:04:48Z", "s", 2_000_000_000_000, "A"), (2, "2025-10-06T18:04:48Z", "s", 1, "A"), (3, None, "s", 1, None)], "news_id bigint, published_at string, source string, time bigint, symbol string")
    sources = spark.createDataFrame([("s", "UTC", "MDY")], "source string, zone_name string, date_order string")
    ticks = spark.createDataFrame([(5, 1_759_773_888, 1), (6, 1_759_773_888_000, 1), (7, 0, 1), (8, None, 1)], "tick_id bigint, timestamp bigint, time bigint")
    dates = spark.createDataFrame([("f.html", 0, "10/06/2025"), ("f.html", 1, "2025-10-06"), ("f.html", 2, None)], "source_file string, position int, transaction_date string")
    got = {tuple(r) for r in rewritten(news, sources, ticks, dates).collect()}
    assert got == {("news", "2", "2025-10-06T18:04:48.000Z"), ("ticks", "5", "2025-10-06T18:04:48.000Z"), ("form4", "f.html#0", "2025-10-06")}
    assert rewritten(news.limit(0), sources.limit(0), ticks.limit(0), dates.limit(0)).collect() == []

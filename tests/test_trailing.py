from __future__ import annotations

from datetime import datetime

from tideglass.operators.trailing import live_windows, trailing_days

SCHEMA = "symbol string, window_start timestamp, window_end timestamp, avg_price double, total_volume bigint, time bigint, diff int"


def row(symbol, day, hour, price, volume, diff=1, time=0):
    at = datetime(2025, 9, day, hour)
    return (symbol, at, at, price, volume, time, diff)


def days(spark, rows):
    return {(r.symbol, r.day_utc): r for r in trailing_days(live_windows(spark.createDataFrame(rows, SCHEMA))).collect()}


def test_totals_with_corrections_and_gaps(spark):
    rows = [
        row("A", 1, 9, 10.0, 100), row("A", 1, 9, 10.0, 100),  # repeated in all columns
        row("A", 1, 10, 10.0, 50), row("A", 1, 10, 10.0, 50, -1, 5), row("A", 1, 10, 12.0, 70, 1, 5),  # corrected
        row("A", 2, 9, 10.0, 30), row("A", 2, 9, 10.0, 30, -1, 9),  # taken back
        row("A", 12, 9, None, None), row("A", 14, 9, float("nan"), 5), row("B", 3, 9, 1.0, 0), (None, datetime(2025, 9, 1), None, 1.0, 1, 0, 1),
    ]
    out = days(spark, rows)
    assert len([k for k in out if k[0] == "A"]) == 14 and len(out) == 15
    first, gap, end = out["A", "2025-09-01"], out["A", "2025-09-12"], out["A", "2025-09-14"]
    assert (first.volume, first.n_windows, first.avg_price_7d) == (170, 2, 11.0)
    assert (out["A", "2025-09-07"].volume_7d, out["A", "2025-09-08"].volume_7d, out["A", "2025-09-08"].volume_30d) == (170, 0, 170)
    assert (gap.volume_7d, gap.volume_30d, gap.avg_price_7d) == (0, 170, None) and (end.volume_7d, end.volume_30d) == (5, 175)
    assert out["A", "2025-09-08"].avg_volume_7d == 0.0 and out["A", "2025-09-03"].avg_volume_30d == 170 / 3


def test_empty(spark):
    assert days(spark, []) == {}

from __future__ import annotations

import math

import numpy as np

from tideglass.operators.grid import TREND_ORIGIN_MS, YEAR_MS, fit_harmonics, regular_grid

DAY = 1_757_289_600_000  # a UTC midnight
P = 300_000


def rows(spark, data):
    return spark.createDataFrame(data, "symbol string, event_ms bigint, price double")


def design(at, k=3):
    at = np.asarray(at, float)
    w = 2 * np.pi * (at % 86_400_000) / 86_400_000
    return np.column_stack([np.ones_like(at), (at - TREND_ORIGIN_MS) / YEAR_MS, *(f(w * i) for i in range(1, k + 1) for f in (np.sin, np.cos))])


def test_missing_periods_are_between_first_and_last(spark):
    df = rows(spark, [("A", DAY + 10, 1.0), ("A", DAY + 4 * P + 5, 2.0), ("A", DAY + 86_400_000 + 1, 5.0), ("B", DAY, 1.0)])
    out = {(r.symbol, r.period_start): r for r in regular_grid(df, "symbol", "event_ms", "price").collect()}
    assert {k for k, r in out.items() if r.is_missing} == {("A", DAY + i * P) for i in (1, 2, 3)}
    assert len(out) == 7 and out["B", DAY].n_readings == 1 and out["A", DAY].day_utc == "2025-09-08"


def test_regression_equals_least_squares_and_bridges_residuals(spark):
    rng = np.random.default_rng(3)
    at = np.concatenate([DAY + d * 86_400_000 + np.arange(0, 288, 2) * P for d in range(6)])
    y = 50 + 3 * np.sin(2 * np.pi * (at % 86_400_000) / 86_400_000) + rng.normal(0, 0.2, len(at))
    df = rows(spark, [("A", int(a), float(v)) for a, v in zip(at, y)])
    fit = np.linalg.lstsq(design(at), y, rcond=None)[0]
    grid = {r.period_start: r for r in regular_grid(df, "symbol", "event_ms", "price").collect()}
    k = 10
    left, right, mid = int(at[k]), int(at[k + 1]), int(at[k]) + P
    predict = lambda t: float((design([t]) @ fit)[0])
    expect = predict(mid) + ((y[k] - predict(left)) + (y[k + 1] - predict(right))) / 2
    assert math.isclose(grid[mid].filled, expect, rel_tol=1e-6)


def test_linear_series_is_filled_exactly(spark):
    df = rows(spark, [("A", DAY + i * P, 10.0 + i) for i in range(100) if i % 7 not in (3, 4)])
    for r in regular_grid(df, "symbol", "event_ms", "price").where("is_missing").collect():
        assert abs(r.filled - (10 + (r.period_start - DAY) / P)) < 0.05


def test_nulls_nan_repeats_and_empty(spark):
    df = rows(spark, [(None, DAY, 1.0), ("A", None, 1.0), ("A", DAY, None), ("A", DAY, float("nan")), ("A", DAY + 2 * P, 4.0), ("A", DAY + 2 * P, 4.0)])
    out = regular_grid(df.selectExpr("*", "1 AS source", "2 AS filled", "3 AS day"), "symbol", "event_ms", "price").collect()
    assert [(r.period_start, r.n_readings, r.observed, r.filled) for r in out] == [(DAY + 2 * P, 2, 4.0, 4.0)]
    assert regular_grid(rows(spark, []), "symbol", "event_ms", "price").collect() == []


def test_systems_without_full_rank(spark):
    df = rows(spark, [("A", DAY, 5.0), ("A", DAY + 3 * P, 5.0)]).selectExpr("symbol AS source", "event_ms AS period_start", "price AS value")
    coefficients = fit_harmonics(df).first().coefficients
    assert np.allclose(design([DAY, DAY + 3 * P]) @ np.array(coefficients), 5.0, atol=1e-3)


def test_held_out_readings_come_back(spark):
    """Gaps of up to two hours in a daily wave with trend and noise: the error is that of the noise, far below that of the day's mean or a line."""
    rng = np.random.default_rng(5)
    at = np.concatenate([DAY + d * 86_400_000 + np.arange(288) * P for d in range(8)])
    phase = 2 * np.pi * (at % 86_400_000) / 86_400_000
    y = 100 + (at - DAY) / 86_400_000 + 6 * np.sin(phase) + 3 * np.cos(3 * phase) + rng.normal(0, 0.1, len(at))
    hidden = np.zeros(len(at), bool)
    for start in rng.integers(10, len(at) - 40, 30):
        hidden[start : start + 24] = True
    hidden[::288] = hidden[287::288] = False  # each day keeps its ends
    df = rows(spark, [("A", int(a), float(v)) for a, v in zip(at[~hidden], y[~hidden], strict=True)])
    filled = {r.period_start: r.filled for r in regular_grid(df, "symbol", "event_ms", "price").where("is_missing").collect()}
    error = np.array([filled[int(a)] for a in at[hidden]]) - y[hidden]
    straight = np.interp(at[hidden], at[~hidden], y[~hidden]) - y[hidden]
    assert np.sqrt((error**2).mean()) < 0.25 < np.sqrt((straight**2).mean())

from __future__ import annotations

import random

import numpy as np
import pytest

from tideglass.operators.outliers import departure, flag_ticks, steps, stuck

T0 = 1_757_338_200_000
SCHEMA = "symbol string, event_ms bigint, tick_id bigint, price double, volume bigint, bid double, ask double"


def walk(n, symbol="A", seed=1, start=1):
    r = random.Random(seed)
    p, out = 100.0, []
    for i in range(n):
        p += r.choice([-0.02, -0.01, 0.01, 0.02])
        out.append([symbol, T0 + i * 1000, start + i, round(p, 2), r.randint(50, 150), round(p - 0.05, 2), round(p + 0.05, 2)])
    return out


def flags(spark, data, **k):
    return {r.tick_id: r for r in flag_ticks(spark.createDataFrame(data, SCHEMA), **k).collect()}


def slow_departure(v, width=3, levels=(5, 7)):
    n, out = len(v), []
    for i in range(n):
        if i in (0, n - 1):
            out.append(0.0)
            continue
        sides = [(np.median(v[max(0, i - k) : i]), np.median(v[i + 1 : i + 1 + k])) for k in levels]
        wins = [(max(0, j), min(n - 1, j + width)) for j in range(i - width, i + 1)]
        opened = max(min(v[x : y + 1]) for x, y in wins)
        closed = min(max(v[x : y + 1]) for x, y in wins)
        above, below = max(min(v[i] - b, v[i] - a) for b, a in sides), max(min(b - v[i], a - v[i]) for b, a in sides)
        out.append(max(0.0, min(above, v[i] - opened), min(below, closed - v[i])))
    return out


def test_departure_equals_brute_force():
    rng = np.random.default_rng(0)
    parts = []
    for n in (1, 2, 3, 4, 5, 9, 40, 200):
        v = np.round(rng.normal(0, 1, n).cumsum(), 2)
        v[rng.integers(0, n, n // 10)] += 50
        parts.append(v)
    first = np.concatenate([np.arange(len(v)) == 0 for v in parts])
    assert np.allclose(departure(np.concatenate(parts), first), np.concatenate([slow_departure(v) for v in parts]))
    assert len(departure(np.zeros(0), np.zeros(0, bool))) == 0


def test_what_departs_has_a_step():
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(0, 1, 500).cumsum(), 2)
    v[rng.integers(0, 500, 40)] += rng.choice([-30, 30], 40)
    first = np.arange(500) % 100 == 0
    far, (move, step) = departure(v, first), steps(v, first)
    assert (step >= far / 3 - 1e-9).all() and np.isnan(move[first]).all() and (far > 20).sum() > 5


def test_the_fence_decides(spark):
    """The same departure is a spike in a calm hour and none in an hour whose moves are often as great."""
    data = []
    for hour in range(3):
        part = walk(600, seed=hour, start=1 + 1000 * hour)
        r = random.Random(hour)
        for row in part:
            row[1] += hour * 3_600_000
        if hour == 1:  # busy: every third tick jumps there and back
            for i in range(2, 598, 3):
                part[i][3] = round(part[i][3] + r.choice([-1, 1]) * r.uniform(0.4, 0.9), 2)
        part[300][3] = round(part[299][3] + 1.0, 2)
        data += part
    found = {t for t, r in flags(spark, data).items() if r.spike_price}
    assert found == {301, 2301}
    assert len({t for t, r in flags(spark, data, fences=-1.0).items() if r.spike_price}) > 50  # without a fence the busy hour's moves all count


@pytest.mark.parametrize("width", [1, 2, 3])
def test_short_spikes_are_found_and_levels_are_not(spark, width):
    data = walk(200)
    for i in range(50, 50 + width):
        data[i][3] += 5
    for i in range(120, 200):  # a lasting change
        data[i][3] += 5
    for i in range(80, 84):  # four ticks are no spike
        data[i][4] = data[i][4]
        data[i][5] += 5
        data[i][6] += 5
    found = flags(spark, data)
    assert {t for t, r in found.items() if r.flagged} == set(range(51, 51 + width))


def test_impossible_stuck_and_volume(spark):
    data = walk(120)
    data[3][3] = 0.0
    data[4][4] = -1
    data[5][5], data[5][6] = 101.0, 100.0
    for i in range(20, 32):
        data[i][3] = 100.0
    for i in range(40, 51):  # eleven are too few
        data[i][3] = 100.0
    for i in range(60, 75):
        data[i][5], data[i][6] = 99.0, 101.0
    data[66][5] = None  # skipped in the run
    data[100][4] = 100_000
    found = flags(spark, data)
    assert {t for t, r in found.items() if r.stuck} == set(range(22, 33)) | (set(range(62, 76)) - {67})
    assert {t for t, r in found.items() if r.impossible} == {4, 5, 6}
    assert [t for t, r in found.items() if r.spike_volume] == [101]


def test_slots_change_nothing(spark):
    data = walk(900, seed=4)
    r = random.Random(5)
    for row in data:  # over three hours, so that there are many periods
        row[1] = T0 + (row[2] - 1) * 12_000
        if r.random() < 0.02:
            row[3] += r.choice([-9, 9])
        if r.random() < 0.2:
            row[3] = None
        if r.random() < 0.1:
            row[5] = float("nan")
    for i in range(395, 425):
        data[i][3] = 100.0 if data[i][3] is not None else None
    whole, cut = flags(spark, data), flags(spark, data, slot_rows=60)
    assert whole == cut and sum(x.flagged for x in whole.values()) > 20


def test_stuck_runs():
    same = np.array([False] + [True] * 11 + [False] + [True] * 10)
    assert stuck(same).tolist() == [False] + [True] * 11 + [False] * 11
    assert stuck(np.array([], bool)).tolist() == []


def test_nulls_and_empty(spark):
    assert flags(spark, []) == {}
    data = [[None, T0, 1, -1.0, 1, 1.0, 2.0], ["A", T0, 2, None, None, None, None], ["A", T0, 3, float("nan"), 5, float("nan"), 1.0]]
    found = flags(spark, data)
    assert set(found) == {2, 3} and not any(r.flagged for r in found.values())

from __future__ import annotations

import random

import numpy as np

from tideglass.operators.lateness import KSlack, k_slack, period_aggregates
from tideglass.operators.ticks import usable_ticks

SCHEMA = "partition int, time bigint, event_ms bigint, tick_id bigint, price double, volume bigint"
T0 = 1_757_338_200_000


def arrivals(n, seed, parts=2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        at = T0 + i * r.choice([0, 1000, 5000])
        out.append((r.randrange(parts), at + r.choice([0, 0, 60_000]), at - r.choice([0, 100, 1000, 400_000, 1_000_000, 2_000_000]), i, float(r.randrange(90, 110)), r.randrange(5)))
    return out


def slow(rows):
    out = {}
    for p, t, e, i, *_ in rows:
        earlier = [x[2] for x in rows if x[0] == p and x[1] < t]
        high = max(earlier) if earlier else None
        ended = high is not None and e - e % 300_000 + 300_000 <= high
        out[i] = "too_late" if ended and e < high - 900_000 else "corrects" if ended else "on_time"
    return out


def test_outcomes_equal_brute_force(spark):
    for seed in range(3):
        rows = arrivals(300, seed)
        got = {r.tick_id: r.outcome for r in k_slack(spark.createDataFrame(rows, SCHEMA), "partition", "event_ms", "time", shard_ms=(60_000, 900_000, 10**12)[seed]).collect()}
        assert got == slow(rows) and {"too_late", "corrects", "on_time"} == set(got.values())


def test_nulls_ties_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert k_slack(df, "partition", "event_ms", "time").collect() == []
    rows = [(None, T0, T0, 1, 1.0, 1), (0, None, T0, 2, 1.0, 1), (0, T0, None, 3, 1.0, 1), (0, T0, T0, 4, 1.0, 1), (0, T0, T0 - 5_000_000, 5, 1.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS outcome", "1 AS high_mark", "2 AS bucket", "3 AS top")
    got = {r.tick_id: (r.outcome, r.high_mark) for r in k_slack(df, "partition", "event_ms", "time").collect()}
    assert got == {4: ("on_time", None), 5: ("on_time", None)}


def test_period_aggregates(spark):
    p = T0 - T0 % 300_000
    rows = [(0, p + 10, p + 5, 1, 10.0, 1), (0, p + 20, p + 3, 2, 11.0, 2), (0, p + 400_000, p + 390_000, 3, 9.0, 1), (0, p + 400_001, p + 1, 4, 12.0, None), (0, p + 2_000_000, p + 1_900_000, 5, 1.0, 1), (0, p + 2_000_001, p, 6, 99.0, 7)]
    out = {r.period_start: r for r in period_aggregates(k_slack(spark.createDataFrame(rows, SCHEMA), "partition", "event_ms", "time"), "partition", "event_ms", "price", "volume", "tick_id").collect()}
    r = out[p]
    assert (r.provisional_count, r.provisional_first, r.provisional_last, r.provisional_volume) == (2, 11.0, 10.0, 3)
    assert (r.corrections, r.too_late, r.final_count, r.final_first, r.final_last, r.final_high, r.final_low, r.final_volume) == (1, 1, 3, 12.0, 10.0, 12.0, 10.0, 3)


def test_machine_publishes_what_the_batch_finds(spark):
    """Batches cut instants at will; provisional versions count up, every period ends with one final row."""
    rows = arrivals(400, 7, parts=1)
    machine, published = KSlack(), []
    ordered = sorted((t, e, i, v, w) for _, t, e, i, v, w in rows)
    for i in range(0, len(ordered), 37):
        a, e, k, v, w = zip(*ordered[i : i + 37], strict=True)
        published += machine.push(np.array(a), np.array(e), np.array(k), np.array(v), np.array(w))
    published += machine.flush()
    final = {r[0]: r for r in published if r[1] == "final"}
    assert len(final) == sum(r[1] == "final" for r in published) and not len(machine.buffer[0])
    versions = [r[2] for r in published if r[0] == min(final) and r[1] != "too_late"]
    assert versions == list(range(1, len(versions) + 1)) and any(r[1] == "provisional" for r in published)
    late = {}
    for r in published:
        if r[1] == "too_late":
            late[r[0]] = late.get(r[0], 0) + r[3]
    batch = period_aggregates(k_slack(spark.createDataFrame(rows, SCHEMA), "partition", "event_ms", "time"), "partition", "event_ms", "price", "volume", "tick_id").collect()
    assert {r.period_start: (r.final_count, r.final_first, r.final_last, r.final_high, r.final_low, r.final_volume) for r in batch if r.final_count} == {s: (r[3], *r[4:9]) for s, r in final.items()}
    assert {r.period_start: r.too_late for r in batch if r.too_late} == late and late


def test_usable_ticks(spark):
    schema = "tick_id bigint, timestamp bigint, symbol string, time bigint, price double"
    rows = [
        (1, T0, " ab ", T0 + 5, 1.0), (1, T0, "AB", T0 + 1, 1.0), (2, T0 // 1000, "ab", T0 + 5, 1.0), (3, T0 * 1000 + 999, "ab", T0, 1.0), (4, T0 * 1_000_000 + 999_999, "ab", T0, 1.0),
        (5, 0, "ab", T0, 1.0), (6, None, "ab", T0, 1.0), (7, T0 + 9, "ab", T0, 1.0), (8, T0, "  ", T0, 1.0), (9, 12345, "ab", T0, 1.0), (10, -T0, "ab", T0, 1.0), (11, T0, None, T0, None), (None, T0, "x", T0, 1.0),
    ]
    got = {r.tick_id: (r.symbol, r.event_ms, r.time) for r in usable_ticks(spark.createDataFrame(rows, schema), "price").collect()}
    whole = T0 // 1000 * 1000
    assert got == {1: ("AB", T0, T0 + 1), 2: ("AB", whole, T0 + 5), 3: ("AB", T0, T0), 4: ("AB", T0, T0), 8: (None, T0, T0), 11: (None, T0, T0)}

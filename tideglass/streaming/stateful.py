"""Stateful operators of streams: statistics as a changelog, EMA, and K-slack reordering."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideglass.operators.lateness import SLACK_MS, KSlack
from tideglass.operators.ticks import PERIOD_MS

CHANGE = "symbol string, count bigint, avg_price double, max_price double, min_price double, total_volume bigint, diff int"


def stats_changelog(ticks: DataFrame) -> DataFrame:
    """count, mean (six places), max and min price and total volume of each symbol as changes: an update takes the old row back (diff -1)
    and asserts the new one (diff 1). State is five numbers for each symbol; a null volume counts as 0."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else None
        n, total, top, low, volume = old or (0, 0.0, float("-inf"), float("inf"), 0)
        for part in parts:
            n += len(part)
            total += float(part["price"].sum())
            top, low = max(top, part["price"].max()), min(low, part["price"].min())
            volume += int(part["volume"].fillna(0).sum())
        new = (n, total, float(top), float(low), volume)
        state.update(new)
        shown = lambda s, diff: (key[0], s[0], round(s[1] / s[0], 6), *s[2:], diff)
        rows = [shown(old, -1)] if old else []
        yield pd.DataFrame([*rows, shown(new, 1)], columns=[x.split()[0] for x in CHANGE.split(", ")])

    return ticks.groupBy("symbol").applyInPandasWithState(step, CHANGE, "n bigint, total double, top double, low double, volume bigint", "update", GroupStateTimeout.NoTimeout)


def stream_ema(ticks: DataFrame, periods: tuple[int, ...] = (12, 26), slack_ms: int = SLACK_MS) -> DataFrame:
    """The EMAs of each symbol after every batch, in order of event time, then tick_id, from symbol, time, event_ms, tick_id, price.

    Rows wait in a K-slack buffer by symbol until none before them can come; what is published goes on over the buffer, so that it is
    provisional for `slack_ms`. Rows later than that don't count. State is one number for each period and the buffer."""
    names = [f"ema_{n}" for n in periods]
    shape = "values array<double>, high bigint, top bigint, instant bigint, event array<bigint>, id array<bigint>, value array<double>"

    def fold(values: list[float] | None, prices: np.ndarray) -> list[float] | None:
        for p in prices.tolist():
            values = [p] * len(periods) if values is None else [p * (2.0 / (n + 1)) + v * (1.0 - 2.0 / (n + 1)) for n, v in zip(periods, values, strict=True)]
        return values

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        values, machine = None, KSlack(slack_ms, 1)
        if state.exists:
            values, machine.high, machine.top, machine.instant, *buffer = state.get
            machine.buffer = (np.array(buffer[0], np.int64), np.array(buffer[1], np.int64), np.array(buffer[2], float), np.zeros(len(buffer[0]), np.int64))
        rows = pd.concat(list(parts)).sort_values("time", kind="stable")
        whole = lambda x: rows[x].to_numpy(np.int64)
        released, waiting = machine.take(whole("time"), whole("event_ms"), whole("tick_id"), rows["price"].to_numpy(float))
        values = fold(values or None, released)
        shown = fold(values, waiting)
        state.update((values or [], machine.high, machine.top, machine.instant, *(x.tolist() for x in machine.buffer[:3])))
        yield pd.DataFrame([(key[0], *shown)] if shown else [], columns=["symbol", *names])

    out = ", ".join(f"{n} double" for n in names)
    known = ticks.where(F.col("symbol").isNotNull() & F.col("time").isNotNull() & F.col("event_ms").isNotNull() & F.col("tick_id").isNotNull() & F.col("price").isNotNull())
    return known.groupBy("symbol").applyInPandasWithState(step, f"symbol string, {out}", shape, "update", GroupStateTimeout.NoTimeout)


PUBLISHED = "partition int, period_start bigint, kind string, version int, count bigint, first double, last double, high double, low double, volume bigint"
MACHINE = "high bigint, top bigint, instant bigint, event array<bigint>, id array<bigint>, value array<double>, weight array<bigint>, open array<bigint>, versions array<int>"


def _restore(state: tuple, slack_ms: int, period_ms: int) -> KSlack:
    high, top, instant, event, id_, value, weight, open_, versions = state
    machine = KSlack(slack_ms, period_ms, high, top, instant)
    machine.buffer = (np.array(event, np.int64), np.array(id_, np.int64), np.array(value, float), np.array(weight, np.int64))
    machine.versions = dict(zip(open_, versions, strict=True))
    return machine


def _saved(machine: KSlack) -> tuple:
    return (machine.high, machine.top, machine.instant, *(x.tolist() for x in machine.buffer), list(machine.versions), list(machine.versions.values()))


def _published(key: int, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(key, *r) for r in rows], columns=[x.split()[0] for x in PUBLISHED.split(", ")]).astype({"version": "Int32", "volume": "Int64"})


def k_slack_stream(ticks: DataFrame, slack_ms: int = SLACK_MS, period_ms: int = PERIOD_MS, idle_ms: int | None = None) -> DataFrame:
    """What the K-slack machine of each partition publishes (PUBLISHED) from a stream of partition, time, event_ms, tick_id, price, volume:
    provisional and final aggregates of periods and the counts of rows that came too late.

    The rows of one batch are put in order of arrival; batches come in order of arrival. State is the buffer, bounded by slack and period,
    in the order of release. With `idle_ms`, a partition without rows for so long by the clock gives up its open periods as final; such a stream
    never runs out of batches, so it needs a trigger by the clock. `open_periods` gives them up for a stream that has ended."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            machine = _restore(state.get, slack_ms, period_ms)
            state.remove()
            yield _published(key[0], machine.flush())
            return
        machine = _restore(state.get, slack_ms, period_ms) if state.exists else KSlack(slack_ms, period_ms)
        rows = pd.concat(list(parts)).sort_values("time", kind="stable")
        whole = lambda x: rows[x].to_numpy(np.int64)
        out = machine.push(whole("time"), whole("event_ms"), whole("tick_id"), rows["price"].to_numpy(float), rows["volume"].fillna(0).to_numpy(np.int64))
        state.update(_saved(machine))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield _published(key[0], out)

    known = ticks.where(F.col("partition").isNotNull() & F.col("time").isNotNull() & F.col("event_ms").isNotNull() & F.col("tick_id").isNotNull())
    return known.groupBy("partition").applyInPandasWithState(step, PUBLISHED, MACHINE, "update", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def open_periods(spark: SparkSession, checkpoint: str, slack_ms: int = SLACK_MS, period_ms: int = PERIOD_MS) -> DataFrame:
    """The periods that the machines of an ended stream still hold, as final rows of PUBLISHED, from the state in its checkpoint."""

    def flush(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for r in part.itertuples(index=False):
                yield _published(r[0], _restore(r[1:], slack_ms, period_ms).flush())

    c = F.col
    state = spark.read.format("statestore").load(checkpoint)
    fields = [x.split()[0] for x in MACHINE.split(", ")]
    return state.select(c("key.partition").alias("partition"), *(c(f"value.groupState.{x}").alias(x) for x in fields)).mapInPandas(flush, PUBLISHED)


def describe(progress: dict) -> str:
    """A line about a batch: rows in, rows of state, duration."""
    state = sum(x.get("numRowsTotal", 0) for x in progress.get("stateOperators", []))
    return json.dumps({"batch": progress.get("batchId"), "rows": progress.get("numInputRows"), "state": state, "ms": progress.get("durationMs", {}).get("triggerExecution")})

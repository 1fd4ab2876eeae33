"""Implausible spikes, stuck and impossible values in ticks (problem 2).

Each symbol's normal behaviour comes from quantile sketches of its tick-to-tick moves and of its volumes: counts of logarithmic
buckets (relative error ACCURACY), made where the rows are and merged by adding counts. Merged over a day they give its usual move, merged
over all days by hour of the day, in units of each day's usual move, they give the hour's expanded interquartile fence.

A spike is a value that passes both: its moves there and back are beyond the fence of its hour (so busy opens and closes have wide
fences), and it leaves the level before and after it, for at most three ticks, by more than `moves` usual moves of its day (its rate of
change is implausible). A volume is one beyond its hour's fence and beyond `volumes` times the symbol's median. A value is stuck when
`run` ticks show no variance.

Order matters within a symbol and day only, so that is the unit of work; days with more than `slot_rows` ticks are cut into slots
of whole periods, each of which also gets the rows around it that its decisions need (`slots`). A period is never cut. Within a task all
slots of a batch are judged at once, by arrays in which gaps keep them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import DAY_MS, div, period_start
from tideglass.session import materialise

SLOT_ROWS = 50_000
RUN = 12
WIDTH = 3
LEVELS = (5, 7)
MOVES = 20.0
VOLUMES = 100.0
#: Interquartile ranges above the upper quartile where a fence stands.
FENCES = 3.0
ACCURACY = 0.01
SERIES = ("price", "bid", "ask")
#: Rows with a value that a decision looks at on either side.
HALO = max(RUN, max(LEVELS) + WIDTH) + 1
#: Buckets are whole numbers around 0 for the value 1; this one holds zeros.
ZERO = -100_000
_LOG = log(1.0 + ACCURACY)


def slots(ticks: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """symbol, period, slot, own for the days of more than `slot_rows` ticks: the slots that need the rows of a period, and
    whether the period belongs to the slot or only surrounds it. Around a slot there are at least HALO rows with a price and
    HALO with a quote, as far as the day has them."""
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    counts = ticks.groupBy("symbol", div(F.col("event_ms"), DAY_MS).alias("day"), period_start(F.col("event_ms")).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known("price")).alias("a"), F.count_if(known("bid") & known("ask")).alias("b")
    )
    day = Window.partitionBy("symbol", "day")
    run = day.orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        counts.withColumn("rows", F.sum("n").over(day))
        .where(F.col("rows") > slot_rows)
        .select("symbol", "day", "period", *(F.sum(c).over(run).alias(f"{c}1") for c in "nab"), *(F.col(c) for c in "nab"))
        .select("symbol", "day", "period", "a1", "b1", (F.col("a1") - F.col("a")).alias("a0"), (F.col("b1") - F.col("b")).alias("b0"), div(F.col("n1") - F.col("n"), slot_rows).alias("home"))
    )
    spans = parts.groupBy("symbol", "day", F.col("home").alias("slot")).agg(*(F.min(f"{c}0").alias(f"{c}_from") for c in "ab"), *(F.max(f"{c}1").alias(f"{c}_to") for c in "ab"))
    # Both sides have one row per period of a day at most.
    before = (F.col("home") < F.col("slot")) & ((F.col("a_from") - F.col("a1") < HALO) | (F.col("b_from") - F.col("b1") < HALO))
    after = (F.col("home") > F.col("slot")) & ((F.col("a0") - F.col("a_to") < HALO) | (F.col("b0") - F.col("b_to") < HALO))
    own = F.col("home") == F.col("slot")
    return parts.join(spans, ["symbol", "day"]).where(own | before | after).select("symbol", "period", "slot", own.alias("own"))


def _spread(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values with NaN between and around the series that begin where `first` is true, and where each value went."""
    gap = max(LEVELS)
    at = np.arange(len(x)) + gap * np.cumsum(first)
    out = np.full(len(x) + gap * (int(first.sum()) + 1), np.nan)
    out[at] = x
    return out, at


def _last(v: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each value and the width - 1 before it."""
    out = v.copy()
    for k in range(1, width):
        out[k:] = pick(out[k:], v[:-k])
    return out


def _median(rows: np.ndarray) -> np.ndarray:
    """Of each row, without its NaN; NaN where nothing is left."""
    rows = np.sort(rows, axis=1)  # NaN come last
    n = (~np.isnan(rows)).sum(axis=1)
    take = lambda i: np.take_along_axis(rows, np.maximum(i, 0)[:, None], axis=1)[:, 0]
    return (take((n - 1) // 2) + take(n // 2)) / 2


def departure(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How far each value leaves what lies before and after it in its series, if it does so for at most WIDTH values; else 0.

    The smaller of two measures: the distance from the levels on either side, and the height above the opening (depth below the
    closing) by a window of WIDTH + 1, which keeps every plateau wider than WIDTH. A level is the median of five or of seven values,
    whichever the value leaves further: seven outweigh another spike nearby, five a change of level soon after. Values that reach
    an end of the series have only one side and get 0."""
    if not len(x):
        return np.zeros(0)
    v, at = _spread(x, first)
    none = np.isnan(v)
    k = WIDTH + 1
    opened = _last(_last(np.where(none, np.inf, v), k, np.minimum)[::-1], k, np.maximum)[::-1]
    closed = _last(_last(np.where(none, -np.inf, v), k, np.maximum)[::-1], k, np.minimum)[::-1]
    up, down = v - opened, closed - v
    near = np.flatnonzero((up > 0) | (down > 0))  # only these can leave anything
    size = max(LEVELS)
    before, after = v[near[:, None] + np.arange(-size, 0)], v[near[:, None] + np.arange(1, size + 1)]
    above = np.full(len(near), -np.inf)
    below = above.copy()
    for level in LEVELS:
        b, a = _median(before[:, size - level :]), _median(after[:, :level])
        above = np.fmax(above, np.minimum(v[near] - b, v[near] - a))
        below = np.fmax(below, np.minimum(b - v[near], a - v[near]))
    far = np.zeros(len(v))
    far[near] = np.maximum(np.maximum(np.minimum(above, up[near]), np.minimum(below, down[near])), 0.0)
    return far[at]


def steps(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(move, step): the move to each value from the one before (NaN for the first), and the smaller of the greatest moves within WIDTH
    ticks there and back. What departs by d has a step of d / WIDTH at least."""
    move = np.full(len(x), np.nan)
    move[1:] = np.abs(np.diff(x))
    move[first] = np.nan
    v, at = _spread(move, first)
    v = np.where(np.isnan(v), -np.inf, v)
    there = _last(v, WIDTH, np.maximum)
    back = np.append(_last(v[::-1], WIDTH, np.maximum)[::-1][1:], -np.inf)
    return move, np.maximum(np.minimum(there, back), 0.0)[at]


def stuck(same: np.ndarray, run: int = RUN) -> np.ndarray:
    """same: whether each value equals the one before. True for all but the first of each run of `run` equal values or more."""
    starts = np.flatnonzero(~same)
    lengths = np.diff(np.append(starts, len(same)))
    return same & np.repeat(lengths >= run, lengths)


def _starts(groups: np.ndarray) -> np.ndarray:
    return np.append(True, groups[1:] != groups[:-1])[: len(groups)]


#: `series` is null for a row to be judged, else the row is a sketch: cells (hour, bucket) and counts of the series' moves.
JUDGED = "symbol string, day bigint, hour int, tick_id bigint, stuck boolean, " + ", ".join(f"far_{s} double, step_{s} double" for s in SERIES) + ", series string, cells array<bigint>, counts array<bigint>"
_CELL = 1_000_000


def bucket(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.ceil(np.log(x) / _LOG), ZERO).astype(np.int64)


def _judge(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
    """What the slots of `rows` show, each in order; `group` numbers them."""
    out = {}
    own, hour = rows["own"].to_numpy(bool), rows["hour"].to_numpy(np.int64)
    held = np.zeros(len(rows), bool)
    sketches = []
    for name in SERIES:
        v = rows[name].to_numpy(float)
        at = np.flatnonzero(~np.isnan(v))
        x, first = v[at], _starts(group[at])
        far, step = np.zeros(len(rows)), np.full(len(rows), np.nan)
        if len(x):
            far[at] = departure(x, first)
            move, step[at] = steps(x, first)
            if name == "price":
                held[at] |= stuck(np.append(False, x[1:] == x[:-1]) & ~first)
            counted = ~np.isnan(move) & own[at]
            cells, counts = np.unique(np.stack([group[at][counted], hour[at][counted] * _CELL + bucket(move[counted]) - ZERO]), axis=1, return_counts=True)
            cuts = np.flatnonzero(_starts(cells[0])) if cells.size else np.zeros(0, np.int64)
            where = np.searchsorted(group, cells[0][cuts])
            sketches.append(pd.DataFrame({
                "symbol": rows["symbol"].to_numpy()[where], "day": rows["day"].to_numpy()[where], "series": name,
                "cells": np.split(cells[1], cuts[1:]) if len(cuts) else [], "counts": np.split(counts, cuts[1:]) if len(cuts) else [],
            }))
        out[f"far_{name}"], out[f"step_{name}"] = np.where(far > 0, far, np.nan), np.where(far > 0, step, np.nan)
    bid, ask = rows["bid"].to_numpy(float), rows["ask"].to_numpy(float)
    at = np.flatnonzero(~(np.isnan(bid) | np.isnan(ask)))
    if len(at):
        held[at] |= stuck(np.append(False, (bid[at][1:] == bid[at][:-1]) & (ask[at][1:] == ask[at][:-1])) & ~_starts(group[at]))
    keep = own & (held | ~np.isnan(np.stack([out[f"far_{s}"] for s in SERIES])).all(axis=0))
    found = rows.loc[keep, ["symbol", "day", "hour", "tick_id"]].assign(stuck=held[keep], **{k: v[keep] for k, v in out.items()})
    out_ = pd.concat([found, *sketches], ignore_index=True).reindex(columns=[c.split()[0] for c in JUDGED.split(", ")])
    lists = {x: out_[x].astype(object).where(out_["series"].notna(), None) for x in ("series", "cells", "counts")}
    return out_.assign(**lists).astype({"hour": "Int32", "tick_id": "Int64", "stuck": "boolean"})


def _judge_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by symbol, day, slot and order; a slot that goes on in the next batch waits for it."""
    rest: list[pd.DataFrame] = []
    key = ["symbol", "day", "slot"]
    for part in batches:
        if part.empty:
            continue
        last = tuple(part[key].iloc[-1])
        if rest and last == tuple(rest[0][key].iloc[0]):
            rest.append(part)
            continue
        whole = pd.concat([*rest, part], ignore_index=True) if rest else part
        tail = ((whole["symbol"] == last[0]) & (whole["day"] == last[1]) & (whole["slot"] == last[2])).to_numpy()
        yield from _judge_each(whole[~tail], key)
        rest = [whole[tail]]
    if rest:
        yield from _judge_each(pd.concat(rest, ignore_index=True), key)


def _judge_each(rows: pd.DataFrame, key: list[str]) -> Iterator[pd.DataFrame]:
    if not rows.empty:
        yield _judge(rows.reset_index(drop=True), np.cumsum(np.logical_or.reduce([_starts(rows[k].to_numpy()) for k in key])))


def _hour(at: Column) -> Column:
    return F.pmod(div(at, 3_600_000), F.lit(24)).cast("int")


def judged(ticks: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """From the ticks of flag_ticks: a row for each tick that is stuck or departs at all, and the sketches of each day's moves."""
    c = F.col
    rows = ticks.where(c("symbol").isNotNull()).select(
        "symbol", div(c("event_ms"), DAY_MS).alias("day"), _hour(c("event_ms")).alias("hour"), "event_ms", period_start(c("event_ms")).alias("period"), "tick_id", *(F.when(~F.isnan(s), c(s)).alias(s) for s in SERIES)
    )
    placed = rows.join(slots(ticks.where(c("symbol").isNotNull()), slot_rows), ["symbol", "period"], "left")
    placed = placed.select("symbol", "day", F.coalesce("slot", F.lit(0)).alias("slot"), F.coalesce("own", F.lit(True)).alias("own"), "hour", "event_ms", "tick_id", *SERIES)
    key = ["symbol", "day", "slot"]
    return placed.repartition(*key).sortWithinPartitions(*key, "event_ms", "tick_id").mapInPandas(_judge_sorted, JUDGED)


def _value(at: Column) -> Column:
    """The middle of a bucket."""
    return F.when(at == ZERO, 0.0).otherwise(F.pow(F.lit(1.0 + ACCURACY), at - F.lit(0.5)))


def _bucket(x: Column) -> Column:
    return F.when(x > 0, F.ceil(F.log(x) / F.lit(_LOG))).otherwise(F.lit(ZERO)).cast("bigint")


def quantiles(sketch: DataFrame, keys: list[str], *shares: float) -> DataFrame:
    """keys, q0, q1 ...: the quantiles of a sketch with a row (keys, bucket, n) for each bucket: of an even number of values the middle of
    the two in question, as a median is."""
    counts = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    key = Window.partitionBy(*keys)
    run = key.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(*keys, _value(F.col("bucket")).alias("x"), F.sum("n").over(run).alias("upto"), F.sum("n").over(key).alias("all"))
    low = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("x")))
    high = lambda q: F.coalesce(F.min(F.when(F.col("upto") > F.col("all") * q, F.col("x"))), F.max("x"))
    return ranked.groupBy(*keys).agg(*(((low(q) + high(q)) / 2).alias(f"q{i}") for i, q in enumerate(shares)))


def _fence(low: str, high: str, fences: float) -> Column:
    return F.col(high) + F.lit(fences) * (F.col(high) - F.col(low))


def spikes(rows: DataFrame, moves: float = MOVES, fences: float = FENCES) -> DataFrame:
    """symbol, tick_id, kind (spike_price, spike_bid or spike_ask) from the table of `judged`."""
    c = F.col
    cells = rows.where(c("series").isNotNull()).select("symbol", "day", "series", F.explode(F.arrays_zip("cells", "counts")).alias("x"))
    sketch = cells.select("symbol", "day", "series", div(c("x.cells"), _CELL).cast("int").alias("hour"), (F.pmod(c("x.cells"), F.lit(_CELL)) + ZERO).alias("bucket"), c("x.counts").alias("n"))
    # The median; where that is 0 the lowest of three higher quantiles that isn't.
    daily = quantiles(sketch, ["symbol", "day", "series"], 0.5, 0.75, 0.9, 1.0)
    usual = F.coalesce(*(F.when(c(f"q{i}") > 0, c(f"q{i}")) for i in range(4)))
    daily = daily.select("symbol", "day", "series", usual.alias("usual"))
    relative = F.when(c("bucket") == ZERO, c("bucket")).otherwise(c("bucket") - _bucket(c("usual")))
    hourly = sketch.join(daily.where(c("usual").isNotNull()), ["symbol", "day", "series"]).select("symbol", "hour", "series", relative.alias("bucket"), "n")
    hourly = quantiles(hourly, ["symbol", "hour", "series"], 0.25, 0.75).select("symbol", "hour", "series", _fence("q0", "q1", fences).alias("fence"))
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("series"), c(f"far_{s}").alias("far"), c(f"step_{s}").alias("step")) for s in SERIES)))
    leaving = rows.where(c("series").isNull()).select("symbol", "day", "hour", "tick_id", each.alias("x")).select("symbol", "day", "hour", "tick_id", "x.*").where(c("far").isNotNull())
    tested = leaving.join(daily, ["symbol", "day", "series"]).where(c("far") > c("usual") * moves).join(hourly, ["symbol", "hour", "series"])
    return tested.where(c("step") > c("fence") * c("usual")).select("symbol", "tick_id", F.concat(F.lit("spike_"), "series").alias("kind"))


def great_volumes(ticks: DataFrame, volumes: float = VOLUMES, fences: float = FENCES) -> DataFrame:
    """symbol, tick_id, kind (spike_volume): volumes beyond the fence of their hour and beyond `volumes` times the symbol's median."""
    c = F.col
    known = ticks.where(c("volume").isNotNull()).select("symbol", _hour(c("event_ms")).alias("hour"), "tick_id", "volume")
    sketch = known.groupBy("symbol", "hour", _bucket(c("volume")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    usual = quantiles(sketch, ["symbol"], 0.5).select("symbol", (c("q0") * volumes).alias("most"))
    hourly = quantiles(sketch, ["symbol", "hour"], 0.25, 0.75).select("symbol", "hour", _fence("q0", "q1", fences).alias("fence"))
    limits = hourly.join(usual, "symbol").select("symbol", "hour", F.greatest("most", "fence").alias("limit"))
    return known.join(limits, ["symbol", "hour"]).where(c("volume") > c("limit")).select("symbol", "tick_id", F.lit("spike_volume").alias("kind"))


KINDS = ("impossible", "stuck", "spike_price", "spike_bid", "spike_ask", "spike_volume")


def flagged_ticks(ticks: DataFrame, moves: float = MOVES, volumes: float = VOLUMES, fences: float = FENCES, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """symbol, tick_id and a boolean for each of KINDS, for every tick with at least one. ticks: symbol, event_ms, tick_id, price, volume,
    bid, ask, as usable_ticks gives them, written out where they took work. Rows without a symbol take no part.

    A day whose median move is 0 takes a higher quantile; without any move nothing spikes. Null and NaN are no case by themselves."""
    c = F.col
    ticks = ticks.where(c("symbol").isNotNull())
    wrong = [(c(s) <= 0) & ~F.isnan(s) for s in SERIES] + [c("volume") < 0, (c("bid") > c("ask")) & ~F.isnan("bid")]
    impossible = ticks.where(F.greatest(*(F.coalesce(w, F.lit(False)) for w in wrong))).select("symbol", "tick_id", F.lit("impossible").alias("kind"))
    rows = materialise(judged(ticks, slot_rows), "judged-ticks")
    held = rows.where(c("stuck") & c("series").isNull()).select("symbol", "tick_id", F.lit("stuck").alias("kind"))
    parts = impossible.unionByName(held).unionByName(spikes(rows, moves, fences)).unionByName(great_volumes(ticks, volumes, fences))
    return parts.groupBy("symbol", "tick_id").agg(*(F.max(c("kind") == k).alias(k) for k in KINDS))


def flag_ticks(ticks: DataFrame, moves: float = MOVES, volumes: float = VOLUMES, fences: float = FENCES, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """symbol, tick_id, KINDS and flagged (any of them) for every tick with a symbol; see flagged_ticks."""
    found = flagged_ticks(ticks, moves, volumes, fences, slot_rows)
    both = ticks.where(F.col("symbol").isNotNull()).select("symbol", "tick_id").join(found, ["symbol", "tick_id"], "left")
    return both.select("symbol", "tick_id", *(F.coalesce(k, F.lit(False)).alias(k) for k in KINDS), F.col(KINDS[0]).isNotNull().alias("flagged"))

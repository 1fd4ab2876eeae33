"""Late and out-of-order events (problem 3): K-slack reordering.

An event waits in its partition's buffer until the partition's high mark (the greatest event time that has arrived) is `slack`
past it; then it is released in event order to the final aggregates. An event that arrives already further behind than that
can't be released in order any more and is too late. Until a period is final, provisional aggregates come from the buffer.

`KSlack` is the machine. `k_slack` replays stored rows through it: as a partition may hold a third of all rows, its arrivals are cut into
shards of time, and the machine of each shard starts with the mark that the shards before it left, which is an aggregate with one row
per shard. `streaming.stateful.k_slack_stream` runs the machine over a live stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.operators.ticks import PERIOD_MS, period_start
from tideglass.session import materialise

SLACK_MS = 900_000
SHARD_MS = 900_000
#: The mark before anything has arrived.
NONE = -(2**63) + 2**40


class KSlack:
    """One partition's marks and buffer. Arrivals come in order, some at a time; rows of one instant don't see each other, even if they
    come in two calls.

    high: the mark before the latest instant, which is complete; top: the greatest event of that instant so far. buffer: event, id, value
    and weight of the rows that aren't final yet, in the order of release. versions: how often each open period was published."""

    def __init__(self, slack: int = SLACK_MS, period: int = PERIOD_MS, high: int = NONE, top: int = NONE, instant: int = NONE):
        self.slack, self.period = slack, period
        self.high, self.top, self.instant = high, top, instant
        self.buffer = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        self.versions: dict[int, int] = {}

    def judge(self, arrival: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(mark, outcome) of rows in order of arrival: 0 on time, 1 corrects an ended period, 2 too late."""
        new = np.append(arrival[0] != self.instant, arrival[1:] != arrival[:-1])
        starts = np.flatnonzero(new)
        run = np.maximum.accumulate(event)
        before = np.where(starts > 0, run[starts - 1], NONE)
        marks = np.append(self.high, np.maximum(before, max(self.high, self.top)))
        mark = marks[np.cumsum(new)]
        if len(starts):
            self.high, self.instant, self.top = int(marks[-1]), int(arrival[-1]), int(event[starts[-1] :].max())
        else:
            self.top = max(self.top, int(event.max()))
        ended = event - event % self.period + self.period <= mark
        return mark, np.where(ended & (event < mark - self.slack), 2, np.where(ended, 1, 0))

    def push(self, arrival: np.ndarray, event: np.ndarray, id_: np.ndarray, value: np.ndarray, weight: np.ndarray) -> list[tuple]:
        """Takes arrivals in and returns what they publish: (period, kind, version, count, first, last, high, low, volume), where kind is
        `provisional` for a period that has ended or that a row came for since, `final` for one that no row can come for any more, and `too_late`,
        with a count only, for periods whose rows were turned away."""
        _, outcome = self.judge(arrival, event)
        kept = outcome < 2
        joined = [np.concatenate(x) for x in zip(self.buffer, (event[kept], id_[kept], value[kept], weight[kept]), strict=True)]
        order = np.lexsort((joined[2], joined[1], joined[0]))
        self.buffer = tuple(x[order] for x in joined)
        late, counts = np.unique(event[~kept] - event[~kept] % self.period, return_counts=True)
        touched = set((event[kept] - event[kept] % self.period).tolist())
        out = [(s, "too_late", None, n, None, None, None, None, None) for s, n in zip(late.tolist(), counts.tolist(), strict=True)]
        return out + self._publish(self.high - self.slack, touched)

    def take(self, arrival: np.ndarray, event: np.ndarray, id_: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(released, waiting): takes arrivals in and returns the values that are released in order now, and those that the buffer still holds."""
        _, outcome = self.judge(arrival, event)
        kept = outcome < 2
        joined = [np.concatenate(x) for x in zip(self.buffer, (event[kept], id_[kept], value[kept], np.zeros(int(kept.sum()), np.int64)), strict=True)]
        order = np.lexsort((joined[2], joined[1], joined[0]))
        joined = [x[order] for x in joined]
        cut = int(np.searchsorted(joined[0], self.high - self.slack))
        self.buffer = tuple(x[cut:] for x in joined)
        return joined[2][:cut], self.buffer[2]

    def flush(self) -> list[tuple]:
        """What is still open becomes final, as nothing more will come."""
        return self._publish(2**62, set())

    def _publish(self, closed: int, touched: set[int]) -> list[tuple]:
        """Periods that end by `closed` as final, and as provisional those that have ended and are in `touched` or weren't published yet."""
        event, id_, value, weight = self.buffer
        start = event - event % self.period
        out = []
        cuts = np.append(np.flatnonzero(np.append(True, start[1:] != start[:-1])[: len(start)]), len(start))
        keep = np.ones(len(start), bool)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            s = int(start[a])
            final = s + self.period <= closed
            if not final and not ((s in touched or s not in self.versions) and s + self.period <= max(self.high, self.top)):
                continue
            self.versions[s] = self.versions.get(s, 0) + 1
            known = value[a:b][~np.isnan(value[a:b])]
            ends = (float(known[0]), float(known[-1]), float(known.max()), float(known.min())) if len(known) else (None,) * 4
            out.append((s, "final" if final else "provisional", self.versions[s], int(b - a), *ends, int(weight[a:b].sum())))
            if final:
                keep[a:b] = False
                del self.versions[s]
        self.buffer = tuple(x[keep] for x in self.buffer)
        return out


OUTCOMES = ("on_time", "corrects", "too_late")


def _replay(key: str, event: str, arrival: str, slack: int, period: int):
    """Rows sorted by key, shard and arrival through one machine for each shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, current = None, None
        for rows in batches:
            if rows.empty:
                continue
            keys = pd.factorize(rows[key])[0]
            change = np.append(True, (keys[1:] != keys[:-1]) | (rows["__shard"].to_numpy()[1:] != rows["__shard"].to_numpy()[:-1]))
            cuts = np.append(np.flatnonzero(change), len(rows))
            at, came = rows[event].to_numpy(np.int64), rows[arrival].to_numpy(np.int64)
            mark, outcome = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                shard = (rows[key].iloc[a], rows["__shard"].iloc[a])
                if shard != current:
                    carried = rows["__carried"].iloc[a]
                    machine, current = KSlack(slack, period, NONE if pd.isna(carried) else int(carried)), shard
                mark[a:b], outcome[a:b] = machine.judge(came[a:b], at[a:b])
            marks = pd.Series(mark).astype("Int64").where(mark > NONE)
            yield rows.drop(columns=["__shard", "__carried"]).assign(high_mark=marks.to_numpy(), outcome=np.array(OUTCOMES, object)[outcome], period_start=at - at % period)

    return run


def k_slack(events: DataFrame, key: str, event: str, arrival: str, slack_ms: int = SLACK_MS, period_ms: int = PERIOD_MS, shard_ms: int = SHARD_MS) -> DataFrame:
    """events with high_mark (the greatest event time of its key among rows that arrived strictly earlier), period_start and outcome:
    `on_time` where the row's period was still open on arrival, `corrects` where it had ended at or before the high mark, `too_late`
    where the row is more than `slack_ms` behind it besides.

    Rows whose key, event or arrival is null take no part. Rows of one instant don't see each other. Columns of events with the
    names of the new ones are replaced. events are read twice: written out where they took work."""
    c = F.col
    known = events.drop("high_mark", "period_start", "outcome").where(c(key).isNotNull() & c(event).isNotNull() & c(arrival).isNotNull())
    known = known.withColumn("__shard", period_start(c(arrival), shard_ms))
    before = Window.partitionBy(key).orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = known.groupBy(key, "__shard").agg(F.max(event).alias("__top")).select(key, "__shard", F.max("__top").over(before).alias("__carried"))
    placed = known.join(shards, [key, "__shard"]).repartition(key, "__shard").sortWithinPartitions(key, "__shard", arrival)
    added = (T.StructField("high_mark", T.LongType()), T.StructField("outcome", T.StringType()), T.StructField("period_start", T.LongType()))
    fields = [f for f in placed.schema.fields if f.name not in ("__shard", "__carried")]
    return placed.mapInPandas(_replay(key, event, arrival, slack_ms, period_ms), T.StructType([*fields, *added]))


def period_aggregates(released: DataFrame, key: str, event: str, value: str, weight: str, tie: str) -> DataFrame:
    """From the rows of k_slack: for each key and period the provisional aggregates (of what had arrived while the period was
    open) and the final ones (corrected by late rows within the slack), with the rows of each outcome.

    first and last value are by event time, then `tie`, of rows whose value is neither null nor NaN; a null weight counts as 0."""
    counted = F.col("outcome") != "too_late"
    early = F.col("outcome") == "on_time"
    good = F.col(value).isNotNull() & ~F.isnan(value)
    order = F.struct(F.col(event), F.col(tie))
    cell = lambda keep: F.when(keep & good, F.col(value))
    place = lambda keep: F.when(keep & good, order)
    total = lambda keep: F.coalesce(F.sum(F.when(keep, F.col(weight))), F.lit(0)).cast("bigint")
    return released.groupBy(key, "period_start").agg(
        F.count_if(early).alias("provisional_count"),
        F.min_by(cell(early), place(early)).alias("provisional_first"),
        F.max_by(cell(early), place(early)).alias("provisional_last"),
        total(early).alias("provisional_volume"),
        F.count_if(F.col("outcome") == "corrects").alias("corrections"),
        F.count_if(~counted).alias("too_late"),
        F.count_if(counted).alias("final_count"),
        F.min_by(cell(counted), place(counted)).alias("final_first"),
        F.max_by(cell(counted), place(counted)).alias("final_last"),
        F.max(cell(counted)).alias("final_high"),
        F.min(cell(counted)).alias("final_low"),
        total(counted).alias("final_volume"),
    )

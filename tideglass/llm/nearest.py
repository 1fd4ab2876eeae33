"""Matching records by nearest time (problem 6): a stateful join of two streams in order of time.

`NearestJoin` is the machine: it buffers both sides of one entity, emits a left row once the watermark has passed its tolerance
horizon, when no nearer right row can come any more, and evicts right rows that no waiting or future left row can reach.

`nearest_in_time` runs it over stored tables: entities are cut into shards of time, so that a hot entity spreads over many tasks;
right rows within the tolerance of a shard's border also go to the neighbour, so that a left row is answered in its own shard alone. Each
task replays its shards in order of time through the machine. `nearest_stream` runs the same machine as a Structured Streaming operator.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import div
from tideglass.session import materialise

TOLERANCE_MS = 300_000
SHARD_MS = 3_600_000
_EMPTY = np.empty(0, np.int64)


class NearestJoin:
    """State of one entity. Times may come in any order as long as they aren't before the last watermark."""

    def __init__(self, tolerance: int = TOLERANCE_MS):
        self.tolerance = tolerance
        self.left_at, self.left_id = _EMPTY, _EMPTY
        self.right_at, self.right_id = _EMPTY, _EMPTY
        self.watermark = -(1 << 62)

    def push(self, left_at: np.ndarray, left_id: np.ndarray, right_at: np.ndarray, right_id: np.ndarray) -> None:
        if len(left_at):
            self.left_at, self.left_id = np.append(self.left_at, left_at), np.append(self.left_id, left_id)
        if len(right_at):
            at, ids = np.append(self.right_at, right_at), np.append(self.right_id, right_id)
            order = np.lexsort((ids, at))
            self.right_at, self.right_id = at[order], ids[order]

    def advance(self, watermark: int) -> tuple[np.ndarray, ...]:
        """left ids, right ids, right times and left times of the left rows that are done; left rows without match drop out."""
        self.watermark = max(self.watermark, watermark)
        done = self.left_at + self.tolerance < self.watermark
        at, ids = self.left_at[done], self.left_id[done]
        self.left_at, self.left_id = self.left_at[~done], self.left_id[~done]
        found = self._match(at, ids)
        reach = min(self.watermark, int(self.left_at.min()) if len(self.left_at) else self.watermark) - self.tolerance
        keep = np.searchsorted(self.right_at, reach, "left")
        self.right_at, self.right_id = self.right_at[keep:], self.right_id[keep:]
        return found

    def _match(self, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(self.right_at)
        if not n or not len(at):
            return _EMPTY, _EMPTY, _EMPTY, _EMPTY
        after = np.searchsorted(self.right_at, at, "left")  # first at or after: of equal times the smallest id
        before = np.searchsorted(self.right_at, self.right_at[np.maximum(after - 1, 0)], "left")
        far = np.int64(1) << 61
        d_after = np.where(after < n, self.right_at[np.minimum(after, n - 1)] - at, far)
        d_before = np.where(after > 0, at - self.right_at[before], far)
        pick = np.where(d_before <= d_after, before, np.minimum(after, n - 1))  # of two equally near the earlier
        ok = np.minimum(d_before, d_after) <= self.tolerance
        return ids[ok], self.right_id[pick[ok]], self.right_at[pick[ok]], at[ok]


def _replay(tolerance: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by entity, shard and time; the machine's state goes on from batch to batch."""
        key, join = None, NearestJoin(tolerance)
        end = np.int64(1) << 61

        def answer(found):
            return pd.DataFrame(dict(zip(("left_id", "right_id", "right_at", "left_at"), found, strict=True))) if len(found[0]) else None

        for part in batches:
            if part.empty:
                continue
            entity, shard = part["entity"].to_numpy(), part["shard"].to_numpy()
            at, ids, is_left = part["at"].to_numpy(np.int64), part["id"].to_numpy(np.int64), part["is_left"].to_numpy(bool)
            change = np.flatnonzero((entity[1:] != entity[:-1]) | (shard[1:] != shard[:-1])) + 1
            out = []
            for a, b in zip([0, *change], [*change, len(part)], strict=True):
                if (entity[a], shard[a]) != key:
                    out.append(answer(join.advance(end)))
                    key, join = (entity[a], shard[a]), NearestJoin(tolerance)
                left = is_left[a:b]
                join.push(at[a:b][left], ids[a:b][left], at[a:b][~left], ids[a:b][~left])
                out.append(answer(join.advance(int(at[b - 1]))))
            out = [x for x in out if x is not None]
            if out:
                yield pd.concat(out, ignore_index=True)
        last = answer(join.advance(end))
        if last is not None:
            yield last

    return run


def nearest_in_time(left: DataFrame, right: DataFrame, tolerance_ms: int = TOLERANCE_MS, shard_ms: int = SHARD_MS) -> DataFrame:
    """left_id, right_id, right_at: each row of left (entity, at, id) with the row of right of the same entity nearest in time, at
    most tolerance_ms away; of two equally near the earlier, at equal time the smaller id. Left rows without one don't come out.

    Rows with a null entity or time match nothing. Ids are bigint; a left id that occurs more than once comes out once."""
    c = F.col
    known = c("entity").isNotNull() & c("at").isNotNull() & c("id").isNotNull()
    left = materialise(left.select("entity", "at", "id").where(known), "nearest-left")  # two branches use it
    home, first, last = div(c("at"), shard_ms), div(c("at") - tolerance_ms, shard_ms), div(c("at") + tolerance_ms, shard_ms)
    lefts = left.select("entity", home.alias("shard"), "at", "id", F.lit(True).alias("is_left"))
    rights = right.where(known).select("entity", F.explode(F.sequence(first, last)).alias("shard"), "at", "id", F.lit(False).alias("is_left"))
    # Shards without a left row can't answer anything: their right rows stay where they are.
    asked = lefts.select("entity", "shard").distinct()
    both = lefts.unionByName(rights.join(asked, ["entity", "shard"], "left_semi"))
    sorted_ = both.repartition("entity", "shard").sortWithinPartitions("entity", "shard", "at")
    found = sorted_.mapInPandas(_replay(tolerance_ms), "left_id bigint, right_id bigint, right_at bigint, left_at bigint")
    best = Window.partitionBy("left_id").orderBy(F.abs(c("right_at") - c("left_at")), "right_at", "right_id")  # for ids that occur more than once
    return found.withColumn("rank", F.row_number().over(best)).where(c("rank") == 1).select("left_id", "right_id", "right_at")


def nearest_stream(events: DataFrame, tolerance_ms: int = TOLERANCE_MS, delay: str = "15 minutes") -> DataFrame:
    """The same join over a stream of both sides: events has entity, at (epoch ms), id, is_left. Rows later than `delay` behind
    the greatest time seen are dropped. State is kept per entity, as two buffers bounded by delay and tolerance."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        join = pickle.loads(state.get[0]) if state.exists else NearestJoin(tolerance_ms)
        if not state.hasTimedOut:
            for part in parts:
                left = part["is_left"].to_numpy(bool)
                at, ids = part["at"].to_numpy(np.int64), part["id"].to_numpy(np.int64)
                join.push(at[left], ids[left], at[~left], ids[~left])
        mark = state.getCurrentWatermarkMs()
        found = join.advance(mark)
        if len(join.left_at) or len(join.right_at):
            state.update((pickle.dumps(join),))
            waits = [int(x.min()) + tolerance_ms for x in (join.left_at, join.right_at) if len(x)]
            state.setTimeoutTimestamp(max(mark, min(waits)) + 1)
        else:
            state.remove()
        yield pd.DataFrame({"entity": key[0], "left_id": found[0], "right_id": found[1], "right_at": found[2]})

    kind = events.schema["entity"].dataType.simpleString()
    marked = events.withColumn("__at", F.timestamp_millis("at")).withWatermark("__at", delay)
    out = f"entity {kind}, left_id bigint, right_id bigint, right_at bigint"
    return marked.groupBy("entity").applyInPandasWithState(step, out, "machine binary", "append", GroupStateTimeout.EventTimeTimeout)

"""Filling containers of fixed capacity with items of varying length (problem 9): minimum bin slack.

Items are spread over shards of bounded size by a hash of their key. A shard is reduced to how many items remain of each length.
For each container the longest remaining item is taken and the rest of the window filled by the multiset of remaining lengths
that comes closest to the capacity: sums that can be reached are the bits of an integer, one shift-and-or for each number of
copies, and the counts are found by going back through the stages. A choice is repeated while its lengths last.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.session import materialise

CAPACITY = 2048
#: Tokens and items that a shard has on average, at most. A shard leaves one container less than full, some 0.1 % of its space.
SHARD_CONTAINERS = 2048
SHARD_ITEMS = 500_000


def closest(room: int, lengths: list[int], left: dict[int, int]) -> list[tuple[int, int]]:
    """(length, copies) of the multiset of remaining items whose sum comes closest to `room` without exceeding it.

    Lengths are tried from the longest; the search ends when the room can be filled exactly."""
    mask, reach = (1 << (room + 1)) - 1, 1
    stages: list[tuple[int, int, int]] = []  # length, copies at once, sums before
    full = 1 << room
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        copies, step = min(left[length], room // length), 1
        while copies > 0:
            take = min(step, copies)
            stages.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            copies -= take
            step *= 2
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(stages):
        if not (before >> total) & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return list(chosen.items())


def fill(counts: dict[int, int], capacity: int = CAPACITY) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """(pattern, times): containers that hold the pattern's (length, copies), until no item is left. Lengths are 1 to capacity."""
    left = {n: k for n, k in counts.items() if k > 0}
    lengths = sorted(left)
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        pattern = dict(closest(capacity - longest, lengths if left[longest] else lengths[:-1], left))
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                lengths.remove(n)
        yield sorted(pattern.items(), reverse=True), times


def _pack_shard(capacity: int, key: str):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", key, "piece"], kind="stable", ignore_index=True)
        sizes = part["n_tokens"].to_numpy()
        values, starts, counts = np.unique(sizes, return_index=True, return_counts=True)
        nexts = dict(zip(values.tolist(), starts.tolist(), strict=True))
        number = np.zeros(len(part), np.int64)
        container = 0
        for pattern, times in fill(dict(zip(values.tolist(), counts.tolist(), strict=True)), capacity):
            for n, k in pattern:
                a = nexts[n]
                number[a : a + k * times] = container + np.arange(k * times) // k
                nexts[n] = a + k * times
            container += times
        return part.assign(container_id=part["shard"].to_numpy() * (1 << 32) + number).drop(columns="shard")

    return run


def pack(items: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """key, piece, first_token, n_tokens, container_id: every item, whole in one container; an item longer than the capacity is
    cut to pieces of the capacity and a rest. Containers hold no more than the capacity.

    Items of size 0 (or null) take no space; they go to the first container of their shard. Rows of one key are items of their own.
    A shard holds whole pieces of bounded number and total size, whatever the keys."""
    c = F.col
    items = materialise(items.select(key, F.coalesce(size, F.lit(0)).cast("bigint").alias("n_tokens")), "item-sizes")
    # How many shards there are is a figure of the whole table: one row.
    rest = F.pmod(c("n_tokens"), F.lit(capacity))
    shards = items.agg(F.coalesce(F.ceil(F.greatest(F.sum(rest) / (capacity * SHARD_CONTAINERS), F.count(F.lit(1)) / SHARD_ITEMS)), F.lit(1)).alias("n"))
    n = max(1, int(shards.first()["n"]))
    # Row numbers of a written table are the same in every attempt; with them copies of one key spread over the shards.
    placed = items.withColumn("shard", F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(n)))
    whole = F.call_function("div", c("n_tokens"), F.lit(capacity).cast("bigint"))
    cut = placed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when((rest > 0) | (whole == 0), whole).otherwise(whole - 1))))
    cut = cut.select(key, c("piece").cast("int").alias("piece"), (c("piece") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), c("n_tokens") - c("piece") * capacity).alias("n_tokens"), "shard")
    kind = items.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, first_token bigint, piece int, n_tokens bigint, container_id bigint"
    # Full pieces are containers as they are and don't travel; numbers from 2^62 on keep them apart from the shards' containers.
    names = [key, "piece", "first_token", "n_tokens", "container_id"]
    full = cut.where(c("n_tokens") == capacity).withColumn("container_id", F.lit(1 << 62) + F.monotonically_increasing_id())
    empty = cut.where(c("n_tokens") == 0).withColumn("container_id", c("shard") * F.lit(1 << 32))
    open_ = cut.where((c("n_tokens") > 0) & (c("n_tokens") < capacity)).select(key, "first_token", "piece", "n_tokens", "shard")
    packed = open_.groupBy("shard").applyInPandas(_pack_shard(capacity, key), columns)
    return packed.select(*names).unionByName(full.select(*names)).unionByName(empty.select(*names))

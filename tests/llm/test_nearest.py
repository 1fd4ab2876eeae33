from __future__ import annotations

import random

import numpy as np

from tideglass.llm.nearest import NearestJoin, nearest_in_time, nearest_stream

SIDE = "entity string, at bigint, id bigint"


def sides(n, seed):
    r = random.Random(seed)
    left = [(r.choice("AB"), r.randrange(0, 5_000) * 1000, i) for i in range(n)]
    right = [(r.choice("AB"), r.randrange(0, 5_000) * 1000, 10_000 + i) for i in range(4 * n)]
    return left, right


def slow(left, right, tolerance):
    out = {}
    for e, t, i in left:
        best = min(((abs(b - t), b, j) for f, b, j in right if f == e and b is not None and t is not None and abs(b - t) <= tolerance), default=None)
        if best:
            out[i] = best[2]
    return out


def test_equals_brute_force(spark):
    for seed, shard in ((0, 3_600_000), (1, 60_000), (2, 7_000)):
        left, right = sides(150, seed)
        got = nearest_in_time(spark.createDataFrame(left, SIDE), spark.createDataFrame(right, SIDE), 9_000, shard)
        assert {r.left_id: r.right_id for r in got.collect()} == slow(left, right, 9_000)


def test_ties_edges_nulls_and_empty(spark):
    left = [("A", 1000, 1), ("A", 5000, 2), ("A", 9000, 3), (None, 1000, 4), ("A", None, 5), ("Z", 1000, 6)]
    right = [("A", 500, 12), ("A", 1500, 11), ("A", 5000, 14), ("A", 5000, 13), ("A", 9300, 15), (None, 1000, 16), ("A", None, 17)]
    l_, r_ = spark.createDataFrame(left, SIDE).selectExpr("*", "1 AS shard"), spark.createDataFrame(right, SIDE).selectExpr("*", "'x' AS is_left")
    assert {r.left_id: r.right_id for r in nearest_in_time(l_, r_, 500).collect()} == {1: 12, 2: 13, 3: 15}
    assert {r.left_id for r in nearest_in_time(l_, r_, 299).collect()} == {2}
    assert nearest_in_time(l_.limit(0), r_).collect() == [] and nearest_in_time(l_, r_.limit(0)).collect() == []


def test_repeated_left_rows_come_once(spark):
    df = spark.createDataFrame([("A", 1000, 1), ("A", 1000, 1)], SIDE)
    assert nearest_in_time(df, spark.createDataFrame([("A", 1001, 2)], SIDE)).count() == 1


def test_machine_emits_after_horizon_and_evicts():
    j = NearestJoin(10)
    one = lambda *x: np.array(x, np.int64)
    none = one()
    j.push(one(100), one(1), one(95, 50), one(7, 8))
    assert len(j.advance(110)[0]) == 0 and j.right_at.tolist() == [95]  # 50 can't be reached any more
    j.push(none, none, one(102), one(9))
    ids, found, *_ = j.advance(111)
    assert ids.tolist() == [1] and found.tolist() == [9] and len(j.left_at) == 0
    j.advance(200)
    assert len(j.right_at) == 0


def test_stream_equals_batch(spark, tmp_path):
    left, right = sides(60, 9)
    rows = sorted([(*x, True) for x in left] + [(*x, False) for x in right], key=lambda x: x[1])
    rows.append(("A", 50_000_000, 99_999, False))  # moves the watermark past everything
    schema = f"{SIDE}, is_left boolean"
    for i in range(0, len(rows), 80):
        spark.createDataFrame(rows[i : i + 80], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    from tideglass.streaming.sinks import to_table

    stream = spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = to_table(nearest_stream(stream, 9_000, "1 seconds"), "append").collect()
    assert {r.left_id: r.right_id for r in got} == slow(left, right, 9_000) and len(got) == len(slow(left, right, 9_000))

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from tideglass.sources.market import TICK_CSV, csv_replay, replay_steps, table_stream
from tideglass.streaming import sinks, stateful

T0 = 1_757_338_200_000


def write_batches(spark, path, rows, schema, n=3):
    for i in range(n):
        spark.createDataFrame(rows[i::n], schema).coalesce(1).write.mode("append").parquet(f"{path}/ticks.parquet")


SCHEMA = "symbol string, event_ms bigint, tick_id bigint, price double, volume bigint, partition int, time bigint"


def ticks(n=90):
    r = random.Random(0)
    return [(r.choice("AB"), T0 + i * 1000, i, float(r.randrange(90, 110)), r.choice([1, None]), i % 2, T0 + i * 1000) for i in range(n)]


def test_changelog_over_several_batches(spark, tmp_path):
    rows = ticks()
    write_batches(spark, tmp_path, rows, SCHEMA)
    schema = spark.createDataFrame([], SCHEMA).schema
    out = sinks.to_table(stateful.stats_changelog(table_stream(spark, str(tmp_path), "ticks", schema, 1))).collect()
    assert len({r.batch for r in out}) == 3 and sum(r["diff"] for r in out) == 2
    net = {}
    for r in out:
        k = (r.symbol, r["count"], r.avg_price, r.max_price, r.min_price, r.total_volume)
        net[k] = net.get(k, 0) + r["diff"]
    want = {(s, len(x), round(sum(x) / len(x), 6), max(x), min(x), sum(v or 0 for t, _, _, _, v, _, _ in rows if t == s)) for s in "AB" if (x := [p for t, _, _, p, *_ in rows if t == s])}
    assert {k for k, v in net.items() if v} == want


def test_stateful_ema_in_event_order(spark, tmp_path):
    rows = ticks()
    r = random.Random(3)  # events up to five minutes behind their arrival, over four batches
    rows = [(s, e - r.choice([0, 0, 300_000]), i, p, v, k, t) for s, e, i, p, v, k, t in rows]
    replay_steps(spark.createDataFrame(rows, SCHEMA), "time", f"{tmp_path}/ticks.parquet", 4)
    schema = spark.createDataFrame([], SCHEMA).schema
    out = sinks.to_table(stateful.stream_ema(table_stream(spark, str(tmp_path), "ticks", schema, 1))).collect()
    assert len({r.batch for r in out}) == 4
    last = {}
    for r in sorted(out, key=lambda r: r.batch):
        last[r.symbol] = r.ema_12
    for s in "AB":
        e = None
        for p in (x[3] for x in sorted(rows, key=lambda x: (x[1], x[2])) if x[0] == s):
            e = p if e is None else p * (2 / 13) + e * (1 - 2 / 13)
        assert abs(last[s] - e) < 1e-9


def test_k_slack_stream_over_batches_and_its_end(spark, tmp_path):
    rows = [("A", T0 + i * 30_000, i, 1.0 + i, 1, 0, T0 + i * 30_000 // 60_000 * 60_000 + 60_000) for i in range(200)]
    rows.append(("A", T0, 999, 5.0, 1, 0, T0 + 6_100_000))  # far too late
    replay_steps(spark.createDataFrame(rows, SCHEMA), "time", f"{tmp_path}/ticks.parquet", 11)
    schema = spark.createDataFrame([], SCHEMA).schema
    place = f"{tmp_path}/checkpoint"
    out = sinks.to_table(stateful.k_slack_stream(table_stream(spark, str(tmp_path), "ticks", schema, 1)), checkpoint=place)
    assert out.select("batch").distinct().count() >= 10
    final = {r.period_start: r for r in out.drop("batch").unionByName(stateful.open_periods(spark, place)).where("kind = 'final'").collect()}
    assert sum(r["count"] for r in final.values()) == 200
    for s, r in final.items():
        inside = [x for x in rows[:200] if s <= x[1] < s + 300_000]
        assert (r["count"], r["first"], r["last"]) == (len(inside), inside[0][3], inside[-1][3])
    assert [(r.period_start, r["count"]) for r in out.where("kind = 'too_late'").collect()] == [(T0 - T0 % 300_000, 1)]
    assert out.where("kind = 'provisional'").count() > 0


def test_idle_partitions_give_up_their_periods(spark, tmp_path):
    rows = [("A", T0 + i * 30_000, i, 1.0, 1, 0, T0 + i * 30_000) for i in range(60)]
    write_batches(spark, tmp_path, rows, SCHEMA, 1)
    stream = stateful.k_slack_stream(table_stream(spark, str(tmp_path), "ticks", spark.createDataFrame([], SCHEMA).schema, 1), idle_ms=500)
    seen = []
    q = sinks.run_every(stream, lambda rows, batch: seen.extend(rows.where("kind = 'final'").collect()), "1 second")
    until = time.time() + 60
    while sum(r["count"] for r in seen) < 60 and time.time() < until:
        time.sleep(0.5)
    q.stop()
    assert sum(r["count"] for r in seen) == 60


def test_upserts_replace_and_go_on_after_a_restart(spark, tmp_path):
    shape = "k string, v int, t int"
    sinks.UpsertTable(spark, str(tmp_path), ["k"], "t")(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], shape), 0)
    again = sinks.UpsertTable(spark, str(tmp_path), ["k"], "t")  # a new object, as after a restart
    again(spark.createDataFrame([("b", 2, 2), ("c", 2, 1)], shape), 1)
    again(spark.createDataFrame([("b", 9, 9)], shape), 1)  # a batch that was committed isn't applied again
    again(spark.createDataFrame([], shape), 2)
    again(spark.createDataFrame([("c", 0, 0)], shape), 3)  # older than what stands
    rows = {(r.k, r.v) for r in sinks.UpsertTable(spark, str(tmp_path), ["k"], "t").read().collect()}
    assert rows == {("a", 1), ("b", 2), ("c", 2)}
    empty = sinks.UpsertTable(spark, f"{tmp_path}/new", ["k"], "t")
    assert empty.read(shape).collect() == [] and empty.committed() == (-1, {})


def test_a_stream_by_the_clock(spark, tmp_path):
    write_batches(spark, tmp_path, ticks(), SCHEMA, 2)
    seen = []
    q = sinks.run_every(table_stream(spark, str(tmp_path), "ticks", spark.createDataFrame([], SCHEMA).schema, 1), lambda rows, batch: seen.append(rows.count()), "1 second", "append")
    until = time.time() + 60
    while sum(seen) < 90 and time.time() < until:
        time.sleep(0.5)
    q.stop()
    assert sum(seen) == 90


def test_csv_replay_and_event_files(spark, tmp_path):
    spark.createDataFrame([(T0, "A", 1.0, 5, 1.0, 1.0, 1.0, 1.0, 1.0, T0, 1)], TICK_CSV).write.option("header", True).csv(f"{tmp_path}/in")
    stream = csv_replay(spark, f"{tmp_path}/in").withColumn("event_time", F.timestamp_millis("timestamp"))
    sinks.run_available(stream, sinks.event_files(f"{tmp_path}/out"), "append")
    back = spark.read.json(f"{tmp_path}/out").collect()
    assert len(back) == 1 and str(back[0].day) == "20250908" and back[0].key == "A"
    sinks.run_available(csv_replay(spark, f"{tmp_path}/in"), sinks.changelog_files(f"{tmp_path}/log", "csv"), "append")
    assert spark.read.option("header", True).csv(f"{tmp_path}/log").count() == 1


def test_kafka_rows(spark):
    r = sinks.kafka_rows(spark.createDataFrame([("MSFT", 1.5)], "symbol string, price double"), "stocks").first()
    assert (r.key, r.value, r.partition, r.topic) == ("MSFT", '{"symbol":"MSFT","price":1.5}', 0, "stocks")

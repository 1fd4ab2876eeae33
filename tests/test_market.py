from __future__ import annotations

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideglass.functions import indicators as ind
from tideglass.functions import scalars as f
from tideglass.operators import market as m

T0 = 1_757_338_200_000


def one(spark, values, expr):
    return spark.createDataFrame([(values,)], "v array<double>").select(expr(F.col("v")).alias("x")).first().x


def rsi(values):
    return ind.rsi_wilder_seeded(ind.steps_of(values))


def slow_rsi(v, n=14):
    g = low = 0.0
    for k, (a, b) in enumerate(zip(v, v[1:]), 1):
        up, down = max(b - a, 0), max(a - b, 0)
        if k <= n:
            g, low = g + up, low + down
            if k == n:
                g, low = g / n, low / n
        else:
            g, low = up / n + g * (1 - 1 / n), down / n + low * (1 - 1 / n)
    return 50.0 if len(v) - 1 < n else 100.0 if low == 0 else 100 - 100 / (1 + g / low)


def test_ema_published_value(spark):
    assert one(spark, [208.07, 208.23], lambda v: ind.ema(v, 6)) == 208.11571428571426
    assert one(spark, [], lambda v: ind.ema(v, 6)) == 0.0 and one(spark, [5.0], lambda v: ind.ema(v, 50)) == 5.0


def test_rsi_edges(spark):
    r = random.Random(1)
    for n in (1, 2, 14, 15, 16, 40):
        v = [round(100 + r.uniform(-1, 1), 2) for _ in range(n)]
        assert math.isclose(one(spark, v, rsi), slow_rsi(v), rel_tol=1e-12)
    up = [float(x) for x in range(20)]
    assert one(spark, up, rsi) == 100.0 and one(spark, up, lambda v: ind.rsi_running(ind.steps_of(v))) == 50.0


def test_bounds(spark):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.floats(1, 1000), min_size=1, max_size=60))
    def check(v):
        e = one(spark, v, lambda x: ind.ema(x, 12))
        assert min(v) - 1e-9 <= e <= max(v) + 1e-9
        assert 0 <= one(spark, v, rsi) <= 100

    check()


def plain_ema(v, n):
    e = v[0]
    for x in v[1:]:
        e = x * (2 / (n + 1)) + e * (1 - 2 / (n + 1))
    return e


def plain_signal(v):
    a = b = last = v[0]
    line, n, g, low, rs, before = 0.0, 0, 0.0, 0.0, [50.0], None
    for p in v[1:]:
        before = a - b
        a, b = p * (2 / 13) + a * (1 - 2 / 13), p * (2 / 27) + b * (1 - 2 / 27)
        line = (a - b) * 0.2 + line * 0.8
        up, down, n = max(p - last, 0.0), max(last - p, 0.0), n + 1
        g, low = (g + up, low + down) if n < 14 else ((g + up) / 14, (low + down) / 14) if n == 14 else (up / 14 + g * 13 / 14, down / 14 + low * 13 / 14)
        rs.append(50.0 if n < 14 else 100.0 if low == 0 else 100 - 100 / (1 + g / low))
        last = p
    return a - b, before, line, sum(rs[-5:]) / 5 if len(rs) >= 5 else 0.0


def test_pieces_equal_plain_loops(spark):
    """Shards of every size around the seeds, one long shard, and a flat end that a cut history would get wrong."""
    r = random.Random(2)
    for n, shard, gap in ((1, 1000, 1), (4, 1000, 1), (16, 7, 1), (20, 20, 1), (21, 21, 1), (60, 17, 1), (400, 40, 1), (400, 3_600_000, 1), (5000, 50_000, 37)):
        v, p = [], 100.0
        for i in range(n):
            p += r.uniform(-1, 1) if i < n * 0.6 else 0.0 if i < n * 0.9 else r.choice([0.0, 0.01])
            v.append(("A", T0 + i * gap, i, p))
        r.shuffle(v)
        df = spark.createDataFrame(v, "symbol string, event_ms bigint, tick_id bigint, price double")
        s = F.col("series")
        pieces = ind.pieces(df, "symbol", ("event_ms", "tick_id"), "price", (12, 26, 50, 200), rsi=True, signal=True, shard_ms=shard)
        got = pieces.select(ind.long_ema(s, 50).alias("e50"), ind.long_ema(s, 200).alias("e200"), ind.rsi_wilder_seeded(s).alias("rsi"), ind.signal_series(s).alias("x")).first()
        plain = [x[3] for x in sorted(v)]
        close = lambda a, b: (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-10)
        assert close(got.e50, plain_ema(plain, 50)) and close(got.e200, plain_ema(plain, 200)) and close(got.rsi, slow_rsi(plain)), (n, shard)
        assert all(map(close, got.x, plain_signal(plain))), (n, shard, got.x, plain_signal(plain))


def test_long_series_in_one_hour_and_over_many(spark):
    n = 100_000
    v = [("A", T0 + i * 36, i, 100 + math.sin(i / 700) * 3 + (i * 7919 % 101) / 50) for i in range(n)]
    df = spark.createDataFrame(v, "symbol string, event_ms bigint, tick_id bigint, price double")
    got = m.tick_pieces(df, 50, 200, 3000).select(*(ind.long_ema(F.col("series"), k).alias(f"e{k}") for k in (50, 200, 3000))).first()
    for k in (50, 200, 3000):
        assert math.isclose(got[f"e{k}"], plain_ema([x[3] for x in v], k), rel_tol=1e-12)


def test_small_prices_keep_their_digits(spark):
    rows = [("A", T0, 1, 0.00001234, 3), ("A", T0 + 1, 2, 1.08765432, 1), ("A", T0 + 2, 3, 1.08765432, 2), ("B", T0, 4, 1e20, 1), ("B", T0, 5, 1.0, None)]
    df = spark.createDataFrame(rows, "symbol string, event_ms bigint, tick_id bigint, price double, volume bigint")
    got = {r.symbol: r.avg_price for r in m.stats(df).collect()}
    assert got == {"A": (0.00001234 + 2 * 1.08765432) / 3, "B": (1e20 + 1) / 2}
    w = {r.tick_id: (r.sma, r.vwap) for r in m.trailing(df).collect()}
    assert w[1] == (0.00001234, 0.00001234) and w[2][0] == (0.00001234 + 1.08765432) / 2 and math.isclose(w[3][1], (3 * 0.00001234 + 3 * 1.08765432) / 6, rel_tol=1e-15) and w[4][0] == (1e20 + 1) / 2
    assert {r.avg_price for r in m.sliding_rollup(df).where("symbol = 'A'").collect()} == {(0.00001234 + 2 * 1.08765432) / 3}


def test_trading_engine(spark):
    days = [(10.0, -1), (20.0, 1), (30.0, 1), (40.0, -1), (50.0, 0), (50.0, 1)]
    df = spark.createDataFrame([([{"price": p, "state": s} for p, s in days],)], "d array<struct<price:double,state:int>>")
    t = df.select(ind.trading_state(F.col("d")).alias("t")).first().t
    assert (t.cash, t.position, t.trades, list(t.log)) == (0.0, 400.0, 3, ["BUY@20.00", "SELL@40.00", "BUY@50.00"])


def test_md5_partition_published(spark):
    df = spark.createDataFrame([(x,) for x in ("MSFT", "NVDA", "AMZN", "GOOGL", None)], "s string")
    assert [r.p for r in df.select(f.md5_partition(F.col("s"), 3).alias("p")).collect()] == [0, 0, 0, 0, None]


def test_nan_is_null(spark):
    r = m.enrich(spark.createDataFrame([(T0, float("nan"), 1.0, 2.0, 1.0)], "event_ms bigint, bid double, ask double, high double, low double")).first()
    assert (r.bid, r.spread, r.mid_price, r.price_range) == (None, None, None, 1.0)


def test_enrich_published_and_null(spark):
    schema = "event_ms bigint, bid double, ask double, high double, low double"
    rows = m.enrich(spark.createDataFrame([(T0, 518.49, 519.5, 2.0, 1.0), (T0, None, 1.0, None, 1.0)], schema)).collect()
    assert (rows[0].spread, rows[0].mid_price, rows[0].price_range) == (1.009999999999991, 518.995, 1.0)
    assert (rows[1].spread, rows[1].price_range) == (None, None)


def test_trailing_window_has_its_lower_edge(spark):
    df = spark.createDataFrame([("A", T0, 1, 1.0, 1), ("A", T0 + 300_000, 2, 3.0, None), ("A", T0 + 300_001, 3, 5.0, 0), ("A", T0 + 3_900_000, 4, 7.0, 2)], "symbol string, event_ms bigint, tick_id bigint, price double, volume bigint")
    for shard in (3_600_000, 400_000, 301_000):
        got = {r.tick_id: (r.sma, r.vwap) for r in m.trailing(df, shard_ms=shard).collect()}
        assert got == {1: (1.0, 1.0), 2: (2.0, 1.0), 3: (4.0, 0.0), 4: (7.0, 7.0)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "symbol string, event_ms bigint, tick_id bigint, price double, volume bigint, high double, low double, bid double, ask double")
    for out in (m.stats(df), m.latest(df), m.changes(df), m.trailing(df), m.sliding_rollup(df), m.features(df), m.features(df, "reference"), m.portfolio(m.daily_bars(df)), m.sharpe(m.daily_bars(df)), m.leaderboard(m.changes(df), "volume")):
        assert out.collect() == []
    assert m.breadth(m.changes(df)).first().total_volume == 0


def test_scalars(spark):
    df = spark.createDataFrame([("10/01/2025", "12.0", "crypto news", 1234567.0), ("2025-10-01", "x", None, 12.0), ("13/45/2025", "1,000", "Forex", 1e10)], "d string, n string, c string, x double")
    got = df.select(f.plain_date(F.col("d")), f.whole_number(F.col("n")), f.topic_of(F.col("c")), f.human_number(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [("2025-10-01", 12, "news-crypto", "$1.23M"), ("2025-10-01", None, "news-stocks", "$12.00"), ("13/45/2025", None, "news-forex", "$10.00B")]

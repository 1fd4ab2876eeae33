"""Indicators as folds over ordered arrays, in JVM expressions.

The array of a key comes from `pieces`, which is exact for any length: a key's rows are cut into shards of time, and of each shard
the first HEAD and the last TAIL values stay as they are, while all between them become one element of sums. EMA, Wilder's smoothing and
the signal line are affine maps of their state, so a run of values is a power and a sum, whatever came before. A hot key thus costs
a few dozen numbers for each shard, and its rows are summed in as many tasks as it has shards. Bars are as many as the calendar has days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import div

#: Values that stay at both ends of a shard: those that seed a mean over 14 changes, and those that a mean of the last five takes.
HEAD, TAIL = 15, 5
SHARD_MS = 3_600_000
RSI_N = 14
SIGNAL = (12, 26, 9)


def recent(df: DataFrame, key: str, order: list[str], fields: list[str], keep: int | None = None) -> DataFrame:
    """key, series: the last `keep` rows of each key in `order` (all, where the calendar bounds them), as an array of structs of `fields`."""
    if keep:
        back = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
        df = df.withColumn("__r", F.row_number().over(back)).where(F.col("__r") <= keep)
    rows = F.collect_list(F.struct(*(F.col(c).alias(f"__o{i}") for i, c in enumerate(order)), *fields))
    return df.groupBy(key).agg(F.array_sort(rows).alias("series"))


def _power(base: float, k: Column) -> Column:
    return F.pow(F.lit(base), k)


def _lag_weight(n: int, back: Column) -> Column:
    """Weight in the signal line of a value `back` places before the end, through its EMA of n."""
    q, z = 1.0 - 2.0 / (n + 1), 1.0 - 2.0 / (SIGNAL[2] + 1)
    return (_power(q, back + 1) - _power(z, back + 1)) * F.lit((1.0 - z) * (1.0 - q) / (q - z))


def pieces(df: DataFrame, key: str, order: tuple[str, str], value: str, emas: tuple[int, ...] = (), rsi: bool = False, signal: bool = False, shard_ms: int = SHARD_MS) -> DataFrame:
    """key, series: each key's values in `order` (event time in ms, then a tie-breaker) as steps for `long_ema`, `long_rsi` and `signal_series`.

    A step is one value `p` (k = 0) or a run of k values with its last one and the sums that were asked for. Values are neither null nor NaN."""
    shard = div(F.col(order[0]), shard_ms)
    rows = df.select(key, shard.alias("__shard"), F.struct(*order).alias("__at"), F.col(value).cast("double").alias("__p"))
    whole = Window.partitionBy(key, "__shard")
    run = whole.orderBy("__at")
    rows = rows.select(key, "__shard", "__p", F.row_number().over(run).alias("__r"), F.count(F.lit(1)).over(whole).alias("__n"), F.lag("__p").over(run).alias("__q"))
    p, back = F.col("__p"), F.col("__n") - TAIL - F.col("__r")
    middle = (F.col("__r") > HEAD) & (back >= 0)
    total = lambda x: F.coalesce(F.sum(F.when(middle, x)), F.lit(0.0))
    sums = {f"e{n}": total(p * _power(1.0 - 2.0 / (n + 1), back) * F.lit(2.0 / (n + 1))) for n in emas}
    if rsi or signal:
        weight = _power(1.0 - 1.0 / RSI_N, back) * F.lit(1.0 / RSI_N)
        sums |= {"g": total(F.greatest(p - F.col("__q"), F.lit(0.0)) * weight), "l": total(F.greatest(F.col("__q") - p, F.lit(0.0)) * weight)}
    if signal:
        sums |= {"s": total(p * (_lag_weight(SIGNAL[0], back) - _lag_weight(SIGNAL[1], back)))}
    cut = rows.groupBy(key, "__shard").agg(
        F.array_sort(F.collect_list(F.when(~middle, F.struct("__r", "__p")))).alias("ends"), F.count_if(middle).alias("k"), F.max_by("__p", F.when(middle, F.col("__r"))).alias("last"), *(v.alias(n) for n, v in sums.items())
    )
    plain = lambda x: F.struct(x["__p"].alias("p"), F.lit(0).cast("bigint").alias("k"), *(F.lit(0.0).alias(n) for n in sums))
    run_ = F.struct(F.col("last").alias("p"), F.col("k"), *sums)
    head = F.transform(F.filter("ends", lambda x: x["__r"] <= HEAD), plain)
    tail = F.transform(F.filter("ends", lambda x: x["__r"] > HEAD), plain)
    steps = F.when(F.col("k") > 0, F.concat(head, F.array(run_), tail)).otherwise(F.concat(head, tail))
    shards = cut.select(key, F.struct(F.col("__shard").alias("at"), steps.alias("steps")).alias("x"))
    return shards.groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["steps"])).alias("series"))


def prices(series: Column, field: str = "price") -> Column:
    return F.transform(series, lambda x: x[field])


def _rest(values: Column) -> Column:
    return F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))


def ema(values: Column, n: int) -> Column:
    """Seeded by the first value; 0 for an empty series."""
    a = 2.0 / (n + 1)
    fold = F.aggregate(_rest(values), F.get(values, F.lit(0)), lambda e, p: p * F.lit(a) + e * F.lit(1.0 - a))
    return F.when(F.size(values) > 0, fold).otherwise(F.lit(0.0))


def long_ema(series: Column, n: int) -> Column:
    """The same over the steps of `pieces`, for an n of its `emas`."""
    a = 2.0 / (n + 1)
    step = lambda e, x: F.when(x["k"] == 0, x["p"] * F.lit(a) + e * F.lit(1.0 - a)).otherwise(e * _power(1.0 - a, x["k"]) + x[f"e{n}"])
    return F.when(F.size(series) > 0, F.aggregate(_rest(series), F.get(series, F.lit(0))["p"], step)).otherwise(F.lit(0.0))


def _gains(s: Column, p: Column) -> tuple[Column, Column]:
    return F.greatest(p - s["last"], F.lit(0.0)), F.greatest(s["last"] - p, F.lit(0.0))


def _strength(g: Column, low: Column, empty: float) -> Column:
    return F.when(low == 0, empty).otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / low))


def _seeded(s: Column, old: Column, x: Column, n: int) -> Column:
    """The mean of the first n changes, then smoothed by 1/n."""
    a = 1.0 / n
    return F.when(s["n"] < n - 1, old + x).when(s["n"] == n - 1, (old + x) / F.lit(float(n))).otherwise(x * F.lit(a) + old * F.lit(1.0 - a))


def _running(s: Column, old: Column, x: Column, n: int) -> Column:
    """A running mean while the count is below n, then smoothed by 1/n."""
    return F.when(s["n"] < n, (old * (s["n"] - 1) + x) / s["n"]).otherwise((old * F.lit(n - 1.0) + x) / F.lit(float(n)))


def _rsi(series: Column, n: int, rule: Callable[[Column, Column, Column, int], Column], start: int, finish: Callable[[Column], Column]) -> Column:
    zero = F.lit(0.0)
    first = F.struct(F.get(series, F.lit(0))["p"].alias("last"), zero.alias("g"), zero.alias("l"), F.lit(start).cast("bigint").alias("n"))

    def step(s: Column, x: Column) -> Column:
        up, down = _gains(s, x["p"])
        fade = _power(1.0 - 1.0 / n, x["k"])
        g = F.when(x["k"] == 0, rule(s, s["g"], up, n)).otherwise(s["g"] * fade + x["g"])
        low = F.when(x["k"] == 0, rule(s, s["l"], down, n)).otherwise(s["l"] * fade + x["l"])
        return F.struct(x["p"].alias("last"), g.alias("g"), low.alias("l"), (s["n"] + F.greatest(x["k"], F.lit(1))).alias("n"))

    return F.aggregate(_rest(series), first, step, finish)


def steps_of(values: Column) -> Column:
    """A plain array as steps."""
    return F.transform(values, lambda v: F.struct(v.alias("p"), F.lit(0).cast("bigint").alias("k"), F.lit(0.0).alias("g"), F.lit(0.0).alias("l"), F.lit(0.0).alias("s"), *(F.lit(0.0).alias(f"e{n}") for n in SIGNAL[:2])))


def rsi_wilder_seeded(series: Column) -> Column:
    """Over steps: the first 14 changes give means, later ones are smoothed by 1/14; 50 below 14 changes, 100 without losses."""
    return _rsi(series, RSI_N, _seeded, 0, lambda s: F.when(s["n"] < RSI_N, 50.0).otherwise(_strength(s["g"], s["l"], 100.0)))


def rsi_running(series: Column) -> Column:
    """Over steps: a running mean while the count is below 14, then smoothed; 50 below two values and without losses."""
    return _rsi(series, RSI_N, _running, 1, lambda s: F.when(s["n"] < 2, 50.0).otherwise(_strength(s["g"], s["l"], 50.0)))


def sma_last(values: Column, n: int = 5) -> Column:
    """Mean of the last n values; 0 below n."""
    tail = F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), F.lit(n))
    return F.when(F.size(values) >= n, F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.lit(float(n))).otherwise(F.lit(0.0))


def heikin_ashi_pair(bars: Column) -> Column:
    """struct(ha_open, ha_close) of the last bar: the first opens at its open, each later one at the mean of the pair before."""
    mean = lambda b: (b["open"] + b["high"] + b["low"] + b["close"]) / F.lit(4.0)
    head = F.get(bars, F.lit(0))
    first = F.struct(head["open"].alias("ha_open"), mean(head).alias("ha_close"))
    step = lambda s, b: F.struct(((s["ha_open"] + s["ha_close"]) / F.lit(2.0)).alias("ha_open"), mean(b).alias("ha_close"))
    return F.aggregate(_rest(bars), first, step)


def heiken_ashi_updated(bars: Column) -> Column:
    """struct(ha_open, ha_close, ha_high, ha_low) of the last bar: the pair starts at (open + close) / 2 and the mean, and the
    open that comes out is the mean of the pair after its update."""
    mean = lambda b: (b["open"] + b["high"] + b["low"] + b["close"]) / F.lit(4.0)
    head = F.get(bars, F.lit(0))
    first = F.struct(((head["open"] + head["close"]) / F.lit(2.0)).alias("o"), mean(head).alias("c"))
    pair = F.aggregate(_rest(bars), first, lambda s, b: F.struct(((s["o"] + s["c"]) / F.lit(2.0)).alias("o"), mean(b).alias("c")))
    last = F.get(bars, F.size(bars) - 1)
    opened = (pair["o"] + pair["c"]) / F.lit(2.0)
    return F.struct(opened.alias("ha_open"), pair["c"].alias("ha_close"), F.greatest(last["high"], opened, pair["c"]).alias("ha_high"), F.least(last["low"], opened, pair["c"]).alias("ha_low"))


def dmi(bars: Column, n: int) -> Column:
    """struct(plus_di, minus_di): Wilder's sums of directional moves over the true range; 0 and 0 below n moves."""
    head, zero = F.get(bars, F.lit(0)), F.lit(0.0)
    first = F.struct(head["high"].alias("h"), head["low"].alias("l"), head["close"].alias("c"), zero.alias("p"), zero.alias("m"), zero.alias("t"), F.lit(0).alias("n"))

    def step(s: Column, b: Column) -> Column:
        up, down = b["high"] - s["h"], s["l"] - b["low"]
        plus, minus = F.when((up > down) & (up > 0), up).otherwise(zero), F.when((down > up) & (down > 0), down).otherwise(zero)
        known = s["c"].isNotNull() & (s["c"] != 0)
        gap = lambda x: F.when(known, F.abs(x - s["c"])).otherwise(zero)
        true_range = F.greatest(b["high"] - b["low"], gap(b["high"]), gap(b["low"]))
        keep = F.when(s["n"] < n, 1.0).otherwise(1.0 - 1.0 / n)
        return F.struct(
            b["high"].alias("h"), b["low"].alias("l"), b["close"].alias("c"),
            (s["p"] * keep + plus).alias("p"), (s["m"] * keep + minus).alias("m"), (s["t"] * keep + true_range).alias("t"), (s["n"] + 1).alias("n"),
        )

    ready = lambda s, x: F.when((s["n"] >= n) & (s["t"] != 0), F.lit(100.0) * x / s["t"]).otherwise(zero)
    return F.aggregate(_rest(bars), first, step, lambda s: F.struct(ready(s, s["p"]).alias("plus_di"), ready(s, s["m"]).alias("minus_di")))


def aroon_oscillator(bars: Column, n: int = 25) -> Column:
    """Aroon up less Aroon down over the last n bars, by the first place of each extreme; 0 below two bars."""
    tail = F.slice(bars, F.greatest(F.size(bars) - (n - 1), F.lit(1)), F.lit(n))
    highs, lows = F.transform(tail, lambda b: b["high"]), F.transform(tail, lambda b: b["low"])
    since = lambda xs, at: F.size(xs) - F.array_position(xs, at)
    score = lambda xs, at: F.lit(100.0) * (F.lit(n) - since(xs, at)) / F.lit(float(n))
    return F.when(F.size(bars) < 2, 0.0).otherwise(score(highs, F.array_max(highs)) - score(lows, F.array_min(lows)))


def chaikin_volatility(bars: Column, n: int = 10) -> Column:
    """Change in percent of the EMA of high less low at the last bar; 0 for one bar or where the EMA before is 0."""
    a = 2.0 / (n + 1)
    spread = F.transform(bars, lambda b: b["high"] - b["low"])
    first = F.struct(F.get(spread, F.lit(0)).alias("e"), F.lit(0.0).alias("before"))
    step = lambda s, x: F.struct((x * F.lit(a) + s["e"] * F.lit(1.0 - a)).alias("e"), s["e"].alias("before"))
    return F.aggregate(_rest(spread), first, step, lambda s: F.when(s["before"] == 0, 0.0).otherwise(F.lit(100.0) * (s["e"] - s["before"]) / s["before"]))


def signal_series(series: Column) -> Column:
    """Over the steps of `pieces(signal=True, emas=(12, 26))`: struct(macd, macd_before, macd_signal, rsi_smoothed) at the last value: MACD there and one
    value earlier, EMA-9 over the series of MACD, and the mean of the last five RSI, 0 below five."""
    p0, zero = F.get(series, F.lit(0))["p"], F.lit(0.0)
    first = F.struct(p0.alias("a"), p0.alias("b"), zero.alias("s"), F.lit(None).cast("double").alias("m"), p0.alias("last"), zero.alias("g"), zero.alias("l"), F.lit(0).cast("bigint").alias("n"), F.array(F.lit(50.0)).alias("r"))
    alpha = [2.0 / (n + 1) for n in SIGNAL]
    z = 1.0 - alpha[2]

    def step(s: Column, x: Column) -> Column:
        p, k, one = x["p"], x["k"], x["k"] == 0
        smooth = lambda old, v, i: v * F.lit(alpha[i]) + old * F.lit(1.0 - alpha[i])
        over = lambda i: F.when(one, smooth(s["ab"[i]], p, i)).otherwise(s["ab"[i]] * _power(1.0 - alpha[i], k) + x[f"e{SIGNAL[i]}"])
        a, b = over(0), over(1)
        # What the EMAs before a run still weigh in the signal line after it.
        left = lambda i: s["ab"[i]] * (_power(1.0 - alpha[i], k) - _power(z, k)) * F.lit(alpha[2] * (1.0 - alpha[i]) / (1.0 - alpha[i] - z))
        line = F.when(one, smooth(s["s"], a - b, 2)).otherwise(s["s"] * _power(z, k) + left(0) - left(1) + x["s"])
        up, down = _gains(s, p)
        fade = _power(1.0 - 1.0 / RSI_N, k)
        g = F.when(one, _seeded(s, s["g"], up, RSI_N)).otherwise(s["g"] * fade + x["g"])
        low = F.when(one, _seeded(s, s["l"], down, RSI_N)).otherwise(s["l"] * fade + x["l"])
        count = s["n"] + F.greatest(k, F.lit(1))
        rsi = F.when(count < RSI_N, 50.0).otherwise(_strength(g, low, 100.0))
        kept = F.slice(F.concat(F.array(rsi), s["r"]), F.lit(1), F.lit(5))  # TAIL values follow each run, so none of it stays here
        return F.struct(a.alias("a"), b.alias("b"), line.alias("s"), (s["a"] - s["b"]).alias("m"), p.alias("last"), g.alias("g"), low.alias("l"), count.alias("n"), kept.alias("r"))

    mean = lambda r: F.aggregate(r, F.lit(0.0), lambda x, y: x + y) / F.lit(5.0)
    finish = lambda s: F.struct((s["a"] - s["b"]).alias("macd"), s["m"].alias("macd_before"), s["s"].alias("macd_signal"), F.when(F.size(s["r"]) >= 5, mean(s["r"])).otherwise(zero).alias("rsi_smoothed"))
    return F.aggregate(_rest(series), first, step, finish)


def _account(cash: float) -> list[Column]:
    return [F.lit(cash).alias("cash"), F.lit(0.0).alias("position"), F.lit(0).alias("state"), F.lit(0).alias("trades"), F.expr("cast(array() as array<string>)").alias("log")]


def _trade(s: Column, price: Column, state: Column) -> list[Column]:
    """The account after a day: from -1 to +1 everything is bought, from +1 to -1 everything sold; 0 keeps the state before; the log keeps ten."""
    buy = (s["state"] == -1) & (state == 1) & (s["cash"] > 0) & (price > 0)
    sell = (s["state"] == 1) & (state == -1) & (s["position"] > 0)
    note = F.when(buy, F.concat(F.lit("BUY@"), F.format_string("%.2f", price))).when(sell, F.concat(F.lit("SELL@"), F.format_string("%.2f", price)))
    log = F.when(buy | sell, F.concat(s["log"], F.array(note))).otherwise(s["log"])
    return [
        F.when(buy, 0.0).when(sell, s["position"] * price).otherwise(s["cash"]).alias("cash"),
        F.when(buy, s["cash"] / price).when(sell, 0.0).otherwise(s["position"]).alias("position"),
        F.when(state == 0, s["state"]).otherwise(state).alias("state"),
        (s["trades"] + F.when(buy | sell, 1).otherwise(0)).alias("trades"),
        F.slice(log, F.greatest(F.size(log) - 9, F.lit(1)), F.lit(10)).alias("log"),
    ]


def trading_state(days: Column, cash: float = 10000.0) -> Column:
    """struct(cash, position, state, trades, log) after all days: structs of price and state (+1, -1 or 0)."""
    return F.aggregate(days, F.struct(*_account(cash)), lambda s, d: F.struct(*_trade(s, d["price"], d["state"])))


def macd_trading(values: Column, cash: float = 10000.0) -> Column:
    """The same over plain values, where the state of each is the sign of MACD (12, 26) after it."""
    p0 = F.get(values, F.lit(0))
    smooth = lambda old, p, n: p * F.lit(2.0 / (n + 1)) + old * F.lit(1.0 - 2.0 / (n + 1))

    def step(s: Column, p: Column) -> Column:
        a, b = smooth(s["a"], p, 12), smooth(s["b"], p, 26)
        return F.struct(a.alias("a"), b.alias("b"), *_trade(s, p, F.when(a > b, 1).when(a < b, -1).otherwise(0)))

    return F.aggregate(_rest(values), F.struct(p0.alias("a"), p0.alias("b"), *_account(cash)), step)

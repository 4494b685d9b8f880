"""Chart indicators.

SMA and Bollinger bands are bounded row frames (built-in window functions).
RSI and MACD are recursive (each value depends on the previous one), which
no bounded frame expresses. They are a fold of the bars of a code, in day
order, over a state of a few numbers: four running averages and the signal,
each a sum until its seed is complete. The fold is built-in array functions,
so no row leaves the JVM. It starts from a code's stored state as well as
from nothing: a new day is one step (``plans.smoothed`` keeps the states). One
code's series is one row per open day, so a group is bounded by the length of
the calendar; it is folded block by block, which keeps the copying of the
growing list of states down.

Definitions (the reference leaves them to a charting library, so they are
fixed here): EMA with alpha = 2/(n+1) seeded by the SMA of the first n
values; RSI(14) with Wilder smoothing (alpha = 1/n) seeded by the mean gain
and loss of the first 14 changes; MACD = EMA12 - EMA26, signal = EMA9 of
MACD, histogram = MACD - signal; Bollinger = SMA20 +- 2 population
standard deviations. A bar without a close is no step: its indicators are
NULL, and the next bar goes on from the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.windows import by_code, trailing_mean_full

SMA_WINDOWS = (5, 10, 20, 30)


def with_sma(df: DataFrame, windows=SMA_WINDOWS, col: str = "close") -> DataFrame:
    """sma{n}, NULL until n rows exist."""
    return df.withColumns({f"sma{n}": trailing_mean_full(col, n) for n in windows})


def with_bollinger(df: DataFrame, n: int = 20, k: float = 2.0, col: str = "close") -> DataFrame:
    """Middle, upper, lower band over n rows (NULL until n rows)."""
    w = by_code().rowsBetween(-(n - 1), 0)
    full = F.count(col).over(w) == n
    mid = F.avg(col).over(w)
    sd = F.stddev_pop(col).over(w)
    return df.withColumns({
        "bb_mid": F.when(full, mid),
        "bb_up": F.when(full, mid + F.lit(k) * sd),
        "bb_dn": F.when(full, mid - F.lit(k) * sd),
    })


FAST, SLOW, SIGNAL, RSI = 12, 26, 9, 14
#: Bars folded at a time.
BLOCK = 64

#: A code after a bar: its steps so far, its last close, the averages of closes, gains, losses and MACD values.
STATE = ("n", "close", "fast", "slow", "gain", "loss", "signal")
_STEP = "struct<date: date, live: boolean, n: bigint, close: double, fast: double, slow: double, gain: double, loss: double, signal: double>"


def _smoothed(before: Column, x: Column, count: Column, n: int, alpha: float) -> Column:
    """The average after its ``count``-th value: a sum until the n-th makes it the seed, then the recursion."""
    return (F.when(count < n, before + x).when(count == n, (before + x) / n)
            .otherwise((1 - alpha) * before + alpha * x))


def _step(was: Column, bar: Column) -> Column:
    """The state after one more bar."""
    x, n = bar["close"], was["n"] + 1
    change = x - was["close"]
    fast = _smoothed(was["fast"], x, n, FAST, 2 / (FAST + 1))
    slow = _smoothed(was["slow"], x, n, SLOW, 2 / (SLOW + 1))
    first = n == 1  # no change yet
    gain = _smoothed(was["gain"], F.greatest(change, F.lit(0.0)), n - 1, RSI, 1 / RSI)
    loss = _smoothed(was["loss"], F.greatest(-change, F.lit(0.0)), n - 1, RSI, 1 / RSI)
    signal = _smoothed(was["signal"], fast - slow, n - (SLOW - 1), SIGNAL, 2 / (SIGNAL + 1))
    live = x.isNotNull()
    after = {"n": n, "close": x, "fast": fast, "slow": slow, "gain": F.when(first, 0.0).otherwise(gain),
             "loss": F.when(first, 0.0).otherwise(loss), "signal": F.when(n < SLOW, 0.0).otherwise(signal)}
    return F.struct(bar["date"].alias("date"), live.alias("live"),
                    *[F.when(live, v).otherwise(was[k]).alias(k) for k, v in after.items()])


def indicator_states(bars: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """``(code, date, close, ...)`` -> a row per bar: code, date, live, and the
    state after it. ``last`` (code and the columns of STATE): the states that
    codes go on from; codes not in it start from nothing."""
    series = bars.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("date", F.col("close").cast("double").alias("close")))).alias("bars"))
    nothing = {k: F.lit(0.0) for k in STATE} | {"n": F.lit(0), "close": F.lit(None).cast("double")}
    if last is not None:
        series = series.join(last.select("code", *STATE), "code", "left")
        nothing = {k: F.coalesce(F.col(k), v) for k, v in nothing.items()}
    start = F.struct(F.lit(None).alias("date"), F.lit(False).alias("live"), *[v.alias(k) for k, v in nothing.items()]).cast(_STEP)

    def block(states: Column, number: Column) -> Column:
        part = F.slice("bars", number * BLOCK + 1, F.lit(BLOCK))
        carry = F.array(F.element_at(states, -1))
        folded = F.aggregate(part, carry, lambda done, bar: F.concat(done, F.transform(F.slice(done, -1, 1), lambda was: _step(was, bar))))
        return F.concat(states, F.slice(folded, 2, BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.size("bars") - 1) / BLOCK).cast("int"))
    folded = series.select("code", F.aggregate(blocks, F.array(start), block).alias("states"))
    # outer: no filter on the list is inferred, which would fold it once more; the first state is the one gone on from
    each = folded.select("code", F.posexplode_outer("states").alias("at", "s"))
    return each.filter("at > 0").select("code", "s.*")


def last_states(states: DataFrame) -> DataFrame:
    """A row per code: the day of its newest row and the state after it."""
    return states.groupBy("code").agg(F.max_by(F.struct("date", *STATE), "date").alias("s")).select("code", "s.*")


def indicators_of(states: DataFrame) -> DataFrame:
    """W12/W13 of each bar from the state after it; NULL until a seed is complete."""
    n, live = F.col("n"), F.col("live")
    macd, signal = F.col("fast") - F.col("slow"), F.col("signal")
    rsi = F.when(F.col("loss") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + F.col("gain") / F.col("loss")))
    signalled = live & (n >= SLOW + SIGNAL - 1)
    return states.select(
        "code", "date", F.when(live, F.col("close")).alias("close"), F.when(live & (n > RSI), rsi).alias("rsi14"),
        F.when(live & (n >= SLOW), macd).alias("macd"), F.when(signalled, signal).alias("macd_signal"),
        F.when(signalled, macd - signal).alias("macd_hist"))


def recursive_indicators(bars: DataFrame) -> DataFrame:
    """RSI(14) and MACD(12, 26, 9) per code."""
    return indicators_of(indicator_states(bars))

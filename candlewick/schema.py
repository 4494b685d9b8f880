"""Explicit schemas of the model tables (never inferred) and shared constants."""

from __future__ import annotations

from pyspark.sql import types as T

D = T.DoubleType()
S = T.StringType()

BAR_BASE_COLS = [
    "code", "date", "open", "high", "close", "low", "volume", "price_change", "p_change",
    "ma5", "ma10", "ma20", "v_ma5", "v_ma10", "v_ma20", "turnover",
]
MORE_MA_COLS = ["ma30", "ma60", "ma120", "ma250"]
BAR_COLS = BAR_BASE_COLS + MORE_MA_COLS

BARS = T.StructType(
    [T.StructField("code", S, False), T.StructField("date", T.DateType(), False)]
    + [T.StructField(c, D) for c in BAR_COLS[2:]]
)

# stock_daily as landed by a feed (no moving averages of the longer windows)
BARS_DAILY = T.StructType(
    [T.StructField("code", S, False), T.StructField("date", T.DateType(), False)]
    + [T.StructField(c, D) for c in BAR_BASE_COLS[2:]]
)

INFO = T.StructType([
    T.StructField("code", S, False), T.StructField("name", S), T.StructField("industry", S),
    T.StructField("esp", D), T.StructField("pe", D),
])

CONCEPT = T.StructType([
    T.StructField("code", S, False), T.StructField("name", S), T.StructField("c_name", S),
])

# quote snapshot (stock_tick_data / stock_tick_hist_data); `time` kept as text
QUOTE = T.StructType(
    [T.StructField("code", S, False), T.StructField("name", S)]
    + [T.StructField(c, D) for c in ["open", "pre_close", "price", "high", "low", "bid", "ask", "volume", "amount"]]
    + [T.StructField(f"{side}{i}_{k}", S) for side in ("b", "a") for i in range(1, 6) for k in ("v", "p")]
    + [T.StructField("date", T.DateType()), T.StructField("time", S)]
)

PICKS = T.StructType([
    T.StructField("code", S), T.StructField("name", S), T.StructField("industry", S),
    T.StructField("esp", D), T.StructField("pe", D), T.StructField("percent", D),
    T.StructField("update_date", T.DateType()), T.StructField("reason", S),
])

# Index series names of the universe and the peak window.
INDEX_NAMES = ["sh", "sz", "hs300", "sz50", "zxb", "cyb"]
CALENDAR_CODE = "sh"
PEAK_LEFT = 10
PEAK_RIGHT = 10

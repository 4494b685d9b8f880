"""Publishing: slice replace of result tables, report lines and chart series
(K04, K07, K08, X18, X19).

Result tables are Parquet partitioned by their run keys. A run replaces
exactly its own slice by overwriting the explicit partition directory: also
an empty result clears yesterday's rows of that slice (dynamic partition
overwrite would leave them, since an empty frame names no partition).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.arrays import join_percent, last
from candlewick.functions.columns import chart_label, exchange_of, quote_link, round_fixed, round_percent
from candlewick.operators.indicators import recursive_indicators, with_bollinger, with_sma
from candlewick.operators.ranking import global_row_number


def slice_path(root: str, **keys) -> str:
    return root.rstrip("/") + "/" + "/".join(f"{k}={v}" for k, v in keys.items())


def replace_slice(df: DataFrame, root: str, **keys) -> str:
    """Write ``df`` (without the key columns) as the slice ``keys`` of
    the table at ``root``; the slice's previous rows are gone, others stay."""
    path = slice_path(root, **keys)
    df.drop(*[k for k in keys if k in df.columns]).write.mode("overwrite").parquet(path)
    return path


def read_slice(spark, root: str, **keys) -> DataFrame:
    """P20: rows of one slice (filters on partition columns prune directories)."""
    df = spark.read.option("basePath", root).parquet(root)
    for k, v in keys.items():
        df = df.filter(F.col(k) == F.lit(v))
    return df


# Report headers (our own wording; the reference's texts are not needed for results).
HEADERS = {
    "up_trend": "Trend breakout picks ({date})",
    "callback": "Breakout pull-back picks ({date})",
    "increase": "Continuous increase picks ({date})",
    "up_all_mas": "Above all moving averages picks ({date})",
}
LINKED = 3


SORT_KEYS = ("s1", "s2", "s3")


def report_rows(picks: DataFrame, report: str | Column, value_text: Column, sort_keys: list[Column]) -> DataFrame:
    """Unnumbered rows (report, industry, name, code, value, s1..s3) of one
    report. ``sort_keys`` are numeric and ascending, NULLs last (a
    descending key is given negated); ``code`` breaks ties. Rows of several
    reports are numbered together by ``number_reports``."""
    keys = list(sort_keys) + [F.lit(None)] * (len(SORT_KEYS) - len(sort_keys))
    return picks.select((F.lit(report) if isinstance(report, str) else report).alias("report"), "industry", "name", "code", value_text.alias("value"),
                        *[k.cast("double").alias(n) for k, n in zip(keys, SORT_KEYS)])


def number_reports(rows: DataFrame) -> DataFrame:
    """Adds ``rn`` (position within its report). The numbering is
    distributed (no single-task window over all picks); the picks of all
    reports are staged once, in a folder of this call."""
    order = [F.col(k).asc_nulls_last() for k in SORT_KEYS] + [F.col("code").asc()]
    numbered = global_row_number(rows, order, group="report")
    return numbered.select("report", "industry", "name", "code", "value", "rn")


def report_lines(rows: DataFrame, as_of, reports=None) -> DataFrame:
    """A header line per report (also without picks), then per pick
    one line; the first three picks get an extra line before it. One pass
    over the picks (numbered first when ``rn`` is missing). Out: report,
    line_no, text."""
    if "rn" not in rows.columns:
        rows = number_reports(rows)
    prefix = F.concat(F.lit("["), F.col("industry"), F.lit("]["), F.col("value"), F.lit("]:"))
    short = F.concat(prefix, F.lit("$"), F.col("name"), F.lit("("), exchange_of(), F.col("code"), F.lit(")$"))
    full = F.concat(prefix, F.lit("\t"), F.col("name"), F.lit(" : "), quote_link())
    # lines before pick rn: header (1) + (rn-1) picks + min(rn-1, 3) extra lines
    base = F.lit(1) + (F.col("rn") - 1) + F.least(F.col("rn") - 1, F.lit(LINKED))
    linked = F.col("rn") <= LINKED
    lines = F.filter(
        F.array(
            F.when(linked, F.struct((base + 1).alias("line_no"), short.alias("text"))),
            F.struct((base + 1 + F.when(linked, 1).otherwise(0)).alias("line_no"), full.alias("text")),
        ),
        lambda x: x.isNotNull(),
    )
    body = rows.select("report", F.explode(lines).alias("l")).select("report", "l.line_no", "l.text")
    names = list(reports or HEADERS)
    spark = rows.sparkSession
    headers = spark.createDataFrame(
        [(r, 1, HEADERS.get(r, r).format(date=as_of)) for r in names], "report string, line_no int, text string")
    return headers.unionByName(body)


def breakout_report(picks: DataFrame, report: str | None = None) -> DataFrame:
    """Rows of the up_trend / callback reports (by the picks' reason, unless
    ``report`` names one): percent printed x 100 (Q23)."""
    text = F.format_string("%.2f%%", round_percent("percent"))
    return report_rows(picks, report or F.col("reason"), text, [-F.col("percent")])


def increase_report(cont: DataFrame) -> DataFrame:
    """Rows of the continuous-increase report: n_days desc, last change desc
    (NULLs last)."""
    return report_rows(cont, "increase", join_percent("p_change"), [-F.col("n_days"), -last("p_change")])


def all_mas_report(rows: DataFrame) -> DataFrame:
    """Rows of the up_all_mas report: one per pick with its smallest interval
    (A22), ordered n_days desc, interval asc, change desc (numeric, Q09)."""
    dedup = rows.groupBy("industry", "name", "code", "p_change", "n_days").agg(F.min("interval").alias("interval"))
    text = F.format_string("%.2f%%", round_fixed("p_change"))
    return report_rows(dedup, "up_all_mas", text, [-F.col("n_days"), F.col("interval"), -F.col("p_change")])


CHART_START = dt.date(2015, 5, 1)


def chart_series(bars: DataFrame, picks: DataFrame, info: DataFrame, since=CHART_START,
                 until=None, bollinger: bool = False) -> DataFrame:
    """OHLCV since ``since`` of each picked code with its label
    and SMA 5/10/20/30 (W10); Bollinger bands (W11) on request. One
    semi-join instead of a query per code."""
    rows = bars.filter(F.col("date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("date") <= F.lit(until))
    rows = rows.select("code", "date", "close", "open", "high", "low", "volume").join(
        picks.select("code"), "code", "left_semi")
    out = with_sma(rows)
    if bollinger:
        out = with_bollinger(out)
    return out.join(info.select("code", "name", "industry"), "code").withColumn(
        "label", chart_label()).drop("name", "industry")


def chart_recursive(bars: DataFrame, picks: DataFrame, since=CHART_START, until=None) -> DataFrame:
    """RSI and MACD series of the picked codes."""
    rows = bars.filter(F.col("date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("date") <= F.lit(until))
    return recursive_indicators(rows.join(picks.select("code"), "code", "left_semi"))


def write_chart_data(series: DataFrame, root: str) -> None:
    """One directory per code."""
    series.repartition("code").write.mode("overwrite").partitionBy("code").parquet(root)

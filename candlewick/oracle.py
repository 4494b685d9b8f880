"""
driver tables (views region nation customer supplier part orders lineitem
...). Used by ``__spark_entry__.oracle_sql`` and by the tests.

The common prefix derives the model tables (FIXTURES.md section 2) in SQL;
each query appends its own CTEs and final SELECT. Parameters are rendered as
literals from the same values the Spark side uses.
"""

from __future__ import annotations

import datetime as dt


def d(value) -> str:
    return f"DATE '{value}'"


def code_sql(key: str) -> str:
    return f"(CASE WHEN {key} % 2 = 0 THEN '6' ELSE '0' END || printf('%05d', {key}))"


def _ma(col: str, n: int) -> str:
    return f"avg({col}) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


BASE = f"""
li AS (
  SELECT {code_sql('l_suppkey')} AS code,
         DATE '2015-01-01' + CAST(floor((CAST(l_shipdate AS DATE) - DATE '1995-01-01') / 7) AS INTEGER) AS date,
         CAST(round(100 * l_discount) AS INTEGER) - CAST(round(100 * l_tax) AS INTEGER) - 1 AS step,
         l_linenumber AS ln, l_quantity AS qty
  FROM lineitem),
cd AS (SELECT code, date, sum(step) AS step, max(ln) AS ln, sum(qty) AS volume FROM li GROUP BY code, date),
rb AS (SELECT code, date, step, ln, volume FROM cd
       UNION ALL
       SELECT 'sh', date, sum(step) % 7, max(ln), sum(volume) FROM cd GROUP BY date),
cl AS (SELECT code, date, ln, volume,
         CAST(greatest(300 + sum(step) OVER (PARTITION BY code ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 20) AS DOUBLE) AS close
       FROM rb),
pv AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY code ORDER BY date), 300.0) AS prev FROM cl),
bars AS (
  SELECT code, date, (prev + close) / 2 AS open, greatest(prev, close) + ln % 3 AS high, close,
         least(prev, close) - ln % 3 AS low, CAST(volume AS DOUBLE) AS volume, close - prev AS price_change,
         round(100 * (close - prev) / prev, 4) AS p_change,
         {_ma('close', 5)} AS ma5, {_ma('close', 10)} AS ma10, {_ma('close', 20)} AS ma20,
         {_ma('volume', 5)} AS v_ma5, {_ma('volume', 10)} AS v_ma10, {_ma('volume', 20)} AS v_ma20,
         CAST(0 AS DOUBLE) AS turnover,
         {_ma('close', 30)} AS ma30, {_ma('close', 60)} AS ma60, {_ma('close', 120)} AS ma120,
         {_ma('close', 250)} AS ma250
  FROM pv),
stocks AS (SELECT * FROM bars WHERE code <> 'sh'),
info AS (
  SELECT {code_sql('s_suppkey')} AS code,
         CASE WHEN s_suppkey % 17 = 3 THEN 'ST ' ELSE '' END || s_name AS name,
         n_name AS industry, s_acctbal / 1000 AS esp, s_acctbal / 100 AS pe
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
concept AS (
  SELECT t.code, i.name, t.c_name
  FROM (SELECT DISTINCT {code_sql('l_suppkey')} AS code, p_brand AS c_name
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity = 50) t
  LEFT JOIN info i ON i.code = t.code),
cal AS (SELECT DISTINCT date FROM bars WHERE code = 'sh')
"""


def exact(x: str, places: int = 12) -> str:
    """A double as the decimal that its shortest text names."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, {places}))"


def half_away(num: str, den: str) -> str:
    return f"(sign({num}) * floor((2 * abs({num}) + {den}) / (2.0 * ({den}))))"


def round2(x: str) -> str:
    """Half-away rounding of the exact decimal to 2 places."""
    return f"CAST(round({exact(x)}, 2) AS DOUBLE)"


def avg_round2(x: str) -> str:
    """round(avg, 2) from an exact sum: |sum| * 10^12 + n * 10^10 / 2 units of 10^-12, cut to whole n * 10^10."""
    total = f"CAST(sum({exact(x)}) * 1000000000000 AS HUGEINT)"
    step = f"(CAST(count({x}) AS HUGEINT) * 10000000000)"
    return (f"CASE WHEN count({x}) > 0 THEN CAST(sign({total}) * ((2 * abs({total}) + {step}) // (2 * {step})) "
            f"AS DOUBLE) / 100.0 END")


def ratio_round2(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN CAST({half_away(f'100 * ({num})', den)} / 100.0 AS DOUBLE) END"


def open_day(end, n: int) -> str:
    """A07 as a scalar subquery."""
    return f"(SELECT min(date) FROM (SELECT date FROM cal WHERE date <= {d(end)} ORDER BY date DESC LIMIT {n}))"


def with_base(*ctes: str, select: str) -> str:
    parts = [BASE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


# ---------------------------------------------------------------------------------------------------------------------
# The rules of SURVEY section 2.11, each stated from its text: membership tests as IN / EXISTS / ANTI JOIN, the best row
# of a group by QUALIFY or arg_max, ordered values as lists.


def group_by_day_sql(group_col: str, members: str, start: str, end, top_n: int, limit_up: str) -> tuple[str, ...]:
    """CTEs `grows` (the day's bars of each group, with their place in it) and `gday` for X11/X13."""
    return (
        f"""grows AS (
          FROM stocks bar JOIN ({members}) mem USING (code)
          SELECT mem.{group_col} AS grp, bar.date AS day, bar.p_change AS chg, mem.name || '(' || code || ')' AS label,
                 row_number() OVER (PARTITION BY mem.{group_col}, bar.date ORDER BY bar.p_change DESC NULLS LAST, code) AS place
          WHERE bar.date >= {start} AND bar.date <= {d(end)} AND code NOT IN ({limit_up}))""",
        f"""gday AS (
          FROM grows
          SELECT grp AS {group_col}, day AS date, {avg_round2('chg')} AS p_change,
                 {ratio_round2('count_if(chg > 0)', 'count(chg)')} AS positive_stock_ratio,
                 list(label ORDER BY place) FILTER (WHERE place <= {top_n}) AS top_n_stock,
                 list(chg ORDER BY place) FILTER (WHERE place <= {top_n}) AS top_n_change,
                 {d(end)} AS update_date
          GROUP BY ALL)""",
    )


def limit_up_codes(as_of, n_days: int, at_least: int) -> str:
    """Codes that rose by more than 9.5 on at least so many of the last open days."""
    return (f"SELECT code FROM bars GROUP BY code "
            f"HAVING count_if(p_change > 9.5 AND date >= {open_day(as_of, n_days)} AND date <= {d(as_of)}) >= {at_least}")


def industry_by_day_ctes(as_of, top_n=5, n_days=30, ignore_n=3) -> tuple[str, ...]:
    return group_by_day_sql("industry", "SELECT code, name, industry FROM info", open_day(as_of, n_days), as_of, top_n,
                            limit_up_codes(as_of, ignore_n, ignore_n))


def concept_by_day_ctes(as_of, top_n=5, n_days=10, limit_up_days=2) -> tuple[str, ...]:
    return group_by_day_sql("concept", "SELECT code, name, c_name AS concept FROM concept", open_day(as_of, n_days), as_of,
                            top_n, limit_up_codes(as_of, n_days, limit_up_days))


def group_summary_sql(group_col: str, top_n: int, label_where: str = "TRUE") -> str:
    """One row per group of `gday`: its daily values, newest first, and the labels listed most often."""
    return f"""
      , said AS (FROM gday SELECT {group_col}, unnest(top_n_stock) AS label WHERE {label_where}),
      often AS (
        FROM said SELECT {group_col}, label, count(*) AS times GROUP BY {group_col}, label
        QUALIFY row_number() OVER (PARTITION BY {group_col} ORDER BY times DESC, label) <= {top_n})
      FROM gday
      SELECT {group_col}, list(p_change ORDER BY date DESC) AS p_change,
             list(positive_stock_ratio ORDER BY date DESC) AS positive_stock_ratio,
             (SELECT list(o.label || '+' || o.times ORDER BY o.times DESC, o.label) FROM often o
              WHERE o.{group_col} = gday.{group_col}) AS top_n_stock,
             any_value(update_date) AS update_date
      WHERE {group_col} IN (SELECT {group_col} FROM often)
      GROUP BY {group_col}"""


def extremes_sql(kind: str, start, end) -> str:
    """Bars that no bar within ten positions of the code's series (in the range) exceeds, numbered by height
    and by newness."""
    better, name = (">", "max_close") if kind == "peak" else ("<", "min_close")
    return f"""
      WITH place AS (
        SELECT code, date, close, row_number() OVER (PARTITION BY code ORDER BY date) AS pos
        FROM stocks WHERE date >= {start} AND date <= {end})
      FROM place x
      SELECT code, date, close, close AS {name}, row_number() OVER high AS rank, row_number() OVER newest AS date_rank
      WHERE NOT EXISTS (FROM place y WHERE y.code = x.code AND abs(y.pos - x.pos) <= 10 AND y.close {better} x.close)
      WINDOW high AS (PARTITION BY code ORDER BY close DESC, date DESC), newest AS (PARTITION BY code ORDER BY date DESC)"""


def picks_sql(codes: str, as_of, reason: str, percent: str = "CAST(0 AS DOUBLE)") -> str:
    """The picks layout for a table of codes."""
    return f"""
      FROM info SEMI JOIN {codes} USING (code)
      SELECT DISTINCT code, name, industry, esp, pe, {percent} AS percent, {d(as_of)} AS update_date, '{reason}' AS reason"""


def breakout_sql(kind: str, reason: str, trend_start, pre_start, trend_percent, up_percent, as_of, on_days: str,
                 today: str = "TRUE") -> str:
    """X01, X02, X07. ``on_days``: condition on the date of the highest extreme; ``today``: condition on the as-of bar."""
    before = as_date(trend_start) - dt.timedelta(days=1)
    return with_base(
        f"ext AS ({extremes_sql(kind, d(trend_start), d(as_of))})",
        """best AS (
          FROM ext SELECT code, arg_min(date, rank) AS date, arg_min(close, rank) AS close,
                          arg_max(close, date) AS later, arg_min(close, date) AS earlier
          WHERE rank <= 2 GROUP BY code HAVING count(*) = 2)""",
        f"""hit AS (
          FROM best SELECT code, (later - earlier) / earlier AS percent
          WHERE {on_days} AND (later - earlier) / earlier <= {trend_percent}
            AND EXISTS (FROM stocks s WHERE s.code = best.code AND s.date <= least({d(trend_start)}, {d(as_of)}))
            AND (SELECT (max(s.close) - best.close) / max(s.close) FROM stocks s
                 WHERE s.code = best.code AND s.date >= {d(pre_start)} AND s.date <= {d(before)}) >= {up_percent}
            AND EXISTS (FROM stocks e WHERE e.code = best.code AND ({today})))""",
        select=f"""
      FROM hit JOIN info USING (code)
      SELECT DISTINCT code, name, industry, esp, pe, percent, {d(as_of)} AS update_date, '{reason}' AS reason
      WHERE NOT contains(name, 'ST')""")


def rising_sql(kind: str, start, end) -> str:
    """Codes with extremes of which none is lower than the one before it."""
    return f"""SELECT code FROM (
        SELECT code, close >= coalesce(lag(close) OVER (PARTITION BY code ORDER BY date), close) AS up
        FROM ({extremes_sql(kind, start, end)})) GROUP BY code HAVING bool_and(up)"""


def over(bar: str, *ns: int, op: str = ">=") -> str:
    """The close is over the averages of ``ns`` bars: it is over the greatest of them."""
    return f"{bar}.close {op} greatest({', '.join(f'{bar}.ma{n}' for n in ns)})"


def ascending_sql(trend_start, as_of, latest: bool = False, hold_days: int = 3) -> str:
    """X04; X05 with ``latest``."""
    least_days, change = (25, "b.p_change >= 0.0 AND b.p_change <= 9.0") if latest else (30, "b.p_change <= 9.0")
    held = f"""AND {hold_days} = (SELECT count(DISTINCT h.date) FROM stocks h
              WHERE h.code = b.code AND h.date >= {open_day(as_of, hold_days)} AND h.date <= {d(as_of)}
                AND {over('h', 5, 10, 20, 30, 60, 120)})
            AND NOT EXISTS (FROM info f WHERE f.code = b.code AND contains(f.name, 'ST'))""" if latest else ""
    return with_base(
        f"rising AS ({rising_sql('peak', d(trend_start), d(as_of))} INTERSECT {rising_sql('trough', d(trend_start), d(as_of))})",
        f"""hit AS (
          SELECT b.code FROM stocks b SEMI JOIN rising USING (code)
          WHERE b.date = {d(as_of)} AND b.open > 0 AND {change} AND {over('b', 5, 10, 20)}
            AND (SELECT count(*) FROM stocks a WHERE a.code = b.code AND a.date <= {d(as_of)}) > {least_days}
            {held})""",
        select=picks_sql("hit", as_of, "latest_asc" if latest else "asc"))


def volume_breakout_sql(as_of, push_days=7, up_days=3, volume_increase=2) -> str:
    """X06."""
    return with_base(
        f"""push AS (
          FROM stocks SELECT code, max(close) AS top, min(close) AS bottom, count(*) AS bars,
               sum(CASE WHEN p_change >= 0 THEN volume END) AS gained, sum(CASE WHEN p_change < 0 THEN volume END) AS lost
          WHERE date >= {d(as_of)} - {push_days} AND date <= {d(as_of)} GROUP BY code)""",
        f"""hit AS (
          FROM push JOIN stocks b USING (code) SELECT code
          WHERE b.date = {d(as_of)} AND bars >= {up_days} AND bottom > 0 AND gained >= {volume_increase} * lost
            AND (top - bottom) / bottom >= 0.04 AND b.close >= top AND b.open > 0 AND b.p_change <= 5.0
            AND {over('b', 5, 10, 20, 30, 60)} AND (b.high - b.close) / b.open <= 0.01)""",
        select=picks_sql("hit", as_of, "up_ma"))


def continuous_increase_sql(as_of, n: int) -> str:
    """The changes of the last n + 1 open days as a list, oldest first."""
    return with_base(
        f"""runs AS (
          FROM stocks SELECT code, list(p_change ORDER BY date) AS changes
          WHERE date >= {open_day(as_of, n + 1)} AND date <= {d(as_of)} AND p_change >= -3.0 AND p_change <= 5.0
          GROUP BY code)""",
        select=f"""
      FROM runs JOIN info USING (code) JOIN stocks b USING (code)
      SELECT industry, code, name, list_transform(changes, lambda x: {round2('x')}) AS p_change,
             CAST({n} AS INTEGER) AS n_days, {d(as_of)} AS update_date
      WHERE b.date = {d(as_of)} AND b.close > b.open AND (b.high - b.close) / b.close <= 0.02
        AND b.low <= b.close - b.price_change
        AND len(list_filter(changes, lambda x: x >= 1.0)) >= {n}
        AND changes[1] <= 0 AND changes[-1] > 0.0""")


def above_all_averages_sql(as_of, n: int, interval: int) -> str:
    """X10."""
    return with_base(select=f"""
      FROM stocks b JOIN info USING (code)
      SELECT industry, code, name, b.p_change, CAST({n} AS INTEGER) AS n_days, CAST({interval} AS INTEGER) AS "interval",
             {d(as_of)} AS update_date
      WHERE b.date = {d(as_of)} AND b.p_change >= 0.1 AND b.p_change <= 5
        AND {over('b', 5, 10, 20, 30, 60, 120, 250, op='>')}
        AND {n} <= (SELECT count(*) FROM stocks w WHERE w.code = b.code AND w.p_change >= -3 AND w.p_change <= 0
                    AND w.date >= {open_day(as_of, n + interval)} AND w.date <= {d(as_of)})""")


def interval_return_sql(interval: int, end) -> str:
    """One pass over the interval's bars."""
    start = open_day(end, interval)
    return with_base(
        f"""span AS (
          FROM stocks SELECT code, min(date) AS start_day, max(date) AS end_day,
               (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) AS percent,
               (max(high) - min(low)) / min(low) AS high_percent
          WHERE date >= {start} AND date <= {d(end)} GROUP BY code)""",
        select=f"""
      FROM concept JOIN span USING (code)
      SELECT code, start_day, end_day, percent, high_percent, name, c_name
      WHERE start_day = {start} AND end_day = {d(end)}""")


def volume_trend_sql(start, end, volume_cnt, neg_pct, as_of) -> str:
    """X08."""
    return with_base(
        f"rw AS (FROM stocks SELECT code, date, p_change, volume WHERE date >= {d(start)} AND date <= {d(end)})",
        """falls AS (
          FROM rw SELECT code, volume, volume / lag(volume) OVER (PARTITION BY code ORDER BY date) - 1 AS step
          WHERE p_change < 0)""",
        "fell AS (FROM falls SELECT code, max(volume) AS most, max(abs(step)) AS jump GROUP BY code)",
        f"""kept AS (
          FROM rw LEFT JOIN fell USING (code) SELECT code GROUP BY code
          HAVING count(*) + 3 >= (SELECT count(*) FROM cal WHERE date >= {d(start)} AND date <= {d(end)})
             AND count_if(p_change >= 0 AND volume < most) <= {volume_cnt}
             AND coalesce(any_value(jump), 0) <= {neg_pct})""",
        f"entry_day AS (FROM cal SELECT date WHERE date > {d(end)} ORDER BY date LIMIT 1)",
        select=f"""
      FROM info SEMI JOIN kept USING (code) JOIN stocks e USING (code) LEFT JOIN stocks t ON t.code = e.code AND t.date = {d(as_of)}
      SELECT e.code, info.name, (t.high - e.close) / e.close AS ratio
      WHERE e.date = (FROM entry_day) AND e.p_change < 9.9""")


BAR_COLUMNS = ("code, date, open, high, close, low, volume, price_change, p_change, ma5, ma10, ma20, "
               "v_ma5, v_ma10, v_ma20, turnover, ma30, ma60, ma120, ma250")


def tick_to_bar_sql(day) -> str:
    """An average moves by the price that enters it and the close that leaves it, over its length."""
    moved = ", ".join(f"h.m[1].ma{k} + (q.close - h.m[{k}].close) / {k} AS ma{k}" for k in (5, 10, 20))
    return with_base(
        f"""h AS (
          FROM stocks SELECT code, list({{'close': close, 'ma5': ma5, 'ma10': ma10, 'ma20': ma20}} ORDER BY date DESC) AS m
          WHERE date < {d(day)} AND date >= {d(day)} - 90 GROUP BY code)""",
        f"q AS (FROM stocks SELECT *, close - price_change AS was WHERE date = {d(day)})",
        select=f"""
      FROM q JOIN h USING (code)
      SELECT code, q.date, q.open, q.high, q.close, q.low, q.volume, q.close - q.was AS price_change,
             ((q.close - q.was) / q.was) * 100 AS p_change, {moved},
             CAST(0 AS DOUBLE) AS v_ma5, CAST(0 AS DOUBLE) AS v_ma10, CAST(0 AS DOUBLE) AS v_ma20,
             CAST(0 AS DOUBLE) AS turnover""")


def hot_sql(k: int) -> str:
    """The k industries with the highest change on the newest day of `gday`."""
    return f"""hot AS (
      FROM gday SELECT industry QUALIFY date = max(date) OVER ()
        AND row_number() OVER (PARTITION BY date ORDER BY p_change DESC NULLS LAST, industry) <= {k})"""


def excess_return_sql(as_of, k: int = 20) -> str:
    """X16."""
    return with_base(*industry_by_day_ctes(as_of, 5, 30, 3), hot_sql(k), select="""
      FROM gday SEMI JOIN hot USING (industry)
      SELECT 'industry index' AS series, industry, date,
             round((p_change - (SELECT b.p_change FROM bars b WHERE b.code = 'sh' AND b.date = gday.date)) * 10000.0)
               / 10000.0 AS p_change""")


def hot_industries_sql(as_of, k: int = 10) -> str:
    """X17."""
    return with_base(*industry_by_day_ctes(as_of, 5, 30, 3), hot_sql(k),
                     "span AS (FROM gday SELECT min(date) AS lo, max(date) AS hi)", select="""
      FROM gday SEMI JOIN hot USING (industry) SELECT 'industry index' AS series, industry, date, p_change
      UNION ALL BY NAME
      FROM bars, span SELECT 'market index' AS series, 'market index' AS industry, date, p_change
      WHERE code = 'sh' AND date >= lo AND date <= hi""")


def _sma(n: int) -> str:
    w = f"OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(close) {w} = {n} THEN avg(close) {w} END AS sma{n}"


def chart_series_sql(picks_select: str, since, until) -> str:
    w = "OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    return f"""
      SELECT b.*, i.code || '-' || i.name || '-' || i.industry AS label
      FROM (SELECT code, date, close, open, high, low, volume, {_sma(5)}, {_sma(10)}, {_sma(20)}, {_sma(30)},
                   CASE WHEN count(close) {w} = 20 THEN avg(close) {w} END AS bb_mid,
                   CASE WHEN count(close) {w} = 20
                        THEN round((avg(close) {w} + 2 * stddev_pop(close) {w}) * 1000000.0) / 1000000.0 END AS bb_up,
                   CASE WHEN count(close) {w} = 20
                        THEN round((avg(close) {w} - 2 * stddev_pop(close) {w}) * 1000000.0) / 1000000.0 END AS bb_dn
            FROM bars WHERE date BETWEEN {d(since)} AND {d(until)}
              AND code IN ({picks_select})) b
      JOIN info i ON b.code = i.code"""


def _ewm(prev: str, x: str, a: str) -> str:
    """One step of the recursion, as it is defined."""
    return f"((1 - {a}) * {prev} + {a} * {x})"


def _r6(x: str) -> str:
    return f"round(({x}) * 1000000.0) / 1000000.0"


def recursive_indicators_sql(picks_select: str, since, until) -> str:
    """U01/W12/W13 by recursive CTEs: EMA seeded with the SMA of the first
    n values; RSI(14) with alpha 1/14 on gains and losses; MACD 12/26 and
    its 9-value signal seeded with the mean of the first 9 MACD values."""
    a12, a26, a9, a14 = "(2.0 / 13)", "(2.0 / 27)", "(2.0 / 10)", "(1.0 / 14)"
    return f"""
    WITH RECURSIVE
    d AS (SELECT code, date, close, row_number() OVER (PARTITION BY code ORDER BY date) AS rn,
                 close - lag(close) OVER (PARTITION BY code ORDER BY date) AS chg
          FROM ({picks_select_base(picks_select, since, until)}) b),
    seed AS (SELECT code, avg(close) FILTER (WHERE rn <= 12) AS s12, avg(close) FILTER (WHERE rn <= 26) AS s26,
                    avg(greatest(chg, 0)) FILTER (WHERE rn BETWEEN 2 AND 15) AS g14,
                    avg(greatest(-chg, 0)) FILTER (WHERE rn BETWEEN 2 AND 15) AS l14
             FROM d GROUP BY code),
    r1 AS (
      SELECT code, rn, CAST(NULL AS DOUBLE) AS e12, CAST(NULL AS DOUBLE) AS e26,
             CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l
      FROM d WHERE rn = 1
      UNION ALL
      SELECT d.code, d.rn,
             CASE WHEN d.rn < 12 THEN NULL WHEN d.rn = 12 THEN sd.s12 ELSE {_ewm('r1.e12', 'd.close', a12)} END,
             CASE WHEN d.rn < 26 THEN NULL WHEN d.rn = 26 THEN sd.s26 ELSE {_ewm('r1.e26', 'd.close', a26)} END,
             CASE WHEN d.rn < 15 THEN NULL WHEN d.rn = 15 THEN sd.g14
                  ELSE {_ewm('r1.g', 'greatest(d.chg, 0)', a14)} END,
             CASE WHEN d.rn < 15 THEN NULL WHEN d.rn = 15 THEN sd.l14
                  ELSE {_ewm('r1.l', 'greatest(-d.chg, 0)', a14)} END
      FROM r1 JOIN d ON d.code = r1.code AND d.rn = r1.rn + 1 JOIN seed sd ON sd.code = d.code),
    m AS (SELECT code, rn, e12 - e26 AS macd, g, l FROM r1),
    seed2 AS (SELECT code, avg(macd) FILTER (WHERE rn BETWEEN 26 AND 34) AS s9 FROM m GROUP BY code),
    r2 AS (
      SELECT code, rn, CAST(NULL AS DOUBLE) AS sig FROM m WHERE rn = 1
      UNION ALL
      SELECT m.code, m.rn,
             CASE WHEN m.rn < 34 THEN NULL WHEN m.rn = 34 THEN s2.s9 ELSE {_ewm('r2.sig', 'm.macd', a9)} END
      FROM r2 JOIN m ON m.code = r2.code AND m.rn = r2.rn + 1 JOIN seed2 s2 ON s2.code = m.code)
    SELECT d.code, d.date, d.close,
           {_r6("CASE WHEN m.g IS NULL THEN NULL WHEN m.l = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + m.g / m.l) END")}
             AS rsi14,
           {_r6('m.macd')} AS macd, {_r6('r2.sig')} AS macd_signal, {_r6('m.macd - r2.sig')} AS macd_hist
    FROM d JOIN m ON d.code = m.code AND d.rn = m.rn JOIN r2 ON d.code = r2.code AND d.rn = r2.rn"""


def with_base_recursive(recursive_sql: str) -> str:
    """Prefix the model CTEs to a `WITH RECURSIVE` statement."""
    return recursive_sql.replace("WITH RECURSIVE", "WITH RECURSIVE " + BASE.strip() + ",", 1)


def picks_select_base(picks_select: str, since, until) -> str:
    return (f"SELECT code, date, close FROM bars WHERE date BETWEEN {d(since)} AND {d(until)} "
            f"AND code IN ({picks_select})")


REPORT_HEADERS = {
    "up_trend": "Trend breakout picks ({date})",
    "callback": "Breakout pull-back picks ({date})",
    "increase": "Continuous increase picks ({date})",
    "up_all_mas": "Above all moving averages picks ({date})",
}


def report_lines_sql(as_of, up_trend: str, callback: str, increase: list[str], all_mas: list[str]) -> str:
    """X18 over full pick statements (each a complete query)."""
    pct6 = f"CAST(round({exact('percent', 15)} * 100, 2) AS DOUBLE)"
    ci = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in increase)
    am = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in all_mas)
    hdr = " ".join(f"WHEN '{r}' THEN '{h.format(date=as_of)}'" for r, h in REPORT_HEADERS.items())
    return f"""
    WITH ut AS ({up_trend}), cb AS ({callback}), ci AS ({ci}), am0 AS ({am}),
    am AS (SELECT industry, name, code, p_change, n_days, min("interval") AS iv FROM am0
           GROUP BY industry, name, code, p_change, n_days),
    rw AS (
      SELECT 'up_trend' AS report, industry, name, code, printf('%.2f%%', {pct6}) AS value,
             row_number() OVER (ORDER BY percent DESC, code) AS rn FROM ut
      UNION ALL
      SELECT 'callback', industry, name, code, printf('%.2f%%', {pct6}),
             row_number() OVER (ORDER BY percent DESC, code) FROM cb
      UNION ALL
      SELECT 'increase', industry, name, code,
             array_to_string(list_transform(p_change, lambda x: printf('%.2f', x)), '%,') || '%',
             row_number() OVER (ORDER BY n_days DESC, p_change[-1] DESC NULLS LAST, code) FROM ci
      UNION ALL
      SELECT 'up_all_mas', industry, name, code, printf('%.2f%%', {round2('p_change')}),
             row_number() OVER (ORDER BY n_days DESC, iv ASC, p_change DESC, code) FROM am)
    SELECT report, CAST(1 AS INTEGER) AS line_no, CASE report {hdr} END AS text
    FROM (VALUES ('up_trend'), ('callback'), ('increase'), ('up_all_mas')) h(report)
    UNION ALL
    SELECT report, CAST(1 + (rn - 1) + least(rn - 1, 3) + 1 AS INTEGER),
           '[' || industry || '][' || value || ']:$' || name || '('
           || CASE WHEN code LIKE '6%' THEN 'SH' ELSE 'SZ' END || code || ')$'
    FROM rw WHERE rn <= 3
    UNION ALL
    SELECT report, CAST(1 + (rn - 1) + least(rn - 1, 3) + 1 + CASE WHEN rn <= 3 THEN 1 ELSE 0 END AS INTEGER),
           '[' || industry || '][' || value || ']:' || chr(9) || name || ' : https://xueqiu.com/S/'
           || CASE WHEN code LIKE '6%' THEN 'SH' ELSE 'SZ' END || code
    FROM rw"""


def as_date(v) -> dt.date:
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v))

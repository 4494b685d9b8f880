"""Command line: the daily jobs of the pipeline.

python -m candlewick screens  --data DIR --out OUT [--as-of DAY] [screen options]
python -m candlewick rankings --data DIR --out OUT [--as-of DAY]
python -m candlewick trends   --data DIR --out OUT [--as-of DAY] [screen options]
python -m candlewick reports  --out OUT --as-of DAY
python -m candlewick charts   --data DIR --out OUT --reason asc [--as-of DAY]
python -m candlewick all      --data DIR --out OUT [--as-of DAY]
python -m candlewick live     --data DIR --out OUT --quotes QDIR [--as-of DAY] [--watch]
python -m candlewick refresh  [--data DIR] --out OUT [--landed LDIR] [--provisional PDIR]

DIR holds stored bar tables (stock_daily, stock_info, stock_concept) or the
driver's parquet tables; without --data a job reads the book that refresh
keeps under OUT/book. OUT is a shared folder. The as-of day is the newest
open day unless given. The Spark master and settings come from spark-submit /
the environment; --master is for local runs.
"""

from __future__ import annotations

import argparse
import json

from candlewick.operators.calendar import as_date, as_of_day
from candlewick.plans import pipeline, runs
from candlewick.streaming import live
from candlewick.plans.market import load_market
from candlewick.session import get_spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="candlewick")
    ap.add_argument("job", choices=["screens", "rankings", "trends", "reports", "charts", "all", "live", "refresh"])
    ap.add_argument("--data", help="folder with the source tables (default: the book under --out)")
    ap.add_argument("--as-of", help="default: the newest open day")
    ap.add_argument("--out", required=True)
    ap.add_argument("--reason", default="asc")
    ap.add_argument("--master", default=None)
    ap.add_argument("--quotes", help="folder where quote snapshot files (parquet) land")
    ap.add_argument("--watch", action="store_true", help="keep the live stream running")
    ap.add_argument("--landed", help="folder with landed final bars (stock_daily layout, parquet)")
    ap.add_argument("--provisional", help="folder with provisional bars (stock_daily layout, or the live job's)")
    options = ap.add_argument_group("screen options (default: see plans/runs.py)")
    for name in ("trend-start", "pre-start", "asc-start"):
        options.add_argument(f"--{name}", type=as_date)
    for name, value in runs.DEFAULTS.items():
        options.add_argument(f"--{name.replace('_', '-')}", type=type(value))
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    params = {k: getattr(a, k) for k in ("trend_start", "pre_start", "asc_start", *runs.DEFAULTS)}
    book = f"{a.out}/book"
    m = None
    if a.data:
        m = load_market(spark, a.data)
    elif a.job != "reports":
        if not pipeline.book_exists(spark, book):
            ap.error("--data is required while there is no book under --out")
        m = pipeline.open_book(spark, book)
    if a.job == "live":
        if not a.quotes:
            ap.error("--quotes is required for live")
        q = live.start(spark, m, a.quotes, a.out, as_date(a.as_of), available_now=not a.watch)
        q.awaitTermination()
        print(json.dumps({"history": f"{a.out}/live/history", "latest": f"{a.out}/live/latest",
                          "provisional": f"{a.out}/live/provisional"}, indent=1))
        return
    if a.job == "refresh":
        if not (a.landed or a.provisional):
            ap.error("--landed or --provisional is required for refresh")
        print(json.dumps(runs.run_refresh(m, a.landed, a.out, a.provisional, spark), indent=1))
        return
    if m is None and not a.as_of:
        ap.error("--as-of is required for reports without --data")
    as_of = as_date(a.as_of) if m is None else as_of_day(m.calendar, a.as_of)
    done: dict = {}
    if a.job in ("screens", "all"):
        done.update(runs.run_screens(m, as_of, a.out, params=params))
    if a.job in ("rankings", "all"):
        done.update(runs.run_rankings(m, as_of, a.out))
    if a.job in ("trends", "all"):
        done.update(runs.run_trends(m, as_of, a.out, params))
    if a.job in ("reports", "all"):
        done["reports"] = runs.run_reports(spark, as_of, a.out)
    if a.job in ("charts", "all"):
        done["charts"] = runs.run_charts(m, as_of, a.out, a.reason)
    print(json.dumps(done, indent=1))


if __name__ == "__main__":
    main()

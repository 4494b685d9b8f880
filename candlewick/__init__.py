"""candlewick: daily-bar screening and bar analytics on PySpark.

Layout
------
sources/    readers for bars, instrument facts, concept tags, quote snapshots
functions/  Column-level helpers (predicates, ordered arrays, formatting)
operators/  reusable DataFrame operators (calendar, windows, aggregates,
            indicators, bar maintenance)
plans/      composite screens, group rankings, publishing and the daily refresh
streaming/  Structured Streaming quote operators

Every screen is a lazy function ``(Market, as_of, **params) -> DataFrame``.

Entry points: ``load_market(spark, data_dir)`` (stored, code-bucketed market
tables in the folder named by ``spark.checkpoint.dir``); ``plans.screens``,
``plans.groups``, ``plans.publish``, ``plans.pipeline`` (the daily refresh);
``plans.runs`` and ``python -m candlewick`` for the daily, refresh and live
jobs; ``plans.registry`` for the registered queries and their DuckDB oracles.
"""

from candlewick.plans.market import Market, load_market

__all__ = ["Market", "load_market"]

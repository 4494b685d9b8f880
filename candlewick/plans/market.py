"""The model tables one screening run reads, as DataFrames.

``load_market`` derives them from the driver tables and, by default, writes
them once as Parquet under the cluster's shared folder
(``spark.checkpoint.dir``): later screens read the stored tables (filters
and column pruning reach the scan; lineage is cut; a lost executor recomputes
from files, not from the raw-line aggregation). Bars keep the code-hash
partitioning of the window stage (no extra shuffle, no sampling pass) and
are sorted by (date, code) inside each file, so the as-of slices every
screen reads skip whole row groups by their date min/max.
"""

from __future__ import annotations

import hashlib
import os
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schema import BAR_BASE_COLS, BAR_COLS, BARS_DAILY, CALENDAR_CODE, CONCEPT, INDEX_NAMES, INFO
from candlewick.session import path_exists, path_state, shared_dir
from candlewick.operators.bars import last_rows
from candlewick.operators.windows import INDEX_COLS, with_bar_index, with_moving_averages
from candlewick.sources import fixtures

# Part of the stored tables' fingerprint: bump whenever the derived tables change.
FIXTURE_VERSION = "8"


@dataclass
class Market:
    bars: DataFrame      # stock_daily + stock_daily_more (all MA columns)
    info: DataFrame      # stock_info
    concept: DataFrame   # stock_concept
    calendar: DataFrame  # open days: dates of the index series `sh`
    listing: DataFrame | None = None  # stored (code, first_date); derived from bars when absent
    numbered: DataFrame | None = None  # bars + bar_no (1-based position in the code's series) + tail_from
    ma_state: DataFrame | None = None  # stored per-code state of the MA table (operators.bars.last_rows)

    def first_dates(self) -> DataFrame:
        """A01's min_date per code (a first day never depends on later bars)."""
        if self.listing is not None:
            return self.listing
        return self.bars.groupBy("code").agg(F.min("date").alias("first_date"))

    @property
    def daily(self) -> DataFrame:
        """stock_daily columns only."""
        return self.bars.select(*BAR_BASE_COLS)

    @property
    def stocks(self) -> DataFrame:
        """Bars without the index series (all six index names)."""
        return self.bars.filter(~F.col("code").isin(*INDEX_NAMES))


def calendar_of(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("code") == CALENDAR_CODE).select("date").distinct()


def market_from_frames(bars: DataFrame, info: DataFrame, concept: DataFrame) -> Market:
    numbered = bars if "bar_no" in bars.columns else None
    bars = bars.select(*BAR_COLS)
    return Market(bars=bars, info=info, concept=concept, calendar=calendar_of(bars), numbered=numbered)


_LOCK = threading.Lock()
_CACHE: dict[tuple, Market] = {}


#: Folders of stored bar, instrument and concept tables (schema.BARS_DAILY, INFO, CONCEPT).
STORED = ("stock_daily", "stock_info", "stock_concept")


def _stored_source(spark: SparkSession, path: str):
    """Builders over stored tables: the averages and bar positions are
    computed, whatever the daily table carries."""
    def bars():
        daily = read_landed(spark, f"{path}/stock_daily", BARS_DAILY)
        return with_bar_index(with_moving_averages(daily)).select(*BAR_COLS, *INDEX_COLS)

    return (bars, lambda: read_landed(spark, f"{path}/stock_info", INFO),
            lambda: read_landed(spark, f"{path}/stock_concept", CONCEPT))


def _fixture_source(spark: SparkSession, path: str):
    """Builders over the driver's tables (FIXTURES.md section 2)."""
    return (lambda: fixtures.bars(spark, path), lambda: fixtures.info(spark, path),
            lambda: fixtures.concept(spark, path))


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Landing files read with an explicit schema (never inferred)."""
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes with the path, size or modification time of any source table,
    on whatever file system it is."""
    h = hashlib.sha1(FIXTURE_VERSION.encode())
    for name in ("lineitem.parquet", "supplier.parquet", "nation.parquet", "part.parquet", *STORED):
        h.update(f"{name}:{path_state(spark, f'{sf_dir}/{name}')};".encode())
    return h.hexdigest()[:16]


def _stored(spark: SparkSession, path: str, build, writer) -> DataFrame:
    if not path_exists(spark, f"{path}/_SUCCESS"):
        target = path
        if path_exists(spark, path):  # a partial earlier write: use a fresh folder
            target = f"{path}-{os.getpid()}-{threading.get_ident()}"
        writer(build()).parquet(target)
        path = target
    return spark.read.parquet(path)


def _bucketed(spark: SparkSession, name: str, path: str, build, buckets: int, sort_cols) -> DataFrame:
    """A table bucketed by code (``buckets`` files, each sorted by
    ``sort_cols``) registered in the session catalog over ``path``.

    Windows, aggregates and joins keyed by code then run without an
    Exchange; date predicates still reach the scan. A later session finds
    the files and only registers the table again.
    """
    sort_sql = ", ".join(sort_cols)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df = build()
        (df.repartition(buckets, "code").write.mode("overwrite").bucketBy(buckets, "code")
         .sortBy(*sort_cols).option("path", path).saveAsTable(name))
    elif not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (code) SORTED BY ({sort_sql}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def use_market(spark: SparkSession, sf_dir: str, m: Market, layout: str | None = None) -> None:
    """Make ``m`` the market that ``load_market(spark, sf_dir)`` returns in
    this session (e.g. one built into a chosen folder)."""
    layout = layout or os.environ.get("CANDLEWICK_LAYOUT", "bucketed")
    with _LOCK:
        _CACHE[(id(spark.sparkContext), _fingerprint(spark, sf_dir), layout, None)] = m


def load_market(spark: SparkSession, sf_dir: str, materialize: bool = True, layout: str | None = None,
                root: str | None = None) -> Market:
    """Bars, info, concept and calendar for the tables in ``sf_dir``: stored
    ``stock_daily``, ``stock_info`` and ``stock_concept`` tables where they
    are there, else the driver's tables.

    ``layout``: ``"bucketed"`` (default; tables bucketed by code) or
    ``"files"`` (plain Parquet folders); override with ``CANDLEWICK_LAYOUT``.
    The bucket count is ``spark.candlewick.buckets`` when set, else
    ``spark.sql.shuffle.partitions`` (equal counts let joins with shuffled
    sides keep the buckets' partitioning). ``root`` overrides the folder of
    the stored tables (default: derived from the input fingerprint in the
    shared folder, so later sessions reuse them).
    """
    source = _stored_source if path_exists(spark, f"{sf_dir}/{STORED[0]}") else _fixture_source
    make_bars, make_info, make_concept = source(spark, sf_dir)
    if not materialize:
        return market_from_frames(make_bars(), make_info(), make_concept())
    layout = layout or os.environ.get("CANDLEWICK_LAYOUT", "bucketed")
    fp = _fingerprint(spark, sf_dir)
    key = (id(spark.sparkContext), fp, layout, root)
    with _LOCK:
        m = _CACHE.get(key)
        if m is not None:
            return m
        root = root or f"{shared_dir(spark)}/candlewick-tables/{fp}"
        tag = hashlib.sha1(root.encode()).hexdigest()[:16]  # catalog names follow the storage folder
        if layout == "bucketed":
            n = int(spark.conf.get("spark.candlewick.buckets", None)
                    or spark.conf.get("spark.sql.shuffle.partitions"))
            bars = _bucketed(spark, f"cw_bars_{tag}_{n}", f"{root}/bars-b{n}", make_bars,
                             n, ("date", "code"))
            info = _bucketed(spark, f"cw_info_{tag}_{n}", f"{root}/info-b{n}", make_info,
                             n, ("code",))
            concept = _bucketed(spark, f"cw_concept_{tag}_{n}", f"{root}/concept-b{n}",
                                make_concept, n, ("code",))
        else:
            bars = _stored(
                spark, f"{root}/bars", make_bars,
                lambda df: df.sortWithinPartitions("date", "code").write,
            )
            info = _stored(spark, f"{root}/info", make_info, lambda df: df.write)
            concept = _stored(
                spark, f"{root}/concept", make_concept, lambda df: df.write)
        cal = _stored(
            spark, f"{root}/calendar", lambda: calendar_of(bars),
            lambda df: df.coalesce(1).sortWithinPartitions("date").write)
        first = lambda: bars.groupBy("code").agg(F.min("date").alias("first_date"))
        if layout == "bucketed":
            listing = _bucketed(spark, f"cw_listing_{tag}_{n}", f"{root}/listing-b{n}", first, n, ("code",))
        else:
            listing = _stored(spark, f"{root}/listing", first, lambda df: df.write)
        state = lambda: last_rows(bars)
        if layout == "bucketed":
            ma_state = _bucketed(spark, f"cw_state_{tag}_{n}", f"{root}/ma_state-b{n}", state, n, ("code",))
        else:
            ma_state = _stored(spark, f"{root}/ma_state", state, lambda df: df.write)
        m = Market(bars=bars.select(*BAR_COLS), info=info, concept=concept, calendar=cal, listing=listing,
                   numbered=bars, ma_state=ma_state)
        _CACHE[key] = m
        return m

"""The registered queries: every operator on whole tables. ``oracle.py`` has the SQL twins.

Rounding happens here only, and only for sums, means and deviations, whose last
digits depend on the order of additions. Jobs that pass over derived rows more
than once (models, attribution, risk labels) write them to a table first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave import schemas
from assetweave.functions import indicators as ind
from assetweave.functions.cleaning import clean_money, ratio
from assetweave.functions.risk import RISK_LABELS, age_risk, risk_bin, risk_score
from assetweave.operators import attribution as shap
from assetweave.operators import cleaning, cluster, lloyd, market, merge, metrics, portfolio, profile, returns, rolling
from assetweave.operators.asof import asof_join
from assetweave.operators.attribution_exact import attribution_exact, largest_gap
from assetweave.operators.ema import ema_lookback, with_ema
from assetweave.operators.series import DAILY, Series, in_blocks
from assetweave.plans import assets as asset_plans
from assetweave.plans import features
from assetweave.plans.advisor import explained, recommend
from assetweave.plans.prices import returns_by_source
from assetweave.session import new_path, stored
from assetweave.sources import market_tables as tables
from assetweave.sources import readers, sinks
from assetweave.sources.keyed_table import read_keyed, upsert_table
from assetweave.sources.lookup import lookup, write_lookup
from assetweave.sources.rejects import audit, read_csv_checked
from assetweave.streaming import quotes as stream
from assetweave.streaming.market_clock import every_interval
from assetweave.streaming.metrics import counted

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: fixed values shared with the SQL twins
TODAY = tables.TODAY
NOW = dt.datetime(2001, 11, 5, 12, 0, tzinfo=dt.timezone.utc)
BEFORE = dt.datetime(2001, 1, 1, 12, 0, tzinfo=dt.timezone.utc)
ONE_ASSET = "Supplier#000000001"
CHOSEN = {
    "core": ["Supplier#000000001", "Supplier#000000002", "Supplier#000000005"],
    "satellite": ["Supplier#000000003", "Supplier#000000002", "no such asset"],
    "empty": [],
}
AS_OF = ["1994-12-31", "1996-06-30", "1998-12-25", "2001-11-04"]
VOLATILITY_CENTERS = [0.8, -0.8, 0.0]
FEATURE_CENTERS = [[0.0, 0.0, 0.3, 1.0], [0.2, 0.0, -0.5, -0.6], [-0.3, 0.1, 0.8, 0.0]]
#: assets that the queries on updates take as known already
KNOWN_REGIONS = ["AFRICA", "ASIA"]


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; all queries run with UTC as session time zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Put columns on a grid of 10^-digits.

    Plain rounding differs between engines on ties, which short averages of
    two-digit prices do hit; the offset keeps ties away from the edge.
    """
    return df.withColumns({c: F.floor(F.col(c) * 10.0**n + 0.4999) / 10.0**n for c, n in digits.items()})


def _bars(spark, sf_dir):
    """Bars for queries that pass over them more than once: ticks are read and aggregated once."""
    return stored(tables.bars(spark, sf_dir), "bars")


def _known(df: DataFrame) -> DataFrame:
    """Rows of the assets that are known already, with their whole history."""
    return df.where(F.col("category").isin(KNOWN_REGIONS))


def key_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("ticker", "dt", *columns)


# sources ---------------------------------------------------------------------


@query
def s01_csv_scan(spark, sf_dir):
    path = new_path(spark, "bars-csv")
    sinks.write_csv(tables.bars(spark, sf_dir), path)
    return readers.read_csv(spark, path, schemas.BARS)


def _two_sources(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    quotes = tables.quotes(spark, sf_dir)
    historical = bars.select(
        F.col("ticker").alias("asset"),
        F.col("dt").cast("timestamp_ntz").alias("ts"),
        F.lit(0).cast("bigint").alias("seq"),
        "close",
    )
    realtime = quotes.select("asset", "ts", F.col("event_id").alias("seq"), F.col("price").alias("close"))
    return {"historical": historical, "realtime": realtime}


@query
def s02_ingest(spark, sf_dir):
    return readers.ingest(_two_sources(spark, sf_dir))


@query
def s03_qualify(spark, sf_dir):
    return readers.qualify(tables.bars(spark, sf_dir).select("ticker", "dt", "close"), "close", "bars", 1)


@query
def s04_read_table(spark, sf_dir):
    path = new_path(spark, "table")
    prices = tables.bars(spark, sf_dir).select(F.concat_ws("/", "ticker", "dt").alias("_id"), "ticker", "dt", "close")
    sinks.append(prices, path)
    return readers.read_table(spark, path)


@query
def s05_load_prices(spark, sf_dir):
    path = new_path(spark, "landed")
    landed = tables.bars(spark, sf_dir).select("ticker", "dt", "close", "category")
    landed.write.partitionBy("category").option("header", True).csv(path)
    schema = landed.select("ticker", "dt", "close").schema
    return readers.load_prices(spark, path, schema, tag="category")


@query
def s06_ingest_audit(spark, sf_dir):
    universe = tables.assets(spark, sf_dir)
    raw = tables.raw_quotes(tables.bars(spark, sf_dir)).withColumnRenamed("asset", "ticker")
    return readers.ingest_audit(universe, cleaning.curate_prices(raw))


@query
def s07_universe(spark, sf_dir):
    return readers.universe_of(tables.bars(spark, sf_dir))


@query
def s07_universe_mapping(spark, sf_dir):
    """A universe given as lists per category, with what is stored of each of its assets."""
    counted = tables.bars(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n_bars"), F.max("dt").alias("last_dt"))
    chosen = readers.universe(spark, CHOSEN).join(counted, "ticker", "left")
    return chosen.select("category", "ticker", F.coalesce("n_bars", F.lit(0)).alias("n_bars"), "last_dt")


def _daily_json(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    cells = [F.col(c).cast("string") for c in ("open", "high", "low", "close")]
    cells.append(F.col("volume").cast("bigint").cast("string"))
    entry = []
    for name, cell in zip(readers.VENDOR_FIELDS, cells):
        entry += [F.lit(name), cell]
    day = F.struct(F.date_format("dt", "yyyy-MM-dd").alias("key"), F.create_map(*entry).alias("value"))
    # one document per asset and month: at most 31 entries
    documents = bars.groupBy("ticker", F.trunc("dt", "month").alias("month")).agg(
        F.to_json(F.map_from_entries(F.collect_list(day))).alias("body")
    )
    return documents.select("ticker", "body")


@query
def s08_daily_json(spark, sf_dir):
    return readers.parse_daily_json(_daily_json(spark, sf_dir))


@query
def s08_daily_json_envelope(spark, sf_dir):
    """Whole vendor responses, the days one level down."""
    open_, close = F.lit(f'{{"Meta Data": {{"2. Symbol": "x"}}, "{readers.VENDOR_ENVELOPE}": '), F.lit("}")
    wrapped = _daily_json(spark, sf_dir).withColumn("body", F.concat(open_, "body", close))
    return readers.parse_daily_json(wrapped, envelope=readers.VENDOR_ENVELOPE)


@query
def s09_prices_for(spark, sf_dir):
    prices = tables.bars(spark, sf_dir, ONE_ASSET).withColumnRenamed("ticker", "asset")
    return readers.prices_for(prices, ONE_ASSET)


@query
def s09_prices_for_sorted(spark, sf_dir):
    """The same lookup in a table laid out for it."""
    path = new_path(spark, "lookup")
    write_lookup(tables.bars(spark, sf_dir), path, key="ticker")
    return lookup(spark, path, ONE_ASSET, key="ticker")


def _csv_with_bad_lines(spark, sf_dir):
    """Lines of bars, some with a broken price, a missing field, one too many, or a broken date."""
    day = F.dayofmonth("dt")
    iso = F.date_format("dt", "yyyy-MM-dd")
    close = F.when(day % 11 == 0, "n/a").otherwise(F.col("close").cast("string"))
    fields = [F.col("ticker"), F.when(day == 29, F.concat(F.lit("day "), iso)).otherwise(iso), close]
    line = F.when(day == 13, F.concat_ws(",", *fields[:2])).when(day == 17, F.concat_ws(",", *fields, F.lit("x")))
    path = new_path(spark, "lines")
    tables.bars(spark, sf_dir).select(line.otherwise(F.concat_ws(",", *fields))).write.text(path)
    return read_csv_checked(spark, path, schemas.PRICE_LINES, header=False)


@query
def s01_checked_rows(spark, sf_dir):
    return _csv_with_bad_lines(spark, sf_dir).rows


@query
def s01_rejects(spark, sf_dir):
    """Lines that don't fit, with their reason."""
    return _csv_with_bad_lines(spark, sf_dir).rejects.select("line", "reason")


@query
def s06_reject_audit(spark, sf_dir):
    return audit(_csv_with_bad_lines(spark, sf_dir))


@query
def u01_union_all(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    old = bars.where(F.col("dt") < F.lit("1998-01-01").cast("date")).select("ticker", "dt", "close")
    new = bars.where(F.col("dt") >= F.lit("1998-01-01").cast("date")).select("ticker", "dt", "close", "volume")
    return readers.union_all([old, new])


# sinks and keyed updates -----------------------------------------------------


@query
def k01_write_csv(spark, sf_dir):
    path = new_path(spark, "prices-csv")
    prices = tables.bars(spark, sf_dir).select("ticker", "dt", "close")
    sinks.write_csv(prices, path)
    return readers.read_csv(spark, path, prices.schema)


def _halves(spark, sf_dir):
    prices = tables.bars(spark, sf_dir).select("ticker", "dt", "close")
    cut = F.lit("1999-01-01").cast("date")
    return prices.where(F.col("dt") < cut), prices.where(F.col("dt") >= cut)


@query
def k02_append(spark, sf_dir):
    path = new_path(spark, "prices")
    for part in _halves(spark, sf_dir):
        sinks.append(part, path)
    return readers.read_table(spark, path)


@query
def k03_overwrite(spark, sf_dir):
    table = new_path(spark, "versions")
    for part in _halves(spark, sf_dir):
        sinks.overwrite(part, table)
    return sinks.read_current(spark, table)


@query
def k04_append_csv(spark, sf_dir):
    path = new_path(spark, "prices-csv")
    first, second = _halves(spark, sf_dir)
    sinks.append_csv(first, path)
    sinks.append_csv(second, path)
    return readers.read_csv(spark, path, first.schema)


def _base_and_delta(bars):
    prices = bars.select("ticker", "dt", "close")
    day = F.col("dt")
    base = prices.where(day < F.lit("2000-01-01").cast("date")).withColumn(
        "last_updated", F.lit("2001-01-01").cast("date")
    )
    delta = prices.where(day >= F.lit("1999-06-01").cast("date")).select(
        "ticker", "dt", (F.col("close") * 2).alias("close"), F.lit(TODAY).cast("date").alias("last_updated")
    )
    return base, delta


@query
def k05_upsert(spark, sf_dir):
    base, delta = _base_and_delta(tables.bars(spark, sf_dir))
    return merge.upsert(base, delta, ["ticker", "dt"], "last_updated", ["close"])


@query
def k05_upsert_stored(spark, sf_dir):
    """The same rows through the keyed table: stored by month, stamped, two deltas, one of them again."""
    table, month = new_path(spark, "prices"), F.date_format("dt", "yyyy-MM")
    order = [F.col("last_updated_timestamp").desc(), F.col("close").desc()]
    base, delta = _base_and_delta(tables.bars(spark, sf_dir))
    for rows, now in ((base, BEFORE), (delta, NOW), (delta, NOW)):
        rows = rows.select("ticker", "dt", "close")
        upsert_table(rows, table, ["ticker", "dt"], order, month, "close", now)
    return _naive(read_keyed(spark, table), "last_updated_timestamp")


@query
def k05_upsert_counts(spark, sf_dir):
    """Rows written and failed; a price that doesn't parse fails."""
    raw = cleaning.curate_prices(_raw(spark, sf_dir)).select("asset", "dt", "close")
    order = [F.col("last_updated_timestamp").desc(), F.col("close").desc()]
    month = F.date_format("dt", "yyyy-MM")
    counts = upsert_table(raw, new_path(spark, "prices"), ["asset", "dt"], order, month, "close", NOW)
    return spark.createDataFrame([(counts["written"], counts["failed"])], "written long, failed long")


@query
def k06_merge_fields(spark, sf_dir):
    base = tables.attributes(spark, sf_dir).withColumn("daily_volatility", F.lit(-1.0))
    known = _known(tables.bars(spark, sf_dir))
    delta = metrics.volatility(metrics.with_returns(known)).select("ticker", "daily_volatility", "annual_volatility")
    return rounded(merge.merge_fields(base, delta, "ticker"), daily_volatility=6, annual_volatility=6)


@query
def k07_observe_stage(spark, sf_dir):
    path = new_path(spark, "observed")
    observed, seen = sinks.observe_stage(tables.bars(spark, sf_dir), "bars")
    observed.write.parquet(path)
    return sinks.stage_metrics(spark, {"bars": seen})


@query
def k07_failed_stage(spark, sf_dir):
    """A stage that fails is reported, and the others go on."""
    quotes = _raw(spark, sf_dir)
    broken = quotes.withColumn("close_text", F.when(F.col("close_text") == "n/a", F.raise_error(F.lit("no price"))))
    stages = {
        name: sinks.run_stage(df, name, lambda d, name=name: d.write.parquet(new_path(spark, name)))
        for name, df in (("quotes", quotes), ("broken", broken))
    }
    found = sinks.stage_metrics(spark, stages)
    return found.withColumn("status", F.regexp_extract("status", "^[a-z]+", 0))


@query
def k08_change_stats(spark, sf_dir):
    bars = stored(tables.bars(spark, sf_dir).select("ticker", "dt", "close"), "bars")
    base, delta = _base_and_delta(bars)
    after = merge.upsert(base, delta, ["ticker", "dt"], "last_updated", ["close"])
    return merge.change_stats(base, after, ["ticker", "dt"])


# cleaning --------------------------------------------------------------------


def _raw(spark, sf_dir):
    return tables.raw_quotes(tables.bars(spark, sf_dir))


def _stamped(spark, sf_dir):
    return _raw(spark, sf_dir).withColumn("last_updated_timestamp", F.lit(None).cast("timestamp"))


@query
def p01_parse_date(spark, sf_dir):
    return cleaning.with_date(_raw(spark, sf_dir), "date_text").select("asset", "date_text", "dt")


@query
def p02_require_every(spark, sf_dir):
    curated = cleaning.curate_prices(_raw(spark, sf_dir)).select("asset", "dt", F.col("close").alias("close_a"))
    return cleaning.require(curated, how="every")


@query
def p02_require_any(spark, sf_dir):
    merged = readers.ingest(_two_sources(spark, sf_dir))
    return cleaning.require(merged, date="ts", how="any")


@query
def p03_drop_incomplete(spark, sf_dir):
    return cleaning.drop_incomplete(cleaning.curate_prices(_raw(spark, sf_dir)))


@query
def p04_project(spark, sf_dir):
    return cleaning.project(tables.bars(spark, sf_dir), schemas.PROCESSED)


@query
def p04_project_enhanced(spark, sf_dir):
    projected = cleaning.project(_enhanced(spark, sf_dir, True), schemas.PROCESSED_ENHANCED)
    return rounded(projected, beta=6, alpha=6)


@query
def p05_clean_money(spark, sf_dir):
    return _raw(spark, sf_dir).select("asset", "date_text", "close_text", clean_money("close_text").alias("close"))


@query
def p06_standardize_dates(spark, sf_dir):
    fixed = cleaning.standardize_dates(_stamped(spark, sf_dir), NOW)
    return fixed.withColumn("last_updated_timestamp", F.col("last_updated_timestamp").cast("timestamp_ntz"))


@query
def p07_assets_with_bad_dates(spark, sf_dir):
    return cleaning.assets_with_bad_dates(_raw(spark, sf_dir))


@query
def p08_backfill_stamps(spark, sf_dir):
    filled = cleaning.backfill_stamps(_stamped(spark, sf_dir), NOW)
    return filled.withColumn("last_updated_timestamp", F.col("last_updated_timestamp").cast("timestamp_ntz"))


@query
def p08_missing_stamps(spark, sf_dir):
    return cleaning.missing_stamps(_stamped(spark, sf_dir))


@query
def p09_impute_mean(spark, sf_dir):
    curated = stored(cleaning.curate_prices(_raw(spark, sf_dir)).select("asset", "dt", "close"), "curated")
    return rounded(cleaning.impute_mean(curated, ["close"]), close=6)


@query
def p10_require_columns(spark, sf_dir):
    return schemas.require_columns(tables.bars(spark, sf_dir), ["ticker", "dt", "close"])


@query
def p11_ensure_features(spark, sf_dir):
    wanted = ["intraday_return", "volatility_10", "avg_volume_50", "rsi_14"]
    df = features.ensure_features(tables.bars(spark, sf_dir), wanted)
    return rounded(key_of(df, *wanted), volatility_10=6, avg_volume_50=4, rsi_14=4)


@query
def p12_needs_enrichment(spark, sf_dir):
    meta = tables.attributes(spark, sf_dir).withColumn("long_name", F.col("short_name"))
    return merge.missing_names(meta)


@query
def p13_normalize_metadata(spark, sf_dir):
    raw = tables.attributes(spark, sf_dir)
    failed = F.col("short_name").isNull() & (F.col("asset_type") != "ETF")
    return cleaning.normalize_metadata(raw, failed)


@query
def p14_j03_pending(spark, sf_dir):
    meta = metrics.volatility(metrics.with_returns(_known(tables.bars(spark, sf_dir))))
    return merge.pending(tables.assets(spark, sf_dir), meta, ["daily_volatility"])


@query
def p15_market_hours(spark, sf_dir):
    return tables.quotes(spark, sf_dir).where(cleaning.market_hours("ts"))


@query
def p16_attach_user(spark, sf_dir):
    latest = portfolio.latest_per_asset(tables.bars(spark, sf_dir), ["ticker", "category"], ["close"])
    return cleaning.attach_user(latest, 30, 50000, 7)


@query
def p16_attach_users(spark, sf_dir):
    """Many users: each with the assets of their risk class, of which a short list is chosen once per class."""
    built = portfolio.build_portfolio(tables.users(spark, sf_dir), _labelled(spark, sf_dir), k=2)
    return built.select("user_id", "age", "amount", "duration", "ticker", "risk_category")


@query
def p17_match_tolerance(spark, sf_dir):
    matched = portfolio.match_tolerance(_labelled(spark, sf_dir), tables.users(spark, sf_dir))
    return matched.select("ticker", "risk_category", "tolerance", "n_users", "total_amount")


@query
def p18_clustered_view(spark, sf_dir):
    view = cluster.clustered_view(_labelled(spark, sf_dir), ["ticker", "daily_volatility"])
    return rounded(view, daily_volatility=6)


@query
def p19_date_range(spark, sf_dir):
    return readers.date_range(tables.bars(spark, sf_dir), "1998-01-01", "2000-01-01")


# joins -----------------------------------------------------------------------


@query
def j01_with_market(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    return key_of(market.with_market(bars, tables.market(bars)), "close", "close_market")


@query
def j02_enrich(spark, sf_dir):
    meta = tables.attributes(spark, sf_dir).select(
        "ticker", "short_name", F.col("short_name").alias("long_name"), "asset_type", "sector"
    )
    found = tables.assets(spark, sf_dir).select(
        "ticker",
        F.concat(F.lit("Asset "), "ticker").alias("short_name"),
        F.lit(None).cast("string").alias("long_name"),
        F.lit("EQUITY").alias("asset_type"),
        F.lower("category").alias("sector"),
    )
    return merge.enrich(meta, found)


@query
def j04_asof_close(spark, sf_dir):
    return returns.asof_close(tables.bars(spark, sf_dir), TODAY)


@query
def j04_asof_closes(spark, sf_dir):
    """The price as of many days, one row per asset and day."""
    return returns.asof_closes(tables.bars(spark, sf_dir), AS_OF)


@query
def j04_asof_join(spark, sf_dir):
    """The last close at or before the day that each request asks for; one asset has a third of all requests."""
    return asof_join(tables.asof_requests(spark, sf_dir), tables.bars(spark, sf_dir), found_at="close_at")


@query
def j04_asof_quotes(spark, sf_dir):
    """The last quote before each order, by the second; the quotes of an asset have no bound."""
    quotes = tables.quotes(spark, sf_dir)
    return asof_join(
        tables.quote_requests(spark, sf_dir), quotes, key="asset", at="asked_at", when="ts", value="price", tie=("event_id",)
    )


@query
def j05_with_fundamentals(spark, sf_dir):
    joined = market.with_fundamentals(tables.bars(spark, sf_dir), tables.fundamentals(spark, sf_dir))
    return key_of(joined, "close", "eps")


# aggregations ----------------------------------------------------------------


@query
def a01_distinct_values(spark, sf_dir):
    return profile.distinct_values(tables.bars(spark, sf_dir), "ticker")


def _lines(spark, sf_dir):
    return tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query
def a02_duplicate_groups(spark, sf_dir):
    return merge.duplicate_groups(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query
def a03_dedupe(spark, sf_dir):
    order = ["l_partkey", "l_suppkey", "l_extendedprice"]
    return merge.dedupe(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], order)


def _returns(spark, sf_dir):
    return metrics.with_returns(tables.bars(spark, sf_dir))


VOLATILITIES = {f"{name}_volatility": 6 for name in metrics.PERIODS}


@query
def a04_volatility(spark, sf_dir):
    return rounded(metrics.volatility(_returns(spark, sf_dir)), **VOLATILITIES)


@query
def a05_sharpe(spark, sf_dir):
    return rounded(metrics.sharpe(_returns(spark, sf_dir)), sharpe_ratio=6)


@query
def a06_sortino(spark, sf_dir):
    return rounded(metrics.sortino(_returns(spark, sf_dir)), sortino_ratio=6)


TRAILING = {"return_ytd": 6, "return_1y": 6, "return_3y": 6, "return_5y": 6}


@query
def a07_trailing_returns(spark, sf_dir):
    return rounded(returns.trailing_returns(tables.bars(spark, sf_dir), TODAY), **TRAILING)


@query
def a08_risk_adjusted(spark, sf_dir):
    all_metrics = metrics.asset_metrics(tables.bars(spark, sf_dir), TODAY)
    out = all_metrics.select("ticker", "risk_adjusted_ytd", "risk_adjusted_1y")
    return rounded(out, risk_adjusted_ytd=6, risk_adjusted_1y=6)


@query
def a09_beta(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    joined = market.with_market_returns(market.with_market(bars, tables.market(bars)))
    return rounded(market.beta(joined), beta=6)


@query
def a10_null_profile(spark, sf_dir):
    return profile.null_profile(cleaning.curate_prices(_raw(spark, sf_dir)))


@query
def a11_describe(spark, sf_dir):
    bars = stored(tables.bars(spark, sf_dir), "bars")
    summary = profile.describe(bars, ["open", "high", "low", "close", "volume"])
    return rounded(summary, mean=4, std=4, p25=4, p50=4, p75=4)


@query
def a12_correlation(spark, sf_dir):
    return rounded(profile.correlation(_basic(spark, sf_dir), features.BASIC), corr=6)


@query
def a13_sector_allocation(spark, sf_dir):
    return rounded(portfolio.sector_allocation(_labelled(spark, sf_dir)), share=6)


@query
def a15_asset_metrics(spark, sf_dir):
    all_metrics = metrics.asset_metrics(tables.bars(spark, sf_dir), TODAY)
    extra = {"sharpe_ratio": 6, "sortino_ratio": 6, "risk_adjusted_ytd": 6, "risk_adjusted_1y": 6}
    return rounded(all_metrics, **VOLATILITIES, **TRAILING, **extra)


@query
def a15_refresh_metadata(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    meta = metrics.volatility(metrics.with_returns(_known(bars))).select("ticker", "daily_volatility")
    assets = tables.assets(spark, sf_dir)
    fresh = asset_plans.refresh_metadata(assets, stored(meta, "metadata"), bars, TODAY, ["daily_volatility"])
    out = fresh.select("ticker", "daily_volatility", "return_1y", "sharpe_ratio")
    return rounded(out, daily_volatility=6, return_1y=6, sharpe_ratio=6)


# windows ---------------------------------------------------------------------


@query
def w01_daily_return(spark, sf_dir):
    return key_of(_returns(spark, sf_dir), "close", "daily_return")


@query
def w01_returns_by_source(spark, sf_dir):
    merged = returns_by_source(_two_sources(spark, sf_dir))
    return merged.select("source", "asset", "ts", "seq", "close", "daily_return")


@query
def w02_intraday_return(spark, sf_dir):
    return key_of(tables.bars(spark, sf_dir).withColumn("intraday_return", ind.intraday_return()), "intraday_return")


SMAS = (10, 20, 30, 50, 100, 200)


@query
def w03_sma(spark, sf_dir):
    wanted = {f"sma_{n}": ("close", n) for n in SMAS}
    df = rolling.with_means(tables.bars(spark, sf_dir), wanted)
    return rounded(key_of(df, *wanted), **{c: 4 for c in wanted})


@query
def w04_volatility_10(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("intraday_return", ind.intraday_return())
    df = rolling.with_deviations(df, {"volatility_10": ("intraday_return", 10)})
    return rounded(key_of(df, "volatility_10"), volatility_10=6)


@query
def w05_avg_volume(spark, sf_dir):
    wanted = {"avg_volume_10": ("volume", 10), "avg_volume_50": ("volume", 50)}
    df = rolling.with_means(tables.bars(spark, sf_dir), wanted)
    return rounded(key_of(df, *wanted), avg_volume_10=4, avg_volume_50=4)


@query
def w06_rsi(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("change", ind.difference("close", 1))
    return rounded(key_of(rolling.with_rsi(df), "rsi_14"), rsi_14=4)


@query
def w07_log_return(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("log_return", ind.log_return())
    return rounded(key_of(df, "log_return"), log_return=6)


@query
def w08_ema(spark, sf_dir):
    df = with_ema(tables.bars(spark, sf_dir), {"ema_20": 20, "ema_50": 50})
    return rounded(key_of(df, "ema_20", "ema_50"), ema_20=4, ema_50=4)


@query
def w08_ema_with_gaps(spark, sf_dir):
    """Closes missing at the start and in between."""
    bars = tables.bars(spark, sf_dir).select("ticker", "dt", "close")
    gone = (F.col("dt") < F.lit("1995-06-01").cast("date")) | (F.dayofmonth("dt") % 7 == 0)
    df = with_ema(bars.withColumn("close", F.when(~gone, F.col("close"))), {"ema_20": 20, "ema_50": 50})
    return rounded(key_of(df, "close", "ema_20", "ema_50"), ema_20=4, ema_50=4)


@query
def w09_bollinger(spark, sf_dir):
    df = rolling.with_bands(tables.bars(spark, sf_dir))
    return rounded(key_of(df, "upper_band", "lower_band"), upper_band=4, lower_band=4)


@query
def w10_historical_volatility(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("log_return", ind.log_return())
    df = rolling.with_deviations(df, {"historical_volatility": ("log_return", 20)})
    return rounded(key_of(df, "historical_volatility"), historical_volatility=6)


@query
def w11_price_change(spark, sf_dir):
    df = tables.bars(spark, sf_dir)
    return key_of(df.withColumn("price_change", F.col("close") - F.col("open")), "price_change")


@query
def w12_momentum_difference(spark, sf_dir):
    wanted = {f"momentum_{n}": ind.difference("close", n) for n in (10, 20)}
    return key_of(tables.bars(spark, sf_dir).withColumns(wanted), *wanted)


@query
def w13_momentum_percent(spark, sf_dir):
    return key_of(tables.bars(spark, sf_dir).withColumn("momentum", ind.momentum()), "momentum")


@query
def w14_price_volume_ratio(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("price_volume_ratio", ratio("close", "volume"))
    return key_of(df, "price_volume_ratio")


def _enhanced(spark, sf_dir, complete):
    bars = _bars(spark, sf_dir)
    return features.enhanced_bars(bars, tables.market(bars), tables.fundamentals(spark, sf_dir), complete=complete)


@query
def w15_alpha(spark, sf_dir):
    return rounded(key_of(_enhanced(spark, sf_dir, False), "beta", "alpha"), beta=6, alpha=6)


@query
def w16_dividend_yield(spark, sf_dir):
    df = tables.bars(spark, sf_dir).withColumn("dividend_yield", market.dividend_yield())
    return key_of(df, "dividend_yield")


@query
def w17_pe_ratio(spark, sf_dir):
    df = market.with_fundamentals(tables.bars(spark, sf_dir), tables.fundamentals(spark, sf_dir))
    return key_of(df.withColumn("pe_ratio", market.pe_ratio()), "pe_ratio")


BASIC_DIGITS = {
    "sma_10": 4,
    "sma_50": 4,
    "sma_200": 4,
    "volatility_10": 6,
    "avg_volume_10": 4,
    "avg_volume_50": 4,
    "rsi_14": 4,
}


@query
def w18_basic_features(spark, sf_dir):
    return rounded(features.basic_features(tables.bars(spark, sf_dir)), **BASIC_DIGITS)


@query
def w18_basic_features_partial(spark, sf_dir):
    """Windows that start before n rows are there."""
    return rounded(features.basic_features(tables.bars(spark, sf_dir), min_periods=1), **BASIC_DIGITS)


@query
def w18_basic_features_blocked(spark, sf_dir):
    """The same features in the blocked layout."""

    def compute(df, s):
        return features.basic_features(df, s, complete=False)

    df = in_blocks(tables.bars(spark, sf_dir), DAILY, features.BASIC_LOOKBACK, compute)
    return rounded(df.na.drop(subset=features.BASIC), **BASIC_DIGITS)


ADVANCED_DIGITS = {
    "log_return": 6,
    "sma_20": 4,
    "sma_50": 4,
    "sma_100": 4,
    "ema_20": 4,
    "ema_50": 4,
    "upper_band": 4,
    "lower_band": 4,
    "historical_volatility": 6,
    "volatility_10": 6,
    "avg_volume_50": 4,
    "rsi_14": 4,
}


@query
def w19_advanced_features(spark, sf_dir):
    return rounded(features.advanced_features(tables.bars(spark, sf_dir)), **ADVANCED_DIGITS)


@query
def w19_advanced_features_blocked(spark, sf_dir):
    """The same features in the blocked layout, exponential averages included."""

    def compute(df, s):
        return features.advanced_features(df, s, complete=False)

    df = in_blocks(tables.bars(spark, sf_dir), DAILY, features.ADVANCED_LOOKBACK, compute)
    return rounded(df.na.drop(subset=features.ADVANCED), **ADVANCED_DIGITS)


@query
def w20_enhanced_bars(spark, sf_dir):
    return rounded(_enhanced(spark, sf_dir, True), beta=6, alpha=6)


# order and limits ------------------------------------------------------------


@query
def o01_sorted_bars(spark, sf_dir):
    return portfolio.sorted_bars(tables.bars(spark, sf_dir))


@query
def o02_first_rows(spark, sf_dir):
    return portfolio.first_rows(tables.bars(spark, sf_dir), ["ticker", "dt"], 10)


@query
def o03_latest_record(spark, sf_dir):
    return portfolio.latest_record(tables.bars(spark, sf_dir), [F.col("dt").desc(), "ticker"])


@query
def o04_latest_per_asset(spark, sf_dir):
    return portfolio.latest_per_asset(tables.bars(spark, sf_dir), ["ticker", "category"], ["close", "volume"])


@query
def o05_choose_assets(spark, sf_dir):
    latest = portfolio.latest_per_asset(tables.bars(spark, sf_dir), ["ticker", "category"], ["close"])
    return portfolio.choose_assets(latest, ["category"])


# clustering ------------------------------------------------------------------


def _basic(spark, sf_dir):
    return stored(features.basic_features(tables.bars(spark, sf_dir)), "basic")


@query
def m01_scale(spark, sf_dir):
    scaled = cluster.scale(_basic(spark, sf_dir), cluster.FEATURES_5)
    values = vector_to_array("features")
    names = [f"z_{c}" for c in cluster.FEATURES_5]
    out = key_of(scaled.withColumns({n: values[i] for i, n in enumerate(names)}), *names)
    return rounded(out, **{n: 6 for n in names})


def _standard(df, columns, keep=()):
    """Gaps filled with the mean, standardised, stored; and the columns' names."""
    z = cluster.standardize(cleaning.impute_mean(df.select(*dict.fromkeys((*columns, *keep))), columns), columns)
    names = [f"z_{c}" for c in columns]
    return stored(z.select(*names, *keep), "standardised"), names


@query
def m02_elbow_costs(spark, sf_dir):
    """The cost of two to nine clusters; all of them take part in every round."""
    rows, names = _standard(_basic(spark, sf_dir), cluster.FEATURES_5)
    return rounded(lloyd.costs(rows, names, lloyd.fit(rows, names, range(2, 10))), cost=3)


def _clusters(df, columns):
    """Size and center of each of three clusters."""
    rows, names = _standard(df, columns)
    found = lloyd.sizes(rows, names, lloyd.fit(rows, names, [cluster.CLUSTERS])[cluster.CLUSTERS])
    found = found.withColumnsRenamed({f"center_{z}": f"center_{c}" for z, c in zip(names, columns)})
    return rounded(found, **{f"center_{c}": 4 for c in columns})


@query
def m03_clusters_5(spark, sf_dir):
    return _clusters(_basic(spark, sf_dir), cluster.FEATURES_5)


@query
def m03_clusters_10(spark, sf_dir):
    return _clusters(_all_features(spark, sf_dir), cluster.FEATURES_10)


@query
def m03_clusters_4(spark, sf_dir):
    return _clusters(_all_features(spark, sf_dir), cluster.FEATURES_4)


@query
def m05_risk_of_clusters(spark, sf_dir):
    """Risk label, rows and mean volatility of each of three clusters."""
    basic = _basic(spark, sf_dir)
    rows, names = _standard(basic, cluster.FEATURES_5, ("volatility_10",))
    k = cluster.CLUSTERS
    near = lloyd.assigned(rows, names, lloyd.fit(rows, names, [k])).withColumnRenamed(f"_cluster_{k}", "prediction")
    labelled = cluster.risk_label(near.select("volatility_10", "prediction"))
    found = labelled.groupBy("risk_category").agg(F.count("*").alias("n"), F.avg("volatility_10").alias("mean_volatility"))
    return rounded(found, mean_volatility=6)


@query
def m06_m07_saved_centers(spark, sf_dir):
    """Means, deviations and centers are saved, loaded, and score every row, gaps included: rows per cluster."""
    path = new_path(spark, "centers")
    features_of_rows = _all_features(spark, sf_dir)
    lloyd.save(lloyd.train(features_of_rows, cluster.FEATURES_4, cluster.CLUSTERS), path)
    scored = lloyd.score(features_of_rows, lloyd.load(spark, path))
    return scored.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))


@query
def m04_silhouette_values(spark, sf_dir):
    """Mean silhouette of every cluster, and (cluster -1) of all rows."""
    rows, names = _standard(_basic(spark, sf_dir), cluster.FEATURES_5)
    k = cluster.CLUSTERS
    near = lloyd.assigned(rows, names, lloyd.fit(rows, names, [k])).select(*names, F.col(f"_cluster_{k}").alias("cluster"))
    shaped = lloyd.silhouette_of(stored(near, "clustered"), names, "cluster")
    each = F.explode(F.array("cluster", F.lit(-1))).alias("cluster")
    found = shaped.select(each, "silhouette").groupBy("cluster")
    return rounded(found.agg(F.count("*").alias("n"), F.avg("silhouette").alias("silhouette")), silhouette=6)


# A trained model's clusters depend on random starts, so these queries return
# facts that hold of any right result and that SQL can state.


@query
def m02_elbow(spark, sf_dir):
    """Per number of clusters: whether its cost lies between zero and that of a single cluster."""
    rows, names = _standard(_basic(spark, sf_dir), cluster.FEATURES_5)
    costs = lloyd.costs(rows, names, lloyd.fit(rows, names, range(2, 10)))
    single = len(names) * (rows.count() - 1)  # standardised features have variance one
    return costs.select("k", F.col("cost").between(0, single * (1 + 1e-9)).alias("plausible"))


def _cluster_facts(rows, features):
    """One row: rows scored, clusters used, rows that lie nearer to another cluster's center."""
    model = cluster.train(rows, features)
    scored = cluster.predict(model, rows)
    _, _, centers = cluster.scaler_and_centers(model)
    names = [f"_at_{c}" for c in features]
    scored = scored.select("prediction", vector_to_array("features").alias("_at"))
    scored = scored.select("prediction", *[F.col("_at")[i].alias(name) for i, name in enumerate(names)])
    scored = scored.withColumn("_gaps", F.array(*[lloyd.squared(names, c) for c in centers]))
    own, least = F.col("_gaps")[F.col("prediction")], F.array_min("_gaps")
    return scored.agg(
        F.count("prediction").alias("rows_scored"),
        F.count_distinct("prediction").alias("clusters"),
        F.count_if(own > least + 1e-9).alias("misplaced"),
    )


@query
def m03_cluster_5(spark, sf_dir):
    return _cluster_facts(_basic(spark, sf_dir), cluster.FEATURES_5)


def _all_features(spark, sf_dir):
    return stored(features.ensure_features(_enhanced(spark, sf_dir, True), cluster.FEATURES_10), "features")


@query
def m03_cluster_10(spark, sf_dir):
    return _cluster_facts(_all_features(spark, sf_dir), cluster.FEATURES_10)


@query
def m03_cluster_4(spark, sf_dir):
    return _cluster_facts(_all_features(spark, sf_dir), cluster.FEATURES_4)


@query
def m04_silhouette(spark, sf_dir):
    clustered = cluster.cluster(_basic(spark, sf_dir), cluster.FEATURES_5)
    value = cluster.silhouette(clustered)
    return spark.createDataFrame([(clustered.count(), -1 <= value <= 1)], "rows_scored long, in_range boolean")


def _labelled(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    latest = stored(asset_plans.latest_profile(bars, tables.fundamentals(spark, sf_dir)), "profile")
    return asset_plans.labelled_assets(latest, VOLATILITY_CENTERS)


@query
def m05_risk_label(spark, sf_dir):
    return _labelled(spark, sf_dir).select("ticker", "prediction", "risk_category")


@query
def m05_trained_risk_label(spark, sf_dir):
    clustered = cluster.cluster(_basic(spark, sf_dir), cluster.FEATURES_5)
    labelled = cluster.risk_label(clustered)
    means = labelled.groupBy("risk_category").agg(F.avg("volatility_10").alias("mean"), F.count("*").alias("n"))
    level = F.array_position(F.array(*map(F.lit, RISK_LABELS)), F.col("risk_category"))
    by_mean = F.row_number().over(Window.orderBy("mean"))  # one row per label
    facts = means.select("n", (by_mean == level).alias("in_order"))
    return facts.agg(F.sum("n").alias("rows_labelled"), F.count("*").alias("labels"), F.bool_and("in_order").alias("in_order"))


@query
def m06_m07_train_and_score(spark, sf_dir):
    """A saved model scores every row, also those with gaps, as the model it was saved from."""
    path = new_path(spark, "model")
    gap = F.dayofmonth("dt") % 9 == 0
    rows = _all_features(spark, sf_dir).withColumn("alpha", F.when(~gap, F.col("alpha")))
    rows = stored(rows, "with-gaps")
    model = cluster.train(rows, cluster.FEATURES_4)
    cluster.save(model, path)
    # the reloaded model scores the scored rows once more, side by side
    before = cluster.predict(model, rows).drop("features")
    after = cluster.score(before, path, "reloaded")
    return after.agg(
        F.count("*").alias("rows_scored"),
        F.count_if(~F.col("prediction").eqNullSafe(F.col("reloaded"))).alias("different"),
        F.count_if(F.col("reloaded").isNull()).alias("without_cluster"),
    )


def _explained(spark, sf_dir):
    columns = cluster.FEATURES_4
    bars = features.ensure_features(_enhanced(spark, sf_dir, True), ["intraday_return", "volatility_10"])
    complete = stored(bars.select("ticker", "category", "dt", *columns).na.drop(), "explained")
    return cluster.standardize(complete, columns), [f"z_{c}" for c in columns]


def _attributed(spark, sf_dir, target):
    scaled, names = _explained(spark, sf_dir)
    return shap.attribution(scaled, names, FEATURE_CENTERS, shap.cells(scaled, names), target, keep=("ticker", "dt"))


ATTRIBUTIONS = {f"phi_z_{c}": 6 for c in cluster.FEATURES_4}


@query
def m08_attribution(spark, sf_dir):
    return rounded(_attributed(spark, sf_dir, "own"), **ATTRIBUTIONS)


@query
def a14_attribution_by_cluster(spark, sf_dir):
    """Per cluster, what on average puts its rows into it."""
    return rounded(shap.attribution_by_cluster(_attributed(spark, sf_dir, "own")), **ATTRIBUTIONS)


@query
def m08_attribution_of_cluster(spark, sf_dir):
    """What speaks for and against one cluster, for every row."""
    return rounded(_attributed(spark, sf_dir, 1), **ATTRIBUTIONS)


@query
def m08_attribution_all_rows(spark, sf_dir):
    """Every row as background, not summarised."""
    scaled, names = _explained(spark, sf_dir)
    return rounded(attribution_exact(scaled, names, FEATURE_CENTERS, keep=("ticker", "dt")), **ATTRIBUTIONS)


@query
def m08_gap_to_cells(spark, sf_dir):
    """How far the summary in cells is from all rows, at most."""
    scaled, names = _explained(spark, sf_dir)
    keys = ("ticker", "dt")
    exact = attribution_exact(scaled, names, FEATURE_CENTERS, keep=keys)
    cells = shap.attribution(scaled, names, FEATURE_CENTERS, shap.cells(scaled, names), keep=keys)
    return rounded(largest_gap(exact, cells, list(keys)), **ATTRIBUTIONS)


@query
def m08_trained_attribution(spark, sf_dir):
    """A trained model: a row's attributions add up to what its cluster has over the average row."""
    rows = _all_features(spark, sf_dir)
    model = cluster.train(rows, cluster.FEATURES_4)
    scored = stored(cluster.predict(model, rows).drop("features"), "scored")
    phi = explained(scored, model, keep=("ticker", "dt"))
    total = sum((F.col(f"phi_z_{c}") for c in cluster.FEATURES_4[1:]), F.col(f"phi_z_{cluster.FEATURES_4[0]}"))
    # 1 less the chance of the cluster in the background: the same for all rows of a cluster, between 0 and 1
    per_cluster = phi.groupBy("cluster").agg(
        F.count("*").alias("n"), F.min(total).alias("least"), F.max(total).alias("most")
    )
    return per_cluster.agg(
        F.sum("n").alias("rows_explained"),
        F.bool_and((F.col("most") - F.col("least") < 1e-9) & F.col("least").between(-1e-9, 1)).alias("adds_up"),
    )


# users and portfolios --------------------------------------------------------


@query
def m09_risk_score(spark, sf_dir):
    users = tables.users(spark, sf_dir)
    return users.select("user_id", risk_score("age", "duration").alias("risk_score"))


@query
def m10_risk_bin(spark, sf_dir):
    users = tables.users(spark, sf_dir)
    return users.select("user_id", risk_bin(risk_score("age", "duration")).alias("risk_category"))


@query
def m11_build_portfolio(spark, sf_dir):
    built = portfolio.build_portfolio(tables.users(spark, sf_dir), _labelled(spark, sf_dir))
    return built.select("user_id", "ticker", "category", "risk_category")


@query
def m12_allocate(spark, sf_dir):
    built = portfolio.build_portfolio(tables.users(spark, sf_dir), _labelled(spark, sf_dir))
    return rounded(built.select("user_id", "ticker", "momentum", "amount", "investment"), investment=4)


@query
def m12_allocate_class(spark, sf_dir):
    """One investor's amount over all assets of each risk class."""
    shares = portfolio.allocate(_labelled(spark, sf_dir))
    out = shares.select("ticker", "risk_category", (F.col("share") * 50000).alias("investment"))
    return rounded(out, investment=4)


@query
def m13_age_risk(spark, sf_dir):
    return tables.users(spark, sf_dir).select("user_id", "age", age_risk("age").alias("risk_category"))


@query
def m14_signal(spark, sf_dir):
    return rounded(portfolio.signal(tables.bars(spark, sf_dir)), last_moving_avg=4)


@query
def m15_portfolio_view(spark, sf_dir):
    return portfolio.portfolio_view(_labelled(spark, sf_dir))


@query
def m11_whole_chain(spark, sf_dir):
    """Bars to features, clusters, explanations and portfolios: rows of each written stage."""
    bars = _bars(spark, sf_dir)
    out = recommend(
        bars,
        tables.market(bars),
        tables.fundamentals(spark, sf_dir),
        tables.users(spark, sf_dir),
        new_path(spark, "advisor"),
    )
    return out["stages"].where("stage in ('enhanced', 'features', 'clustered')")


# streams ---------------------------------------------------------------------


def _quote_stream(spark, sf_dir):
    return stream.as_quotes(stream.stream_table(spark, sf_dir, schemas.EVENTS, "events.parquet"))


def _land(spark, sf_dir, landed, parts):
    events = tables.table(spark, sf_dir, "events")
    for part in parts:
        week = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == part
        events.where(week).coalesce(1).write.mode("append").parquet(landed)


def _quote_batches(spark, sf_dir):
    """The quotes as several files, which arrive one per micro-batch."""
    landed = new_path(spark, "landed")
    _land(spark, sf_dir, landed, range(4))
    return stream.as_quotes(stream.stream_table(spark, landed, schemas.EVENTS, files_per_batch=1))


def _naive(df, column="ts"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query
def t01_market_snapshots(spark, sf_dir):
    path, checkpoint = new_path(spark, "snapshots"), new_path(spark, "checkpoint")
    feed = stream.quotes_once(stream.during_market(_quote_batches(spark, sf_dir)), lateness="1 hour")
    stream.write_batches(stream.snapshots(feed), path, checkpoint).awaitTermination()
    return _naive(stream.read_newest(spark, path, ["window_start", "asset"]), "window_start")


@query
def t01_every_interval(spark, sf_dir):
    """A row for every asset and market quarter-hour since its first quote, NULL where it was silent.

    The job stops half-way and goes on from its checkpoint; the last hour, which may still get quotes, is not out yet.
    """
    landed, path, checkpoint = (new_path(spark, n) for n in ("landed", "intervals", "checkpoint"))
    for parts in ((0, 1), (2, 3)):
        _land(spark, sf_dir, landed, parts)
        quotes = stream.as_quotes(stream.stream_table(spark, landed, schemas.EVENTS, files_per_batch=1))
        feed = stream.quotes_once(stream.during_market(quotes), lateness="1 hour")
        stream.append_to(every_interval(feed), path, checkpoint).awaitTermination()
    return _naive(spark.read.parquet(path), "window_start")


@query
def t01_late_quotes(spark, sf_dir):
    """The first week arrives last: what is later than the watermark is counted, not lost unseen.

    A batch is held against the watermark that the batch before its predecessor left.
    """
    landed, path, checkpoint = (new_path(spark, n) for n in ("landed", "unique", "checkpoint"))
    events = tables.table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    for part in (day.between(8, 20), day > 20, day < 8):
        events.where(part).coalesce(1).write.mode("append").parquet(landed)
    quotes = stream.as_quotes(stream.stream_table(spark, landed, schemas.EVENTS, files_per_batch=1))
    query = stream.append_to(stream.unique_quotes(quotes, lateness="1 day"), path, checkpoint)
    query.awaitTermination()
    kept = spark.read.parquet(path).count()
    return spark.createDataFrame([(kept, stream.dropped_rows(query))], "kept long, dropped long")


#: columns of a wide snapshot
WIDEST = 1000


@query
def t02_long_quotes(spark, sf_dir):
    landed, path, checkpoint = (new_path(spark, n) for n in ("wide", "long", "checkpoint"))
    quotes = tables.quotes(spark, sf_dir)
    # the assets are the columns of a wide snapshot, so their number is bounded by what a row can hold
    found = quotes.select("asset").distinct().limit(WIDEST + 1).collect()
    if len(found) > WIDEST:
        raise ValueError(f"more than {WIDEST} assets are too many for a wide snapshot")
    assets = sorted(r.asset for r in found)
    quarter = F.window(F.col("ts").cast("timestamp"), "15 minutes").start.alias("ts")
    wide = quotes.groupBy(quarter).pivot("asset", assets).agg(F.max_by("price", F.struct("ts", "event_id")))
    wide.write.parquet(landed)
    long = stream.long_quotes(stream.stream_table(spark, landed, wide.schema), assets)
    stream.append_to(long, path, checkpoint).awaitTermination()
    return _naive(spark.read.parquet(path))


@query
def t03_append_quotes(spark, sf_dir):
    path, checkpoint = new_path(spark, "quotes"), new_path(spark, "checkpoint")
    stream.append_to(_quote_stream(spark, sf_dir), path, checkpoint).awaitTermination()
    return _naive(spark.read.parquet(path))


@query
def t04_upsert_stream(spark, sf_dir):
    table, checkpoint = new_path(spark, "closes"), new_path(spark, "checkpoint")
    daily = _quote_batches(spark, sf_dir).withColumn("dt", F.to_date("ts"))
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    stream.upsert_stream(daily, table, checkpoint, ["asset", "dt"], order, F.col("dt")).awaitTermination()
    return _naive(read_keyed(spark, table))


@query
def t05_latest_prices(spark, sf_dir):
    path, checkpoint = new_path(spark, "latest"), new_path(spark, "checkpoint")
    stream.write_batches(stream.latest_prices(_quote_stream(spark, sf_dir)), path, checkpoint).awaitTermination()
    return _naive(stream.read_newest(spark, path, ["asset"]))


@query
def t05_latest_from_state(spark, sf_dir):
    """The newest prices straight from the job's state after four batches; no batch output is kept."""
    checkpoint = new_path(spark, "checkpoint")
    stream.keep_state(stream.latest_prices(_quote_batches(spark, sf_dir)), checkpoint).awaitTermination()
    return _naive(stream.latest_from_state(spark, checkpoint))


@query
def k07_stream_counts(spark, sf_dir):
    """Rows read, kept and dropped as late over all batches of a stream."""
    landed, path, checkpoint = (new_path(spark, n) for n in ("landed", "unique", "checkpoint"))
    events = tables.table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    for part in (day.between(8, 20), day > 20, day < 8):
        events.where(part).coalesce(1).write.mode("append").parquet(landed)
    listener = counted(spark)
    try:
        quotes = stream.as_quotes(stream.stream_table(spark, landed, schemas.EVENTS, files_per_batch=1))
        job = stream.append_to(stream.unique_quotes(quotes, lateness="1 day"), path, checkpoint)
        job.awaitTermination()
        listener.wait_for(job)
        totals = listener.totals(job)
    finally:
        spark.streams.removeListener(listener)
    kept = spark.read.parquet(path).count()
    row = (totals["rows_in"], kept, totals["dropped"])
    return spark.createDataFrame([row], "rows_in long, kept long, dropped long")


@query
def w01_quote_returns_blocked(spark, sf_dir):
    quotes = tables.quotes(spark, sf_dir).withColumnRenamed("price", "close")
    return metrics.quote_returns(quotes, Series(("asset",), ("ts", "event_id")))


@query
def w08_quote_ema_blocked(spark, sf_dir):
    quotes = tables.quotes(spark, sf_dir)
    df = in_blocks(
        quotes,
        Series(("asset",), ("ts", "event_id")),
        ema_lookback(20),
        lambda block, s: with_ema(block, {"ema_20": 20}, "price", s),
    )
    return rounded(df.select("event_id", "asset", "ema_20"), ema_20=4)

"""SQL twins of the registered queries, for DuckDB on the same tables.

Each is a body on top of named parts (common table expressions). The parts are
written from the definitions, not from the Spark code: bars by row numbers,
averages by plain frames, the exponential average by recursion.
"""

from __future__ import annotations

import re

TODAY = "date '2001-11-04'"

PARTS = {
    "px": """
      select l_suppkey, cast(l_shipdate as date) as dt, l_extendedprice / l_quantity as price,
             l_quantity as qty, l_discount as disc,
             row_number() over (partition by l_suppkey, cast(l_shipdate as date)
               order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as rn,
             count(*) over (partition by l_suppkey, cast(l_shipdate as date)) as cnt
      from lineitem""",
    "daily": """
      select l_suppkey, dt, max(case when rn = 1 then price end) as open, max(price) as high, min(price) as low,
             max(case when rn = cnt then price end) as close, sum(qty) as volume, max(disc) as dividends
      from px group by l_suppkey, dt""",
    "assets": """
      select s_suppkey, s_name as ticker, r_name as category
      from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "bars": """
      select ticker, category, dt, open, high, low, close, volume, dividends
      from daily join assets on l_suppkey = s_suppkey""",
    "market": "select dt, max(close) as close from bars group by dt",
    "eps_of": "select s_name as ticker, s_acctbal / 1000 as eps from supplier",
    "raw_quotes": """
      select ticker as asset,
             case when day(dt) % 3 = 0 then strftime(dt, '%m/%d/%Y') else strftime(dt, '%Y-%m-%d') end as date_text,
             case when day(dt) % 7 = 0 then 'n/a'
                  when day(dt) % 4 = 0 then '$' || cast(cast(floor(close) as bigint) as varchar) || '.50'
                  else cast(cast(floor(close) as bigint) as varchar) end as close_text,
             case when day(dt) % 5 = 0 then null else dt end as last_updated
      from bars""",
    "curated": """
      select asset, date_text, close_text, last_updated,
             cast(case when date_text like '__/__/____' then strptime(date_text, '%m/%d/%Y')
                       else strptime(date_text, '%Y-%m-%d') end as date) as dt,
             try_cast(replace(replace(close_text, '$', ''), ',', '') as double) as close
      from raw_quotes""",
    "users": """
      select c_custkey as user_id, 18 + c_custkey % 63 as age, 1000 + 500 * (c_custkey % 100) as amount,
             1 + c_custkey % 20 as duration,
             case c_custkey % 3 when 0 then 'Low' when 1 then 'Medium' else 'High' end as tolerance
      from customer""",
    "attributes": """
      select ticker, case when s_suppkey % 4 = 0 then null when s_suppkey % 4 = 1 then 'N/A' else ticker end as short_name,
             case when s_suppkey % 5 = 0 then 'ETF' else 'EQUITY' end as asset_type, category as sector
      from assets""",
    "quotes": "select event_id, ts, event_type as asset, value as price from events",
    "sources": """
      select ticker as asset, cast(dt as timestamp) as ts, cast(0 as bigint) as seq, close as close_historical_1,
             'historical' as source, cast(null as double) as close_realtime_1
      from bars
      union all
      select asset, ts, event_id, null, 'realtime', price from quotes""",
    "rets": """
      select *, close / lag(close) over w - 1 as daily_return, close - lag(close) over w as change,
             ln(close / lag(close) over w) as log_return, (close - open) / open as intraday_return,
             close / lag(close, 14) over w - 1 as momentum, row_number() over w as rn
      from bars window w as (partition by ticker order by dt)""",
    "rolled": """
      select *,
        case when rn >= 10 then avg(close) over w10 end as sma_10,
        case when rn >= 20 then avg(close) over w20 end as sma_20,
        case when rn >= 30 then avg(close) over w30 end as sma_30,
        case when rn >= 50 then avg(close) over w50 end as sma_50,
        case when rn >= 100 then avg(close) over w100 end as sma_100,
        case when rn >= 200 then avg(close) over w200 end as sma_200,
        case when rn >= 10 then stddev_samp(intraday_return) over w10 end as volatility_10,
        case when rn >= 10 then avg(volume) over w10 end as avg_volume_10,
        case when rn >= 50 then avg(volume) over w50 end as avg_volume_50,
        case when rn >= 20 then stddev_samp(close) over w20 end as sd_20,
        case when rn >= 21 then stddev_samp(log_return) over w20 end as historical_volatility,
        close / volume as price_volume_ratio, close - open as price_change,
        close - lag(close, 10) over w as momentum_10, close - lag(close, 20) over w as momentum_20,
        avg(case when change > 0 then change else 0 end) over w14 as up,
        avg(case when change < 0 then -change else 0 end) over w14 as down
      from rets
      window w as (partition by ticker order by dt),
        w10 as (partition by ticker order by dt rows between 9 preceding and current row),
        w14 as (partition by ticker order by dt rows between 13 preceding and current row),
        w20 as (partition by ticker order by dt rows between 19 preceding and current row),
        w30 as (partition by ticker order by dt rows between 29 preceding and current row),
        w50 as (partition by ticker order by dt rows between 49 preceding and current row),
        w100 as (partition by ticker order by dt rows between 99 preceding and current row),
        w200 as (partition by ticker order by dt rows between 199 preceding and current row)""",
    "feats": """
      select *, case when rn >= 14 then
          case when down = 0 and up > 0 then 100 when down = 0 then null
               else 100 - 100 / (1 + up / down) end end as rsi_14
      from rolled""",
    "basic": """
      select ticker, category, dt, open, high, low, close, volume, dividends, intraday_return, sma_10, sma_50, sma_200,
             volatility_10, avg_volume_10, avg_volume_50, rsi_14
      from feats where sma_200 is not null and volatility_10 is not null and rsi_14 is not null""",
    "ema": """
      select ticker, dt, rn, close as ema_20, close as ema_50 from rets where rn = 1
      union all
      select r.ticker, r.dt, r.rn, r.close * (2e0 / 21) + e.ema_20 * (1 - 2e0 / 21),
             r.close * (2e0 / 51) + e.ema_50 * (1 - 2e0 / 51)
      from ema e join rets r on r.ticker = e.ticker and r.rn = e.rn + 1""",
    "numbered": "select *, row_number() over (partition by asset order by ts, event_id) as rn from quotes",
    "quote_ema": """
      select event_id, asset, rn, price as ema_20 from numbered where rn = 1
      union all
      select n.event_id, n.asset, n.rn, n.price * (2e0 / 21) + e.ema_20 * (1 - 2e0 / 21)
      from quote_ema e join numbered n on n.asset = e.asset and n.rn = e.rn + 1""",
    "joined": """
      select b.ticker, b.category, b.dt, b.open, b.high, b.low, b.close, b.volume, b.dividends, b.daily_return,
             b.momentum, b.intraday_return, b.rn, eps, m.close as close_market,
             m.close / lag(m.close) over (partition by b.ticker order by b.dt) - 1 as market_return
      from rets b join market m on b.dt = m.dt left join eps_of e on b.ticker = e.ticker""",
    "betas": """
      select ticker, covar_samp(daily_return, market_return) / nullif(var_samp(market_return), 0) as beta
      from joined group by ticker""",
    "enhanced": """
      select j.*, beta, daily_return - (0.01e0 / 252 + beta * (market_return - 0.01e0 / 252)) as alpha,
             dividends / nullif(close, 0) as dividend_yield, close / nullif(eps, 0) as pe_ratio
      from joined j join betas b on j.ticker = b.ticker""",
    "lookback": f"""
      select ticker, arg_max(close, dt) as last_close,
             arg_min(close, dt) filter (dt >= date '2001-01-01') as ytd_start,
             arg_max(close, dt) filter (dt <= {TODAY} - 365) as c1,
             arg_max(close, dt) filter (dt <= {TODAY} - 1095) as c3,
             arg_max(close, dt) filter (dt <= {TODAY} - 1825) as c5
      from bars group by ticker""",
    "trail": """
      select ticker, (last_close - ytd_start) / ytd_start * 100 as return_ytd, (last_close - c1) / c1 * 100 as return_1y,
             (last_close - c3) / c3 * 100 as return_3y, (last_close - c5) / c5 * 100 as return_5y
      from lookback""",
    "risk": """
      select ticker, stddev_samp(daily_return) as sd, avg(daily_return - 0.02e0 / 252) as excess,
             stddev_samp(case when daily_return < 0 then daily_return end) as downside
      from rets group by ticker""",
    "metrics": """
      select t.*, sd as daily_volatility, sd * sqrt(21) as monthly_volatility, sd * sqrt(63) as quarterly_volatility,
             sd * sqrt(252) as annual_volatility, excess / nullif(sd, 0) as sharpe_ratio,
             excess / nullif(downside, 0) as sortino_ratio, return_ytd / nullif(sd * sqrt(252), 0) as risk_adjusted_ytd,
             return_1y / nullif(sd * sqrt(252), 0) as risk_adjusted_1y
      from trail t join risk r on t.ticker = r.ticker""",
    "known_risk": """
      select r.ticker, sd from risk r join assets a on r.ticker = a.ticker where category in ('AFRICA', 'ASIA')""",
    "gapped": """
      select ticker, dt, case when dt >= date '1995-06-01' and day(dt) % 7 <> 0 then close end as close from bars""",
    "gap_rows": """
      select *, row_number() over (partition by ticker order by dt) as rn from gapped where close is not null""",
    "gap_ema": """
      select ticker, dt, rn, close as ema_20, close as ema_50 from gap_rows where rn = 1
      union all
      select r.ticker, r.dt, r.rn, r.close * (2e0 / 21) + e.ema_20 * (1 - 2e0 / 21),
             r.close * (2e0 / 51) + e.ema_50 * (1 - 2e0 / 51)
      from gap_ema e join gap_rows r on r.ticker = e.ticker and r.rn = e.rn + 1""",
    "gap_filled": """
      select g.ticker, g.dt, g.close, last_value(ema_20 ignore nulls) over so_far as ema_20,
             last_value(ema_50 ignore nulls) over so_far as ema_50
      from gapped g left join gap_ema e on g.ticker = e.ticker and g.dt = e.dt
      window so_far as (partition by g.ticker order by g.dt rows between unbounded preceding and current row)""",
    "base": """
      select ticker, dt, close, date '2001-01-01' as last_updated from bars where dt < date '2000-01-01'""",
    "delta": f"""
      select ticker, dt, close * 2 as close, {TODAY} as last_updated from bars where dt >= date '1999-06-01'""",
    "upserted": """
      select * from delta
      union all
      select * from base b where not exists (select 1 from delta d where d.ticker = b.ticker and d.dt = b.dt)""",
    "latest": """
      select r.ticker, r.category, stddev_samp(daily_return) as daily_volatility, arg_max(close, dt) as close,
             arg_max(momentum, dt) as momentum
      from rets r group by r.ticker, r.category""",
    "scored": """
      select l.*, close / nullif(eps, 0) as pe_ratio,
             (daily_volatility - avg(daily_volatility) over ()) / stddev_samp(daily_volatility) over () as z
      from latest l left join eps_of e on l.ticker = e.ticker where daily_volatility is not null""",
    "clustered": """
      select *, case when (z - 0.8e0) * (z - 0.8e0) <= least((z + 0.8e0) * (z + 0.8e0), z * z) then 0
                     when (z + 0.8e0) * (z + 0.8e0) <= z * z then 1 else 2 end as prediction
      from scored""",
    "names": """
      select prediction, case row_number() over (order by avg(daily_volatility), prediction)
          when 1 then 'Low Risk' when 2 then 'Medium Risk' else 'High Risk' end as risk_category
      from clustered group by prediction""",
    "labelled": "select c.*, risk_category from clustered c join names n on c.prediction = n.prediction",
    "short_list": """
      select *, momentum / nullif(sum(momentum) over (partition by risk_category), 0) as share from (
        select *, row_number() over (partition by risk_category, category order by md5(ticker || '42'), ticker) as pick
        from labelled) where pick <= 5""",
    "user_risk": """
      select *, case when s <= 0.5e0 then 'Low Risk' when s <= 1 then 'Medium Risk' when s <= 2 then 'High Risk' end as risk
      from (select *, greatest(0, 35 - age) / 35e0 + least(duration, 5) / 5e0 as s from users)""",
    "model_rows": """
      select e.ticker, e.category, e.dt, beta, alpha, dividend_yield,
             stddev_samp(intraday_return) over (partition by e.ticker order by e.dt rows between 9 preceding and current row) as v,
             row_number() over (partition by e.ticker order by e.dt) as n
      from enhanced e where momentum is not null and alpha is not null and pe_ratio is not null and dividend_yield is not null""",
    "z": """
      select ticker, category, dt, (beta - avg(beta) over ()) / stddev_samp(beta) over () as x1,
             (alpha - avg(alpha) over ()) / stddev_samp(alpha) over () as x2,
             (dividend_yield - avg(dividend_yield) over ()) / stddev_samp(dividend_yield) over () as x3,
             (v - avg(v) over ()) / stddev_samp(v) over () as x4
      from model_rows where n >= 10""",
    "background": """
      select avg(x1) as b1, avg(x2) as b2, avg(x3) as b3, avg(x4) as b4, count(*) as weight from (
        select *, cast(x1 > -1 as int) + cast(x1 > 0 as int) + cast(x1 > 1 as int) as p1,
               cast(x2 > -1 as int) + cast(x2 > 0 as int) + cast(x2 > 1 as int) as p2,
               cast(x3 > -1 as int) + cast(x3 > 0 as int) + cast(x3 > 1 as int) as p3,
               cast(x4 > -1 as int) + cast(x4 > 0 as int) + cast(x4 > 1 as int) as p4 from z)
      group by p1, p2, p3, p4""",
    "centers": """
      select * from (values (0, 0.0e0, 0.0e0, 0.3e0, 1.0e0), (1, 0.2e0, 0.0e0, -0.5e0, -0.6e0),
                            (2, -0.3e0, 0.1e0, 0.8e0, 0.0e0)) t(c, c1, c2, c3, c4)""",
    "coalitions": "select s, s & 1 as s1, (s >> 1) & 1 as s2, (s >> 2) & 1 as s3, (s >> 3) & 1 as s4 from range(16) t(s)",
    "own": """
      select ticker, dt, arg_min(c, (x1-c1)*(x1-c1) + (x2-c2)*(x2-c2) + (x3-c3)*(x3-c3) + (x4-c4)*(x4-c4)) as cluster
      from z, centers group by ticker, dt""",
    "mixed": """
      select z.ticker, z.dt, s, s1, s2, s3, s4, weight,
             case when s1 = 1 then x1 else b1 end as m1, case when s2 = 1 then x2 else b2 end as m2,
             case when s3 = 1 then x3 else b3 end as m3, case when s4 = 1 then x4 else b4 end as m4
      from z, background, coalitions""",
    "outcomes": """
      select *, case when d0 <= least(d1, d2) then 0 when d1 <= d2 then 1 else 2 end as c from (
        select *, m1*m1 + m2*m2 + (m3-0.3e0)*(m3-0.3e0) + (m4-1)*(m4-1) as d0,
               (m1-0.2e0)*(m1-0.2e0) + m2*m2 + (m3+0.5e0)*(m3+0.5e0) + (m4+0.6e0)*(m4+0.6e0) as d1,
               (m1+0.3e0)*(m1+0.3e0) + (m2-0.1e0)*(m2-0.1e0) + (m3-0.8e0)*(m3-0.8e0) + m4*m4 as d2
        from mixed)""",
    "worth": """
      select o.ticker, o.dt, any_value(own.cluster) as cluster, o.s, any_value(s1) as s1, any_value(s2) as s2,
             any_value(s3) as s3, any_value(s4) as s4,
             sum(case when o.c = own.cluster then weight else 0 end) / sum(weight) as own_v,
             sum(case when o.c = 1 then weight else 0 end) / sum(weight) as one_v
      from outcomes o join own on o.ticker = own.ticker and o.dt = own.dt group by o.ticker, o.dt, o.s""",
    "weighted": """
      select *, [0.25e0, 1e0/12, 1e0/12, 0.25e0] as wt, s1 + s2 + s3 + s4 as size from worth""",
    # every row as background: ranks of points and queries, then one count per binary digit of a query's rank
    "sided": """
      select z.ticker, z.dt, cluster, s,
             (1-s1)*(x1-0.0e0)*(x1-0.0e0) + (1-s2)*(x2-0.0e0)*(x2-0.0e0) + (1-s3)*(x3-0.3e0)*(x3-0.3e0) + (1-s4)*(x4-1)*(x4-1) as o0,
             (1-s1)*(x1-0.2e0)*(x1-0.2e0) + (1-s2)*x2*x2 + (1-s3)*(x3+0.5e0)*(x3+0.5e0) + (1-s4)*(x4+0.6e0)*(x4+0.6e0) as o1,
             (1-s1)*(x1+0.3e0)*(x1+0.3e0) + (1-s2)*(x2-0.1e0)*(x2-0.1e0) + (1-s3)*(x3-0.8e0)*(x3-0.8e0) + (1-s4)*x4*x4 as o2,
             s1*x1*x1 + s2*x2*x2 + s3*(x3-0.3e0)*(x3-0.3e0) + s4*(x4-1)*(x4-1) as n0,
             s1*(x1-0.2e0)*(x1-0.2e0) + s2*x2*x2 + s3*(x3+0.5e0)*(x3+0.5e0) + s4*(x4+0.6e0)*(x4+0.6e0) as n1,
             s1*(x1+0.3e0)*(x1+0.3e0) + s2*(x2-0.1e0)*(x2-0.1e0) + s3*(x3-0.8e0)*(x3-0.8e0) + s4*x4*x4 as n2
      from z join own on z.ticker = own.ticker and z.dt = own.dt, coalitions where s between 1 and 14""",
    "in_planes": """
      select s, j, 1 as point, null as ticker, null as dt, 1 as tie_a, 1 as tie_b,
             case j when 0 then o0 - o1 when 1 then o1 - o0 else o2 - o0 end as a,
             case j when 0 then o0 - o2 when 1 then o1 - o2 else o2 - o1 end as b
      from sided, range(3) t(j)
      union all
      select s, cluster, 0, ticker, dt, case cluster when 0 then 2 else 0 end, case cluster when 2 then 0 else 2 end,
             case cluster when 0 then n1 - n0 when 1 then n0 - n1 else n0 - n2 end,
             case cluster when 0 then n2 - n0 when 1 then n2 - n1 else n1 - n2 end
      from sided""",
    "ranked": """
      select *, sum(point) over (partition by s, j order by a, tie_a rows unbounded preceding)::bigint as below from in_planes""",
    "levels": "select range as l from range((select floor(log2(count(*)))::bigint + 1 from z))",
    "dyadic": """
      select s, j, point, ticker, dt, tie_b, b, l, case point when 1 then (below - 1) >> l else (below >> l) - 1 end as block
      from ranked, levels where point = 1 or (below >> l) & 1 = 1""",
    "under": """
      select s, point, ticker, dt, sum(point) over (partition by s, j, l, block order by b, tie_b rows unbounded preceding) as n
      from dyadic""",
    "shares": "select ticker, dt, s, sum(n) / (select count(*) from z) as v from under where point = 0 group by all",
    "chances": "select cluster as c, count(*) / (select count(*) from z) as share from own group by cluster",
    "all_worth": """
      select own.ticker, own.dt, cluster, k.s, s1, s2, s3, s4,
             case k.s when 15 then 1 when 0 then share else coalesce(v, 0) end as v
      from own join chances on c = cluster cross join coalitions k
      left join shares on shares.ticker = own.ticker and shares.dt = own.dt and shares.s = k.s""",
    "all_weighted": "select *, [0.25e0, 1e0/12, 1e0/12, 0.25e0] as wt, s1 + s2 + s3 + s4 as size from all_worth",
    # close as Spark writes it: the shortest digits, with a point
    "lines": """
      select *, case when day(dt) = 13 then 'fields: 2' when day(dt) = 17 then 'fields: 4'
                     when day(dt) = 29 then 'not a date: dt' when day(dt) % 11 = 0 then 'not a double: close' else 'ok' end as reason,
             case when day(dt) = 13 then left_part when day(dt) = 17 then left_part || ',' || shown || ',x'
                  else left_part || ',' || shown end as line
      from (select *, ticker || ',' || case when day(dt) = 29 then 'day ' else '' end || strftime(dt, '%Y-%m-%d') as left_part,
                   case when day(dt) % 11 = 0 then 'n/a' else close::varchar end as shown from bars)""",
    "complete_rows": """
      select *, close - lag(close) over w as step, row_number() over w as row_no from enhanced
      where momentum is not null and alpha is not null and dividend_yield is not null and pe_ratio is not null
      window w as (partition by ticker order by dt)""",
    "complete_rolled": """
      select ticker, dt, momentum, beta, alpha, pe_ratio, dividend_yield, intraday_return,
             case when row_no >= 50 then avg(close) over w50 end as sma_50,
             case when row_no >= 10 then stddev_samp(intraday_return) over w10 end as volatility_10,
             case when row_no >= 50 then avg(volume) over w50 end as avg_volume_50,
             case when row_no >= 14 then avg(case when step > 0 then step else 0 end) over w14 end as up,
             case when row_no >= 14 then avg(case when step < 0 then -step else 0 end) over w14 end as down
      from complete_rows
      window w10 as (partition by ticker order by dt rows between 9 preceding and current row),
        w14 as (partition by ticker order by dt rows between 13 preceding and current row),
        w50 as (partition by ticker order by dt rows between 49 preceding and current row)""",
    "model_features": """
      select *, case when down = 0 and up > 0 then 100 when down > 0 then 100 - 100 / (1 + up / down) end as rsi_14
      from complete_rolled""",
    "hours": """
      select *, ts - interval 5 hour as local from quotes""",
    "open_quotes": """
      select * from hours
      where isodow(local) <= 5 and hour(local) * 60 + minute(local) >= 570 and hour(local) * 60 + minute(local) < 960""",
}
RECURSIVE = {"ema", "quote_ema", "gap_ema"}


def _shapley(value: str) -> str:
    """Attribution of each feature: weighted differences with and without it."""
    cells = []
    for i, name in enumerate(["beta", "alpha", "dividend_yield", "volatility_10"], start=1):
        cells.append(
            f"sum(case when s{i} = 1 then wt[size] * {value} else -wt[size + 1] * {value} end) as phi_z_{name}"
        )
    return ", ".join(cells)


PARTS["phi_own"] = f"select ticker, dt, cluster, {_shapley('own_v')} from weighted group by ticker, dt, cluster"
PARTS["phi_one"] = f"select ticker, dt, cluster, {_shapley('one_v')} from weighted group by ticker, dt, cluster"
PARTS["phi_all"] = f"select ticker, dt, cluster, {_shapley('v')} from all_weighted group by ticker, dt, cluster"


FIVE = ["intraday_return", "sma_50", "volatility_10", "avg_volume_50", "rsi_14"]
FOUR = ["beta", "alpha", "dividend_yield", "volatility_10"]
TEN = ["momentum", "beta", "alpha", "pe_ratio", "dividend_yield", *FIVE]


def _kmeans(name: str, source: str, columns: list[str], least: int, most: int, rounds: int = 8) -> None:
    """Parts ``<name>_z`` (rows), ``<name>_centers`` (k, c, m1 ..) and ``<name>_near`` (rows with k and nearest c)."""
    n = range(1, len(columns) + 1)

    def gap(x: str = "") -> str:
        return " + ".join(f"({x}x{i} - m{i}) * ({x}x{i} - m{i})" for i in n)

    filled = ", ".join(f"coalesce({c}, avg({c}) over ()) as f{i}" for i, c in zip(n, columns))
    scaled = ", ".join(f"(f{i} - avg(f{i}) over ()) / stddev_samp(f{i}) over () as x{i}" for i in n)
    means, cells = ", ".join(f"m{i}" for i in n), ", ".join(f"floor(x{i})" for i in n)
    PARTS[f"{name}_z"] = f"select ticker, dt, {scaled} from (select ticker, dt, {filled} from {source})"
    PARTS[f"{name}_cells"] = (
        f"select {', '.join(f'avg(x{i}) as x{i}' for i in n)}, count(*) as n from {name}_z group by {cells}"
    )
    order = ", ".join(f"x{i} desc" for i in n)
    first = ", ".join(f"x{i} as m{i}" for i in n)
    PARTS[f"{name}_chosen1"] = f"select 0 as c, {first} from (select * from {name}_cells order by n desc, {order} limit 1)"
    for j in range(2, most + 1):
        PARTS[f"{name}_far{j}"] = f"""
          select {', '.join(f'a.x{i}' for i in n)}, a.n, min({gap('a.')}) as gap from {name}_cells a, {name}_chosen{j - 1}
          group by {', '.join(f'a.x{i}' for i in n)}, a.n"""
        PARTS[f"{name}_chosen{j}"] = f"""
          select * from {name}_chosen{j - 1}
          union all
          select {j - 1}, {first} from (select * from {name}_far{j} order by n * gap desc, {order} limit 1)"""
    PARTS[f"{name}_centers0"] = f"select k, c, {means} from {name}_chosen{most}, range({least}, {most + 1}) t(k) where c < k"
    for r in range(rounds + 1):
        nearest = f"select ticker, dt, k, arg_min(c, (gap, c)) as c, min(gap) as gap from (select z.ticker, z.dt, k, c, {gap('z.')} as gap from {name}_z z, {name}_centers{r}) group by ticker, dt, k"
        if r == rounds:
            PARTS[f"{name}_near"] = nearest
            PARTS[f"{name}_centers"] = f"select * from {name}_centers{r}"
            break
        PARTS[f"{name}_near{r}"] = nearest
        PARTS[f"{name}_moved{r}"] = f"""
          select k, c, {', '.join(f'avg(x{i}) as y{i}' for i in n)}
          from {name}_near{r} a join {name}_z z on z.ticker = a.ticker and z.dt = a.dt group by k, c"""
        PARTS[f"{name}_centers{r + 1}"] = f"""
          select o.k, o.c, {', '.join(f'coalesce(y{i}, m{i}) as m{i}' for i in n)}
          from {name}_centers{r} o left join {name}_moved{r} w on w.k = o.k and w.c = o.c"""


_kmeans("elbow5", "basic", FIVE, 2, 9)
_kmeans("three5", "basic", FIVE, 3, 3)
_kmeans("three10", "model_features", TEN, 3, 3)
_kmeans("three4", "model_features", FOUR, 3, 3)
PARTS["three5_sums"] = (
    "select c, count(*)::double as n, "
    + ", ".join(f"sum(x{i}) as s{i}" for i in range(1, 6))
    + ", sum("
    + " + ".join(f"x{i} * x{i}" for i in range(1, 6))
    + ") as q from three5_near a join three5_z z on z.ticker = a.ticker and z.dt = a.dt group by c"
)
PARTS["three5_means"] = (
    "select a.ticker, a.dt, a.c, s.c = a.c as own, s.n, "
    + " + ".join(f"x{i} * x{i}" for i in range(1, 6))
    + " + q / s.n - 2 * ("
    + " + ".join(f"x{i} * s{i}" for i in range(1, 6))
    + ") / s.n as mean from three5_near a join three5_z z on z.ticker = a.ticker and z.dt = a.dt, three5_sums s"
)
PARTS["three5_shape"] = """
  select ticker, dt, any_value(c) as c, min(case when own then n end) as n, min(case when own then mean * n / (n - 1) end) as a,
         min(case when not own then mean end) as b
  from three5_means group by ticker, dt"""
PARTS["three5_silhouette"] = "select c, case when n = 1 then 0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end as s from three5_shape"


def _uses(text: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", text)) & set(PARTS)


def sql(body: str, **fill: str) -> str:
    """``body`` with the parts it needs, in order."""
    needed: list[str] = []

    def visit(text: str, seen: tuple[str, ...] = ()) -> None:
        for name in sorted(_uses(text)):
            if name not in needed and name not in seen:
                visit(PARTS[name], (*seen, name))
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = []
    for name in needed:
        text = PARTS[name]
        for key, value in fill.items():
            text = text.replace("{" + key + "}", value)
        ctes.append(f"{name} as ({text})")
    start = "with recursive " if set(needed) & RECURSIVE else "with "
    return (start + ",\n".join(ctes) + "\n" if ctes else "") + body


def r(column: str, digits: int, alias: str | None = None) -> str:
    """On a grid of 10^-digits. As in the queries: plain rounding differs between engines on ties."""
    return f"floor(({column}) * 1e{digits} + 0.4999e0) / 1e{digits} as {alias or column.split('.')[-1]}"


def many(digits: int, *columns: str) -> str:
    return ", ".join(r(c, digits) for c in columns)


ALL_BARS = "select ticker, category, dt, open, high, low, close, volume, dividends from bars"
PRICES = "select ticker, dt, close from bars"
BAR = "ticker, category, dt, open, high, low, close, volume, dividends"
VOLS = "daily_volatility monthly_volatility quarterly_volatility annual_volatility".split()
TRAILS = "return_ytd return_1y return_3y return_5y".split()
RATIOS = "sharpe_ratio sortino_ratio risk_adjusted_ytd risk_adjusted_1y".split()
BASIC_SQL = (
    f"select {BAR}, intraday_return, "
    + many(4, "sma_10", "sma_50", "sma_200", "avg_volume_10", "avg_volume_50", "rsi_14")
    + ", "
    + many(6, "volatility_10")
)
ADVANCED_SQL = f"""
  select f.ticker, category, f.dt, open, high, low, close, volume, dividends, intraday_return, price_volume_ratio,
         price_change, momentum_10, momentum_20,
         {many(4, "sma_20", "sma_50", "sma_100", "avg_volume_50", "rsi_14", "e.ema_20", "e.ema_50")},
         {r("sma_20 + 2 * sd_20", 4, "upper_band")}, {r("sma_20 - 2 * sd_20", 4, "lower_band")},
         {many(6, "log_return", "historical_volatility", "volatility_10")}
  from feats f join ema e on f.ticker = e.ticker and f.dt = e.dt
  where sma_100 is not null and historical_volatility is not null and rsi_14 is not null
    and volatility_10 is not null and price_volume_ratio is not null"""
CORRELATED = "intraday_return sma_10 sma_50 sma_200 volatility_10 avg_volume_10 avg_volume_50 rsi_14".split()


def _correlations() -> str:
    rows = [
        f"select '{a}' as feature_a, '{b}' as feature_b, {r(f'corr({a}, {b})', 6, 'corr')} from basic"
        for a in CORRELATED
        for b in CORRELATED
    ]
    return "\nunion all\n".join(rows)


def _describe() -> str:
    rows = []
    for c in ("open", "high", "low", "close", "volume"):
        quartiles = ", ".join(r(f"quantile_cont({c}, {q})", 4, n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
        rows.append(
            f"""select '{c}' as "column", count({c}) as count, {r(f'avg({c})', 4, 'mean')},
            {r(f'stddev_samp({c})', 4, 'std')}, min({c}) as min, {quartiles}, max({c}) as max from bars"""
        )
    return "\nunion all\n".join(rows)


def _scaled() -> str:
    columns = "intraday_return sma_50 volatility_10 avg_volume_50 rsi_14".split()
    return ", ".join(r(f"({c} - avg({c}) over ()) / stddev_samp({c}) over ()", 6, f"z_{c}") for c in columns)


def _partial() -> str:
    def frame(n: int) -> str:
        return f"over (partition by ticker order by dt rows between {n - 1} preceding and current row)"

    return f"""
      select {BAR}, intraday_return, {r("sma_10", 4)}, {r("sma_50", 4)}, {r("sma_200", 4)}, {r("volatility_10", 6)},
             {r("avg_volume_10", 4)}, {r("avg_volume_50", 4)}, {r("rsi_14", 4)}
      from (select *, case when down = 0 and up > 0 then 100 when down = 0 then null
                           else 100 - 100 / (1 + up / down) end as rsi_14
            from (select {BAR}, intraday_return, avg(close) {frame(10)} as sma_10, avg(close) {frame(50)} as sma_50,
                         avg(close) {frame(200)} as sma_200, stddev_samp(intraday_return) {frame(10)} as volatility_10,
                         avg(volume) {frame(10)} as avg_volume_10, avg(volume) {frame(50)} as avg_volume_50,
                         avg(case when change > 0 then change else 0 end) {frame(14)} as up,
                         avg(case when change < 0 then -change else 0 end) {frame(14)} as down
                  from rets))
      where volatility_10 is not null and rsi_14 is not null"""


STAMP = "timestamp '2001-11-05 12:00:00'"
COMPLETE = (
    "momentum is not null and alpha is not null and dividend_yield is not null and pe_ratio is not null"
)
PHIS = [f"phi_z_{c}" for c in ("beta", "alpha", "dividend_yield", "volatility_10")]

ORACLE = {
    "s01_csv_scan": sql(ALL_BARS),
    "s02_ingest": sql("select * from sources"),
    "s03_qualify": sql("select ticker, dt, close as close_bars_1 from bars"),
    "s04_read_table": sql(PRICES),
    "s05_load_prices": sql("select ticker, dt, close, category from bars"),
    "s06_ingest_audit": sql("""
      select a.ticker, count(c.asset) as n_rows,
             case when count(c.asset) = 0 then 'empty' when count(c.close) = 0 then 'error' else 'success' end as status
      from assets a left join curated c on c.asset = a.ticker
      group by a.ticker"""),
    "s07_universe": sql("select distinct category, ticker from bars"),
    "s07_universe_mapping": sql("""
      select u.category, u.ticker, count(b.ticker) as n_bars, max(dt) as last_dt
      from (values ('core', 'Supplier#000000001'), ('core', 'Supplier#000000002'), ('core', 'Supplier#000000005'),
                   ('satellite', 'Supplier#000000003'), ('satellite', 'Supplier#000000002'), ('satellite', 'no such asset'))
           u(category, ticker)
      left join bars b on b.ticker = u.ticker group by u.category, u.ticker"""),
    "s08_daily_json_envelope": sql("select ticker, dt, open, high, low, close, cast(volume as bigint) as volume from bars"),
    "s08_daily_json": sql("select ticker, dt, open, high, low, close, cast(volume as bigint) as volume from bars"),
    "s09_prices_for": sql("select dt, close from bars where ticker = 'Supplier#000000001'"),
    "s09_prices_for_sorted": sql("select dt, close from bars where ticker = 'Supplier#000000001'"),
    "s01_checked_rows": sql("select ticker, dt, close from bars where day(dt) % 11 <> 0 and day(dt) not in (13, 17, 29)"),
    "s01_rejects": sql("select line, reason from lines where reason <> 'ok'"),
    "s06_reject_audit": sql("select reason, count(*) as n from lines group by reason"),
    "k07_stream_counts": sql("""
      select count(*) as rows_in, count(*) filter (day(ts) > 7) as kept, count(*) filter (day(ts) <= 7) as dropped from quotes"""),
    "t05_latest_from_state": sql(
        "select asset, max(ts) as ts, arg_max(price, (ts, event_id)) as price from quotes group by asset"
    ),
    "u01_union_all": sql("select ticker, dt, close, case when dt >= date '1998-01-01' then volume end as volume from bars"),
    "k01_write_csv": sql(PRICES),
    "k02_append": sql(PRICES),
    "k03_overwrite": sql(PRICES + " where dt >= date '1999-01-01'"),
    "k04_append_csv": sql(PRICES),
    "k05_upsert": sql("select * from upserted"),
    "k05_upsert_stored": sql(f"""
      select ticker, dt, close, case when new then date '2001-11-05' else date '2001-01-01' end as last_updated,
             case when new then {STAMP} else timestamp '2001-01-01 12:00:00' end as last_updated_timestamp
      from (select *, last_updated > date '2001-01-01' as new from upserted)"""),
    "k05_upsert_counts": sql("""
      select count(*) filter (dt is not null and close is not null) as written,
             count(*) filter (dt is null or close is null) as failed from curated"""),
    "k06_merge_fields": sql(
        f"""
      select coalesce(a.ticker, d.ticker) as ticker, short_name, asset_type, sector,
             {r("case when d.ticker is null then -1e0 else d.sd end", 6, "daily_volatility")},
             {r("d.sd * sqrt(252)", 6, "annual_volatility")}
      from attributes a full join known_risk d on a.ticker = d.ticker"""
    ),
    "k07_observe_stage": sql('select \'bars\' as stage, \'success\' as status, count(*) as "rows" from bars'),
    "k07_failed_stage": sql("""
      select 'quotes' as stage, 'success' as status, count(*) as "rows" from raw_quotes
      union all select 'broken', 'failed', null"""),
    "k08_change_stats": sql("""
      select count(*) filter (b.ticker is null) as inserted, count(*) filter (u.ticker is null) as removed,
             count(*) filter (b.ticker is not null and u.ticker is not null
               and not (b.close = u.close and b.last_updated = u.last_updated)) as updated,
             count(*) filter (b.close = u.close and b.last_updated = u.last_updated) as unchanged
      from base b full join upserted u on b.ticker = u.ticker and b.dt = u.dt"""),
    "p01_parse_date": sql("select asset, date_text, cast(try_strptime(date_text, '%Y-%m-%d') as date) as dt from raw_quotes"),
    "p02_require_every": sql("select asset, dt, close as close_a from curated where dt is not null and close is not null"),
    "p02_require_any": sql(
        "select * from sources where ts is not null and (close_historical_1 is not null or close_realtime_1 is not null)"
    ),
    "p03_drop_incomplete": sql("""
      select asset, date_text, close_text, last_updated, dt, close from curated
      where dt is not null and close is not null and last_updated is not null"""),
    "p04_project": sql("select dt, open, high, low, close, volume, ticker, category from bars"),
    "p04_project_enhanced": sql(f"""
      select dt, open, high, low, close, volume, ticker, category, momentum, {many(6, "beta", "alpha")}, pe_ratio,
             dividend_yield
      from enhanced where momentum is not null and alpha is not null and dividend_yield is not null and pe_ratio is not null"""),
    "p05_clean_money": sql("select asset, date_text, close_text, close from curated"),
    "p06_standardize_dates": sql(f"""
      select asset, strftime(dt, '%Y-%m-%d') as date_text, close_text,
             case when date_text like '__/__/____' then date '2001-11-05' else last_updated end as last_updated,
             case when date_text like '__/__/____' then {STAMP} end as last_updated_timestamp
      from curated"""),
    "p07_assets_with_bad_dates": sql("select distinct asset from raw_quotes where date_text like '__/__/____'"),
    "p08_backfill_stamps": sql(f"""
      select asset, date_text, close_text, coalesce(last_updated, date '2001-11-05') as last_updated,
             {STAMP} as last_updated_timestamp
      from raw_quotes"""),
    "p08_missing_stamps": sql("""
      select count(*) filter (last_updated is null) as last_updated_filled, count(*) as last_updated_timestamp_filled
      from raw_quotes"""),
    "p09_impute_mean": sql(
        f"select asset, dt, {r('coalesce(close, (select avg(close) from curated))', 6, 'close')} from curated"
    ),
    "p10_require_columns": sql(ALL_BARS),
    "p11_ensure_features": sql(
        f"select ticker, dt, intraday_return, {many(6, 'volatility_10')}, {many(4, 'avg_volume_50', 'rsi_14')} from feats"
    ),
    "p12_needs_enrichment": sql("""
      select ticker, short_name, asset_type, sector, short_name as long_name from attributes
      where short_name is null or short_name = 'N/A'"""),
    "p13_normalize_metadata": sql(
        "select ticker, "
        + ", ".join(
            f"case when short_name is null and asset_type <> 'ETF' then 'Error' else {value} end as {name}"
            for name, value in {
                "short_name": "coalesce(short_name, 'N/A')",
                "long_name": "'N/A'",
                "asset_type": "asset_type",
                "sector": "case when asset_type = 'ETF' then 'N/A' else sector end",
                "industry": "'N/A'",
                "exchange": "'N/A'",
                "currency": "'N/A'",
                "description": "'N/A'",
            }.items()
        )
        + " from attributes"
    ),
    "p14_j03_pending": sql(
        "select ticker from assets where ticker not in (select ticker from known_risk where sd is not null)"
    ),
    "p15_market_hours": sql("select event_id, ts, asset, price from open_quotes"),
    "p16_attach_user": sql("""
      select ticker, category, max(dt) as dt, arg_max(close, dt) as close, 30 as user_age, 50000 as investment_amount,
             7 as investment_duration
      from bars group by ticker, category"""),
    "p16_attach_users": sql("""
      select user_id, age, amount, duration, ticker, risk_category
      from user_risk join short_list on risk = risk_category where pick <= 2"""),
    "p17_match_tolerance": sql("""
      select ticker, risk_category, tolerance, n_users, total_amount
      from labelled join (select tolerance, count(*) as n_users, cast(sum(amount) as bigint) as total_amount
                          from users group by tolerance) on risk_category = tolerance || ' Risk'"""),
    "p18_clustered_view": sql(
        f"select ticker, {r('daily_volatility', 6)}, prediction as cluster, risk_category from labelled"
    ),
    "p19_date_range": sql(ALL_BARS + " where dt >= date '1998-01-01' and dt < date '2000-01-01'"),
    "j01_with_market": sql(
        "select b.ticker, b.dt, b.close, m.close as close_market from bars b join market m on b.dt = m.dt"
    ),
    "j02_enrich": sql("""
      select ticker, case when gap then 'Asset ' || ticker else short_name end as short_name,
             case when gap then 'N/A' else short_name end as long_name,
             case when gap then 'EQUITY' else asset_type end as asset_type,
             case when gap then lower(sector) else sector end as sector
      from (select *, short_name is null or short_name = 'N/A' as gap from attributes)"""),
    "j04_asof_close": sql("select ticker, c1 as close_1y, c3 as close_3y, c5 as close_5y from lookback"),
    "j04_asof_closes": sql("""
      select a.ticker, d as as_of, arg_max(close, dt) as close
      from (select distinct ticker from bars) a
      cross join (values (date '1994-12-31'), (date '1996-06-30'), (date '1998-12-25'), (date '2001-11-04')) t(d)
      left join bars b on b.ticker = a.ticker and b.dt <= d group by a.ticker, d"""),
    "j04_asof_join": sql("""
      select request_id, r.ticker, as_of, close, b.dt as close_at
      from (select o_orderkey as request_id, s_name as ticker,
                   cast(o_orderdate as date) - case when o_orderkey % 10 = 0 then 400 else 0 end as as_of
            from orders join supplier on s_suppkey = case when o_orderkey % 3 = 0 then 0 else o_custkey end
                                                     % (select max(s_suppkey) + 1 from supplier)) r
      asof left join bars b on r.ticker = b.ticker and r.as_of >= b.dt"""),
    "j04_asof_quotes": sql("""
      select request_id, r.asset, asked_at, price
      from (select event_id as request_id, asset, ts + to_minutes(event_id % 7) as asked_at
            from quotes where event_id % 3 <> 0) r
      asof left join quotes q on r.asset = q.asset and r.asked_at >= q.ts"""),
    "j05_with_fundamentals": sql(
        "select b.ticker, dt, close, eps from bars b left join eps_of e on b.ticker = e.ticker"
    ),
    "a01_distinct_values": sql("select distinct ticker from bars"),
    "a02_duplicate_groups": sql("""
      select l_orderkey, l_linenumber, count(*) as count from lineitem group by all having count(*) > 1"""),
    "a03_dedupe": sql("""
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
      qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) = 1"""),
    "a04_volatility": sql(f"select ticker, {many(6, *VOLS)} from metrics"),
    "a05_sharpe": sql(f"select ticker, {many(6, 'sharpe_ratio')} from metrics"),
    "a06_sortino": sql(f"select ticker, {many(6, 'sortino_ratio')} from metrics"),
    "a07_trailing_returns": sql(f"select ticker, {many(6, *TRAILS)} from trail"),
    "a08_risk_adjusted": sql(f"select ticker, {many(6, 'risk_adjusted_ytd', 'risk_adjusted_1y')} from metrics"),
    "a09_beta": sql(f"select ticker, {r('beta', 6)} from betas"),
    "a10_null_profile": sql(
        "\nunion all\n".join(
            f"""select '{c}' as "column", count(*) filter ({c} is null) as nulls from curated"""
            for c in ("asset", "date_text", "close_text", "last_updated", "dt", "close")
        )
    ),
    "a11_describe": sql(_describe()),
    "a12_correlation": sql(_correlations()),
    "a13_sector_allocation": sql(
        f"select category, count(*) as count, {r('count(*) / sum(count(*)) over ()', 6, 'share')} from labelled group by category"
    ),
    "a15_asset_metrics": sql(f"select ticker, {many(6, *TRAILS, *VOLS, *RATIOS)} from metrics"),
    "a15_refresh_metadata": sql(
        f"""
      select a.ticker, {r("coalesce(p.sd, m.daily_volatility)", 6, "daily_volatility")},
             {r("case when p.sd is null then m.return_1y end", 6, "return_1y")},
             {r("case when p.sd is null then m.sharpe_ratio end", 6, "sharpe_ratio")}
      from (select distinct ticker from bars) a join metrics m on a.ticker = m.ticker
      left join known_risk p on a.ticker = p.ticker"""
    ),
    "w01_daily_return": sql("select ticker, dt, close, daily_return from rets"),
    "w01_returns_by_source": sql("""
      select source, asset, ts, seq, close,
             close / nullif(lag(close) over (partition by source, asset order by ts, seq), 0) - 1 as daily_return
      from (select *, coalesce(close_historical_1, close_realtime_1) as close from sources) where close is not null"""),
    "w02_intraday_return": sql("select ticker, dt, intraday_return from rets"),
    "w03_sma": sql(f"select ticker, dt, {many(4, *[f'sma_{n}' for n in (10, 20, 30, 50, 100, 200)])} from feats"),
    "w04_volatility_10": sql(f"select ticker, dt, {many(6, 'volatility_10')} from feats"),
    "w05_avg_volume": sql(f"select ticker, dt, {many(4, 'avg_volume_10', 'avg_volume_50')} from feats"),
    "w06_rsi": sql(f"select ticker, dt, {many(4, 'rsi_14')} from feats"),
    "w07_log_return": sql(f"select ticker, dt, {many(6, 'log_return')} from rets"),
    "w08_ema": sql(f"select ticker, dt, {many(4, 'ema_20', 'ema_50')} from ema"),
    "w08_ema_with_gaps": sql(f"select ticker, dt, close, {many(4, 'ema_20', 'ema_50')} from gap_filled"),
    "w09_bollinger": sql(
        f"select ticker, dt, {r('sma_20 + 2 * sd_20', 4, 'upper_band')}, {r('sma_20 - 2 * sd_20', 4, 'lower_band')} from feats"
    ),
    "w10_historical_volatility": sql(f"select ticker, dt, {many(6, 'historical_volatility')} from feats"),
    "w11_price_change": sql("select ticker, dt, price_change from feats"),
    "w12_momentum_difference": sql("select ticker, dt, momentum_10, momentum_20 from feats"),
    "w13_momentum_percent": sql("select ticker, dt, momentum from rets"),
    "w14_price_volume_ratio": sql("select ticker, dt, price_volume_ratio from feats"),
    "w15_alpha": sql(f"select ticker, dt, {many(6, 'beta', 'alpha')} from enhanced"),
    "w16_dividend_yield": sql("select ticker, dt, dividends / nullif(close, 0) as dividend_yield from bars"),
    "w17_pe_ratio": sql(
        "select b.ticker, dt, close / nullif(eps, 0) as pe_ratio from bars b left join eps_of e on b.ticker = e.ticker"
    ),
    "w18_basic_features": sql(BASIC_SQL + " from basic"),
    "w18_basic_features_partial": sql(_partial()),
    "w18_basic_features_blocked": sql(BASIC_SQL + " from basic"),
    "w19_advanced_features": sql(ADVANCED_SQL),
    "w19_advanced_features_blocked": sql(ADVANCED_SQL),
    "w20_enhanced_bars": sql(f"""
      select {BAR}, eps, close_market, momentum, daily_return, market_return, {many(6, "beta", "alpha")},
             dividend_yield, pe_ratio
      from enhanced where momentum is not null and alpha is not null and dividend_yield is not null and pe_ratio is not null"""),
    "o01_sorted_bars": sql(ALL_BARS),
    "o02_first_rows": sql(ALL_BARS + " order by ticker, dt limit 10"),
    "o03_latest_record": sql(ALL_BARS + " order by dt desc, ticker limit 1"),
    "o04_latest_per_asset": sql(
        "select ticker, category, max(dt) as dt, arg_max(close, dt) as close, arg_max(volume, dt) as volume from bars group by ticker, category"
    ),
    "o05_choose_assets": sql("""
      select ticker, category, dt, close from (
        select ticker, category, max(dt) as dt, arg_max(close, dt) as close from bars group by ticker, category)
      qualify row_number() over (partition by category order by md5(ticker || '42'), ticker) <= 5"""),
    "m01_scale": sql(f"select ticker, dt, {_scaled()} from basic"),
    "m02_elbow": sql("select cast(k as integer) as k, true as plausible from range(2, 10) t(k)"),
    "m02_elbow_costs": sql(f"select k::integer as k, {r('sum(gap)', 3, 'cost')} from elbow5_near group by k"),
    **{
        f"m03_clusters_{len(names)}": sql(
            "select n.c::integer as cluster, count(*) as n, "
            + ", ".join(r(f"any_value(m{i})", 4, f"center_{c}") for i, c in enumerate(names, 1))
            + f" from three{len(names)}_near n join three{len(names)}_centers m on m.c = n.c group by n.c"
        )
        for names in (FIVE, TEN, FOUR)
    },
    "m05_risk_of_clusters": sql(f"""
      select case row_number() over (order by avg(volatility_10), c) when 1 then 'Low Risk' when 2 then 'Medium Risk'
                  else 'High Risk' end as risk_category, count(*) as n, {r('avg(volatility_10)', 6, 'mean_volatility')}
      from three5_near a join basic b on b.ticker = a.ticker and b.dt = a.dt group by c"""),
    "m06_m07_saved_centers": sql("select c::integer as cluster, count(*) as n from three4_near group by c"),
    "m04_silhouette_values": sql(f"""
      select c::integer as cluster, count(*) as n, {r('avg(s)', 6, 'silhouette')} from three5_silhouette group by c
      union all select -1, count(*), {r('avg(s)', 6, 'silhouette')} from three5_silhouette"""),
    "m03_cluster_5": sql("select count(*) as rows_scored, 3 as clusters, 0 as misplaced from basic"),
    "m03_cluster_10": sql(f"select count(*) as rows_scored, 3 as clusters, 0 as misplaced from enhanced where {COMPLETE}"),
    "m03_cluster_4": sql(f"select count(*) as rows_scored, 3 as clusters, 0 as misplaced from enhanced where {COMPLETE}"),
    "m04_silhouette": sql("select count(*) as rows_scored, true as in_range from basic"),
    "m05_trained_risk_label": sql("select count(*) as rows_labelled, 3 as labels, true as in_order from basic"),
    "m06_m07_train_and_score": sql(f"""
      select count(*) as rows_scored, 0 as different, 0 as without_cluster from enhanced where {COMPLETE}"""),
    "m05_risk_label": sql("select ticker, prediction, risk_category from labelled"),
    "m08_attribution": sql(f"select ticker, dt, cluster, {many(6, *PHIS)} from phi_own"),
    "a14_attribution_by_cluster": sql(
        "select cluster, " + ", ".join(r(f"avg({c})", 6, c) for c in PHIS) + " from phi_own group by cluster"
    ),
    "m08_attribution_of_cluster": sql(f"select ticker, dt, cluster, {many(6, *PHIS)} from phi_one"),
    "m08_attribution_all_rows": sql(f"select ticker, dt, cluster, {many(6, *PHIS)} from phi_all"),
    "m08_gap_to_cells": sql(
        "select " + ", ".join(r(f"max(abs(a.{c} - o.{c}))", 6, c) for c in PHIS)
        + " from phi_all a join phi_own o on a.ticker = o.ticker and a.dt = o.dt"
    ),
    "m08_trained_attribution": sql("select count(*) as rows_explained, true as adds_up from z"),
    "m11_whole_chain": sql(f"""
      select stage, 'success' as status, n as "rows"
      from (values ('enhanced'), ('features'), ('clustered')) t(stage),
           (select count(*) as n from enhanced where {COMPLETE})"""),
    "m09_risk_score": sql("select user_id, s as risk_score from user_risk"),
    "m10_risk_bin": sql("select user_id, risk as risk_category from user_risk"),
    "m11_build_portfolio": sql("""
      select user_id, ticker, category, risk_category from user_risk join short_list on risk = risk_category"""),
    "m12_allocate": sql(f"""
      select user_id, ticker, momentum, amount, {r("share * amount", 4, "investment")}
      from user_risk join short_list on risk = risk_category"""),
    "m12_allocate_class": sql(f"""
      select ticker, risk_category,
             {r("momentum / nullif(sum(momentum) over (partition by risk_category), 0) * 50000", 4, "investment")}
      from labelled"""),
    "m13_age_risk": sql("""
      select user_id, age, case when age < 30 then 'Mid Risk' when age > 50 then 'Low Risk' else 'High Risk' end as risk_category
      from users"""),
    "m14_signal": sql(f"""
      select ticker, dt as date, close as last_close, {r("sma_30", 4, "last_moving_avg")},
             case when close > sma_30 then 'Buy' when sma_30 is not null then 'Hold' end as recommendation
      from feats qualify row_number() over (partition by ticker order by dt desc) = 1"""),
    "m15_portfolio_view": sql("select ticker, category, momentum, pe_ratio, risk_category from labelled"),
    "t01_market_snapshots": sql("""
      select time_bucket(interval '15 minutes', ts) as window_start, asset, arg_max(price, (ts, event_id)) as price,
             count(*) as n_quotes
      from open_quotes group by all"""),
    "t01_every_interval": sql("""
      select window_start, s.asset, price, coalesce(n, 0) as n_quotes
      from (select asset, unnest(generate_series(min(time_bucket(interval '15 minutes', ts)),
                   (select max(ts) from open_quotes) - interval 75 minute, interval 15 minute)) as window_start
            from open_quotes group by asset) s
      left join (select time_bucket(interval '15 minutes', ts) as began, asset, arg_max(price, (ts, event_id)) as price, count(*) as n
                 from open_quotes group by all) q on q.asset = s.asset and began = window_start
      where isodow(window_start - interval 5 hour) <= 5
        and hour(window_start - interval 5 hour) * 60 + minute(window_start - interval 5 hour) between 570 and 945"""),
    "t01_late_quotes": sql("""
      select count(*) filter (day(ts) > 7) as kept, count(*) filter (day(ts) <= 7) as dropped from quotes"""),
    "t02_long_quotes": sql("""
      select w as ts, a as asset, arg_max(price, (ts, event_id)) as price
      from (select distinct time_bucket(interval '15 minutes', ts) as w from quotes)
      cross join (select distinct asset as a from quotes)
      left join quotes on time_bucket(interval '15 minutes', ts) = w and asset = a group by w, a"""),
    "t03_append_quotes": sql("select event_id, ts, asset, price from quotes"),
    "t04_upsert_stream": sql("""
      select event_id, ts, asset, price, cast(ts as date) as dt from quotes
      qualify row_number() over (partition by asset, cast(ts as date) order by ts desc, event_id desc) = 1"""),
    "t05_latest_prices": sql("select asset, max(ts) as ts, arg_max(price, (ts, event_id)) as price from quotes group by asset"),
    "w08_quote_ema_blocked": sql(f"select event_id, asset, {many(4, 'ema_20')} from quote_ema"),
    "w01_quote_returns_blocked": sql("""
      select event_id, ts, asset, price as close,
             price / nullif(lag(price) over (partition by asset order by ts, event_id), 0) - 1 as daily_return
      from quotes"""),
}

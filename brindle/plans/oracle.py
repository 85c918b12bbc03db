"""The same results in plain SQL, worked out another way where there is one."""

from __future__ import annotations

_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _cents(col: str) -> str:
    return f"cast(floor({col} * 100 + 0.5) as bigint)"


_TRAILING = f"""
select e.event_id, e.user_id, e.ts,
       count(p.event_id) as n_before,
       coalesce(cast(sum({_cents('p.value')}) as double) / 100, 0) as sum_before
from events e
left join events p
  on p.user_id = e.user_id
 and p.ts < e.ts
 and p.ts >= e.ts - interval 7 day
group by e.event_id, e.user_id, e.ts
"""

_AS_OF = """
select p.event_id, p.user_id, p.ts,
       v.event_id as feature_event_id, v.ts as feature_ts, v.value as feature_value
from (select * from events where event_type = 'purchase') p
asof left join (select * from events where event_type = 'view') v
  on p.user_id = v.user_id and p.ts > v.ts
"""

_CUTS = f"""
ranked as (
  select {_cents('o_totalprice')} as x,
         row_number() over (order by o_totalprice) - 1 as r,
         count(*) over () as total
  from orders where o_orderdate < timestamp '1999-01-01'
),
positions as (
  select i, (total - 1) * i // 10 as r, (total - 1) * i % 10 as rest
  from (select max(total) as total from ranked), range(1, 10) as s(i)
),
cuts as (
  select p.i, lo.x * 10 + p.rest * (coalesce(hi.x, lo.x) - lo.x) as cut
  from positions p
  join ranked lo on lo.r = p.r
  left join ranked hi on hi.r = p.r + 1
),
binned as (
  select o_orderkey, o_totalprice, o_orderdate,
         case when o_totalprice is null then -1
              else (select count(*) from cuts where {_cents('o_totalprice')} * 10 > cut) end as bin
  from orders
)
"""

_DAYS = (
    "days as (select user_id, date_trunc('day', ts) as day, "
    + ", ".join(f"count(*) filter (event_type = '{t}') as n_{t}" for t in _EVENT_TYPES)
    + """ from events group by 1, 2),
labelled as (
  select d.*, cast(exists (select 1 from events e
                           where e.user_id = d.user_id and e.event_type = 'purchase'
                             and date_trunc('day', e.ts) = d.day + interval 1 day) as int) as label
  from days d where d.day < (select date_trunc('day', max(ts)) from events)
)"""
)


def _odds(for_1: str, of_1: str, for_0: str, of_0: str) -> str:
    return (
        f"cast(floor((ln(({for_1})::double / ({of_1})::double) - ln(({for_0})::double / ({of_0})::double))"
        " * 1e9 + 0.5) as bigint)"
    )


_FORECAST = (
    f"""{_DAYS},
model as (
  select count(*) filter (label = 1) as n1, count(*) filter (label = 0) as n0, """
    + ", ".join(
        f"count(*) filter (label = {y} and n_{t} > 0) as {t}_{y}" for t in _EVENT_TYPES for y in (0, 1)
    )
    + """ from labelled where day < timestamp '2024-01-22'
),
forecast as (
  select user_id, day, label, """
    + _odds("n1 + 1", "n1 + n0 + 2", "n0 + 1", "n1 + n0 + 2")
    + "".join(
        f" + case when n_{t} > 0 then {_odds(f'{t}_1 + 1', 'n1 + 2', f'{t}_0 + 1', 'n0 + 2')}"
        f" else {_odds(f'n1 - {t}_1 + 1', 'n1 + 2', f'n0 - {t}_0 + 1', 'n0 + 2')} end"
        for t in _EVENT_TYPES
    )
    + """ as log_odds_e9
  from labelled, model where day >= timestamp '2024-01-22'
)"""
)


def _metrics(scored: str, cut: str) -> str:
    return f"""
scored as (
  select *, rank() over (order by score) as first_rank, count(*) over (partition by score) as ties
  from ({scored})
),
totals as (
  select count(*) filter (score >= {cut} and label) as tp,
         count(*) filter (score >= {cut} and not label) as fp,
         count(*) filter (score < {cut} and label) as fn,
         count(*) filter (score < {cut} and not label) as tn,
         cast(sum(2 * first_rank + ties - 1) filter (label) as hugeint) as ranks2
  from scored
)
select tp, fp, fn, tn,
       tp / nullif(tp + fp, 0)::double as precision,
       tp / (tp + fn)::double as recall,
       2 * tp / (2 * tp + fp + fn)::double as f1,
       cast(ranks2 - cast(tp + fn as hugeint) * (tp + fn + 1) as double)
         / (2 * cast(tp + fn as double) * cast(fp + tn as double)) as auc
from totals
"""


ORACLE: dict[str, str] = {
    "order_features": f"""
select c_custkey,
       count(o_orderkey) as n_orders,
       coalesce(cast(sum({_cents('o_totalprice')}) as double) / 100, 0) as spend,
       cast(sum({_cents('o_totalprice')}) as double) / 100 / nullif(count(o_orderkey), 0)
         as mean_order,
       max(o_orderdate) as last_order
from customer left join orders on o_custkey = c_custkey
group by c_custkey
""",
    "event_counts": "select user_id, "
    + ", ".join(
        f"count(*) filter (event_type = '{t}') as n_{t}, "
        f"coalesce(cast(sum({_cents('value')}) filter (event_type = '{t}') as double) / 100, 0)"
        f" as sum_{t}"
        for t in _EVENT_TYPES
    )
    + ", count(*) filter (event_type is null or event_type not in ("
    + ", ".join(f"'{t}'" for t in _EVENT_TYPES)
    + ")) as n_other, coalesce(sum(value) filter (event_type is null or event_type not in ("
    + ", ".join(f"'{t}'" for t in _EVENT_TYPES)
    + ")), 0) as sum_other from events group by user_id",
    "window_counts_tumbling": """
select date_trunc('day', ts) as window_start,
       date_trunc('day', ts) + interval 1 day as window_end,
       event_type, count(*) as n_events
from events group by 1, 2, 3
""",
    "window_counts_sliding": """
select window_start, window_start + interval 1 day as window_end,
       event_type, count(*) as n_events
from (
  select event_type,
         date_trunc('day', ts) + (hour(ts) // 6 - back) * interval 6 hour as window_start
  from events, range(4) as s(back)
)
group by 1, 2, 3
""",
    "trailing_features": _TRAILING,
    "trailing_features_large_keys": _TRAILING,
    "as_of_feature": _AS_OF,
    "as_of_feature_large_keys": _AS_OF,
    "session_features": """
with flagged as (
  select *, case when ts - lag(ts) over w <= interval 12 hour then 0 else 1 end as opens
  from events window w as (partition by user_id order by ts, event_id)
),
numbered as (
  select *, sum(opens) over (
    partition by user_id order by ts, event_id rows unbounded preceding) as session
  from flagged
)
select user_id, min(ts) as session_start, max(ts) as session_last,
       count(*) as n_events, count(distinct event_type) as n_types
from numbered group by user_id, session
""",
    "standardised_prices": f"""
with fitted as (
  select count(*) as n,
         cast(sum(x) as hugeint) as total,
         cast(sum(cast(x as hugeint) * x) as hugeint) as squares,
         cast(min(x) as double) as low,
         cast(max(x) as double) as high
  from (select {_cents('o_totalprice')} as x from orders
        where o_orderdate < timestamp '1999-01-01')
)
select o_orderkey,
       ({_cents('o_totalprice')} - cast(total as double) / n)
         / sqrt(cast(n * squares - total * total as double) / cast(n * (n - 1) as double))
         as o_totalprice_z,
       ({_cents('o_totalprice')} - low) / (high - low) as o_totalprice_unit
from orders, fitted
""",
    "quantile_bins": f"with {_CUTS} select o_orderkey, o_totalprice, nullif(bin, -1) as bin from binned",
    "smoothed_return_rates": """
with fitted as (
  select l_suppkey, count(*) as n, count(*) filter (l_returnflag = 'R') as ones
  from lineitem where l_shipdate < timestamp '1999-01-01' group by l_suppkey
),
overall as (
  select cast(sum(ones) as double) / cast(sum(n) as double) as p from fitted
)
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       coalesce((f.ones + 10.0::double * p) / (f.n + 10.0::double), p) as encoded
from lineitem l cross join overall left join fitted f using (l_suppkey)
""",
    "binary_metrics": "with "
    + _metrics("select l_extendedprice as score, l_returnflag = 'R' as label from lineitem", "50000"),
    "purchase_forecast": f"with {_FORECAST} select * from forecast",
    "purchase_forecast_metrics": f"with {_FORECAST}, "
    + _metrics("select log_odds_e9::double as score, label = 1 as label from forecast", "-600000000"),
    "price_drift": f"""
with {_CUTS},
counted as (
  select s.bin,
         count(b.o_orderkey) filter (b.o_orderdate < timestamp '1999-01-01') as n_a,
         count(b.o_orderkey) filter (b.o_orderdate >= timestamp '1999-01-01') as n_b
  from range(-1, 10) as s(bin) left join binned b on b.bin = s.bin
  group by s.bin
),
shares as (
  select bin, n_a, n_b,
         greatest(n_a / cast(sum(n_a) over () as double), 1e-6) as a,
         greatest(n_b / cast(sum(n_b) over () as double), 1e-6) as b
  from counted
),
terms as (
  select bin, n_a, n_b,
         cast(floor((a - b) * ln(a / b) * 1e9 + 0.5) as bigint) as term_e9
  from shares
)
select bin, n_a, n_b, term_e9, cast(sum(term_e9) over () as bigint) as psi_e9 from terms
""",
    "purchase_forecast_inputs": "with days as (select user_id, date_trunc('day', ts) as day, "
    + ", ".join(f"count(*) filter (event_type = '{t}') as n_{t}" for t in _EVENT_TYPES)
    + f""", cast(sum({_cents('value')}) as double) / 100 as value_sum
  from events group by 1, 2)
select d.*,
       case when d.day < (select date_trunc('day', max(ts)) from events)
            then cast(exists (select 1 from events e
                              where e.user_id = d.user_id and e.event_type = 'purchase'
                                and date_trunc('day', e.ts) = d.day + interval 1 day) as int)
       end as label
from days d
""",
    "streamed_window_counts": """
select date_trunc('day', ts) as window_start,
       date_trunc('day', ts) + interval 1 day as window_end,
       event_type, count(*) as n_events
from events group by 1, 2, 3
""",
    "streamed_dedup": "select distinct * from events",
}

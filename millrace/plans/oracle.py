"""For each registered query the same question in SQL, for DuckDB.

Written apart from the Spark code where another form exists: gaps and islands for
sessions, ASOF for the last view, QUALIFY for the newest row.
"""

from __future__ import annotations

_SESSIONS = """
    select user_id,
           min(ts) as session_start,
           max(ts) + interval 30 minutes as session_end,
           cast(count(*) as bigint) as n_events
    from (
        select *, sum(opens) over (partition by user_id order by ts, event_id) as session_no
        from (
            select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id)
                                <= interval 30 minutes then 0 else 1 end as opens
            from events
        )
    )
    group by user_id, session_no
"""

# Spark keeps watermarks in whole milliseconds.
_WATERMARK = (
    "(select date_trunc('milliseconds', max(ts)) - interval 10 minutes from events)"
)

ORACLE_SQL: dict[str, str] = {
    "revenue_by_region_year": """
        select r_name as region,
               cast(year(o_orderdate) as bigint) as order_year,
               cast(count(*) as bigint) as n_lines,
               cast(sum(cast(l_extendedprice as decimal(12,2))
                        * (1 - cast(l_discount as decimal(12,2)))) as decimal(38,4)) as revenue
        from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        where l_shipdate >= timestamp '1997-01-01 00:00:00'
        group by r_name, year(o_orderdate)
    """,
    "line_counts_cube": """
        select l_returnflag, l_linestatus,
               cast(grouping(l_returnflag) as bigint) as l_returnflag_total,
               cast(grouping(l_linestatus) as bigint) as l_linestatus_total,
               cast(count(*) as bigint) as n_lines
        from lineitem
        group by cube (l_returnflag, l_linestatus)
    """,
    "orders_without_lines": """
        select * from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
    """,
    "duplicate_line_keys": """
        select l_orderkey, l_linenumber, cast(count(*) as bigint) as n_lines
        from lineitem
        group by l_orderkey, l_linenumber
        having count(*) > 1
    """,
    "top_customers_per_nation": """
        select n_name as nation, cast(rank as bigint) as rank, c_custkey, c_name,
               cast(order_value as decimal(38,2)) as order_value
        from (
            select c_nationkey, c_custkey, c_name, order_value,
                   row_number() over (partition by c_nationkey
                                      order by order_value desc, c_custkey) as rank
            from customer
            join (
                select o_custkey, sum(cast(o_totalprice as decimal(12,2))) as order_value
                from orders group by o_custkey
            ) on o_custkey = c_custkey
        )
        join nation on c_nationkey = n_nationkey
        where rank <= 3
    """,
    "monthly_revenue_trend": """
        select order_month,
               cast(order_value as decimal(38,2)) as order_value,
               cast(order_value - case when lag(number) over months = number - 1
                    then lag(order_value) over months end as decimal(38,2)) as change,
               cast(case when number is not null then sum(order_value) over (
                    partition by number is null order by number
                    range between 2 preceding and current row) end as decimal(38,2))
                   as three_months
        from (
            select date_trunc('month', o_orderdate) as order_month,
                   cast(year(o_orderdate) * 12 + month(o_orderdate) as bigint) as number,
                   sum(cast(o_totalprice as decimal(12,2))) as order_value
            from orders
            group by 1, 2
        )
        window months as (partition by number is null order by number)
    """,
    "orders_priority_by_status": """
        select o_orderpriority,
               cast(count(*) filter (where o_orderstatus = 'F') as bigint) as n_f,
               cast(count(*) filter (where o_orderstatus = 'O') as bigint) as n_o,
               cast(count(*) filter (where o_orderstatus = 'P') as bigint) as n_p,
               cast(count(*) filter (where o_orderstatus is null
                    or o_orderstatus not in ('F', 'O', 'P')) as bigint) as n_other
        from orders
        group by o_orderpriority
    """,
    "price_quantiles": """
        select l_returnflag,
               cast(quantile_cont(l_extendedprice, 0.5) as decimal(18,4)) as median_price,
               cast(quantile_cont(l_extendedprice, 0.95) as decimal(18,4)) as p95_price
        from lineitem
        group by l_returnflag
    """,
    "nations_without_poor_suppliers": """
        select n_nationkey, n_name
        from nation
        where n_nationkey in (
            select c_nationkey from customer
            except
            select s_nationkey from supplier where s_acctbal < 5000
        )
    """,
    "events_hourly": """
        select time_bucket(interval 1 hour, ts) as window_start, event_type,
               cast(count(*) as bigint) as n_events
        from events
        where ts is not null
        group by 1, 2
    """,
    "events_sliding": """
        select window_start, cast(count(*) as bigint) as n_events
        from (
            select time_bucket(interval 30 minutes, ts) as window_start from events
            union all
            select time_bucket(interval 30 minutes, ts) - interval 30 minutes from events
        )
        where window_start is not null
        group by window_start
    """,
    "user_sessions": _SESSIONS,
    "overlapping_sessions": f"""
        with s as materialized (
            select user_id, session_start, session_end from ({_SESSIONS})
            where session_start < session_end
        )
        select a.user_id, a.session_start, a.session_end,
               (select count(*) from s) - 1
               - (select count(*) from s b where b.session_start >= a.session_end)
               - (select count(*) from s b where b.session_end <= a.session_start)
                   as n_overlapping
        from s a
    """,
    "peak_open_sessions": f"""
        with s as materialized (
            select session_start, session_end from ({_SESSIONS})
            where session_start < session_end
        ), points as (
            select t, sum(step) as step from (
                select session_start as t, 1 as step from s
                union all select session_end, -1 from s
            ) group by t
        ), running as (
            select t, sum(step) over (order by t) as n, step from points
        )
        select date_trunc('day', t)::timestamp as day,
               cast(max(greatest(n, case when t > date_trunc('day', t) then n - step else n end))
                   as bigint) as n_open
        from running group by day
    """,
    "order_value_percentiles": """
        select o_orderkey, o_totalprice,
               rank() over (order by o_totalprice) as rank,
               percent_rank() over (order by o_totalprice) as percent_rank,
               ntile(100) over (order by o_totalprice, o_orderkey) as bucket
        from orders where o_totalprice is not null
    """,
    "weekly_active_users": """
        with active as (
            select distinct user_id, date_trunc('day', ts)::timestamp as day
            from events where user_id is not null and ts is not null
        )
        select d.day, cast(count(distinct user_id) as bigint) as n_users
        from (select distinct day from active) d
        join active a on a.day between d.day - interval 6 days and d.day
        group by d.day
    """,
    "funnel_view_signup_purchase": """
        with steps as (
            select user_id, ts, event_id,
                   list_position(['view', 'signup', 'purchase'], event_type) - 1 as step
            from events
            where event_type in ('view', 'signup', 'purchase')
              and user_id is not null and ts is not null
        ), taken as (
            select user_id, cast(list_reduce(
                       list_prepend(0, list(step order by ts, event_id, step)),
                       lambda n, step: case when step = n % 3 then n + 1 else n end) as bigint) as n
            from steps group by user_id
        )
        select user_id, cast(least(n, 3) as bigint) as n_steps,
               cast(n // 3 as bigint) as n_complete
        from taken
    """,
    "last_view_before_purchase": """
        select user_id, event_id as purchase_id, ts as purchase_ts,
               case when user_id is not null and ts is not null then view_id end as view_id,
               case when user_id is not null and ts is not null then view_ts end as view_ts
        from (
            select *,
                   last_value(case when event_type = 'view' then event_id end ignore nulls)
                       over before as view_id,
                   last_value(case when event_type = 'view' then ts end ignore nulls)
                       over before as view_ts
            from events
            window before as (partition by user_id, ts is null order by ts, event_id
                              rows between unbounded preceding and 1 preceding)
        )
        where event_type = 'purchase'
    """,
    "json_prop_totals": """
        select event_type,
               cast(sum(case when regexp_full_match(k, '[+-]?[0-9]+')
                    then try_cast(ltrim(k, '+') as bigint) end) as bigint) as total_k
        from (
            select event_type,
                   json_extract_string(case when json_valid(props) then props end, '$.k') as k
            from events
        )
        group by event_type
    """,
    "latest_event_per_user": """
        select user_id, ts, event_id, event_type, value
        from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
    """,
    "orders_by_year_sink": """
        select cast(year(o_orderdate) as bigint) as order_year,
               cast(count(*) as bigint) as n_orders,
               cast(sum(cast(o_totalprice as decimal(12,2))) as decimal(38,2)) as order_value,
               min(o_orderdate) as first_order,
               max(o_orderdate) as last_order
        from orders
        group by 1
    """,
    "stream_events_hourly": f"""
        select time_bucket(interval 1 hour, ts) as window_start,
               cast(count(*) as bigint) as n_events
        from events
        where ts is not null
        group by 1
        having time_bucket(interval 1 hour, ts) + interval 1 hour <= {_WATERMARK}
    """,
    "stream_user_sessions": f"""
        select * from ({_SESSIONS})
        where session_end <= {_WATERMARK}
    """,
    "stream_dedup": """
        select distinct event_id, ts, user_id, event_type, value from events
    """,
    "stream_view_to_purchase": """
        with minutes as materialized (
            select user_id, event_type, date_trunc('minute', ts)::timestamp as m,
                   cast(count(*) as bigint) as n
            from events where event_type in ('view', 'purchase') and ts is not null
            group by all
        ), closed as (
            select date_trunc('milliseconds', min(latest)) - interval 10 minutes as t
            from (select max(ts) as latest from events
                  where event_type in ('view', 'purchase') group by event_type)
        ), pairs as (
            select v.user_id, v.m as view_minute, v.n as n_views,
                   p.m as purchase_minute, p.n as n_purchases
            from minutes v left join minutes p
              on p.event_type = 'purchase' and p.user_id = v.user_id
                 and p.m between v.m and v.m + interval 30 minutes
            where v.event_type = 'view'
        )
        select pairs.* from pairs, closed
        where case when purchase_minute is not null
                   then purchase_minute + interval 1 minute <= t
                   else view_minute + interval 31 minutes < t end
    """,
    "stream_inactive_users": f"""
        with known as (
            select user_id, ts, event_id,
                   coalesce(ts - lag(ts) over u > interval 2 days, true) as opens
            from events where user_id is not null and ts is not null
            window u as (partition by user_id order by ts, event_id)
        ), numbered as (
            select *, sum(opens::int) over (partition by user_id order by ts, event_id) as run
            from known
        )
        select user_id, max(ts) as last_seen, cast(count(*) as bigint) as n_events
        from numbered group by user_id, run
        having time_bucket(interval 1 hour, max(ts) + interval 2 days) + interval 1 hour
               <= {_WATERMARK}
    """,
    "stream_revenue_upserts": """
        select date_trunc('month', l_shipdate)::timestamp as ship_month,
               cast(count(*) as bigint) as n_lines,
               cast(sum(cast(l_extendedprice as decimal(12,2))) as decimal(38,2)) as revenue
        from lineitem
        where l_returnflag is distinct from 'R'
        group by 1
    """,
}

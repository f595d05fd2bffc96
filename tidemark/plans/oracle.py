"""Independent SQL statements (DuckDB dialect) for each catalog query.

They are written the plain way - windows with ROW_NUMBER / LEAD / LAST_VALUE,
scalar subqueries, full outer joins - so they check the aggregate-based
Spark plans rather than repeat them. Column names equal the Spark aliases.
"""

# states that several table jobs must leave
TWO_BATCHES = """
    with t as (select o_orderkey, o_totalprice, o_orderdate from orders where o_orderdate < timestamp '2000-01-01'),
         s as (select o_orderkey, o_orderdate,
                      case when o_orderstatus = 'F' then o_totalprice else o_totalprice + 1 end as o_totalprice
               from orders where o_orderdate >= timestamp '1999-01-01')
    select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice,
           strftime(coalesce(s.o_orderdate, t.o_orderdate), '%Y') as year
    from t full outer join s on t.o_orderkey = s.o_orderkey"""
ALL_PRICES = "select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') as year from orders"

ORACLE_SQL = {
    "monthly_summary": """
        select strftime(o_orderdate, '%Y-%m') as month,
               round(avg(o_totalprice), 4) as avg_close,
               max(o_totalprice) as max_close, min(o_totalprice) as min_close
        from orders where o_totalprice > 0 group by 1""",
    "monthly_by_symbol": """
        select event_type as symbol, strftime(ts, '%Y-%m') as month,
               round(avg(value), 4) as avg_close,
               max(value) as max_close, min(value) as min_close
        from events where value > 0 group by 1, 2""",
    "null_month_group": """
        select m as month, count(*) as n from (
          select case when o_orderkey % 9 = 0 then null else strftime(o_orderdate, '%Y-%m') end as m
          from orders) where m is not null group by 1""",
    "clean_strict": """
        select * from (
          select c_custkey, c_name, case when c_custkey % 11 = 0 then null else c_acctbal end as c_acctbal
          from customer)
        where c_custkey is not null and c_name is not null and c_acctbal is not null and c_acctbal > 0""",
    "drop_null_subset": """
        select * from (
          select event_id, case when event_id % 7 = 0 then null else ts end as ts,
                 case when event_id % 5 = 0 then null else value end as value from events)
        where ts is not null""",
    "check_violations": """
        select 'positive_balance' as rule,
               count(*) filter (where not coalesce(c_acctbal > 0, false)) as violations from customer
        union all
        select 'named_customer', count(*) filter (where not coalesce(c_name like 'Customer#%', false))
        from customer""",
    "coerce_numeric": """
        select o_orderkey, try_cast(o_orderpriority as double) as whole,
               try_cast(split_part(o_orderpriority, '-', 1) as double) as head from orders""",
    "dedup_keep_last": """
        select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
    "dedup_rows": "select distinct l_orderkey, l_linenumber from lineitem",
    "fill_by_key": """
        select event_id,
               coalesce(last_value(v ignore nulls) over (partition by event_type order by ts, event_id
                          rows between unbounded preceding and current row),
                        first_value(v ignore nulls) over (partition by event_type order by ts, event_id
                          rows between current row and unbounded following)) as filled
        from (select *, case when event_id % 7 = 0 then null else value end as v from events)""",
    "fill_global": """
        select event_id,
               coalesce(last_value(v ignore nulls) over (order by ts, event_id
                          rows between unbounded preceding and current row),
                        first_value(v ignore nulls) over (order by ts, event_id
                          rows between current row and unbounded following)) as filled
        from (select *, case when event_id % 7 = 0 then null else value end as v from events)""",
    "upsert_orders": """
        with t as (select o_orderkey, o_totalprice from orders where o_orderdate < timestamp '2000-01-01'),
             s as (select o_orderkey,
                          case when o_orderstatus = 'F' then o_totalprice else o_totalprice + 1 end as o_totalprice
                   from orders where o_orderdate >= timestamp '1999-01-01')
        select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
               case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end as o_totalprice
        from t full outer join s on t.o_orderkey = s.o_orderkey""",
    "upsert_metrics": """
        with t as (select o_orderkey as k, o_totalprice as p from orders where o_orderdate < timestamp '2000-01-01'),
             s as (select o_orderkey as k,
                          case when o_orderstatus = 'F' then o_totalprice else o_totalprice + 1 end as p
                   from orders where o_orderdate >= timestamp '1999-01-01')
        select count(*) filter (where t.k is null) as inserted,
               count(*) filter (where t.k is not null and s.k is not null) as updated,
               count(*) filter (where s.k is null) as kept,
               count(*) filter (where t.k is not null and s.k is not null and t.p is not distinct from s.p) as unchanged
        from t full outer join s on t.k = s.k""",
    "replace_by_key": """
        select o_orderkey, o_totalprice from orders where o_orderstatus <> 'O'
        union all
        select o_orderkey, o_totalprice + 1 from orders where o_orderstatus = 'O'""",
    "schema_merge": """
        select c_custkey, c_name, cast(null as double) as extra from customer
        where c_mktsegment in ('AUTOMOBILE', 'BUILDING')
        union all
        select c_custkey, c_name, c_acctbal as extra from customer
        where c_mktsegment not in ('AUTOMOBILE', 'BUILDING')""",
    "high_water": """
        select event_id, ts from events
        where ts > (select max(ts) from events where ts < timestamp '2024-01-20')""",
    "high_water_by_key": """
        select e.event_id, e.event_type, e.ts from events e
        left join (select event_type, max(ts) as hw from events
                   where event_type in ('click', 'view') and ts < timestamp '2024-01-15' group by 1) h
          on e.event_type = h.event_type
        where h.hw is null or e.ts > h.hw""",
    "fx_scalar_enrich": """
        select event_id, value * (
          select v from (select case when event_id % 7 = 0 then null else value end as v, ts, event_id
                         from events where event_type = 'purchase')
          where v is not null order by ts desc, event_id desc limit 1) as close_fx
        from events""",
    "latest_row": "select event_id, ts, value from events order by ts desc, event_id desc limit 1",
    "latest_per_key": "select event_type, max(ts) as ts, arg_max(value, ts) as value from events group by 1",
    "derive_dates": """
        select event_id, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%Y-%m') as month from events""",
    "json_field": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "payload_rows": """
        select o_custkey as symbol, strftime(o_orderdate, '%Y-%m-%d') as date,
               min(o_totalprice) as open, max(o_totalprice) as close, min(o_totalprice) as close_1,
               cast(count(*) as double) as volume
        from orders group by 1, 2""",
    "fx_latest": """
        select from_currency_code, to_currency_code, rate, last_refreshed from (
          select 'C' || cast(user_id as varchar) as from_currency_code, upper(event_type) as to_currency_code,
                 value as rate, strftime(ts, '%Y-%m-%d %H:%M:%S') as last_refreshed,
                 row_number() over (partition by user_id, event_type order by date_trunc('second', ts) desc, event_id desc) as rn
          from events where event_type <> 'error')
        where rn = 1""",
    "payload_rejects": "select 'no_quote' as reason, count(*) as n from events where event_type = 'error'",
    "asof_version": """
        select o_custkey, o_orderkey, o_totalprice from orders where year(o_orderdate) <= 1998
        qualify row_number() over (partition by o_custkey order by year(o_orderdate) desc, o_orderkey desc) = 1""",
    "version_history": """
        select year(o_orderdate) as _version, count(*) as n from orders group by 1 order by 1 desc limit 3""",
    "vacuum_changelog": """
        select o_custkey, o_orderkey, o_orderdate from (
          select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as nx
          from orders)
        where nx is null or nx >= (select max(o_orderdate) from orders) - interval 168 hour""",
    "zorder_code": """
        select distinct l_partkey, l_suppkey,
               cast(list_sum(list_transform(range(0, 31), lambda i:
                 (((l_partkey >> i) & 1) << (2 * i)) + (((l_suppkey >> i) & 1) << (2 * i + 1)))) as bigint) as z
        from lineitem""",
    "silver_prices": """
        with e as (
          select event_type as symbol, case when event_id % 13 = 0 then null else ts end as datetime,
                 case when event_id % 7 = 0 then null when event_id % 10 = 0 then 0.0 else value end as close,
                 event_id from events),
        d as (select * from e qualify row_number() over (partition by symbol, datetime order by event_id desc) = 1),
        n as (select * from d where datetime is not null),
        f as (select symbol, datetime, event_id,
                     coalesce(last_value(close ignore nulls) over (partition by symbol order by datetime, event_id
                                rows between unbounded preceding and current row),
                              first_value(close ignore nulls) over (partition by symbol order by datetime, event_id
                                rows between current row and unbounded following)) as close
              from n),
        p as (select * from f where close > 0),
        r as (select close as rate from p where symbol = 'purchase' order by datetime desc, event_id desc limit 1)
        select symbol, datetime, close, strftime(datetime, '%Y-%m-%d') as date, strftime(datetime, '%Y-%m') as month,
               close * (select rate from r) as close_fx
        from p""",
    "coerce_dates": """
        select o_orderkey, cast(cast(o_orderdate as date) as timestamp) as d_fixed,
               o_orderdate as d_inferred, cast(null as timestamp) as d_bad
        from orders""",
    "quarantine_rows": """
        select c_custkey, concat_ws(',',
                 case when not coalesce(c_acctbal > 0, false) then 'positive_balance' end,
                 case when not coalesce(c_nationkey < 20, false) then 'low_nation' end) as failed_rules
        from customer
        where not coalesce(c_acctbal > 0, false) or not coalesce(c_nationkey < 20, false)""",
    "quote_silver": """
        select 'C' || cast(user_id as varchar) as from_currency_code,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as last_refreshed, arg_max(value, event_id) as rate
        from events where event_type <> 'error' group by 1, 2, event_type""",
    "stream_latest_daily": """
        select event_type as symbol, strftime(ts, '%Y-%m-%d') as day, ts as datetime, event_id, value as close
        from events
        qualify row_number() over (partition by event_type, strftime(ts, '%Y-%m-%d') order by ts desc, event_id desc) = 1""",
    "gold_from_payloads": """
        with d as (
          select event_type as symbol, date_trunc('day', ts) as day, arg_min(value, ts) as open,
                 case when dayofmonth(date_trunc('day', ts)) % 7 = 0 then null else max(value) end as high,
                 min(value) as low, arg_max(value, ts) as close, count(*) as volume
          from events group by 1, 2)
        select symbol, strftime(day, '%Y-%m') as month,
               round(avg(close), 4) as avg_close,
               max(close) as max_close, min(close) as min_close
        from d
        where open is not null and high is not null and low is not null and close is not null
          and volume is not null and close > 0
        group by 1, 2""",
    "stream_dedup_copies": "select event_id, ts, value from events",
    "preview_rows": "select event_id, ts, value from events order by ts, event_id limit 5",
    "row_counts": """
        select 'orders' as "table", count(*) as n from orders
        union all select 'lineitem', count(*) from lineitem
        union all select 'events', count(*) from events
        union all select 'customer', count(*) from customer""",
    "table_upsert": TWO_BATCHES,
    "zorder_then_upsert": TWO_BATCHES,
    "overwrite_schema_merge": """
        select c_custkey, c_name, cast(null as double) as c_acctbal, upper(c_mktsegment) as segment from customer""",
    "sorted_partitions": ALL_PRICES,
    "compacted_table": ALL_PRICES,
    "publish_prices": """
        select o_orderkey, case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice
        from orders""",
    "fallback_scan": "select n_nationkey, n_name, n_regionkey from nation",
    "picked_columns": """
        select event_id, value as close, value as close_dup, value * 2 as exchange_rate from events""",
    "strict_dates": "select o_orderkey, cast(cast(o_orderdate as date) as timestamp) as day from orders",
    "vacuum_then_as_of": """
        select o_orderkey, case when o_orderstatus = 'P' then o_totalprice + 2 else o_totalprice + 1 end as o_totalprice
        from orders where o_orderstatus = 'P' or (o_orderstatus <> 'O' and o_orderpriority <> '1-URGENT')""",
    "as_of_after_delete": """
        select o_orderkey, o_totalprice + 1 as o_totalprice from orders
        where o_orderstatus = 'P' or (o_orderstatus <> 'O' and o_orderpriority <> '1-URGENT')""",
    "current_version": "select cast(3 as bigint) as version from orders where o_orderstatus = 'P' group by 1",
    "document_outcomes": """
        select event_id, case when event_type = 'purchase' then cast(value as varchar) end as exchange_rate,
               case when event_type = 'purchase' then cast(user_id as varchar) end as seen_by,
               case event_type when 'purchase' then null when 'error' then 'no_quote' when 'click' then 'not_a_json_object'
                               when 'view' then 'malformed_quote' else 'empty' end as reason
        from events""",
    "ingest_overlapping": """
        select event_type as symbol, 'USD' as market, strftime(day, '%Y-%m-%d') as date, strftime(day, '%Y-%m') as month,
               max(value) as high,
               case when dayofmonth(day) >= 15 then arg_max(value, ts) / 2 else arg_max(value, ts) end as close
        from (select *, date_trunc('day', ts) as day from events)
        group by event_type, day having arg_max(value, ts) > 0""",
    "version_changes": """
        select cast(v as bigint) as _version, op as _op, inserted, updated, deleted, cast(0 as bigint) as unchanged from (
          select 0 as v, 'upsert' as op, count(*) as inserted, 0::bigint as updated, 0::bigint as deleted from orders
          union all
          select 1, 'overwrite', 0, count(*) filter (where o_orderstatus <> 'O'), count(*) filter (where o_orderstatus = 'O') from orders
          union all
          select 2, 'delete', 0, 0, count(*) from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'
          union all
          select 3, 'upsert', 0, count(*), 0 from orders where o_orderstatus = 'P')""",
    "overlap_depth": """
        with spans as (
          select o_orderkey, o_orderstatus, o_orderdate as a, shipped as b from orders
          join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1) on l_orderkey = o_orderkey
          where o_orderdate is not null and shipped is not null),
        points as (
          select o_orderstatus, a as point, 0 as is_end from spans union all select o_orderstatus, b, 1 from spans),
        swept as (
          select *, sum(1 - is_end) over w as started, sum(is_end) over w as ended from points
          window w as (partition by o_orderstatus order by point, is_end range between unbounded preceding and current row)),
        counted as (
          select o_orderstatus, sum(is_end) as n, max(started - ended) as deepest,
                 sum(case when is_end = 1 then started else -ended end) as met from swept group by 1)
        select o_orderstatus, cast(n as bigint) as intervals, round(cast(met as double) / cast(n as double), 6) as avg_depth,
               cast(deepest as bigint) as max_depth from counted""",
    "clustering_depth": """
        select layout, c as "column", count(*) as rows, true as fell
        from orders, unnest(['flat', 'partitioned']) as l(layout), unnest(['o_custkey', 'o_orderdate', 'o_totalprice']) as t(c)
        group by 1, 2""",
    "check_blocks_write": """
        select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') as year from orders where o_orderstatus <> 'P'""",
    "widened_types": """
        select o_orderkey, case when o_orderstatus = 'F' then trunc(o_totalprice) else o_totalprice end as price,
               case when o_orderstatus = 'F' then cast(date_trunc('day', o_orderdate) as timestamp) else o_orderdate end as at
        from orders""",
    "moved_rows": """
        select o_orderkey, o_totalprice,
               case when o_orderstatus = 'O' and o_orderdate < timestamp '1997-01-01' then 'P' else o_orderstatus end as o_orderstatus
        from orders""",
    "stream_late_rows": """
        with dealt as (select *, cast(least(floor((dayofmonth(ts) - 1) / 10), 2) as int) as third from events),
        due as (select *, third + case when event_type = 'error' then 1 else 0 end as run from dealt),
        marks as (
          select run, max(max(ts)) over (order by run rows between unbounded preceding and 1 preceding) - interval 2 day as mark
          from (select run, ts from due union all select third + 1, ts from dealt where event_type = 'purchase') group by run)
        select event_id, ts, event_type, value,
               case when date_trunc('millisecond', ts) < date_trunc('millisecond', mark) then 'late' else 'kept' end as outcome
        from due join marks using (run)""",
    "asof_rates": """
        with closes as (
          select event_type, date_trunc('day', ts) + interval 1 day as since, max(value) as rate from events group by 1, 2),
        ended as (
          select *, lead(since) over (partition by event_type order by since) as until from closes)
        select e.event_id, e.event_type, e.value as close, e.value * c.rate as close_fx
        from events e left join ended c on e.event_type = c.event_type and e.ts >= c.since and (c.until is null or e.ts < c.until)""",
}

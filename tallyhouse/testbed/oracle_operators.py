"""What each operator query must return, in DuckDB's SQL."""

from __future__ import annotations

from tallyhouse.testbed.adapter import duckdb_with

_CREDIT = "case l_returnflag when 'R' then 1 when 'A' then 0 end"
_LINE_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
               "l_linestatus, l_shipdate")


def operator_oracles() -> dict[str, str]:
    return {
        "open_invoice_balance": f"""
            select l_orderkey, cast(sum(case when {_CREDIT} = 1 then q else -q end) as double) as balance
            from (select *, cast(l_quantity as decimal(19,4)) as q from lineitem)
            group by l_orderkey having sum(case when {_CREDIT} = 1 then q else -q end) <> 0""",
        "ar_aging_buckets": f"""
            with ledger as (select l_orderkey, l_shipdate, {_CREDIT} as credit, cast(l_extendedprice as decimal(19,4)) as a from lineitem),
            open as (select l_orderkey from ledger group by 1 having sum(case when credit = 1 then a else -a end) <> 0),
            due as (
                select l_orderkey, sum(case when credit = 0 then a else -a end) as due from ledger
                where l_shipdate < timestamp '2000-01-01' and l_orderkey in (select l_orderkey from open)
                group by 1 having sum(case when credit = 0 then a else -a end) <> 0),
            aged as (
                select n_name, due, date_diff('day', cast(o_orderdate as date), date '2000-01-01') - 1 as age
                from due join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
                join nation on n_nationkey = c_nationkey)
            select n_name, cast(sum(case when age <= 30 then due else 0 end) as double) as current,
                   cast(sum(case when age between 31 and 60 then due else 0 end) as double) as days_31_60,
                   cast(sum(case when age between 61 and 90 then due else 0 end) as double) as days_61_90,
                   cast(sum(case when age between 91 and 120 then due else 0 end) as double) as days_91_120,
                   cast(sum(case when age > 120 then due else 0 end) as double) as days_121_up,
                   cast(sum(due) as double) as total_due
            from aged group by n_name""",
        "first_sale_line": f"""
            select l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
            qualify row_number() over (partition by l_orderkey, l_returnflag order by {_LINE_ORDER}) = 1""",
        "latest_order_per_customer": """
            with kinds as (select distinct o_custkey, o_orderkey, o_orderstatus, o_orderpriority in ('1-URGENT', '2-HIGH') as main from orders),
            latest as (select * from kinds qualify row_number() over (partition by o_custkey, main order by o_orderkey desc) = 1)
            select c_custkey, p.o_orderkey as primary_order, p.o_orderstatus as primary_status, a.o_orderkey as addon_order,
                   a.o_orderstatus as addon_status
            from customer left join latest p on p.o_custkey = c_custkey and p.main
            left join latest a on a.o_custkey = c_custkey and not a.main""",
        "latest_event_lateral": "select c_custkey, " + ", ".join(
            f"(select case when value >= 1 then value end from events where user_id = c_custkey and event_type = '{kind}'"
            f" order by event_id desc limit 1) as last_{kind}" for kind in ("click", "error", "purchase", "signup", "view")
        ) + " from customer",
        "unordered_top1": """
            select n_nationkey, c_custkey, c_name, r_name from nation
            left join (select * from customer where c_acctbal > 0 and c_custkey in
                       (select max(c_custkey) from customer where c_acctbal > 0 group by c_nationkey)) on c_nationkey = n_nationkey
            left join region on r_regionkey = n_regionkey""",
        "last_row_joinback": """
            select m.o_custkey, o_orderkey as last_order, o_orderstatus as last_status, o_totalprice as last_price, o_orderdate as last_date
            from (select o_custkey, max(o_orderkey) as k from orders group by o_custkey) as m join orders on o_orderkey = m.k""",
        "endpoint_counts": """
            select nation.*, (select count(*) from supplier where s_nationkey = n_nationkey and s_acctbal > 5000) as suppliers, r_name
            from nation join region on r_regionkey = n_regionkey order by n_nationkey""",
        "exclusion_anti": """
            with listed as (
                select case when s_suppkey % 5 = 4 then 'other' else 'parts' end as report, s_acctbal < 0 as deleted,
                       s_nationkey % 2 = 0 as by_part, try_cast(case when s_suppkey % 7 = 3 then 'n/a' else cast(s_suppkey as varchar) end as bigint) as v
                from supplier)
            select p_partkey, p_size from part
            where not exists (select 1 from listed where report = 'parts' and not deleted and by_part and v = p_partkey)
              and not exists (select 1 from listed where report = 'parts' and not deleted and not by_part and v = p_size)""",
        "unmatched_anti": """
            select o_orderkey, o_custkey, o_totalprice from orders left join lineitem on l_orderkey = o_orderkey where l_orderkey is null""",
        "optional_filter": """
            select 'off' as mode, o_orderstatus, count(*) as orders from orders
            where nullif(o_orderpriority, '5-LOW') = nullif(o_orderpriority, '5-LOW') group by 2
            union all
            select 'on', o_orderstatus, count(*) from orders where nullif(o_orderpriority, '5-LOW') = '1-URGENT' group by 2""",
        "watermark_window": """
            select event_id, ts, event_type, 'given' as run from events
            where cast(ts as date) >= timestamp '2024-01-10 12:00:00' and cast(ts as date) < timestamp '2024-01-13 00:00:00'
            union all
            select event_id, ts, event_type, 'default' from events
            where cast(ts as date) >= timestamp '2024-01-19 00:00:00' and cast(ts as date) < timestamp '2024-01-20 00:00:00'""",
        "valid_at": """
            select l_returnflag, l_suppkey, count(*) as lines from lineitem
            where l_linestatus <> 'F' and l_shipdate <= timestamp '1998-06-01 12:00:00'
              and (l_returnflag = 'N' or l_shipdate + interval '90' day >= timestamp '1998-06-01 12:00:00')
            group by 1, 2""",
        "wide_key_distinct": """
            select l_suppkey as supplier, l_returnflag as flag from lineitem group by l_orderkey, l_returnflag, l_suppkey""",
        "sum_times_multiplicity": """
            select l_returnflag, l_linenumber, cast(q as double) as quantity, cast(q * count(*) as double) as total
            from (select *, cast(l_quantity as decimal(19,4)) as q from lineitem) group by l_returnflag, l_linenumber, q""",
        "computed_group_key": """
            select cast(cast(o_orderdate as date) as varchar) as ordered_on, case when o_orderstatus = 'F' then 'done' else 'open' end as state,
                   count(*) as orders, cast(sum(cast(o_totalprice as decimal(19,4))) as double) as price
            from orders group by 1, 2""",
        "distinct_over_aggregate": """
            select distinct o_custkey, o_orderstatus, count(*) as orders from orders group by o_custkey, o_orderstatus, o_orderpriority""",
        "self_join_primary": """
            select o.o_orderkey, l.o_orderkey as lead_order, l.o_orderdate as lead_date, home.n_name as home_nation, parent.n_name as parent_nation
            from orders o
            left join (select o_custkey, min(o_orderkey) as k from orders where o_orderpriority = '1-URGENT' group by 1) g on g.o_custkey = o.o_custkey
            left join orders l on l.o_orderkey = g.k
            left join customer on c_custkey = o.o_custkey
            left join nation home on home.n_nationkey = c_nationkey
            left join nation parent on parent.n_nationkey = home.n_regionkey""",
        "level_lookup": """
            select s_suppkey, 1 + s_suppkey % 3 as level, r_name, n_name from supplier
            left join region on s_nationkey % 7 = r_regionkey and 1 + s_suppkey % 3 = 2
            left join nation on s_nationkey % 7 = n_nationkey and 1 + s_suppkey % 3 = 3 and n_nationkey = s_nationkey""",
        "enrich_update": """
            select c_custkey, case when c_acctbal < 0 then null else c_custkey end as buyer, o_orderkey as best_order, o_totalprice as best_price
            from customer left join (
                select * from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey desc) = 1)
            on o_custkey = case when c_acctbal < 0 then null else c_custkey end""",
        "first_value_role": f"""
            select distinct l_suppkey,
                   first_value(l_orderkey) over top as top_order, first_value(l_quantity) over top as top_quantity,
                   first_value(l_orderkey) over low as low_order, first_value(nullif(l_linenumber, 7)) over low as low_sequence
            from lineitem
            window top as (partition by l_suppkey order by l_quantity desc, l_orderkey, {_LINE_ORDER}),
                   low as (partition by l_suppkey order by nullif(l_linenumber, 7) nulls first, l_orderkey, {_LINE_ORDER})""",
        "min_date_per_key": """
            select o.o_custkey, min(o.o_orderdate) as first_date
            from orders o join (select o_custkey, max(o_orderkey) as own from orders where o_orderstatus = 'F' group by 1) m
            on m.o_custkey = o.o_custkey and o.o_orderkey <> m.own group by 1""",
        "scalar_cleanup": """
            select doc_id, md5(clean) as clean_md5, length(clean) as clean_chars,
                   case lang when 'en' then 'English' when 'de' then 'German' when 'fr' then 'French' else 'OTHER' end as language,
                   coalesce(nullif(source, 'web'), 'none') as source_name,
                   case when n_chars > 1000 then 'long' else 'short' end as size_class,
                   cast(-n_chars as varchar) as negated, 'Payment' as kind
            from (select *, replace(replace(replace(text || chr(9) || source || chr(13) || chr(10), chr(10), ''), chr(13), ''), chr(9), '') as clean from documents)""",
        "predicates_like_in_between": """
            select p_partkey, nullif(p_name, 'red bolt') as name, p_brand, p_size from part
            where p_size between 10 and 40 and p_type not in ('ECONOMY') and p_retailprice >= 905 and p_brand <> 'Brand#3'
              and nullif(p_name, 'red bolt') not ilike '%green%' and nullif(p_name, 'red bolt') not ilike '%gear%'
              and p_brand like 'Brand#%'""",
        "typed_insert": """
            select p_partkey as part_id, p_name as title, cast(null as timestamp) as sold_at, p_size as size,
                   cast(cast(cast(p_retailprice as decimal(19,4)) * cast(0.0125 as decimal(19,4)) as decimal(12,2)) as double) as monthly
            from part""",
        "replace_guard": """
            select o_custkey, count(*) as orders, cast(sum(cast(o_totalprice as decimal(19,4))) as double) as price from orders group by 1""",
        "stage_reuse": f"""
            with due as (select l_orderkey, sum(case when {_CREDIT} = 0 then a else -a end) as due
                         from (select *, cast(l_extendedprice as decimal(19,4)) as a from lineitem) group by 1
                         having sum(case when {_CREDIT} = 0 then a else -a end) <> 0)
            select o_orderstatus, count(*) as orders, cast(sum(due) as double) as due
            from orders join due on l_orderkey = o_orderkey group by 1""",
        "left_join_fanout": """
            select c_custkey, c_name, o_orderkey from customer left join orders on o_custkey = c_custkey and o_orderpriority = '1-URGENT'""",
        "point_in_time_join": """
            select o_orderkey, o_orderstatus, count(*) as lines
            from orders join lineitem on l_orderkey = o_orderkey and l_shipdate < timestamp '2000-01-01' group by 1, 2""",
        "semi_restrict": """
            select l_orderkey, max(l_shipdate) as last_ship from lineitem
            where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O') group by 1""",
        "row_counts": """
            select count(*) as all_rows, count(*) filter (where o_orderstatus = 'P') as some_rows, min(o_orderdate) as first_date,
                   max(o_orderkey) as last_key from orders""",
        "source_columns": duckdb_with(["PartyPropertiesReporting", "PartyPropertiesReportingView"]) + """
            select p.PartyId as party, p."3" as first_name, p."5" as last_name, p."31" as organisation, v."First Name" as shown_name
            from PartyPropertiesReporting p left join PartyPropertiesReportingView v on v.PartyID = p.PartyId""",
    }

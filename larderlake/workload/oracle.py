"""The same results in plain SQL for DuckDB, written against the inputs and not against the engine.

A check is a SELECT over named building blocks; ``oracle`` prepends the blocks it needs.
"""

from __future__ import annotations

import re

from larderlake.plans import schemas
from larderlake.workload import inputs
from larderlake.workload.inputs import ENV, FIRST, SECOND

_FIRST, _SECOND = f"timestamp '{FIRST}'", f"timestamp '{SECOND}'"


def _day(col: str) -> str:
    return f"cast(strptime({col}, '%m/%d/%Y') as date)"


def _key(prefix: str, *cols: str) -> str:
    parts = ", ".join(f"cast({c} as varchar)" for c in cols)
    return f"md5(concat_ws('||', '{prefix}', {parts}))"


def _yyyymmdd(col: str) -> str:
    return f"cast(year({col}) * 10000 + month({col}) * 100 + day({col}) as integer)"


def _half_up(value: str) -> str:
    """A double to cents by its decimal digits, halves up, as Spark rounds."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 12)), 2) as double)"


BLOCKS: dict[str, str] = {
    name: text.replace("@K", inputs.JSON_K["duckdb"]).format(**{t: t for t in inputs.TABLES})
    for name, text in inputs.SQL.items()
}

BLOCKS |= {
    # --- orders in four deliveries: ten days each, some orders with the next one ---
    "x_delivered": """
        select order_id, cast(event_time as timestamp) as ts, store_id, quantity,
               case when day(cast(event_time as timestamp)) <= 10 then 0
                    when day(cast(event_time as timestamp)) <= 20 then 1 else 2 end
                 + cast(order_id % 17 = 0 as int) as delivery
        from r_order_events where quantity > 0""",
    "x_newest": """
        select n, max(ts) as mark from x_delivered, unnest([1, 2, 3]) u(n) where delivery < n group by n""",
    "x_judged": """
        select d.*, coalesce(ts < mark - interval 10 minutes, false) as late
        from x_delivered d left join x_newest on n = delivery""",
    "x_closing": "select max(ts) - interval 10 minutes as mark from x_judged where not late",
    # --- silver ---
    "s_lines": f"""
        select {_day('transaction_date')} as transaction_date, {_day('stock_date')} as stock_date,
               cast(product_id as integer) as product_id,
               cast(customer_id as integer) as customer_id,
               cast(store_id as integer) as store_id, cast(quantity as integer) as quantity
        from r_transactions""",
    "s_transactions": """
        select *, cast(year(transaction_date) as integer) as transaction_year,
               cast(month(transaction_date) as integer) as transaction_month,
               cast(quarter(transaction_date) as integer) as transaction_quarter,
               cast(dayofweek(transaction_date) + 1 as integer) as transaction_day_of_week
        from s_lines
        where transaction_date is not null and quantity > 0 and product_id is not null
          and store_id is not null and customer_id is not null""",
    "s_returns": f"""
        select * from (
            select {_day('return_date')} as return_date,
                   cast(year({_day('return_date')}) as integer) as return_year,
                   cast(month({_day('return_date')}) as integer) as return_month,
                   cast(product_id as integer) as product_id,
                   cast(store_id as integer) as store_id, cast(quantity as integer) as quantity
            from r_returns)
        where return_date is not null and quantity > 0 and product_id is not null
          and store_id is not null""",
    "s_calendar": f"""
        select d as date, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
               cast(quarter(d) as integer) as quarter,
               cast(dayofweek(d) + 1 as integer) as day_of_week,
               cast(weekofyear(d) as integer) as week_of_year, dayname(d) as day_name,
               monthname(d) as month_name, dayofweek(d) in (0, 6) as is_weekend
        from (select {_day('date')} as d from r_calendar) where d is not null""",
    "s_stores": f"""
        select cast(store_id as integer) as store_id, cast(region_id as integer) as region_id,
               store_type, store_name, store_street_address, store_city, store_state,
               store_country, store_phone, {_day('first_opened_date')} as first_opened_date,
               {_day('last_remodel_date')} as last_remodel_date,
               cast(total_sqft as integer) as total_sqft,
               cast(grocery_sqft as integer) as grocery_sqft
        from r_stores where region_id is not null""",
    "s_regions": """
        select cast(region_id as integer) as region_id, sales_district, sales_region
        from r_regions""",
    "s_customers": f"""
        select * exclude (ingestion_time, birthdate, acct_open_date),
               {_day('birthdate')} as birthdate, {_day('acct_open_date')} as acct_open_date,
               concat_ws(' ', first_name, last_name) as full_name
        from r_customers""",
    "s_products": f"""
        select * exclude (ingestion_time, recyclable, low_fat), recyclable = 1 as recyclable,
               low_fat = 1 as low_fat,
               {_half_up('(product_retail_price - product_cost) / product_retail_price * 100')}
                   as margin_pct
        from r_products where product_retail_price > 0 and product_cost > 0""",
    "s_orders": """
        select order_id, cast(event_time as timestamp) as event_timestamp, product_id, o.store_id,
               customer_id, quantity, cast(cast(event_time as timestamp) as date) as order_date,
               cast(year(cast(event_time as timestamp)) as integer) as order_year,
               cast(month(cast(event_time as timestamp)) as integer) as order_month,
               store_city, store_state, region_id
        from r_order_events o left join s_stores s on o.store_id = s.store_id
        where order_id is not null and quantity > 0 and product_id is not null""",
    "s_inventory": """
        select event_id, cast(event_time as timestamp) as event_timestamp, product_id, store_id,
               stock_level, event_type,
               case when stock_level = 0 then 'OUT_OF_STOCK' when stock_level < 10 then 'LOW'
                    when stock_level < 50 then 'MEDIUM' else 'HEALTHY' end as stock_status
        from r_inventory_events where event_id is not null and stock_level >= 0""",
    # --- dimensions ---
    "b_date": f"""
        select distinct {_key('dim_date', _yyyymmdd('date'))} as date_sk,
               {_yyyymmdd('date')} as date_key, *, year as fiscal_year, quarter as fiscal_quarter
        from s_calendar""",
    "b_region": f"""
        select {_key('dim_region', 'region_id')} as region_sk, * from s_regions""",
    "b_store": f"""
        select {_key('dim_store', 'store_id', 'effective_from')} as store_sk, *
        from (select s.*, case when store_id % 5 = 0 then {_SECOND} else {_FIRST} end
                     as effective_from, sales_district, sales_region
              from s_stores s left join s_regions r on s.region_id = r.region_id)""",
    "b_customer": f"""
        select {_key('dim_customer', 'customer_id', 'effective_from')} as customer_sk, *
        from (select *, case when customer_id % 5 = 0 then {_SECOND} else {_FIRST} end
                     as effective_from from s_customers)""",
    "b_product": f"""
        select {_key('dim_product', 'product_id', 'effective_from')} as product_sk, *
        from (select *, case when product_id % 5 = 0 then {_SECOND} else {_FIRST} end
                     as effective_from from s_products)""",
    # --- facts ---
    "b_sales": f"""
        select {_key('fact_sales', 'transaction_date', 't.product_id', 't.customer_id',
                     't.store_id', 'quantity', 'stock_date')} as sale_sk,
               product_sk, customer_sk, store_sk, date_sk, date_key, transaction_date, stock_date,
               t.product_id, t.customer_id, t.store_id, quantity, revenue, cost,
               round(revenue - cost, 2) as gross_profit, transaction_year, transaction_month,
               transaction_quarter
        from (select l.*, {_yyyymmdd('transaction_date')} as line_key,
                     round(quantity * product_retail_price, 2) as revenue,
                     round(quantity * product_cost, 2) as cost
              from s_transactions l left join s_products p on l.product_id = p.product_id) t
             left join b_product p on t.product_id = p.product_id
             left join b_customer c on t.customer_id = c.customer_id
             left join b_store s on t.store_id = s.store_id
             left join b_date d on t.line_key = d.date_key""",
    "b_returns": f"""
        select {_key('fact_returns', 'return_date', 't.product_id', 't.store_id', 'quantity')}
                   as return_sk,
               product_sk, store_sk, date_sk, line_key as date_key, return_date, t.product_id,
               t.store_id, quantity, return_revenue, return_cost, return_year
        from (select l.* exclude (return_month), {_yyyymmdd('return_date')} as line_key,
                     round(quantity * product_retail_price, 2) as return_revenue,
                     round(quantity * product_cost, 2) as return_cost
              from s_returns l left join s_products p on l.product_id = p.product_id) t
             left join b_product p on t.product_id = p.product_id
             left join b_store s on t.store_id = s.store_id
             left join b_date d on t.line_key = d.date_key""",
    # --- marts ---
    "m_alerts": f"""
        select {_key('agg_inventory_alert', 'store_sk', 'product_sk', 'stock_status')}
                   as inventory_alert_sk, store_sk, product_sk, stock_status,
               min(i.store_id) as store_id, min(i.product_id) as product_id,
               max(event_timestamp) as last_alert_time, min(stock_level) as lowest_stock_level
        from s_inventory i left join b_store s on i.store_id = s.store_id
             left join b_product p on i.product_id = p.product_id
        where stock_status in ('OUT_OF_STOCK', 'LOW')
        group by store_sk, product_sk, stock_status""",
    "m_minutes": f"""
        select {_key('agg_orders_per_min', 'store_sk', 'order_minute')} as orders_per_min_sk,
               store_sk, order_minute, min(store_id) as store_id,
               count(order_id) as orders_per_minute,
               cast(sum(quantity) as bigint) as total_quantity_per_minute
        from (select o.store_id, order_id, quantity, store_sk,
                     date_trunc('minute', event_timestamp) as order_minute
              from s_orders o left join b_store s on o.store_id = s.store_id)
        group by store_sk, order_minute""",
    "m_regional": f"""
        select {_key('agg_regional_sales', 'f.store_sk', 'transaction_year', 'transaction_month')}
                   as regional_sales_sk, f.store_sk, transaction_year, transaction_month,
               min(region_id) as region_id, min(sales_region) as sales_region,
               min(f.store_id) as store_id, min(store_name) as store_name,
               sum(revenue) as total_store_revenue, cast(sum(quantity) as bigint) as total_items_sold
        from b_sales f join b_store s on f.store_id = s.store_id
        group by f.store_sk, transaction_year, transaction_month""",
    "m_ltv": f"""
        select {_key('agg_customer_ltv', 'f.customer_sk')} as customer_ltv_sk, f.customer_sk,
               min(f.customer_id) as customer_id, min(first_name) as first_name,
               min(last_name) as last_name, min(customer_country) as customer_country,
               min(yearly_income) as yearly_income, min(member_card) as member_card,
               round(sum(revenue), 2) as lifetime_revenue,
               round(sum(gross_profit), 2) as lifetime_profit,
               count(date_key) as total_items_purchased,
               {_half_up('round(sum(revenue), 2) / count(date_key)')} as avg_item_value
        from b_sales f join b_customer c on f.customer_id = c.customer_id
        group by f.customer_sk""",
    "m_stores": """
        select a.transaction_year, a.transaction_month, a.region_id, a.store_id, a.store_name,
               a.total_store_revenue, a.total_items_sold, s.store_city, s.store_state,
               s.store_country, s.store_type, s.total_sqft, r.sales_district, r.sales_region
        from m_regional a join b_store s on a.store_id = s.store_id
             join b_region r on a.region_id = r.region_id""",
    # --- change application ---
    "h_marked": """
        select *, case when lag(seq) over w is null
                         or member_card is distinct from lag(member_card) over w
                       then 1 else 0 end as opens
        from r_customer_feed window w as (partition by customer_id order by seq)""",
    "h_numbered": """
        select *, sum(opens) over (partition by customer_id order by seq
                                   rows unbounded preceding) as version
        from h_marked""",
    "h_versions": """
        select customer_id, seq, member_card, education,
               min(seq) over (partition by customer_id, version) as start_at,
               row_number() over (partition by customer_id, version order by seq desc) as back
        from h_numbered""",
    "h_history": """
        select customer_id, seq, member_card, education, start_at as "__START_AT",
               lead(start_at) over (partition by customer_id order by start_at) as "__END_AT"
        from h_versions where back = 1""",
    "h_regions": """
        select region_id, seq, sales_region, sales_district
        from (select *, row_number() over (partition by region_id order by seq desc) as back
              from r_region_feed) where back = 1""",
    # --- audit ---
    "a_created": """
        select layer, update_id, max(timestamp) as created from r_pipeline_events
        where event_type = 'create_update' group by layer, update_id""",
    "a_newest": """
        select layer, update_id, created
        from (select *, row_number() over (partition by layer order by created desc) as back
              from a_created) where back = 1""",
    "a_events": """
        select e.*, json_extract_string(details, '$.flow_progress.flow_name') as flow,
               cast(json_extract_string(details, '$.flow_progress.metrics.num_output_rows')
                    as bigint) as written,
               cast(json_extract_string(details, '$.flow_progress.data_quality.dropped_records')
                    as bigint) as dropped,
               cast(json_extract(details, '$.flow_progress.data_quality.expectations') as varchar)
                   as checks
        from r_pipeline_events e join a_newest n
             on e.layer = n.layer and e.update_id = n.update_id""",
    "a_final": """
        select layer, details
        from (select *, row_number() over (partition by layer order by timestamp desc) as back
              from a_events where event_type = 'update_progress'
                and regexp_matches(details, 'COMPLETED|FAILED|CANCELED'))
        where back = 1""",
    "a_timing": """
        select e.layer, update_id, min(timestamp) as start_ts, max(timestamp) as end_ts,
               cast(floor(epoch(max(timestamp) - min(timestamp))) as bigint) as duration_s,
               case when f.details like '%COMPLETED%' then 'COMPLETED'
                    when f.details like '%FAILED%' then 'FAILED'
                    when f.details like '%CANCELED%' then 'CANCELED'
                    else 'IN_PROGRESS' end as status,
               count(*) filter (event_type = 'flow_progress' and e.details like '%COMPLETED%')
                   as tables,
               cast(coalesce(sum(written) filter (event_type = 'flow_progress'
                    and e.details like '%COMPLETED%'), 0) as bigint) as total_rows
        from a_events e left join a_final f on e.layer = f.layer
        group by e.layer, update_id, f.details""",
    "a_flow_lines": """
        select timestamp, layer, concat('flow_', flow) as stage, 'INFO' as level,
               concat(flow, ' finished with ', written, ' rows, ', dropped, ' left out') as message, 'SUCCESS' as status, written as row_count,
               cast(null as varchar) as error
        from a_events where event_type = 'flow_progress' and details like '%COMPLETED%'
        union all
        select timestamp, layer, concat('dq_drop_', flow), 'WARN',
               concat(dropped, ' rows of ', flow, ' broke a drop rule'), 'DQ_DROP', dropped, null
        from a_events where event_type = 'flow_progress' and details like '%COMPLETED%'
          and dropped > 0""",
    "a_dq_lines": """
        select timestamp, layer, concat('dq_expectations_', flow) as stage, 'INFO' as level,
               concat('Rules checked on ', flow, ': ', substr(checks, 1, 500))
                   as message, 'DQ_CHECK' as status, cast(null as bigint) as row_count,
               cast(null as varchar) as error
        from a_events where event_type = 'flow_progress' and checks is not null""",
    "a_error_lines": """
        select timestamp, layer, concat('error_', coalesce(flow, 'pipeline')) as stage,
               'ERROR' as level,
               concat(coalesce(flow, 'pipeline'), ' reports a failure: ', substr(details, 1, 200))
                   as message, 'FAILED' as status, cast(null as bigint) as row_count,
               substr(details, 1, 2000) as error
        from a_events where event_type in ('flow_progress', 'update_progress')
          and (details like '%FAILED%' or details like '%"error"%')""",
    # One line per entry of the configured layers, with what the closing entry counts.
    "a_stages": """
        select layer, 'x' as status from a_flow_lines where layer <> 'archive'
        union all select layer, 'x' from a_dq_lines where layer <> 'archive'
        union all select layer, 'x' from a_error_lines where layer <> 'archive'
        union all select layer, 'x' from a_timing where layer <> 'archive'
        union all select layer, 'x' from a_timing where layer <> 'archive'
        union all select layer, status from a_timing where layer <> 'archive'
        union all select 'quality', 'x' union all select 'export', 'x'""",
}

_RUN = "'run-1' as run_id, 'retail' as pipeline"
_HELD = "environment"
_STAMP = f"{_FIRST} as bronze_ingestion_time, '{ENV}' as environment"

CHECKS: dict[str, str] = {
    "s1_csv_stream": """
        select transaction_date, stock_date, cast(product_id as integer) as product_id,
               cast(customer_id as integer) as customer_id, cast(store_id as integer) as store_id,
               cast(quantity as integer) as quantity, 'transactions' as source_name
        from r_transactions""",
    "s1_csv_drift": """
        select transaction_date, case when cast(quantity as int) % 3 <> 2 then stock_date end as stock_date,
               cast(product_id as integer) as product_id,
               case when cast(quantity as int) % 3 <> 1 or cast(product_id as int) % 5 <> 0
                    then cast(customer_id as integer) end as customer_id,
               cast(store_id as integer) as store_id, cast(quantity as integer) as quantity,
               case when cast(quantity as int) % 3 = 2 then concat('p', store_id) end as promo,
               case when cast(quantity as int) % 3 = 1 and cast(product_id as int) % 5 = 0
                         and customer_id is not null
                    then concat('{"customer_id":"x', customer_id, '"}') end as _rescued
        from r_transactions""",
    "s2_found_types": """
        select cast(product_id as integer) as product_id,
               cast(customer_id as bigint) + case when cast(product_id as int) % 3 = 1 then 3000000000 else 0 end
                   as customer_id,
               case when cast(product_id as int) % 3 = 2 then concat('S', store_id) else store_id end as store_id,
               cast(quantity as double) + case when cast(product_id as int) % 3 = 1 then 0.5 else 0 end as quantity,
               case when cast(product_id as int) % 3 = 2
                    then make_date(2024, 1, cast(product_id as int) % 28 + 1) end as arrived
        from r_transactions""",
    "s12_interleaved_sink": """
        select store_id, product_id, count(*) as lines, round(sum(revenue), 2) as revenue
        from b_sales where store_id = 3 or product_id < 20 group by all""",
    "s3_lineage": """
        select 'lineitem.parquet' as file_name, 'transactions' as source_name,
               count(*) as stamped_rows from lineitem""",
    "s6_json_value_decode": "select * from r_order_events",
    "s7_table_stream": "select * exclude (ingestion_time), 'products' as source from r_products",
    "s11_partitioned_sink": """
        select transaction_year, transaction_month, count(*) as lines,
               round(sum(revenue), 2) as revenue
        from b_sales group by all""",
    "v1_transactions": f"""
        select *, {_STAMP}, 'landing/transactions.csv' as source_file from s_transactions""",
    "v2_returns": f"select *, {_STAMP} from s_returns",
    "v3_stores": f"select *, {_STAMP} from s_stores",
    "v4_regions": f"select *, {_STAMP} from s_regions",
    "v5_calendar": f"select *, {_STAMP} from s_calendar",
    "v6_customers": f"select *, {_STAMP} from s_customers",
    "v7_products": f"select *, {_STAMP} from s_products",
    "v8_unwrap_json": """
        select d.delivery, product_id, product_sku, product_cost, low_fat
        from r_products, (values ('nested'), ('flat')) d(delivery)""",
    "v9_orders_enriched": f"select *, '{ENV}' as environment from s_orders",
    "v10_inventory_status": f"select *, '{ENV}' as environment from s_inventory",
    "e1_expect_warn": """
        select cast(year(transaction_date) as integer) as transaction_year, count(*) as lines,
               count(*) filter (stock_date > transaction_date) as late_stock
        from s_lines group by 1""",
    "e2_expect_drop": """
        select transaction_year, count(*) as lines, cast(sum(quantity) as bigint) as units
        from s_transactions group by 1""",
    "e3_expect_fail_pass": f"select *, {_STAMP} from s_regions",
    "e4_rule_scorecard": """
        select 'transactions' as table_name, rule, action, count(*) as total_rows,
               count(*) filter (ok) as passed, count(*) filter (ok is not true) as failed
        from (select unnest([
                 {'rule': 'valid_transaction_date', 'action': 'drop',
                  'ok': transaction_date is not null},
                 {'rule': 'valid_quantity', 'action': 'drop', 'ok': quantity > 0},
                 {'rule': 'valid_product_id', 'action': 'drop', 'ok': product_id is not null},
                 {'rule': 'valid_store_id', 'action': 'drop', 'ok': store_id is not null},
                 {'rule': 'valid_customer_id', 'action': 'drop', 'ok': customer_id is not null},
                 {'rule': 'stock_before_sale', 'action': 'warn',
                  'ok': stock_date <= transaction_date}], recursive := true)
              from s_lines)
        group by rule, action""",
    "e4_rules_applied": "select store_id, count(*) as lines from s_transactions group by 1",
    "e4_observed_counts": """
        select metric, cast(value as bigint) as value
        from (select count(*) as total_rows, count(*) filter (quantity > 0 and customer_id is not null) as kept_rows,
                     count(*) filter (transaction_date is null) as valid_transaction_date,
                     count(*) filter ((quantity > 0) is not true) as valid_quantity,
                     count(*) filter (product_id is null) as valid_product_id,
                     count(*) filter (store_id is null) as valid_store_id,
                     count(*) filter (customer_id is null) as valid_customer_id,
                     count(*) filter ((stock_date <= transaction_date) is not true) as stock_before_sale
              from s_lines) unpivot (value for metric in (columns(*)))""",
    "a8_audit_errors": """
        select 'gold' as layer, 'audit_extraction' as stage, 'ERROR' as level, 'AUDIT_ERROR' as status,
               substr(replace(details, '"num_output_rows":', '"num_output_rows":"many","was":'), 1, 2000) as error
        from r_pipeline_events e join a_newest n on n.layer = e.layer and n.update_id = e.update_id
        where e.layer = 'gold' and event_type = 'flow_progress' and contains(details, '"num_output_rows":')
        order by timestamp, details limit 1""",
    "x6_stream_counts": """
        select 'transactions' as label, metric, cast(value as bigint) as value, true as over_100_batches
        from (select count(*) as total_rows,
                     count(*) filter (transaction_date is not null and quantity > 0 and product_id is not null
                                      and store_id is not null and customer_id is not null) as kept_rows,
                     count(*) filter (transaction_date is null) as valid_transaction_date,
                     count(*) filter ((quantity > 0) is not true) as valid_quantity,
                     count(*) filter (product_id is null) as valid_product_id,
                     count(*) filter (store_id is null) as valid_store_id,
                     count(*) filter (customer_id is null) as valid_customer_id,
                     count(*) filter ((stock_date <= transaction_date) is not true) as stock_before_sale
              from s_lines) unpivot (value for metric in (columns(*)))""",
    "e6_stream_quarantine": """
        select case when dropped then 'quarantined' else 'accepted' end as verdict,
               case when dropped then rules else '' end as rules,
               count(*) as lines, cast(sum(quantity) as bigint) as units
        from (select quantity, not (transaction_date is not null and coalesce(quantity > 0, false)
                                    and product_id is not null and store_id is not null
                                    and customer_id is not null) as dropped,
                     concat_ws(',', case when stock_date <= transaction_date then null else 'stock_before_sale' end,
                               case when customer_id is null then 'valid_customer_id' end,
                               case when quantity > 0 then null else 'valid_quantity' end) as rules
              from s_lines)
        group by 1, 2""",
    "x7_minute_stream": """
        select store_id, date_trunc('minute', ts) as order_minute, count(order_id) as orders_per_minute,
               cast(sum(quantity) as bigint) as total_quantity_per_minute, false as late
        from x_judged, x_closing where not late group by store_id, date_trunc('minute', ts)
        having date_trunc('minute', ts) + interval 1 minute <= any_value(x_closing.mark)
        union all
        select store_id, null, count(order_id), cast(sum(quantity) as bigint), true from x_judged where late group by 1""",
    "e5_violations": """
        select concat_ws(',', case when quantity > 0 then null else 'valid_quantity' end,
                         case when customer_id is null then 'valid_customer_id' end,
                         case when stock_date <= transaction_date then null
                              else 'stock_before_sale' end) as violated_rules, count(*) as lines
        from s_lines
        where not coalesce(quantity > 0 and customer_id is not null
                           and stock_date <= transaction_date, false)
        group by 1""",
    "scd2_history": "select * from h_history",
    "scd2_hot_keys": "select * from h_history",
    "scd2_incremental": "select * from h_history",
    "scd2_current": """
        select customer_id, member_card, education, "__START_AT" as effective_from
        from h_history where "__END_AT" is null""",
    "scd1_latest": "select * from h_regions",
    "scd1_incremental": "select * from h_regions",
    "g1_dim_date": "select * from b_date",
    "g2_dim_region": "select * from b_region",
    "g3_dim_store": "select * from b_store",
    "g4_dim_customer": "select * from b_customer",
    "g5_dim_product": "select * from b_product",
    "g6_fact_sales": "select * from b_sales",
    "g7_fact_returns": "select * from b_returns",
    "k1_surrogate_key": f"""
        select customer_id, {_key('k', 'customer_id', 'last_name', 'email_address')} as sk
        from r_customers""",
    "k2_dedup": """
        select customer_id, seq, member_card, education
        from (select *, row_number() over (partition by customer_id order by seq) as n
              from r_customer_feed) where n = 1""",
    "g8_executive_overview": f"""
        select {_key('agg_exec_overview', 'transaction_year', 'transaction_month')}
                   as exec_overview_sk, transaction_year, transaction_month,
               round(sum(revenue), 2) as total_revenue,
               round(sum(gross_profit), 2) as total_profit,
               {_half_up('round(sum(gross_profit), 2) / round(sum(revenue), 2) * 100')}
                   as profit_margin_pct
        from b_sales group by transaction_year, transaction_month""",
    "g9_inventory_alerts": "select * from m_alerts",
    "g10_orders_per_minute": "select * from m_minutes",
    "g11_regional_sales": """
        select * replace (round(total_store_revenue, 2) as total_store_revenue) from m_regional""",
    "g12_customer_ltv": "select * from m_ltv",
    "g13_store_space": f"""
        select {_key('agg_store_space', 'store_sk')} as store_space_sk, *,
               {_half_up('total_revenue / total_sqft')} as revenue_per_sqft,
               {_half_up('total_profit / total_sqft')} as profit_per_sqft
        from (select f.store_sk, min(f.store_id) as store_id, min(store_name) as store_name,
                     min(store_type) as store_type, min(total_sqft) as total_sqft,
                     min(grocery_sqft) as grocery_sqft, round(sum(revenue), 2) as total_revenue,
                     round(sum(gross_profit), 2) as total_profit
              from b_sales f join b_store s on f.store_id = s.store_id group by f.store_sk)""",
    "d1_alert_details": """
        select product_name, product_brand, store_name, store_city, stock_status,
               lowest_stock_level, last_alert_time
        from m_alerts a left join b_product p on a.product_id = p.product_id
             left join b_store s on a.store_id = s.store_id""",
    "d1_alert_count": "select count(*) as count from m_alerts",
    "d2_orders_source": """
        select o.*, order_minute, orders_per_minute, total_quantity_per_minute
        from s_orders o left join m_minutes m on o.store_id = m.store_id
             and date_trunc('minute', o.event_timestamp) = m.order_minute""",
    "d2a_total_orders": "select count(*) as count from s_orders",
    "d2b_orders_rate": """
        select count(*) / nullif(date_sub('minute', min(event_timestamp), max(event_timestamp)), 0)
                   as orders_per_minute from s_orders""",
    "d2c_qty_latest": """
        select cast(sum(quantity) as bigint) as total_quantity,
               max(event_timestamp) as latest_event from s_orders""",
    "d2d_orders_by_minute": """
        select date_trunc('minute', event_timestamp) as event_minute, count(*) as count
        from s_orders group by 1""",
    "d2e_orders_by_city": """
        select store_state, store_city, count(*) as count from s_orders group by 1, 2
        order by count desc""",
    "d2f_orders_by_hour": """
        select date_trunc('hour', event_timestamp) as event_hour, count(*) as count,
               cast(sum(quantity) as bigint) as total_quantity
        from s_orders group by 1""",
    "d2_widgets": """
        select 'total' as widget, null as event_hour, null as store_city, null as store_state, count(*) as count,
               cast(sum(quantity) as bigint) as total_quantity from s_orders
        union all select 'by_city', null, store_city, store_state, count(*), null from s_orders group by 3, 4
        union all select 'by_hour', date_trunc('hour', event_timestamp), null, null, count(*), cast(sum(quantity) as bigint)
                  from s_orders group by 2
        union all select 'large_by_city', null, store_city, null, count(*), cast(sum(quantity) as bigint)
                  from s_orders where quantity >= 4 group by 3
        union all select 'large', null, null, null, count(*), null from s_orders where quantity >= 4""",
    "t3_ordered": """
        select store_state, store_city, count(*) as count,
               cast(row_number() over (order by count(*) desc, store_state nulls first, store_city nulls first) as integer) as place
        from s_orders group by 1, 2""",
    "d3_inventory_measures": """
        select count(*) as count, avg(stock_level) as avg_stock_level from s_inventory""",
    "d3a_low_stock": """
        select count(*) as count from s_inventory where stock_status in ('LOW', 'OUT_OF_STOCK')""",
    "d3b_out_of_stock": """
        select count(*) as count from s_inventory where stock_status = 'OUT_OF_STOCK'""",
    "d3c_by_status": """
        select stock_status, count(*) as count from s_inventory group by 1 order by count desc""",
    "d4_month_date": """
        select store_id, make_date(transaction_year, transaction_month, 1) as month_date,
               round(total_store_revenue, 2) as total_store_revenue, total_items_sold
        from m_regional""",
    "d4a_totals": """
        select round(sum(total_store_revenue), 2) as total_store_revenue,
               cast(sum(total_items_sold) as bigint) as total_items_sold from m_regional""",
    "d4b_monthly_trend": """
        select make_date(transaction_year, transaction_month, 1) as month_date,
               round(sum(total_store_revenue), 2) as total_store_revenue
        from m_regional group by 1""",
    "d5_sales_with_stores": """
        select * replace (round(total_store_revenue, 2) as total_store_revenue) from m_stores""",
    "d5a_revenue_by_store": """
        select store_name, round(sum(total_store_revenue), 2) as total_store_revenue
        from m_stores group by 1 order by 2 desc""",
    "d5b_region_district": """
        select sales_district, sales_region,
               round(sum(total_store_revenue), 2) as total_store_revenue
        from m_stores group by 1, 2""",
    "d5c_store_performance": """
        select store_name, store_city, store_state, sales_region, sales_district,
               round(sum(total_store_revenue), 2) as total_store_revenue,
               cast(sum(total_items_sold) as bigint) as total_items_sold
        from m_stores group by all""",
    "r1_row_filter": """
        select 'user_0' as viewer, store_id, sales_region from b_store
        where sales_region in (select assigned_region from user_region_map
                               where user_id = 'user_0')
        union all select 'root', store_id, sales_region from b_store""",
    "r3_mask_customer": """
        select * replace ('### MASKED ###' as first_name, '### MASKED ###' as last_name,
                          '### MASKED ###' as full_name, '### MASKED ###' as email_address,
                          '### MASKED ###' as customer_address,
                          '### MASKED ###' as customer_postal_code,
                          cast(null as date) as birthdate) from b_customer""",
    "r5_mask_store": """
        select * replace ('### MASKED ###' as store_street_address,
                          '### MASKED ###' as store_phone) from b_store""",
    "r5_mask_ltv": """
        select * replace ('### MASKED ###' as first_name, '### MASKED ###' as last_name)
        from m_ltv""",
    "r6_secure_regional": """
        select sales_region, make_date(transaction_year, transaction_month, 1) as month_date,
               round(sum(total_store_revenue), 2) as total_store_revenue,
               cast(sum(total_items_sold) as bigint) as total_items_sold
        from m_regional where sales_region in (select assigned_region from user_region_map
                                               where user_id = 'user_0') group by 1, 2""",
    "r2_user_regions": "select user_id, assigned_region from user_region_map",
    "udf_sql_functions": """
        select store_id, sales_region, '### MASKED ###' as store_name, cast(null as date) as first_opened_date
        from b_store where sales_region in (select assigned_region from user_region_map where user_id = 'user_0')""",
    "s4_bronze_factory": """
        select 'return' as dataset, 'bronze_return' as bronze_table, count(*) as lines, count(*) as stamped,
               true as from_files from r_returns
        union all select 'regions', 'bronze_regions', count(*), count(*), true from r_regions
        union all select 'products', 'bronze_products', count(*), count(*), false from r_products""",
    "s14_replace": "select n_nationkey, n_name, n_regionkey from nation where n_regionkey <> 0",
    "s9_layer_read": """
        select store_id, count(*) as lines, cast(sum(quantity) as bigint) as units
        from s_transactions group by 1""",
    "x5_replay": """
        select cast(store_id as integer) as store_id, count(*) as lines from r_returns group by 1""",
    "a1_latest_update": "select * from a_newest",
    "a2_timing_status": """
        select layer, update_id, start_ts, end_ts, duration_s, status from a_timing""",
    "a3_flow_metrics": f"select *, {_RUN} from a_flow_lines",
    "a4_dq_rows": f"select *, {_RUN} from a_dq_lines",
    "a5_errors": f"select *, {_RUN} from a_error_lines",
    "a6_summary": f"""
        select layer, 'pipeline_summary' as stage, 'INFO' as level,
               concat('Layer ', layer, ': ', status, ', ', total_rows, ' rows in ', tables,
                      ' tables, ', duration_s, ' s') as message,
               status, total_rows as row_count, cast(null as varchar) as error, {_RUN}
        from a_timing where layer <> 'archive'
        union all
        select 'quality', 'pipeline_update', 'WARN',
               'Layer quality has not run yet', 'NO_UPDATES', null, null,
               {_RUN}
        union all
        select 'export', 'pipeline_config', 'WARN',
               'Layer export is switched off and was not read', 'SKIPPED', null,
               null, {_RUN}
        union all
        select 'orchestration', 'job_complete', 'INFO',
               concat('All layers together ', overall, ': bronze=', b, ', silver=', s, ', gold=', g,
                      ', quality=N/A, export=N/A'), overall, n, null, {_RUN}
        from (select case when bool_and(status = 'COMPLETED') filter (status <> 'x')
                          then 'COMPLETED' else 'PARTIAL_FAILURE' end as overall,
                     max(status) filter (layer = 'bronze' and status <> 'x') as b,
                     max(status) filter (layer = 'silver' and status <> 'x') as s,
                     max(status) filter (layer = 'gold' and status <> 'x') as g, count(*) as n
              from a_stages)""",
    "a7_audit_append": "select layer, count(*) as count from a_stages group by 1",
    "f1_date_functions": f"""
        select o_orderkey, {_yyyymmdd('o_orderdate')} as date_key,
               cast(strftime(o_orderdate, '%Y%m%d') as integer) as formatted_key,
               cast(quarter(o_orderdate) as integer) as quarter,
               cast(dayofweek(o_orderdate) + 1 as integer) as day_of_week,
               cast(weekofyear(o_orderdate) as integer) as week_of_year,
               dayname(o_orderdate) as day_name, monthname(o_orderdate) as month_name,
               make_date(cast(year(o_orderdate) as integer), cast(month(o_orderdate) as integer), 1)
                   as month_date,
               date_trunc('hour', o_orderdate) as hour
        from orders""",
    "f2_casts": """
        select l_orderkey, l_linenumber,
               case when l_linenumber = 3 then null else cast(l_quantity as integer) end as as_int,
               case when l_linenumber = 3 then null else cast(cast(l_quantity as integer) as double)
                    end as as_double,
               case when l_linenumber = 2 then null else date '2024-02-29' end as as_date,
               l_linenumber % 2 = 1 as as_flag, cast(l_linenumber as varchar) as as_text
        from lineitem""",
    "f3_strings_hash": """
        select customer_id, concat_ws(' ', first_name, last_name) as full_name,
               concat_ws(' ', last_name, email_address) as both_may_be_null,
               md5(customer_address) as address_hash,
               customer_acct_num like '%7%' as has_seven, substr(customer_address, 1, 6) as cut
        from r_customers""",
    "f4_json": """
        select event_id, cast(json_extract_string(props, '$.k') as bigint) as by_path,
               cast(json_extract_string(props, '$.k') as integer) as by_schema,
               cast(null as varchar) as missing, cast(null as integer) as malformed
        from events""",
    "f5_conditionals": """
        select l_orderkey, l_linenumber,
               case when q = 0 then 'OUT_OF_STOCK' when q < 10 then 'LOW' when q < 50 then 'MEDIUM'
                    else 'HEALTHY' end as band,
               l_returnflag in ('A', 'R') as flagged, nullif(l_linenumber, 1) as not_first,
               case when q = 0 then null else 10.0::double / q end as share,
               case when l_linestatus = 'O' then 'open' else l_linestatus end as state
        from (select *, cast(l_quantity as integer) - 1 as q from lineitem)""",
    "x1_stream_cleanse": f"select *, '{ENV}' as environment from s_returns",
    "j2_stream_static": f"select *, '{ENV}' as environment from s_orders",
}


CHECKS["g8_incremental"] = CHECKS["g8_executive_overview"]
CHECKS["g12_incremental"] = CHECKS["g12_customer_ltv"]


def _needed(sql: str) -> list[str]:
    """Blocks that ``sql`` reads, each after those it reads itself."""
    found: list[str] = []
    for name in BLOCKS:
        if re.search(rf"\b{name}\b", sql):
            found += [b for b in (*_needed(BLOCKS[name]), name) if b not in found]
    return list(dict.fromkeys(found))


def _versions_of(name: str, earlier: dict[str, str]) -> str:
    """The history that the two deliveries of a feed give, island by island."""
    (key,), tracked = schemas.KEYS[name], ", ".join(schemas.TRACKED[name])
    changed = ", ".join(f"case when {key} % 5 = 0 then {e} else {c} end as {c}" for c, e in earlier.items())
    order = f"partition by {key} order by bronze_ingestion_time nulls first"
    return f"""
        select * exclude (island, opens, back) from (
            select *, first_value(bronze_ingestion_time) over (partition by {key}, island
                          order by bronze_ingestion_time nulls first) as "__START_AT",
                   lead(bronze_ingestion_time) over ({order}) as "__END_AT",
                   row_number() over (partition by {key}, island
                          order by bronze_ingestion_time desc nulls last) as back
            from (select *, sum(cast(opens as int)) over ({order}) as island from (
                select *, row({tracked}) is distinct from lag(row({tracked})) over ({order}) as opens
                from (select * from (
                    select * replace ({changed}), {_FIRST} as bronze_ingestion_time, '{ENV}' as environment
                    from s_{name}
                    union all by name select *, {_FIRST} as bronze_ingestion_time, 'a tie' as environment
                    from s_{name} where {key} % 10 = 0
                    union all by name select *, {_SECOND} as bronze_ingestion_time, '{ENV}' as environment
                    from s_{name} where {key} % 5 = 0 or {key} % 7 = 0
                    union all by name select *, cast(null as timestamp) as bronze_ingestion_time,
                    '{ENV}' as environment from s_{name} where {key} % 11 = 0)
                    qualify row_number() over (partition by {key}, bronze_ingestion_time
                                               order by environment desc) = 1))))
        where back = 1"""


CHECKS |= {
    f"scd2_{name}": _versions_of(name, earlier)
    for name, earlier in {
        "stores": {"total_sqft": "total_sqft - 1000"},
        "customers": {"member_card": "'Starter'"},
        "products": {"product_cost": "product_cost * 2"},
    }.items()
}


def oracle() -> dict[str, str]:
    """Query name to complete SQL text."""
    texts = {}
    for name, sql in CHECKS.items():
        blocks = ", ".join(f"{b} as ({BLOCKS[b]})" for b in _needed(sql))
        texts[name] = f"with {blocks} {sql}" if blocks else sql
    return texts

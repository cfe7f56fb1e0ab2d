"""Source tables shaped like the pipeline's inputs, derived from the driver
tables (region, nation, customer, supplier, part, orders, lineitem, events).

Each recipe is portable SQL that runs unchanged in Spark and in DuckDB, so
the Spark plans and the SQL oracle see identical inputs. ``{name}`` marks a
table reference; Spark fills in per-directory temp views, the oracle fills
in the plain table / CTE name. ``_loaded_at`` marks the batch:
2024-01-01 is day 1 (first run), 2024-01-02 is day 2 (incremental run).

Spark reads all ``timestamp`` columns back as ``timestamp_ntz`` so that they
compare with the driver's own (zone-less) timestamps without casts on scans.
"""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# --- fixed values: batch stamps of the two-day scenario ---------------------
DAY1_TS = "2024-01-01 00:00:00"
DAY2_TS = "2024-01-02 00:00:00"
DAY1_DATE = "2024-01-01"
DAY2_DATE = "2024-01-02"

# --- fixed values: fixture recipes (portable SQL) ---------------------------
RECIPES: dict[str, str] = {
    # TPC-H source tables as the bronze models read them (source column names).
    "src_lineitem": """
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
 cast(l_quantity as decimal(12,2)) as l_quantity, cast(l_extendedprice as decimal(12,2)) as l_extendedprice,
 cast(l_discount as decimal(12,2)) as l_discount, cast(l_tax as decimal(12,2)) as l_tax,
 l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate,
 cast(l_shipdate as date) + cast(l_partkey % 31 - 15 as int) as l_commitdate, cast(l_shipdate as date) + cast(l_suppkey % 30 - 1 as int) as l_receiptdate,
 'NONE' as l_shipinstruct, case l_linenumber % 3 when 0 then 'AIR' when 1 then 'RAIL' else 'SHIP' end as l_shipmode,
 l_partkey % 2 = 0 as in_day1 from {lineitem}""",
    "src_orders": """
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(12,2)) as o_totalprice,
 cast(o_orderdate - interval '3' year as date) as o_orderdate, o_orderpriority, concat('Clerk#', cast(o_custkey % 1000 as varchar(20))) as o_clerk, 0 as o_shippriority,
 o_orderkey % 2 = 0 as in_day1 from {orders}""",
    "src_customer": """
select c_custkey, concat(' ', c_name, ' ') as c_name, concat('Addr ', cast(c_custkey as varchar(20))) as c_address, c_nationkey,
 concat(cast(10 + c_nationkey as varchar(5)), '-555-', cast(c_custkey as varchar(20))) as c_phone, cast(c_acctbal as decimal(12,2)) as c_acctbal,
 lower(c_mktsegment) as c_mktsegment, concat('comment ', cast(c_custkey as varchar(20))) as c_comment, true as in_day1 from {customer}""",
    "src_supplier": """
select s_suppkey, case when s_suppkey % 50 = 49 then '  ' else concat(' ', s_name) end as s_name, concat('Addr ', cast(s_suppkey as varchar(20))) as s_address, s_nationkey,
 concat(cast(10 + s_nationkey as varchar(5)), '-555-', cast(s_suppkey as varchar(20))) as s_phone, cast(s_acctbal as decimal(12,2)) as s_acctbal, true as in_day1 from {supplier}""",
    "src_part": """
select p_partkey, p_name, concat('Manufacturer#', cast(1 + p_partkey % 5 as varchar(5))) as p_mfgr, p_brand, p_type, p_size, 'JUMBO BOX' as p_container,
 cast(p_retailprice as decimal(12,2)) as p_retailprice, true as in_day1 from {part}""",
    "src_partsupp": """
select distinct l_partkey as ps_partkey, l_suppkey as ps_suppkey, cast((l_partkey * 31 + l_suppkey * 17) % 9999 - 50 as int) as ps_availqty,
 cast(cast((l_partkey * 7 + l_suppkey * 13) % 100000 as decimal(12,2)) / 100 as decimal(12,2)) as ps_supplycost, true as in_day1 from {lineitem}""",
    "src_nation": "select n_nationkey, n_name, n_regionkey, true as in_day1 from {nation}",
    "src_region": "select r_regionkey, r_name, true as in_day1 from {region}",
    # Bronze-shaped tables (what the silver models read).
    "fx_orders": """
select o_orderkey as order_key, o_custkey as customer_key, o_orderstatus as order_status, cast(o_totalprice as decimal(12,2)) as total_price,
 cast(o_orderdate - interval '3' year as date) as order_date, o_orderpriority as order_priority, concat('Clerk#', cast(o_custkey % 1000 as varchar(20))) as clerk, 0 as ship_priority,
 case when o_orderkey % 2 = 0 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end as _loaded_at from {orders}""",
    "fx_lineitem": """
select l_orderkey as order_key, l_partkey as part_key, l_suppkey as supplier_key, l_linenumber as line_number,
 cast(l_quantity as decimal(12,2)) as quantity, cast(l_extendedprice as decimal(12,2)) as extended_price, cast(l_discount as decimal(12,2)) as discount, cast(l_tax as decimal(12,2)) as tax,
 l_returnflag as return_flag, l_linestatus as line_status, cast(l_shipdate as date) as ship_date,
 cast(l_shipdate as date) + cast(l_partkey % 31 - 15 as int) as commit_date, cast(l_shipdate as date) + cast(l_suppkey % 30 - 1 as int) as receipt_date,
 'NONE' as ship_instructions, case l_linenumber % 3 when 0 then 'AIR' when 1 then 'RAIL' else 'SHIP' end as ship_mode,
 case when l_partkey % 2 = 0 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end as _loaded_at from {lineitem}""",
    "fx_partsupp": """
select distinct l_partkey as part_key, l_suppkey as supplier_key, cast((l_partkey * 31 + l_suppkey * 17) % 9999 - 50 as int) as available_qty,
 cast(cast((l_partkey * 7 + l_suppkey * 13) % 100000 as decimal(12,2)) / 100 as decimal(12,2)) as supply_cost, timestamp '2024-01-01 00:00:00' as _loaded_at from {lineitem}""",
    "fx_customer": """
select c_custkey as customer_key, concat(' ', c_name, ' ') as customer_name, concat('Addr ', cast(c_custkey as varchar(20))) as customer_address, c_nationkey as nation_key, concat(cast(10 + c_nationkey as varchar(5)), '-555-', cast(c_custkey as varchar(20))) as customer_phone,
 cast(c_acctbal as decimal(12,2)) as account_balance, lower(c_mktsegment) as market_segment, timestamp '2024-01-01 00:00:00' as _loaded_at from {customer}""",
    "fx_customer_v2": """
select customer_key, customer_name, case when customer_key % 7 = 0 then concat(customer_address, ' moved') else customer_address end as customer_address, nation_key,
 case when customer_key % 13 = 0 then null else customer_phone end as customer_phone, account_balance, market_segment, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_customer} where customer_key % 11 <> 0""",
    "fx_supplier": """
select s_suppkey as supplier_key, case when s_suppkey % 50 = 49 then '  ' else concat(' ', s_name) end as supplier_name, concat('Addr ', cast(s_suppkey as varchar(20))) as supplier_address, s_nationkey as nation_key, concat(cast(10 + s_nationkey as varchar(5)), '-555-', cast(s_suppkey as varchar(20))) as supplier_phone,
 cast(s_acctbal as decimal(12,2)) as account_balance, timestamp '2024-01-01 00:00:00' as _loaded_at from {supplier}""",
    "fx_part": """
select p_partkey as part_key, p_name as part_name, concat('Manufacturer#', cast(1 + p_partkey % 5 as varchar(5))) as manufacturer, p_brand as brand, p_type as part_type, p_size as part_size, 'JUMBO BOX' as container, cast(p_retailprice as decimal(12,2)) as retail_price, timestamp '2024-01-01 00:00:00' as _loaded_at from {part}""",
    "fx_nation": "select n_nationkey as nation_key, n_name as nation_name, n_regionkey as region_key, timestamp '2024-01-01 00:00:00' as _loaded_at from {nation}",
    "fx_region": "select r_regionkey as region_key, r_name as region_name, timestamp '2024-01-01 00:00:00' as _loaded_at from {region}",
    # Day-2 changes of bronze rows, with one broken row of each validity rule among them
    # (a broken row must not replace the row that is there).
    "fx_supplier_v2": """
select supplier_key, case when supplier_key % 35 = 0 then '   ' else supplier_name end as supplier_name, concat(supplier_address, ' moved') as supplier_address, nation_key,
 case when supplier_key % 10 = 0 then null else supplier_phone end as supplier_phone, account_balance, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_supplier} where supplier_key % 5 = 0
union all select cast(null as bigint) as supplier_key, supplier_name, supplier_address, nation_key, supplier_phone, account_balance, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_supplier} where supplier_key % 20 = 1""",
    "fx_part_v2": """
select case when part_key % 30 = 6 then null else part_key end as part_key, part_name, manufacturer, brand, part_type, part_size, container,
 cast(case when part_key % 30 = 12 then -1 else retail_price + 10 end as decimal(12,2)) as retail_price, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_part} where part_key % 6 = 0""",
    "fx_partsupp_v2": """
select part_key, supplier_key, cast(case when part_key % 27 = 9 then -5 else 7 end as int) as available_qty,
 cast(case when part_key % 27 = 18 then -1 else supply_cost + 1 end as decimal(12,2)) as supply_cost, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_partsupp} where part_key % 9 = 0""",
    "fx_orders_v2": """
select case when order_key % 50 = 5 then null else order_key end as order_key, case when order_key % 50 = 15 then null else customer_key end as customer_key,
 case when order_key % 100 = 45 then 'Z' else 'F' end as order_status, cast(case when order_key % 50 = 25 then -1 else total_price + 5 end as decimal(12,2)) as total_price,
 case when order_key % 100 = 35 then null when order_key % 100 = 85 then date '2099-01-01' else order_date end as order_date, order_priority, clerk, ship_priority,
 timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_orders} where order_key % 10 = 5""",
    "fx_lineitem_v2": """
select case when order_key % 100 = 8 then null else order_key end as order_key, part_key, supplier_key, case when order_key % 100 = 16 then null else line_number end as line_number,
 cast(case when order_key % 100 = 24 then 0 else quantity + 1 end as decimal(12,2)) as quantity, cast(case when order_key % 100 = 32 then -1 else extended_price + 100 end as decimal(12,2)) as extended_price,
 cast(case when order_key % 100 = 40 then 1.5 else discount end as decimal(12,2)) as discount, cast(case when order_key % 100 = 48 then -0.5 else tax end as decimal(12,2)) as tax,
 case when order_key % 100 = 56 then 'X' else return_flag end as return_flag, case when order_key % 100 = 64 then 'P' else line_status end as line_status,
 case when order_key % 100 = 72 then null else ship_date end as ship_date, commit_date, case when order_key % 100 = 80 then ship_date - 1 else ship_date + 3 end as receipt_date,
 ship_instructions, ship_mode, timestamp '2024-01-02 00:00:00' as _loaded_at from {fx_lineitem} where order_key % 8 = 0""",
    # Online-retail raw (text) tables.
    "fx_raw_orders": """
select cast(o_orderkey as varchar(20)) as order_id, cast(o_custkey as varchar(20)) as customer_id,
 case o_orderkey % 8 when 0 then ' shipped ' when 1 then 'canceled' when 2 then 'invoiced' else 'delivered ' end as order_status,
 cast(o_orderdate + interval '21' year as varchar(30)) as order_purchase_timestamp,
 case when o_orderkey % 10 = 0 then '' when o_orderkey % 97 = 0 then 'bad' else cast(cast(o_orderdate + interval '21' year as date) + cast(o_orderkey % 40 as int) as varchar(30)) end as order_delivered_customer_date,
 cast(cast(o_orderdate + interval '21' year as date) + 20 as varchar(30)) as order_estimated_delivery_date, timestamp '2024-01-01 00:00:00' as _loaded_at,
 case when o_orderkey % 5 = 0 then null else cast(o_orderdate + interval '21' year as varchar(30)) end as order_approved_at, cast(cast(o_orderdate + interval '21' year as date) + 2 as varchar(30)) as order_delivered_carrier_date, 'orders.csv' as _source_file, 'synthetic' as _source_system, date '2024-01-01' as _load_date, 'b1' as _batch_id from {orders}""",
    # Day-2 re-delivery of raw orders (status and delivery updates) used by the
    # order snapshot: every 9th order becomes 'delivered' with a new delivered
    # date, every 6th gets its approval stamp cleared; stamped day 2.
    "fx_raw_orders_v2": """
select order_id, customer_id,
 case when cast(order_id as bigint) % 9 = 0 then 'delivered' else order_status end as order_status, order_purchase_timestamp,
 case when cast(order_id as bigint) % 9 = 0 then order_estimated_delivery_date else order_delivered_customer_date end as order_delivered_customer_date,
 order_estimated_delivery_date, timestamp '2024-01-02 00:00:00' as _loaded_at,
 case when cast(order_id as bigint) % 6 = 0 then null else order_approved_at end as order_approved_at, order_delivered_carrier_date,
 'orders_v2.csv' as _source_file, _source_system, date '2024-01-02' as _load_date, 'b2' as _batch_id
 from {fx_raw_orders} where cast(order_id as bigint) % 9 = 0 or cast(order_id as bigint) % 6 = 0""",
    "fx_raw_customers": """
select cast(c_custkey as varchar(20)) as customer_id, md5(c_name) as customer_unique_id, concat('  ', c_mktsegment, ' city ') as customer_city,
 concat(' ', case c_nationkey when 0 then 'sp' when 1 then 'rj' when 2 then 'mg' when 3 then 'es' when 4 then 'pr' when 5 then 'sc' when 6 then 'rs' when 7 then 'mt' when 8 then 'ms'
  when 9 then 'go' when 10 then 'df' when 11 then 'ba' when 12 then 'ce' when 13 then 'ma' when 14 then 'pb' when 15 then 'pe' when 16 then 'pi' when 17 then 'rn' when 18 then 'se' when 19 then 'al'
  when 20 then 'am' when 21 then 'pa' when 22 then 'ro' when 23 then 'rr' when 24 then 'ac' else 'xx' end, ' ') as customer_state, timestamp '2024-01-01 00:00:00' as _loaded_at,
 cast((c_custkey * 37) % 100000 as varchar(10)) as customer_zip_code_prefix, 'customers.csv' as _source_file, 'synthetic' as _source_system, date '2024-01-01' as _load_date, 'b1' as _batch_id from {customer}""",
    "fx_raw_products": """
select cast(p_partkey as varchar(20)) as product_id, concat(' ', p_type, ' ') as product_category_name,
 case when p_partkey % 50 = 0 then null else cast(p_size * 150 as varchar(20)) end as product_weight_g, timestamp '2024-01-01 00:00:00' as _loaded_at,
 cast(p_partkey % 60 as varchar(10)) as product_name_lenght, cast(p_partkey % 900 as varchar(10)) as product_description_lenght, cast(p_partkey % 6 as varchar(10)) as product_photos_qty,
 cast(p_size as varchar(10)) as product_length_cm, cast(p_size + 1 as varchar(10)) as product_height_cm, cast(p_size + 2 as varchar(10)) as product_width_cm, 'products.csv' as _source_file, 'synthetic' as _source_system, date '2024-01-01' as _load_date, 'b1' as _batch_id from {part}""",
    "fx_raw_order_items": """
select cast(l_orderkey as varchar(20)) as order_id, cast(l_linenumber as varchar(20)) as order_item_id, cast(l_partkey as varchar(20)) as product_id, cast(l_suppkey as varchar(20)) as seller_id,
 case when l_partkey % 101 = 0 then 'n/a' else cast(cast(l_extendedprice as decimal(12,2)) as varchar(20)) end as price, cast(cast(l_quantity as decimal(12,2)) as varchar(20)) as freight_value,
 case when l_partkey % 2 = 0 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end as _loaded_at,
 cast(l_shipdate + interval '21' year as varchar(30)) as shipping_limit_date, 'order_items.csv' as _source_file, 'synthetic' as _source_system, date '2024-01-01' as _load_date, 'b1' as _batch_id from {lineitem}""",
    "fx_raw_payments": """
select cast(o_orderkey as varchar(20)) as order_id, cast(s.n as varchar(20)) as payment_sequential,
 case (o_orderkey + s.n) % 4 when 0 then ' credit_card' when 1 then 'boleto' when 2 then 'voucher ' else 'debit_card' end as payment_type,
 cast((o_orderkey + s.n) % 12 as varchar(20)) as payment_installments, cast(cast(o_totalprice as decimal(12,2)) as varchar(20)) as payment_value, timestamp '2024-01-01 00:00:00' as _loaded_at, 'payments.csv' as _source_file, 'synthetic' as _source_system, date '2024-01-01' as _load_date, 'b1' as _batch_id
 from {orders} join (values (1),(2),(3)) as s(n) on s.n <= o_orderkey % 4""",
    # Day-2 deliveries of the other raw tables: changed rows, NULL keys, names with punctuation.
    "fx_raw_customers_v2": """
select case when cast(customer_id as bigint) % 16 = 0 then null else customer_id end as customer_id, customer_unique_id,
 concat('  vila-nova d''OESTE (', trim(customer_city), ')/sul & norte_', customer_id, ' ') as customer_city, customer_state, timestamp '2024-01-02 00:00:00' as _loaded_at,
 customer_zip_code_prefix, 'customers_v2.csv' as _source_file, _source_system, date '2024-01-02' as _load_date, 'b2' as _batch_id from {fx_raw_customers} where cast(customer_id as bigint) % 4 = 0""",
    "fx_raw_products_v2": """
select case when cast(product_id as bigint) % 21 = 0 then null else product_id end as product_id, product_category_name,
 case cast(product_id as bigint) % 4 when 0 then '499.5' when 1 then '1999.4' when 2 then ' 2500 ' else 'heavy' end as product_weight_g, timestamp '2024-01-02 00:00:00' as _loaded_at,
 product_name_lenght, product_description_lenght, product_photos_qty, '12.5' as product_length_cm, product_height_cm, product_width_cm,
 'products_v2.csv' as _source_file, _source_system, date '2024-01-02' as _load_date, 'b2' as _batch_id from {fx_raw_products} where cast(product_id as bigint) % 7 = 0""",
    "fx_raw_order_items_v2": """
select case when cast(order_id as bigint) % 40 = 0 then null else order_id end as order_id, case when cast(order_id as bigint) % 40 = 20 then null else order_item_id end as order_item_id, product_id, seller_id,
 '19.99' as price, freight_value, timestamp '2024-01-02 00:00:00' as _loaded_at, shipping_limit_date, 'order_items_v2.csv' as _source_file, _source_system, date '2024-01-02' as _load_date, 'b2' as _batch_id
 from {fx_raw_order_items} where cast(order_id as bigint) % 20 = 0 and order_item_id = '1'""",
    "fx_raw_payments_v2": """
select case when cast(order_id as bigint) % 30 = 15 then null else order_id end as order_id, payment_sequential, 'CREDIT_CARD' as payment_type, '6' as payment_installments, '10.50' as payment_value,
 timestamp '2024-01-02 00:00:00' as _loaded_at, 'payments_v2.csv' as _source_file, _source_system, date '2024-01-02' as _load_date, 'b2' as _batch_id
 from {fx_raw_payments} where cast(order_id as bigint) % 15 = 0 and payment_sequential = '1'""",
    # Run-log inputs derived from the events table.
    "fx_run_results": """
select event_id as result_id, user_id as run_id, case user_id % 4 when 0 then 'bronze' when 1 then 'silver' when 2 then 'snapshot' else 'gold' end as layer,
 concat(case event_type when 'signup' then 'snapshot' when 'click' then 'test' else 'model' end, '.proj.', case user_id % 4 when 0 then 'stg_tpch__' when 1 then 'tpch_silver_' when 2 then 'snap_tpch_' else 'tpch_fact_' end, cast(event_id % 9 as varchar(5))) as unique_id,
 case event_type when 'error' then 'error' when 'signup' then 'skipped' when 'click' then 'pass' else 'success' end as status, value as execution_time, case when event_type = 'error' then concat('failed ', props) else null end as message,
 case when event_id % 5 = 0 then null else cast(event_id % 1000 as int) end as rows_affected, ts as started_at from {events}""",
    "fx_task_events": """
select event_id, concat('dag', cast(user_id % 3 as varchar(5))) as dag_id,
 concat(concat(case user_id % 4 when 0 then 'stg_tpch__' when 1 then 'tpch_silver_' when 2 then 'snap_tpch_' else 'tpch_fact_' end, 'm', cast(event_id % 9 as varchar(5))),
  case event_id % 4 when 0 then '.run' when 1 then '_run' when 2 then '_test' else '_snapshot' end) as task_id,
 case when event_type = 'error' then 'error' else 'success' end as status,
 case when event_id % 17 = 3 then null else ts end as start_date,
 case when event_id % 19 = 4 then null when event_id % 23 = 5 then ts - interval '45' second else ts + interval '30' second end as end_date from {events}""",
    "fx_query_history": """
select event_id as query_id, ts + interval '5' second as end_time,
 concat('MERGE INTO ', upper(concat(case user_id % 4 when 0 then 'stg_tpch__' when 1 then 'tpch_silver_' when 2 then 'snap_tpch_' else 'tpch_fact_' end, 'm', cast(event_id % 9 as varchar(5)))), ' USING x') as query_text,
 case when event_type = 'error' then 'FAIL' else 'SUCCESS' end as execution_status,
 case event_id % 5 when 0 then 'SELECT' when 1 then 'INSERT' when 2 then 'MERGE' when 3 then 'CREATE_TABLE_AS_SELECT' else 'UPDATE' end as query_type,
 case when event_id % 3 = 0 then null else event_id % 100 end as rows_inserted,
 case when event_id % 2 = 0 then null else event_id % 10 end as rows_updated from {events}""",
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    """Fixture names a recipe depends on (transitively, dependency order)."""
    out: list[str] = []
    for ref in _REF.findall(RECIPES[name]):
        if ref in RECIPES:
            for d in deps(ref) + [ref]:
                if d not in out:
                    out.append(d)
    return out


def sql_text(name: str) -> str:
    """Recipe text with plain table names (the oracle's view of it)."""
    return _REF.sub(lambda m: m.group(1), RECIPES[name]).strip()


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the given fixtures (and their dependencies)."""
    ordered: list[str] = []
    for n in names:
        for d in deps(n) + [n]:
            if d not in ordered:
                ordered.append(d)
    return "with " + ",\n".join(f"{n} as ({sql_text(n)})" for n in ordered) + "\n"


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:8]


def _view(sf_dir: str, name: str) -> str:
    return f"tf_{_tag(sf_dir)}_{name}"


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame (also registered as a per-directory view)."""
    view = _view(sf_dir, name)
    if not spark.catalog.tableExists(view):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(view)
    return spark.table(view)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame; timestamps come back as ``timestamp_ntz``."""
    view = _view(sf_dir, name)
    if spark.catalog.tableExists(view):
        return spark.table(view)
    mapping = {}
    for ref in set(_REF.findall(RECIPES[name])):
        if ref in RECIPES:
            fixture(spark, sf_dir, ref)
        else:
            driver_table(spark, sf_dir, ref)
        mapping[ref] = _view(sf_dir, ref)
    df = spark.sql(_REF.sub(lambda m: mapping[m.group(1)], RECIPES[name]))
    df = df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    df.createOrReplaceTempView(view)
    return spark.table(view)


def day_slice(df: DataFrame, day: int) -> DataFrame:
    """The table as it stood on ``day``: rows stamped on or before that day."""
    cut = DAY1_TS if day == 1 else DAY2_TS
    return df.filter(F.col("_loaded_at") <= F.lit(cut).cast("timestamp_ntz"))

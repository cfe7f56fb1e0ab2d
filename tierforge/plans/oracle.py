"""DuckDB SQL that replays the two-day run, used as the correctness oracle.

Each model is a set of named CTE blocks (``<model>_1`` after day 1,
``<model>_2`` after day 2) written independently of the Spark plans, from
the same rules: first run without a high-water filter, then rows newer
than the target's mark, validity filters, latest row per key, keyed merge
(``NOT EXISTS`` + ``UNION ALL``), SCD2 check snapshots, full-refresh marts.
``sql_for(block, select)`` assembles the needed fixtures and blocks into
one ``WITH`` query.
"""

from __future__ import annotations

from ..sources import fixtures as fx

# --- fixed values, spelled out here and not shared with the plans ---------------
BRONZE = {  # source column as bronze column; keys of the table
    "customer": ("c_custkey as customer_key, c_name as customer_name, c_address as customer_address, c_nationkey as nation_key, c_phone as "
         "customer_phone, c_acctbal as account_balance, c_mktsegment as market_segment, c_comment as customer_comment",
         [("customer_key", "c_custkey")]),
    "lineitem": ("l_orderkey as order_key, l_partkey as part_key, l_suppkey as supplier_key, l_linenumber as line_number, l_quantity as "
         "quantity, l_extendedprice as extended_price, l_discount as discount, l_tax as tax, l_returnflag as return_flag, "
         "l_linestatus as line_status, l_shipdate as ship_date, l_commitdate as commit_date, l_receiptdate as receipt_date, "
         "l_shipinstruct as ship_instructions, l_shipmode as ship_mode",
         [("order_key", "l_orderkey"), ("line_number", "l_linenumber")]),
    "nation": ("n_nationkey as nation_key, n_name as nation_name, n_regionkey as region_key",
         [("nation_key", "n_nationkey")]),
    "orders": ("o_orderkey as order_key, o_custkey as customer_key, o_orderstatus as order_status, o_totalprice as total_price, "
         "o_orderdate as order_date, o_orderpriority as order_priority, o_clerk as clerk, o_shippriority as ship_priority",
         [("order_key", "o_orderkey")]),
    "part": ("p_partkey as part_key, p_name as part_name, p_mfgr as manufacturer, p_brand as brand, p_type as part_type, p_size as "
         "part_size, p_container as container, p_retailprice as retail_price",
         [("part_key", "p_partkey")]),
    "partsupp": ("ps_partkey as part_key, ps_suppkey as supplier_key, ps_availqty as available_qty, ps_supplycost as supply_cost",
         [("part_key", "ps_partkey"), ("supplier_key", "ps_suppkey")]),
    "region": ("r_regionkey as region_key, r_name as region_name",
         [("region_key", "r_regionkey")]),
    "supplier": ("s_suppkey as supplier_key, s_name as supplier_name, s_address as supplier_address, s_nationkey as nation_key, s_phone as "
         "supplier_phone, s_acctbal as account_balance",
         [("supplier_key", "s_suppkey")]),
}
TIE = {  # after _loaded_at, the latest row has the largest of these
    "lineitem": ["extended_price", "part_key", "supplier_key"],
    "orders": ["total_price", "customer_key"],
    "customer": ["account_balance", "customer_name"],
    "part": ["retail_price", "part_name"],
    "partsupp": ["supply_cost", "available_qty"],
    "supplier": ["account_balance", "supplier_name"],
    "nation_region": ["region_key"],
    "raw_customers": ["customer_zip_code_prefix", "customer_unique_id"],
    "raw_order_items": ["price", "product_id", "seller_id"],
    "raw_orders": ["order_status", "customer_id"],
    "raw_payments": ["payment_value", "payment_type"],
    "raw_products": ["product_weight_g", "product_category_name"],
}
CUSTOMER_CHECK = ["customer_name", "customer_address", "nation_key", "customer_phone", "account_balance", "market_segment"]
SUPPLIER_CHECK = ["supplier_name", "supplier_address", "nation_key", "supplier_phone", "account_balance"]
FACT_LINEITEM_COLUMNS = [
    "order_key", "line_number", "part_key", "supplier_key", "customer_key", "ship_date", "commit_date", "receipt_date", "order_date",
    "quantity", "extended_price", "discount", "tax", "net_revenue", "gross_revenue", "return_flag", "line_status", "ship_mode",
    "days_late", "order_status", "order_priority", "_loaded_at"
]
ORDER_SNAPSHOT_CHECK = ["order_status", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
ORDER_SNAPSHOT_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date", "actual_delivery_days", "is_late_delivery",
    "total_payment_value", "total_order_value", "order_date", "order_year", "order_month_num", "_loaded_at"
]
META = "_source_file, _source_system, _loaded_at, _load_date, _batch_id"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
INITCAP_DELIMITERS = '!?@"^#$&~_,.:;+-*%/|\\[](){}<>'
ORDER_STATUS_LABEL = {"O": "Open", "F": "Fulfilled", "P": "Partially Filled"}
STATE_REGION = {
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast", "PR": "South", "SC": "South", "RS": "South",
    "MT": "Centre-West", "MS": "Centre-West", "GO": "Centre-West", "DF": "Centre-West", "BA": "Northeast", "CE": "Northeast",
    "MA": "Northeast", "PB": "Northeast", "PE": "Northeast", "PI": "Northeast", "RN": "Northeast", "SE": "Northeast", "AL":
    "Northeast", "AM": "North", "PA": "North", "RO": "North", "RR": "North", "AC": "North", "AP": "North", "TO": "North"
}
TS = {1: "timestamp '2024-01-01 00:00:00'", 2: "timestamp '2024-01-02 00:00:00'"}
RUN_DATE = {1: "date '2024-01-01'", 2: "date '2024-01-02'"}
FLOOR = "timestamp '1900-01-01 00:00:00'"

BLOCKS: dict[str, str] = {}


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql.strip()


def _refs(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", sql))
    return [w for w in list(BLOCKS) + list(fx.RECIPES) if w in words]


def sql_for(final_select: str) -> str:
    """``WITH`` query defining every block/fixture the select needs."""
    order: list[str] = []

    def visit(n: str, seen: tuple = ()):
        if n in order or n in seen:
            return
        body = BLOCKS[n] if n in BLOCKS else fx.sql_text(n)
        for d in _refs(body):
            if d != n:
                visit(d, seen + (n,))
        order.append(n)

    for d in _refs(final_select):
        visit(d)
    ctes = ",\n".join(f"{n} as ({BLOCKS[n] if n in BLOCKS else fx.sql_text(n)})" for n in order)
    return f"with {ctes}\n{final_select}"


# ------------------------------------------------------------- helpers ----

def dedup(src: str, keys: list[str], tie: list[str], order: str = "_loaded_at desc nulls first") -> str:
    ob = ", ".join([order] + [f"{c} desc nulls last" for c in tie])
    return (f"select * exclude (_rn) from (select *, row_number() over (partition by {', '.join(keys)} "
            f"order by {ob}) as _rn from {src}) where _rn = 1")


def merge(target: str, upd: str, keys: list[str]) -> str:
    cond = " and ".join(f"u.{k} = t.{k}" for k in keys)
    return f"select * from {target} t where not exists (select 1 from {upd} u where {cond}) union all by name select * from {upd}"


def newer(src: str, target: str, floor: bool) -> str:
    mx = f"coalesce(max(_loaded_at), {FLOOR})" if floor else "max(_loaded_at)"
    return f"select * from {src} where _loaded_at > (select {mx} from {target})"


def case_map(expr: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {expr} {whens} else '{default}' end"


def sk(key: str, ts: str) -> str:
    tok = f"'{SURROGATE_NULL}'"
    return (f"md5(concat_ws('-', coalesce(cast({key} as varchar), {tok}), "
            f"coalesce(strftime({ts}, '%Y-%m-%d %H:%M:%S.%g'), {tok})))")


def pct(numer: str, denom: str, scale: int = 1) -> str:
    n, d = f"cast(({numer}) * {scale} as hugeint)", f"cast(({denom}) * {scale} as hugeint)"
    return f"case when {d} = 0 then null else cast(({n} * 20000 + {d}) // ({d} * 2) as double) / 100.0 end"


def avg(x: str) -> str:
    return f"cast(sum({x}) as double) / cast(nullif(count({x}), 0) as double)"


def initcap(s: str) -> str:
    delims = INITCAP_DELIMITERS.replace("'", "''")
    return (f"(select case when v is null then null else array_to_string(list_transform(range(length(v)), lambda i: "
            f"case when i = 0 or contains('{delims}', substr(v, i, 1)) or regexp_matches(substr(v, i, 1), '^\\s$') "
            f"then upper(substr(v, i + 1, 1)) else substr(v, i + 1, 1) end), '') end from (select lower({s}) as v))")


def silver(prefix: str, inputs: dict[int, str], valid: str, project: str, keys: list[str], tie: list[str], floor: bool) -> None:
    """Blocks ``<prefix>_1`` and ``<prefix>_2`` for a validated, deduplicated, merged table."""
    block(f"{prefix}_u1", dedup(f"(select {project} from ({inputs[1]}) where {valid})", keys, tie))
    block(f"{prefix}_1", f"select * from {prefix}_u1")
    block(f"{prefix}_in2", newer(f"({inputs[2]})", f"{prefix}_1", floor))
    block(f"{prefix}_u2", dedup(f"(select {project} from {prefix}_in2 where {valid})", keys, tie))
    block(f"{prefix}_2", merge(f"{prefix}_1", f"{prefix}_u2", keys))


def scd2(prefix: str, src: str, key: str, check: list[str], hard_deletes: bool) -> None:
    """Blocks ``<prefix>_1`` (first load from ``<src>_1``) and ``<prefix>_2``."""
    null_ts = "cast(null as timestamp)"
    block(f"{prefix}_1", f"select *, {sk(key, TS[1])} as scd_id, {TS[1]} as updated_at, {TS[1]} as valid_from, "
                         f"{null_ts} as valid_to from {src}_1")
    differs = " or ".join(f"o.{c} is distinct from s.{c}" for c in check)
    close = f"(s.{key} is not null and ({differs}))" + (f" or s.{key} is null" if hard_deletes else "")
    block(f"{prefix}_open", f"select * from {prefix}_1 where valid_to is null")
    block(f"{prefix}_2", f"""
select * from {prefix}_1 where valid_to is not null
union all by name
select o.* replace (case when {close} then {TS[2]} else o.valid_to end as valid_to)
from {prefix}_open o left join {src}_2 s on o.{key} = s.{key}
union all by name
select s.*, {sk('s.' + key, TS[2])} as scd_id, {TS[2]} as updated_at, {TS[2]} as valid_from, {null_ts} as valid_to
from {src}_2 s left join {prefix}_open o on o.{key} = s.{key}
where o.{key} is null or ({differs})""")


def bronze_rows(t: str) -> dict[int, str]:
    """What the silver model of ``t`` reads: the bronze table, on day 2 with the changed rows."""
    return {1: f"select * from brz_{t}_1", 2: f"select * from brz_{t}_2 union all by name select * from fx_{t}_v2"}


def day_slice(fixture: str, day: int) -> str:
    return f"select * from {fixture} where _loaded_at <= {TS[day]}"


# ---------------------------------------------------------------- TPC-H ----

def _bronze_blocks() -> None:
    for t, (sel, keys) in BRONZE.items():
        block(f"brz_{t}_1", f"select {sel}, {TS[1]} as _loaded_at from src_{t} where in_day1")
        cond = " and ".join(f"b.{k} = s.{source}" for k, source in keys)
        block(f"brz_{t}_2", f"select * from brz_{t}_1 union all by name select {sel}, {TS[2]} as _loaded_at from src_{t} s "
                            f"where not exists (select 1 from brz_{t}_1 b where {cond})")


def _tpch_blocks() -> None:
    _bronze_blocks()
    T = TIE
    silver("scu", bronze_rows("customer"),
           "customer_key is not null and trim(customer_name) != '' and account_balance is not null",
           "customer_key, trim(customer_name) as customer_name, trim(customer_address) as customer_address, nation_key, "
           "customer_phone, account_balance, upper(trim(market_segment)) as market_segment, _loaded_at",
           ["customer_key"], T["customer"], True)
    silver("sli", bronze_rows("lineitem"),
           "order_key is not null and line_number is not null and quantity > 0 and extended_price >= 0 "
           "and discount between 0 and 1 and tax between 0 and 1 and return_flag in ('A','N','R') "
           "and line_status in ('O','F') and ship_date is not null and receipt_date >= ship_date",
           "order_key, part_key, supplier_key, line_number, quantity, extended_price, discount, tax, return_flag, line_status, "
           "ship_date, commit_date, receipt_date, ship_instructions, ship_mode, "
           "cast(round(extended_price * (1 - discount), 2) as decimal(18,2)) as net_revenue, "
           "cast(round(extended_price * (1 - discount) * (1 + tax), 2) as decimal(18,2)) as gross_revenue, "
           "cast(datediff('day', commit_date, receipt_date) as int) as days_late, _loaded_at",
           ["order_key", "line_number"], T["lineitem"], True)
    status = case_map("order_status", ORDER_STATUS_LABEL, "Unknown")
    for d in (1, 2):
        block(f"sor_src{d}", f"select * from ({bronze_rows('orders')[d]}) where order_date <= {RUN_DATE[d]}")
    silver("sor", {1: "select * from sor_src1", 2: "select * from sor_src2"},
           "order_key is not null and customer_key is not null and total_price >= 0 and order_date is not null",
           f"order_key, customer_key, {status} as order_status, total_price, order_date, order_priority, clerk, ship_priority, "
           "cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month, _loaded_at",
           ["order_key"], T["orders"], True)
    silver("spa", bronze_rows("part"), "part_key is not null and retail_price >= 0",
           "part_key, part_name, manufacturer, brand, part_type, part_size, container, retail_price, _loaded_at",
           ["part_key"], T["part"], True)
    silver("sps", bronze_rows("partsupp"), "available_qty >= 0 and supply_cost >= 0",
           "part_key, supplier_key, available_qty, supply_cost, _loaded_at", ["part_key", "supplier_key"], T["partsupp"], True)
    silver("ssu", bronze_rows("supplier"),
           "supplier_key is not null and trim(supplier_name) != ''",
           "supplier_key, trim(supplier_name) as supplier_name, trim(supplier_address) as supplier_address, nation_key, "
           "supplier_phone, account_balance, _loaded_at", ["supplier_key"], T["supplier"], True)
    for d in (1, 2):
        block(f"snr_{'1' if d == 1 else 'u2'}", dedup(
            f"(select n.nation_key, n.nation_name, r.region_key, r.region_name, n._loaded_at from brz_nation_{d} n "
            f"join brz_region_{d} r on n.region_key = r.region_key)", ["nation_key"], T["nation_region"]))
    block("snr_2", merge("snr_1", "snr_u2", ["nation_key"]))

    scd2("snc", "scu", "customer_key", CUSTOMER_CHECK, False)
    scd2("sns", "ssu", "supplier_key", SUPPLIER_CHECK, False)

    for d in (1, 2):
        block(f"dimc_{d}", f"select {sk('sc.customer_key', 'sc.valid_from')} as customer_sk, sc.customer_key, sc.customer_name, "
                           "sc.customer_address, sc.customer_phone, sc.account_balance, sc.market_segment, nr.nation_name, "
                           "nr.region_name, sc.valid_from as effective_from, sc.valid_to as effective_to, "
                           f"sc.valid_to is null as is_current from snc_{d} sc left join snr_{d} nr on sc.nation_key = nr.nation_key")
        block(f"dims_{d}", f"select {sk('ss.supplier_key', 'ss.valid_from')} as supplier_sk, ss.supplier_key, ss.supplier_name, "
                           "ss.supplier_address, ss.supplier_phone, ss.account_balance, nr.nation_name, nr.region_name, "
                           "ss.valid_from as effective_from, ss.valid_to as effective_to, ss.valid_to is null as is_current "
                           f"from sns_{d} ss left join snr_{d} nr on ss.nation_key = nr.nation_key")
        block(f"dimp_u{d}", f"select p.part_key, p.part_name, p.manufacturer, p.brand, p.part_type, p.part_size, p.container, "
                            f"p.retail_price, {avg('ps.supply_cost')} as avg_supply_cost, "
                            "cast(sum(ps.available_qty) as bigint) as total_available_qty "
                            f"from spa_{d} p left join sps_{d} ps on p.part_key = ps.part_key group by all")
    block("dimp_1", "select * from dimp_u1")
    block("dimp_2", merge("dimp_1", "dimp_u2", ["part_key"]))
    block("dimd", """select date_key, cast(year(date_key) as int) as year, cast(quarter(date_key) as int) as quarter,
 cast(month(date_key) as int) as month, strftime(date_key, '%b') as month_name, cast(day(date_key) as int) as day,
 strftime(date_key, '%a') as day_name, cast(weekofyear(date_key) as int) as week_of_year
 from (select cast(d as date) as date_key from generate_series(date '1992-01-01', date '1998-12-31' - 1, interval 1 day) g(d))""")

    cols = ", ".join(("o." if c in ("customer_key", "order_date", "order_status", "order_priority") else "li.") + c
                     for c in FACT_LINEITEM_COLUMNS)
    fact_keys = ["order_key", "line_number"]
    block("fli_1", dedup(f"(select {cols} from sli_1 li left join sor_1 o on li.order_key = o.order_key)", fact_keys, T["lineitem"]))
    block("fli_in2", newer("sli_2", "fli_1", True))
    block("fli_u2", dedup(f"(select {cols} from fli_in2 li left join sor_2 o on li.order_key = o.order_key)", fact_keys, T["lineitem"]))
    block("fli_2", merge("fli_1", "fli_u2", fact_keys))

    agg = ("select order_key, customer_key, order_date, order_status, order_priority, count(distinct line_number) as line_item_count, "
           "cast(sum(quantity) as decimal(38,2)) as total_quantity, cast(sum(net_revenue) as decimal(38,2)) as total_net_revenue, "
           f"cast(sum(gross_revenue) as decimal(38,2)) as total_gross_revenue, {avg('discount')} as avg_discount, "
           "max(receipt_date) as last_receipt_date from {src} group by all")
    block("fo_1", agg.format(src="fli_1"))
    block("fo_in2", "select * from fli_2 where order_date >= (select coalesce(cast(max(order_date) - 3 as date), date '1900-01-01') from fo_1)")
    block("fo_u2", agg.format(src="fo_in2"))
    block("fo_2", merge("fo_1", "fo_u2", ["order_key"]))

    block("mart_sales", """select d.year, d.quarter, c.region_name, c.nation_name, c.market_segment,
 count(distinct f.order_key) as order_count, cast(sum(f.quantity) as decimal(38,2)) as total_quantity,
 cast(sum(f.net_revenue) as decimal(38,2)) as net_revenue, cast(sum(f.gross_revenue) as decimal(38,2)) as gross_revenue,
 cast(sum(f.gross_revenue) - sum(f.net_revenue) as decimal(38,2)) as tax_collected
 from fli_2 f join dimc_2 c on f.customer_key = c.customer_key and c.is_current = true
 join dimd d on f.order_date = d.date_key group by all""")
    block("mart_supplier", f"""select s.supplier_key, s.supplier_name, s.nation_name, s.region_name, count(*) as lines_shipped,
 cast(sum(f.net_revenue) as decimal(38,2)) as net_revenue, {avg('f.days_late')} as avg_days_late,
 cast(sum(case when f.days_late > 0 then 1 else 0 end) as bigint) as late_shipment_count,
 {pct('sum(case when f.days_late > 0 then 1 else 0 end)', 'count(*)')} as late_shipment_pct
 from fli_2 f join dims_2 s on f.supplier_key = s.supplier_key and s.is_current = true group by all""")
    block("mart_segment", f"""select c.market_segment, c.region_name, c.nation_name, count(distinct o.order_key) as order_count,
 cast(sum(o.total_net_revenue) as decimal(38,2)) as net_revenue, {avg('o.total_net_revenue')} as avg_order_value,
 min(o.order_date) as first_order_date, max(o.order_date) as last_order_date
 from fo_2 o join dimc_2 c on o.customer_key = c.customer_key and c.is_current = true group by all""")


# --------------------------------------------------------------- retail ----


def _retail_blocks() -> None:
    T = {k[4:]: v for k, v in TIE.items() if k.startswith("raw_")}
    state = "upper(trim(customer_state))"
    _retail_stage("rcu", "fx_raw_customers", ["customer_id"], T["customers"], "customer_id is not null",
                  f"customer_id, customer_unique_id, customer_zip_code_prefix, {initcap('trim(customer_city)')} as customer_city, "
                  f"{state} as customer_state, {case_map(state, STATE_REGION, 'Unknown')} as customer_region, {META}",
                  ["customer_id"])
    price, freight = "try_cast(price as decimal(10,2))", "try_cast(freight_value as decimal(10,2))"
    _retail_stage("roi", "fx_raw_order_items", ["order_id", "order_item_id"], T["order_items"],
                  "order_id is not null and order_item_id is not null",
                  "order_id, try_cast(order_item_id as decimal(38,0)) as order_item_id, product_id, seller_id, "
                  f"try_cast(shipping_limit_date as timestamp) as shipping_limit_date, {price} as price, {freight} as freight_value, "
                  f"{price} + {freight} as total_item_value, {META}", ["order_id", "order_item_id"])
    ts = {c: f"try_cast({c} as timestamp)" for c in (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date")}
    _retail_stage("rod", "fx_raw_orders", ["order_id"], T["orders"], "order_id is not null",
                  "order_id, customer_id, upper(trim(order_status)) as order_status, "
                  + ", ".join(f"{v} as {k}" for k, v in ts.items()) + ", "
                  f"cast(datediff('day', {ts['order_purchase_timestamp']}, {ts['order_delivered_customer_date']}) as int) as actual_delivery_days, "
                  f"cast(datediff('day', {ts['order_purchase_timestamp']}, {ts['order_estimated_delivery_date']}) as int) as estimated_delivery_days, "
                  f"coalesce({ts['order_delivered_customer_date']} > {ts['order_estimated_delivery_date']}, false) as is_late_delivery, {META}",
                  ["order_id"])
    ptype, inst = "upper(trim(payment_type))", "try_cast(payment_installments as decimal(38,0))"
    _retail_stage("rpy", "fx_raw_payments", ["order_id", "payment_sequential"], T["payments"], "order_id is not null",
                  f"order_id, try_cast(payment_sequential as decimal(38,0)) as payment_sequential, {ptype} as payment_type, "
                  f"{inst} as payment_installments, try_cast(payment_value as decimal(10,2)) as payment_value, "
                  f"coalesce({ptype} = 'CREDIT_CARD', false) as is_credit_card, coalesce({inst} > 1, false) as is_installment, {META}",
                  ["order_id", "payment_sequential"])
    w = "try_cast(product_weight_g as decimal(38,0))"
    num = lambda c, a=None: f"try_cast({c} as decimal(38,0)) as {a or c}"
    _retail_stage("rpr", "fx_raw_products", ["product_id"], T["products"], "product_id is not null",
                  "product_id, lower(trim(product_category_name)) as product_category_name, "
                  f"{num('product_name_lenght', 'product_name_length')}, {num('product_description_lenght', 'product_description_length')}, "
                  f"{num('product_photos_qty')}, {num('product_weight_g')}, {num('product_length_cm')}, {num('product_height_cm')}, "
                  f"{num('product_width_cm')}, case when {w} < 500 then 'Light' when {w} < 2000 then 'Medium' "
                  f"when {w} < 5000 then 'Heavy' else 'Very Heavy' end as weight_class, {META}", ["product_id"])

    block("rdimc", "select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, customer_region, _loaded_at from rcu_2")
    block("rdimp", "select product_id, product_category_name, product_photos_qty, product_weight_g, product_length_cm, "
                   "product_height_cm, product_width_cm, weight_class, _loaded_at from rpr_2")
    block("rdimd", f"""select date_id, cast(year(date_id) as int) as year, cast(month(date_id) as int) as month_num,
 strftime(date_id, '%b') as month_name, cast(quarter(date_id) as int) as quarter, cast(weekofyear(date_id) as int) as week_num,
 cast(dayofweek(date_id) as int) as day_of_week, strftime(date_id, '%a') as day_name, dayofweek(date_id) in (0, 6) as is_weekend,
 cast(date_trunc('month', date_id) as date) as first_day_of_month, cast(date_trunc('quarter', date_id) as date) as first_day_of_quarter
 from (select cast(date '2016-01-01' + cast(i as int) as date) as date_id from range(1461) t(i))""")

    fct = """select o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
 o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date, o.actual_delivery_days,
 o.estimated_delivery_days, o.is_late_delivery, coalesce(i.item_count, 0) as item_count,
 cast(coalesce(i.total_items_price, 0) as decimal(38,2)) as total_items_price, cast(coalesce(i.total_freight_value, 0) as decimal(38,2)) as total_freight_value,
 cast(coalesce(i.total_order_value, 0) as decimal(38,2)) as total_order_value, coalesce(i.distinct_products, 0) as distinct_products,
 coalesce(i.distinct_sellers, 0) as distinct_sellers, cast(coalesce(p.total_payment_value, 0) as decimal(38,2)) as total_payment_value,
 cast(coalesce(p.max_installments, 0) as decimal(38,0)) as max_installments, coalesce(p.payment_type_count, 0) as payment_type_count,
 coalesce(p.has_credit_card, 0) as has_credit_card, cast(o.order_purchase_timestamp as date) as order_date,
 date_trunc('month', o.order_purchase_timestamp) as order_month, cast(year(o.order_purchase_timestamp) as int) as order_year,
 cast(month(o.order_purchase_timestamp) as int) as order_month_num, o._loaded_at
 from {orders} o
 left join (select order_id, count(*) as item_count, sum(price) as total_items_price, sum(freight_value) as total_freight_value,
   sum(total_item_value) as total_order_value, count(distinct product_id) as distinct_products, count(distinct seller_id) as distinct_sellers
   from roi_{d} group by order_id) i on o.order_id = i.order_id
 left join (select order_id, sum(payment_value) as total_payment_value, max(payment_installments) as max_installments,
   count(distinct payment_type) as payment_type_count, max(case when is_credit_card then 1 else 0 end) as has_credit_card
   from rpy_{d} group by order_id) p on o.order_id = p.order_id"""
    block("rfo_1", fct.format(orders="rod_1", d=1))
    block("rfo_in2", newer("rod_2", "rfo_1", False))
    block("rfo_u2", fct.format(orders="rfo_in2", d=2))
    block("rfo_2", merge("rfo_1", "rfo_u2", ["order_id"]))
    cols = ", ".join(ORDER_SNAPSHOT_COLUMNS)
    block("rfs_1", f"select {cols} from rfo_1")
    block("rfs_2", f"select {cols} from rfo_2")
    scd2("rscd", "rfs", "order_id", ORDER_SNAPSHOT_CHECK, True)

    block("rkpi", f"""select f.order_year, f.order_month_num, d.month_name, c.customer_state, c.customer_region, p.product_category_name,
 count(distinct f.order_id) as total_orders, count(distinct f.customer_id) as unique_customers,
 cast(sum(f.total_payment_value) as decimal(38,2)) as total_revenue, {avg('f.total_payment_value')} as avg_order_value,
 cast(sum(f.total_freight_value) as decimal(38,2)) as total_freight,
 {pct('sum(f.total_freight_value)', 'sum(f.total_payment_value)', 100)} as freight_pct_of_revenue,
 {avg('f.actual_delivery_days')} as avg_delivery_days,
 cast(sum(case when f.is_late_delivery then 1 else 0 end) as bigint) as late_deliveries,
 {pct('sum(case when f.is_late_delivery then 1 else 0 end)', 'count(*)')} as late_delivery_pct
 from rfo_2 f left join rdimc c on f.customer_id = c.customer_id left join roi_2 oi on f.order_id = oi.order_id
 left join rdimp p on oi.product_id = p.product_id left join rdimd d on f.order_date = d.date_id
 where f.order_status = 'DELIVERED' group by all""")


def _retail_stage(prefix, fixture, raw_keys, tie, keep, project, merge_keys) -> None:
    """Retail silver: strict high-water, dedup on raw keys, key check, parse, merge on parsed keys."""
    d1 = day_slice(fixture, 1)
    d2 = f"{day_slice(fixture, 2)} union all by name select * from {fixture}_v2"
    block(f"{prefix}_1", f"select {project} from ({dedup(f'({d1})', raw_keys, tie)}) where {keep}")
    block(f"{prefix}_in2", newer(f"({d2})", f"{prefix}_1", False))
    block(f"{prefix}_u2", f"select {project} from ({dedup(f'{prefix}_in2', raw_keys, tie)}) where {keep}")
    block(f"{prefix}_2", merge(f"{prefix}_1", f"{prefix}_u2", merge_keys))


_tpch_blocks()
_retail_blocks()

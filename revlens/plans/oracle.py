"""DuckDB oracle SQL for every registered query.

Written from the operator semantics (SURVEY section 2), not from the Spark
plans. The driver registers the base tables as views; fixture views are
prepended as CTEs. Means are ``sum / count`` in double and rounding is
``round_even(x * 100, 0) / 100`` on both sides.
"""

from __future__ import annotations

# Fixture views (FIXTURES.md section 3), DuckDB dialect.
VIEW_SQL: dict[str, str] = {
    "v_sales": """
select cast(l_shipdate as date) sale_date, r_name region, p_brand product,
       cast(l_extendedprice as decimal(12,2)) revenue
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey""",
    "v_sales_lines": """
select l_orderkey*10 + l_linenumber order_id,
       case when l_partkey % 50 = 0 then l_partkey + 100000000 else l_partkey end product_id,
       r_name region,
       case when (l_orderkey + l_linenumber) % 41 = 0 then 'n/a'
            when (l_orderkey + l_linenumber) % 37 = 0 then '0'
            when (l_orderkey + l_linenumber) % 43 = 0 then '-3'
            else cast(cast(l_quantity as int) as string) end quantity,
       case when (l_orderkey + l_partkey) % 53 = 0 then '-10'
            else cast(cast(floor(l_extendedprice / l_quantity) as int) as string) end unit_price
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_products": """
select p_partkey product_id, p_name product_name,
       case when p_partkey % 29 = 0 then null else p_type end category,
       cast(cast(floor(p_retailprice * 0.6) as int) as string) unit_cost
from part""",
    "v_customers": """
select c_custkey customer_id, case when c_custkey % 11 = 0 then null else c_mktsegment end segment
from customer""",
    "v_orders": """
select o_orderkey order_id,
       case when o_custkey % 83 = 0 then o_custkey + 100000000 else o_custkey end customer_id,
       case when o_orderkey % 89 = 0 then 'invalid_date' else cast(cast(o_orderdate as date) as string) end order_date,
       case when o_orderkey % 97 = 0 then 'abc' else cast(o_orderkey % 9 - 1 as string) end quantity,
       case when o_orderkey % 101 = 0 then '-50' else cast(cast(floor(o_totalprice / 100) as int) as string) end unit_price
from orders""",
    "v_order_batches": """
select v.*, concat(cast(cast(o_orderdate as date) as string), '-',
                   lpad(cast(o_orderkey % 3 as string), 4, '0')) ingestion_date, o_orderkey row_index
from v_orders v join orders on order_id = o_orderkey
union all
select order_id, customer_id, order_date, '7', unit_price, '2002-01-01-0000', order_id
from v_orders where order_id % 71 = 0
union all
select order_id, customer_id, order_date, '0', unit_price, '2002-01-02-0000', order_id
from v_orders where order_id % 142 = 0""",
    "v_orders_repeated": """
select * from v_orders
union all select * from v_orders where order_id % 61 = 0
union all select order_id, customer_id, order_date, '5', unit_price from v_orders where order_id % 67 = 0""",
    "v_orders_copies": """
select * from v_orders
union all select * from v_orders where order_id % 61 = 0""",
    "v_batch_files": """
select cast(v.order_id as string) order_id, cast(v.customer_id as string) customer_id, v.order_date, v.quantity,
       v.unit_price, concat(strftime(date_trunc('quarter', cast(o_orderdate as date)), '%Y-%m-%d'), '-',
                            lpad(cast(o_orderkey % 3 as string), 4, '0')) ingestion_date, o_orderkey row_key
from v_orders v join orders on order_id = o_orderkey
union all
select cast(order_id as string), cast(customer_id as string), order_date, case when k = 0 then '7' else '0' end,
       unit_price, case when k = 0 then '2002-01-01-0000' else '2002-01-02-0000' end, order_id
from v_orders join orders on order_id = o_orderkey, range(2) t(k)
where order_id % (71 * (k + 1)) = 0 and strftime(cast(o_orderdate as date), '%Y-%m') between '1995-01' and '1995-03'""",
    "v_file_customers": """
select cast(customer_id as string) customer_id, segment from v_customers""",
    "v_file_customer_updates": """
select cast(customer_id as string) customer_id,
       case when customer_id % 34 = 0 then null when customer_id = 17 then 'MACHINERY' else segment end segment
from v_customers where customer_id % 17 = 0""",
    "v_customer_updates": """
select c_custkey customer_id, case when c_custkey % 34 = 0 then null else 'MACHINERY' end segment
from customer where c_custkey % 17 = 0""",
}

VIEW_DEPS = {
    "v_batch_files": ["v_orders"],
    "v_file_customers": ["v_customers"],
    "v_file_customer_updates": ["v_customers"],
    "v_order_batches": ["v_orders"],
    "v_orders_repeated": ["v_orders"],
    "v_orders_copies": ["v_orders"],
}

ORDER_VIEW = ["v_sales", "v_sales_lines", "v_products", "v_customers", "v_orders", "v_order_batches",
              "v_orders_repeated", "v_orders_copies", "v_customer_updates", "v_batch_files", "v_file_customers",
              "v_file_customer_updates"]


def num(x: str) -> str:
    """Lenient numeric parse: NULL for text that is not a plain float."""
    v = f"try_cast(trim({x}) as double)"
    return (f"(case when regexp_matches({x}, '[dDfF]\\s*$') and not regexp_matches(lower({x}), 'inf\\s*$') "
            f"then null when isnan({v}) then null else {v} end)")


def strict_date(x: str) -> str:
    return (f"(case when regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"then cast(try_strptime({x}, '%Y-%m-%d') as date) end)")


def r2(x: str) -> str:
    return f"(round_even(cast({x} as double) * 100, 0) / 100)"


def build(views: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    """``WITH`` fixture views (with their dependencies) and named steps."""
    need: list[str] = []

    def add(v):
        for d in VIEW_DEPS.get(v, []):
            add(d)
        if v not in need:
            need.append(v)

    for v in views:
        add(v)
    need.sort(key=ORDER_VIEW.index)
    parts = [f"{v} as ({VIEW_SQL[v]}\n)" for v in need] + [f"{n} as ({s}\n)" for n, s in ctes]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + final


# ------------------------------------------------------------ shared steps

# Product join with defaults, cleaning, line metrics.
J3_STEPS = [
    ("enriched", """
select s.order_id, s.product_id, s.region, s.quantity, s.unit_price,
       coalesce(p.product_name, 'UNKNOWN') product_name, coalesce(p.category, 'UNKNOWN') category,
       coalesce(p.unit_cost, '0') unit_cost
from v_sales_lines s left join v_products p on s.product_id is not distinct from p.product_id"""),
    ("typed", f"""
select order_id, product_id, region, product_name, category,
       {num('quantity')} quantity, {num('unit_price')} unit_price, {num('unit_cost')} unit_cost
from enriched"""),
    ("lines", """
select *, quantity * unit_price revenue, quantity * unit_cost cost,
       quantity * unit_price - quantity * unit_cost profit
from typed
where quantity is not null and unit_price is not null and unit_cost is not null
  and quantity > 0 and unit_price >= 0"""),
]

# Sales lines with category, cleaned, revenue.
J4_STEPS = [
    ("typed4", f"""
select s.order_id, s.product_id, s.region, {num('s.quantity')} quantity, {num('s.unit_price')} unit_price, p.category
from v_sales_lines s left join v_products p on s.product_id = p.product_id"""),
    ("rev", """
select region, category, quantity * unit_price revenue from typed4
where quantity > 0 and unit_price >= 0"""),
    ("pv", """
select region,
       coalesce(sum(revenue) filter (where category = 'ECONOMY'), 0) "ECONOMY",
       coalesce(sum(revenue) filter (where category = 'PROMO'), 0) "PROMO",
       coalesce(sum(revenue) filter (where category = 'STANDARD'), 0) "STANDARD",
       coalesce(sum(revenue) filter (where category = 'ABSENT'), 0) "ABSENT"
from rev where region is not null and category is not null group by region"""),
]


def clean_orders_sql(src: str, extra: str = "") -> str:
    """J5/J6 cleaning of ``src`` (orders with segment), keeping ``extra`` columns."""
    return f"""
select order_id, customer_id, {strict_date('order_date')} order_date, {num('quantity')} quantity,
       {num('unit_price')} unit_price, coalesce(segment, 'UNKNOWN') segment{extra}
from {src}
where {num('quantity')} > 0 and {num('unit_price')} >= 0 and {strict_date('order_date')} is not null"""


def join_customers_sql(src: str, customers: str = "v_customers", extra: str = "") -> str:
    return f"""
select o.order_id, o.customer_id, o.order_date, o.quantity, o.unit_price, c.segment{extra}
from {src} o left join {customers} c on o.customer_id is not distinct from c.customer_id"""


# J5 flow: join, clean, strict dedup, metrics.
J5_STEPS = [
    ("j5_joined", join_customers_sql("v_orders")),
    ("j5_clean", clean_orders_sql("j5_joined")),
    ("enriched", """
select distinct order_id, customer_id, order_date, quantity, unit_price, segment,
       quantity * unit_price revenue, strftime(order_date, '%Y-%m') order_month
from j5_clean"""),
]

ROLLUP_STEP = ("rollup_rows", """
select order_month, case when grouping(segment) = 1 then 'ALL' else segment end segment,
       count(order_id) orders_count, count(distinct customer_id) customers_count,
       cast(sum(revenue) as double) total_revenue, grouping(segment) = 1 is_total
from {src} group by grouping sets ((order_month, segment), (order_month))""")

WINDOWS_SELECT = """
select order_month, segment, orders_count, customers_count, total_revenue,
       sum(total_revenue) over (partition by is_total, segment order by order_month
                                rows between unbounded preceding and current row) cumulative_revenue,
       avg(total_revenue) over (partition by is_total, segment order by order_month
                                rows between 2 preceding and current row) rolling_avg_revenue,
       is_total
from {src}"""


def rollup(src: str, name: str = "rollup_rows") -> tuple[str, str]:
    return name, ROLLUP_STEP[1].format(src=src)


# J6 flow pieces.
def batch_state_sql(name: str, customers: str, cond: str, batches: str = "v_order_batches") -> list[tuple[str, str]]:
    """Latest cleaned version per order of the batches matching ``cond``, with metrics."""
    return [
        (f"{name}_j", join_customers_sql(f"(select * from {batches} where {cond})", customers,
                                         ", o.ingestion_date, o.row_index")),
        (f"{name}_c", clean_orders_sql(f"{name}_j", ", ingestion_date, row_index")),
        (name, f"""
select order_id, customer_id, order_date, quantity, unit_price, segment, ingestion_date,
       quantity * unit_price revenue, strftime(order_date, '%Y-%m') order_month
from (select *, row_number() over (partition by order_id order by ingestion_date desc, row_index desc) rn
      from {name}_c) where rn = 1"""),
    ]


CUSTOMERS_NOW = ("customers_now", """
select customer_id, segment from (
  select *, row_number() over (partition by customer_id order by src desc) rn
  from (select customer_id, segment, 0 src from v_customers
        union all select customer_id, segment, 1 src from v_customer_updates))
where rn = 1""")

STATE_COLS = "order_id, customer_id, order_date, quantity, unit_price, segment, ingestion_date, revenue, order_month"

FILE_ROWS = "(select *, row_key row_index from v_batch_files)"

INCREMENTAL_STEPS = [
    ("customers_now", """
select customer_id, segment from (
  select *, row_number() over (partition by customer_id order by src desc) rn
  from (select customer_id, segment, 0 src from v_file_customers
        union all select customer_id, segment, 1 src from v_file_customer_updates))
where rn = 1"""),
    *batch_state_sql("prior", "v_file_customers", "ingestion_date < '2002-01-01'", FILE_ROWS),
    *batch_state_sql("newv", "customers_now", "ingestion_date >= '2002-01-01'", FILE_ROWS),
    ("refreshed", """
select s.order_id, s.customer_id, s.order_date, s.quantity, s.unit_price,
       coalesce(c.segment, s.segment) segment, s.ingestion_date, s.revenue, s.order_month,
       c.segment is not null and c.segment <> s.segment changed
from prior s left join customers_now c on s.customer_id is not distinct from c.customer_id"""),
    ("state", f"""
select {STATE_COLS} from (
  select *, row_number() over (partition by order_id order by ingestion_date desc, is_new desc) rn
  from (select {STATE_COLS}, 0 is_new from refreshed union all select {STATE_COLS}, 1 is_new from newv))
where rn = 1"""),
]
INCREMENTAL_VIEWS = ["v_batch_files", "v_file_customers", "v_file_customer_updates"]

# The same steps over all order batches and all customer changes.
WHOLE_STEPS = [
    CUSTOMERS_NOW,
    *batch_state_sql("prior", "v_customers", "ingestion_date < '2002-01-01'"),
    *batch_state_sql("newv", "customers_now", "ingestion_date >= '2002-01-01'"),
    *[step for step in INCREMENTAL_STEPS if step[0] in ("refreshed", "state")],
]


ORACLE_SQL: dict[str, str] = {
    "scan_sales": build(["v_sales"], [], """
select sale_date, region, product, cast(revenue as double) revenue from v_sales"""),
    "group_region_product": build(["v_sales"], [], f"""
select region, product, count(*) sales_count,
       {r2('coalesce(sum(revenue), 0)')} total_revenue,
       {r2('cast(sum(revenue) as double) / nullif(count(revenue), 0)')} average_revenue
from v_sales where region is not null and product is not null group by region, product"""),
    "filter_region_metrics": build(["v_sales"], [], """
select 'EUROPE' region, count(*) sales_count, cast(coalesce(sum(revenue), 0) as double) total_revenue,
       cast(sum(revenue) as double) / nullif(count(revenue), 0) average_revenue
from v_sales where region = 'EUROPE'"""),
    "filter_region_product_metrics": build(["v_sales"], [], """
select 'EUROPE' region, 'Brand#4' product, count(*) sales_count,
       cast(coalesce(sum(revenue), 0) as double) total_revenue,
       cast(sum(revenue) as double) / nullif(count(revenue), 0) average_revenue
from v_sales where region = 'EUROPE' and product = 'Brand#4'"""),
    "coerce_numeric": build(["v_sales_lines"], [], f"""
select order_id, {num('quantity')} quantity, {num('unit_price')} unit_price from v_sales_lines"""),
    "parse_order_date": build(["v_orders"], [], f"""
select order_id, {strict_date('order_date')} order_date from v_orders"""),
    "clean_sales_lines": build(["v_sales_lines"], [("t", f"""
select order_id, product_id, region, {num('quantity')} quantity, {num('unit_price')} unit_price
from v_sales_lines""")], """
select * from t where quantity is not null and unit_price is not null and quantity > 0 and unit_price >= 0"""),
    "dq_counters": build(["v_order_batches", "v_customers"], [
        ("j", join_customers_sql("v_order_batches")),
        ("p", f"""
select order_id, segment is null no_segment, {num('quantity')} q, {num('unit_price')} pr,
       {strict_date('order_date')} is not null date_ok from j"""),
        ("f", """
select *, q is not null and pr is not null numeric, q is not null and pr is not null and q > 0 and pr >= 0 valid
from p"""),
    ], """
select count(*) rows_in,
       count(*) filter (where no_segment) missing_segment,
       count(*) filter (where not numeric) non_numeric,
       count(*) filter (where numeric and q <= 0) non_positive_quantity,
       count(*) filter (where numeric and pr < 0) negative_price,
       count(*) filter (where valid and not date_ok) bad_date,
       count(*) filter (where valid and date_ok) - count(distinct order_id) filter (where valid and date_ok)
         - (case when count(*) filter (where valid and date_ok and order_id is null) > 0 then 1 else 0 end)
         duplicate_ids,
       count(distinct order_id) filter (where valid and date_ok)
         + (case when count(*) filter (where valid and date_ok and order_id is null) > 0 then 1 else 0 end) rows_out
from f"""),
    "enrich_sales_products": build(["v_sales_lines", "v_products"], [], """
select s.order_id, s.product_id, s.region, s.quantity, s.unit_price,
       coalesce(p.product_name, 'UNKNOWN') product_name, coalesce(p.category, 'UNKNOWN') category,
       coalesce(p.unit_cost, '0') unit_cost
from v_sales_lines s left join v_products p on s.product_id is not distinct from p.product_id"""),
    "line_profit": build(["v_sales_lines", "v_products"], J3_STEPS, "select * from lines"),
    "profit_by_region_category": build(["v_sales_lines", "v_products"], J3_STEPS + [("g", f"""
select region, category, count(order_id) orders_count, {r2('coalesce(sum(revenue), 0)')} total_revenue,
       {r2('coalesce(sum(cost), 0)')} total_cost, {r2('coalesce(sum(profit), 0)')} total_profit
from lines where region is not null and category is not null group by region, category""")], f"""
select *, coalesce({r2('total_profit / nullif(total_revenue, 0)')}, 0.0) profit_margin, false is_total from g"""),
    "profit_grand_total": build(["v_sales_lines", "v_products"], J3_STEPS + [("g", f"""
select 'ALL' region, 'ALL' category, count(*) orders_count, {r2('coalesce(sum(revenue), 0)')} total_revenue,
       {r2('coalesce(sum(cost), 0)')} total_cost, {r2('coalesce(sum(profit), 0)')} total_profit
from lines""")], f"""
select *, coalesce({r2('total_profit / nullif(total_revenue, 0)')}, 0.0) profit_margin, true is_total from g"""),
    "profit_report": build(["v_sales_lines", "v_products"], J3_STEPS + [("g", f"""
select region, category, count(order_id) orders_count, {r2('coalesce(sum(revenue), 0)')} total_revenue,
       {r2('coalesce(sum(cost), 0)')} total_cost, {r2('coalesce(sum(profit), 0)')} total_profit, false is_total
from lines where region is not null and category is not null group by region, category
union all
select 'ALL', 'ALL', count(*), {r2('coalesce(sum(revenue), 0)')}, {r2('coalesce(sum(cost), 0)')},
       {r2('coalesce(sum(profit), 0)')}, true
from lines""")], f"""
select region, category, orders_count, total_revenue, total_cost, total_profit,
       coalesce({r2('total_profit / nullif(total_revenue, 0)')}, 0.0) profit_margin, is_total
from g order by region, category"""),
    "pivot_region_category": build(["v_sales_lines", "v_products"], J4_STEPS, "select * from pv"),
    "pivot_with_totals": build(["v_sales_lines", "v_products"], J4_STEPS + [("pt", """
select *, "ECONOMY" + "PROMO" + "STANDARD" + "ABSENT" "TOTAL" from pv""")], """
select *, false is_total from pt
union all
select 'ALL', sum("ECONOMY"), sum("PROMO"), sum("STANDARD"), sum("ABSENT"), sum("TOTAL"), true from pt"""),
    "enrich_orders": build(["v_orders", "v_customers"], [], """
select o.order_id, o.customer_id, o.order_date, o.quantity, o.unit_price, coalesce(c.segment, 'UNKNOWN') segment
from v_orders o left join v_customers c on o.customer_id is not distinct from c.customer_id"""),
    "dimension_key_conflicts": build(["v_customers", "v_customer_updates"], [], """
select customer_id, count(*) key_count
from (select * from v_customers union all select * from v_customer_updates)
group by customer_id having count(*) > 1"""),
    "order_conflicts": build(["v_orders_repeated", "v_customers"], [
        ("j", join_customers_sql("v_orders_repeated")),
        ("c", clean_orders_sql("j")),
        ("g", """
select order_id, count(*) row_count,
       count(distinct customer_id) <> 1 d_customer_id, count(distinct order_date) <> 1 d_order_date,
       count(distinct quantity) <> 1 d_quantity, count(distinct unit_price) <> 1 d_unit_price,
       count(distinct segment) <> 1 d_segment
from c group by order_id"""),
    ], """
select order_id, row_count,
       concat_ws(',', case when d_customer_id then 'customer_id' end, case when d_order_date then 'order_date' end,
                 case when d_quantity then 'quantity' end, case when d_unit_price then 'unit_price' end,
                 case when d_segment then 'segment' end) conflict_columns
from g
where row_count > 1 and (d_customer_id or d_order_date or d_quantity or d_unit_price or d_segment)"""),
    "dedup_identical_orders": build(["v_orders_copies", "v_customers"], [
        ("j", join_customers_sql("v_orders_copies")),
        ("c", clean_orders_sql("j")),
    ], "select distinct * from c"),
    "monthly_segment_base": build(["v_orders", "v_customers"], J5_STEPS, """
select order_month, segment, count(order_id) orders_count, count(distinct customer_id) customers_count,
       cast(sum(revenue) as double) total_revenue
from enriched group by order_month, segment order by order_month, segment"""),
    "monthly_totals_additive": build(["v_orders", "v_customers"], J5_STEPS + [
        ("base", """
select order_month, segment, count(order_id) orders_count, count(distinct customer_id) customers_count,
       cast(sum(revenue) as double) total_revenue
from enriched group by order_month, segment"""),
        ("tot", """
select order_month, 'ALL' segment, sum(orders_count) orders_count, sum(customers_count) customers_count,
       sum(total_revenue) total_revenue
from base group by order_month"""),
    ], """
select order_month, segment, cast(orders_count as bigint) orders_count, cast(customers_count as bigint) customers_count,
       total_revenue,
       sum(total_revenue) over (order by order_month rows between unbounded preceding and current row) cumulative_revenue,
       avg(total_revenue) over (order by order_month rows between 2 preceding and current row) rolling_avg_revenue
from tot"""),
    "monthly_segment_report": build(["v_orders", "v_customers"], J5_STEPS + [rollup("enriched")],
                                    WINDOWS_SELECT.format(src="rollup_rows")
                                    + "\norder by order_month, is_total, segment"),
    "monthly_report_additive": build(["v_orders", "v_customers"], J5_STEPS + [
        ("base", """
select order_month, segment, count(order_id) orders_count, count(distinct customer_id) customers_count,
       cast(sum(revenue) as double) total_revenue, false is_total
from enriched group by order_month, segment"""),
        ("both_rows", """
select * from base
union all
select order_month, 'ALL', cast(sum(orders_count) as bigint), cast(sum(customers_count) as bigint),
       sum(total_revenue), true
from base group by order_month"""),
    ], WINDOWS_SELECT.format(src="both_rows")),
    "monthly_segment_dense": build(["v_orders", "v_customers"], J5_STEPS + [
        rollup("enriched"),
        ("ranges", """
select segment, is_total, min(order_month) first_m,
       (select max(order_month) from rollup_rows) last_m
from rollup_rows group by segment, is_total"""),
        ("spine", """
select segment, is_total, strftime(m, '%Y-%m') order_month
from (select segment, is_total,
             unnest(generate_series(cast(first_m || '-01' as date), cast(last_m || '-01' as date),
                                    interval 1 month)) m
      from ranges)"""),
        ("dense", """
select s.order_month, s.segment, coalesce(r.orders_count, 0) orders_count,
       coalesce(r.customers_count, 0) customers_count, coalesce(r.total_revenue, 0) total_revenue, s.is_total
from spine s left join rollup_rows r
  on s.segment = r.segment and s.order_month = r.order_month and s.is_total = r.is_total"""),
    ], WINDOWS_SELECT.format(src="dense")),
    "monthly_report_printable": build(["v_orders", "v_customers"], J5_STEPS + [
        rollup("enriched"), ("rep", WINDOWS_SELECT.format(src="rollup_rows"))], """
select * from rep
union all
select null, null, null, null, null, null, null, null from (select distinct order_month from rep)"""),
    "latest_order_version": build(["v_order_batches", "v_customers"], [
        ("j", join_customers_sql("v_order_batches", extra=", o.ingestion_date, o.row_index")),
        ("c", clean_orders_sql("j", ", ingestion_date, row_index")),
    ], """
select order_id, customer_id, order_date, quantity, unit_price, segment, ingestion_date, row_index
from (select *, row_number() over (partition by order_id order by ingestion_date desc, row_index desc) rn from c)
where rn = 1"""),
    "state_upsert": build(["v_order_batches", "v_customers"], [
        *batch_state_sql("prior", "v_customers", "ingestion_date < '2002-01-01'"),
        *batch_state_sql("newv", "v_customers", "ingestion_date >= '2002-01-01'"),
    ], f"""
select {STATE_COLS} from (
  select *, row_number() over (partition by order_id order by ingestion_date desc, is_new desc) rn
  from (select {STATE_COLS}, 0 is_new from prior union all select {STATE_COLS}, 1 is_new from newv))
where rn = 1"""),
    "customer_upsert": build(["v_customers", "v_customer_updates"], [CUSTOMERS_NOW],
                             "select * from customers_now"),
    "scd1_segment_refresh": build(["v_order_batches", "v_customers", "v_customer_updates"], [
        CUSTOMERS_NOW,
        *batch_state_sql("prior", "v_customers", "ingestion_date < '2002-01-01'"),
    ], """
select s.order_id, s.customer_id, s.order_date, s.quantity, s.unit_price,
       coalesce(c.segment, s.segment) segment, s.ingestion_date, s.revenue, s.order_month
from prior s left join customers_now c on s.customer_id is not distinct from c.customer_id"""),
    "ingest_batches": build(["v_batch_files"], [], """
select 'orders-' || ingestion_date || '.csv' file_name, ingestion_date,
       cast(substr(ingestion_date, 1, 10) as date) batch_day, cast(substr(ingestion_date, 12, 4) as int) batch_seq,
       order_id, customer_id, order_date, quantity, unit_price,
       row_number() over (partition by ingestion_date order by row_key) - 1 row_index
from v_batch_files"""),
    "raw_archive": build(["v_batch_files"], [("b", """
select 'orders-' || ingestion_date || '.csv' file_name from v_batch_files""")], """
select file_name, array_to_string(string_split(file_name, '-')[2:4], '/') archive_dir,
       array_to_string(string_split(file_name, '-')[2:4], '/') || '/' || file_name archive_path,
       true by_name, count(*) row_count
from b group by file_name"""),
    "affected_months": build(INCREMENTAL_VIEWS, INCREMENTAL_STEPS, """
select order_month from newv
union
select order_month from prior where order_id in (select order_id from newv)
union
select order_month from refreshed where changed"""),
    "incremental_report": build(["v_order_batches", "v_customers", "v_customer_updates"],
                                WHOLE_STEPS + [rollup("state")],
                                WINDOWS_SELECT.format(src="rollup_rows")),
}

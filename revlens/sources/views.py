"""Fixture views over the driver's test tables (see FIXTURES.md section 3).

The test tables carry no NULLs, orphans or bad values, so dirt is injected
by deterministic expressions of the keys. Every view reads whole tables; the
key expressions only decide *which* rows carry dirt, never which rows exist.
The same views are written as SQL for the DuckDB oracle in
``revlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.sources.tables import Tables

C = F.col


def _int_text(c) -> F.Column:
    return c.cast("int").cast("string")


def region_of_customer(t: Tables) -> DataFrame:
    """customer -> region name (customer x nation x region; the last two are tiny)."""
    nation_region = t.nation.join(t.region, C("n_regionkey") == C("r_regionkey")).select(
        "n_nationkey", C("r_name").alias("region")
    )
    return t.customer.join(nation_region, C("c_nationkey") == C("n_nationkey")).select(
        C("c_custkey"), "region"
    )


def region_of_order(t: Tables) -> DataFrame:
    """orders -> region of the ordering customer."""
    return t.orders.join(region_of_customer(t), C("o_custkey") == C("c_custkey")).select(
        C("o_orderkey"), "region"
    )


def v_sales(t: Tables) -> DataFrame:
    """J0-J2 sales: ``sale_date, region, product, revenue decimal(12,2)``."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    return (
        li.join(region_of_order(t), C("l_orderkey") == C("o_orderkey"))
        .join(t.part.select("p_partkey", "p_brand"), C("l_partkey") == C("p_partkey"))
        .select(
            C("l_shipdate").cast("date").alias("sale_date"),
            "region",
            C("p_brand").alias("product"),
            C("l_extendedprice").cast("decimal(12,2)").alias("revenue"),
        )
    )


def v_sales_lines(t: Tables) -> DataFrame:
    """J3/J4 sales lines with text quantity/price, bad values and orphan products."""
    li = t.lineitem
    k = C("l_orderkey") + C("l_linenumber")
    quantity = (
        F.when(k % 41 == 0, F.lit("n/a"))
        .when(k % 37 == 0, F.lit("0"))
        .when(k % 43 == 0, F.lit("-3"))
        .otherwise(_int_text(C("l_quantity")))
    )
    unit_price = F.when((C("l_orderkey") + C("l_partkey")) % 53 == 0, F.lit("-10")).otherwise(
        _int_text(F.floor(C("l_extendedprice") / C("l_quantity")))
    )
    product_id = F.when(C("l_partkey") % 50 == 0, C("l_partkey") + 100000000).otherwise(C("l_partkey"))
    return li.join(region_of_order(t), C("l_orderkey") == C("o_orderkey")).select(
        (C("l_orderkey") * 10 + C("l_linenumber")).alias("order_id"),
        product_id.alias("product_id"),
        "region",
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
    )


def v_products(t: Tables) -> DataFrame:
    """Product dimension; blank category on every 29th part, cost as text."""
    return t.part.select(
        C("p_partkey").alias("product_id"),
        C("p_name").alias("product_name"),
        F.when(C("p_partkey") % 29 == 0, F.lit(None).cast("string")).otherwise(C("p_type")).alias("category"),
        _int_text(F.floor(C("p_retailprice") * 0.6)).alias("unit_cost"),
    )


def v_customers(t: Tables) -> DataFrame:
    """Customer dimension; blank segment on every 11th customer."""
    return t.customer.select(
        C("c_custkey").alias("customer_id"),
        F.when(C("c_custkey") % 11 == 0, F.lit(None).cast("string")).otherwise(C("c_mktsegment")).alias("segment"),
    )


def _orders_text_columns() -> list[F.Column]:
    key = C("o_orderkey")
    return [
        key.alias("order_id"),
        F.when(C("o_custkey") % 83 == 0, C("o_custkey") + 100000000).otherwise(C("o_custkey")).alias("customer_id"),
        F.when(key % 89 == 0, F.lit("invalid_date"))
        .otherwise(C("o_orderdate").cast("date").cast("string"))
        .alias("order_date"),
        F.when(key % 97 == 0, F.lit("abc")).otherwise((key % 9 - 1).cast("string")).alias("quantity"),
        F.when(key % 101 == 0, F.lit("-50"))
        .otherwise(_int_text(F.floor(C("o_totalprice") / 100)))
        .alias("unit_price"),
    ]


ORDER_TEXT_COLUMNS = ["order_id", "customer_id", "order_date", "quantity", "unit_price"]


def v_orders(t: Tables) -> DataFrame:
    """J5 orders as text: bad dates, non-numeric and non-positive quantities,
    negative prices and orphan customers."""
    return t.orders.select(*_orders_text_columns())


def _with_copies(rows: DataFrame, copies: list[tuple[F.Column, dict]], names: list[str]) -> DataFrame:
    """Each row and, where a condition holds, a copy of it with other values:
    one scan, whatever the number of copies."""
    whole = F.struct(*[C(c) for c in names])
    others = [F.when(cond, F.struct(*[v.get(c, C(c)).alias(c) for c in names])) for cond, v in copies]
    # array_compact would take the whole expression out of code generation
    return rows.select(F.explode(F.array(whole, *others)).alias("_r")).where(C("_r").isNotNull()).select("_r.*")


def v_order_batches(t: Tables) -> DataFrame:
    """J6 order batches: every order in a batch named by its order date, plus
    two later correction batches (one valid, one invalid)."""
    batch = F.concat(
        C("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lpad((C("o_orderkey") % 3).cast("string"), 4, "0")
    )
    rows = t.orders.select(
        *_orders_text_columns(), batch.alias("ingestion_date"), C("o_orderkey").alias("row_index")
    )
    copies = [
        (C("order_id") % 71 == 0, {"quantity": F.lit("7"), "ingestion_date": F.lit("2002-01-01-0000")}),
        (C("order_id") % 142 == 0, {"quantity": F.lit("0"), "ingestion_date": F.lit("2002-01-02-0000")}),
    ]
    return _with_copies(rows, copies, rows.columns)


# Fixed values of the batch-file fixture: corrections come from this version
# on and concern orders of these months.
CORRECTIONS_FROM = "2002-01-01"
CORRECTED_MONTHS = ("1995-01", "1995-03")


def v_batch_files(t: Tables) -> DataFrame:
    """Order batches as they are written to files: text columns, one version
    per quarter and sequence number, plus two correction batches of a few months."""
    date = C("o_orderdate").cast("date")
    month = F.date_format(date, "yyyy-MM")
    quarter = F.date_format(F.trunc(date, "quarter"), "yyyy-MM-dd")
    version = F.concat(quarter, F.lit("-"), F.lpad((C("o_orderkey") % 3).cast("string"), 4, "0"))
    rows = t.orders.select(
        *[c.cast("string") for c in _orders_text_columns()],
        version.alias("ingestion_date"),
        C("o_orderkey").alias("row_key"),
        month.between(*CORRECTED_MONTHS).alias("_in"),
    )
    copies = [
        (C("_in") & (C("row_key") % 71 == 0), {"quantity": F.lit("7"), "ingestion_date": F.lit("2002-01-01-0000")}),
        (C("_in") & (C("row_key") % 142 == 0), {"quantity": F.lit("0"), "ingestion_date": F.lit("2002-01-02-0000")}),
    ]
    return _with_copies(rows, copies, [c for c in rows.columns if c != "_in"])


def v_all_batch_files(t: Tables) -> DataFrame:
    """All of :func:`v_order_batches` as they are written to files: one version
    per quarter and sequence number, in which later batches stand further down, and
    the correction batches."""
    batch = C("ingestion_date")
    quarter = F.date_format(F.trunc(F.substring(batch, 1, 10).cast("date"), "quarter"), "yyyy-MM-dd")
    regular = F.concat(quarter, F.substring(batch, 11, 5))
    return v_order_batches(t).select(
        *ORDER_TEXT_COLUMNS,
        F.when(batch >= CORRECTIONS_FROM, batch).otherwise(regular).alias("ingestion_date"),
        F.struct(batch, "row_index").alias("row_key"),
    )


def v_file_customers(t: Tables) -> DataFrame:
    return v_customers(t).withColumn("customer_id", C("customer_id").cast("string"))


def v_file_customer_updates(t: Tables) -> DataFrame:
    """Customer update file: every 17th customer, blank or as before, but for
    one whose segment changes."""
    c = v_customers(t).where(C("customer_id") % 17 == 0)
    segment = (
        F.when(C("customer_id") % 34 == 0, F.lit(None).cast("string"))
        .when(C("customer_id") == 17, F.lit("MACHINERY"))
        .otherwise(C("segment"))
    )
    return c.select(C("customer_id").cast("string").alias("customer_id"), segment.alias("segment"))


def v_orders_repeated(t: Tables) -> DataFrame:
    """J5 orders with exact repeats and repeats that differ in quantity."""
    rows = v_orders(t)
    return _with_copies(rows, [(C("order_id") % 61 == 0, {}), (C("order_id") % 67 == 0, {"quantity": F.lit("5")})],
                        rows.columns)


def v_orders_copies(t: Tables) -> DataFrame:
    """J5 orders with exact repeats only (the strict de-duplication passes)."""
    rows = v_orders(t)
    return _with_copies(rows, [(C("order_id") % 61 == 0, {})], rows.columns)


def v_customer_updates(t: Tables) -> DataFrame:
    """Customer update file: segment changes for every 17th customer, some blank."""
    c = t.customer.where(C("c_custkey") % 17 == 0)
    return c.select(
        C("c_custkey").alias("customer_id"),
        F.when(C("c_custkey") % 34 == 0, F.lit(None).cast("string")).otherwise(F.lit("MACHINERY")).alias("segment"),
    )

"""Registered queries: one per operator group of SURVEY section 2.

Each query takes ``(spark, sf_dir)``, reads whole driver tables through the
fixture views of ``revlens.sources.views`` and returns a lazy DataFrame.
Column names equal those of the matching SQL in ``revlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.scalar import coerce_numeric, parse_date_strict
from revlens.operators import aggregate as agg
from revlens.operators.clean import clean_orders, clean_sales_lines, dq_counters
from revlens.operators.enrich import (
    guarded_unique,
    join_customers,
    join_products,
    key_conflicts,
    left_join,
    refresh_segment,
)
from revlens.operators.pivot import pivot_sum, pivot_with_totals
from revlens.operators.report import (
    add_order_metrics,
    monthly_report_additive,
    monthly_report_dense,
    monthly_segment_report,
    printable_order,
    printable_report,
)
from revlens.operators.versions import (
    customer_upsert,
    dedup_strict,
    latest_order_version,
    order_conflicts,
    upsert,
)
from revlens.operators.windows import add_running_metrics
from revlens.sources import views as V
from revlens.plans import file_flow
from revlens.sources.files import archive_dir, batch_day, batch_seq, with_row_index
from revlens.sources.tables import Tables

C = F.col

# Fixed query parameters.
REGION = "EUROPE"
PRODUCT = "Brand#4"
PIVOT_DOMAIN = ("ECONOMY", "PROMO", "STANDARD", "ABSENT")
# Batches from this version on are the "new" files of an incremental run;
# earlier ones form the state that run starts from.
NEW_BATCHES_FROM = "2002-01-01"

STATE_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "quantity",
    "unit_price",
    "segment",
    "ingestion_date",
    "revenue",
    "order_month",
]


# ---------------------------------------------------------------- job flows


def sales_lines_profit(t: Tables) -> DataFrame:
    """Product enrichment (fill before coercion), cleaning, line metrics."""
    enriched = join_products(V.v_sales_lines(t), V.v_products(t))
    cleaned = clean_sales_lines(enriched, numeric=("quantity", "unit_price", "unit_cost"))
    return agg.line_metrics(cleaned)


def sales_lines_revenue(t: Tables) -> DataFrame:
    """Sales lines with their category, cleaned, with revenue."""
    lines = left_join(V.v_sales_lines(t), V.v_products(t).select("product_id", "category"), "product_id")
    return clean_sales_lines(lines).withColumn("revenue", C("quantity") * C("unit_price"))


FILE_ORDER = "_file_order"


def in_file_order(orders: DataFrame) -> DataFrame:
    """Adds the order of rows as scanned (A5), before anything moves them."""
    return orders.withColumn(FILE_ORDER, F.monotonically_increasing_id())


def orders_enriched(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Validated customer join, cleaning, strict de-duplication, metrics."""
    orders = V.v_orders(t) if orders is None else orders
    joined = join_customers(in_file_order(orders), V.v_customers(t))
    return add_order_metrics(dedup_strict(clean_orders(joined), FILE_ORDER))


def batch_versions(t: Tables, customers: DataFrame, new: bool | None = None) -> DataFrame:
    """Batches enriched and cleaned; latest version per order; metrics.

    ``new`` picks the batches of the incremental run (True), the ones
    before it (False) or all (None).
    """
    batches = V.v_order_batches(t)
    if new is not None:
        is_new = C("ingestion_date") >= F.lit(NEW_BATCHES_FROM)
        batches = batches.where(is_new if new else ~is_new)
    cleaned = clean_orders(join_customers(batches, customers))
    return add_order_metrics(latest_order_version(cleaned)).select(*STATE_COLUMNS)


# ---------------------------------------------------------------- queries


def q_scan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the sales fact as the J0-J2 jobs see it."""
    return V.v_sales(Tables(spark, sf_dir)).withColumn("revenue", C("revenue").cast("double"))


def q_group_region_product(spark, sf_dir):
    """E3 + C5: GROUP BY region, product."""
    return agg.group_metrics(V.v_sales(Tables(spark, sf_dir)), ("region", "product"))


def q_filter_region_metrics(spark, sf_dir):
    """B1 + E1 + E13: one region's count / sum / mean."""
    return agg.filter_metrics(V.v_sales(Tables(spark, sf_dir)), {"region": REGION})


def q_filter_region_product_metrics(spark, sf_dir):
    """B2 + E2: one region and product."""
    return agg.filter_metrics(V.v_sales(Tables(spark, sf_dir)), {"region": REGION, "product": PRODUCT})


def q_coerce_numeric(spark, sf_dir):
    """Lenient numeric parse of quantity and price text."""
    s = V.v_sales_lines(Tables(spark, sf_dir))
    return s.select("order_id", coerce_numeric(C("quantity")).alias("quantity"),
                    coerce_numeric(C("unit_price")).alias("unit_price"))


def q_parse_order_date(spark, sf_dir):
    """Strict ``yyyy-MM-dd`` parse."""
    o = V.v_orders(Tables(spark, sf_dir))
    return o.select("order_id", parse_date_strict(C("order_date")).alias("order_date"))


def q_clean_sales_lines(spark, sf_dir):
    """B3 + B4 + C1: J4 cleaning."""
    return clean_sales_lines(V.v_sales_lines(Tables(spark, sf_dir)))


def q_dq_counters(spark, sf_dir):
    """L1 + C10 + E11: cleaning counters of a J6 batch, in cascade."""
    t = Tables(spark, sf_dir)
    return dq_counters(join_customers(V.v_order_batches(t), V.v_customers(t)))


def q_enrich_sales_products(spark, sf_dir):
    """D1 + C4: left join to products with defaults."""
    t = Tables(spark, sf_dir)
    return join_products(V.v_sales_lines(t), V.v_products(t))


def q_line_profit(spark, sf_dir):
    """Revenue, cost, profit per cleaned line."""
    return sales_lines_profit(Tables(spark, sf_dir))


def q_profit_by_region_category(spark, sf_dir):
    """E4 + C5 + C6."""
    return agg.profit_by_group(sales_lines_profit(Tables(spark, sf_dir)))


def q_profit_grand_total(spark, sf_dir):
    """E5."""
    return agg.profit_total(sales_lines_profit(Tables(spark, sf_dir)))


def q_profit_report(spark, sf_dir):
    """E6 + J1 + I1: groups plus grand total, in report order."""
    return agg.profit_report(sales_lines_profit(Tables(spark, sf_dir))).orderBy(*agg.profit_report_order())


def q_pivot_region_category(spark, sf_dir):
    """F1 + F2: region x fixed category domain."""
    return pivot_sum(sales_lines_revenue(Tables(spark, sf_dir)), "region", "category", "revenue", PIVOT_DOMAIN)


def q_pivot_with_totals(spark, sf_dir):
    """F3 + F4 + C7 + E10 + B8 + I5."""
    table = pivot_with_totals(sales_lines_revenue(Tables(spark, sf_dir)), "region", "category", "revenue", PIVOT_DOMAIN)
    return table.orderBy("is_total", "region")


def q_enrich_orders(spark, sf_dir):
    """D2 + C3: validated customer join, segment filled."""
    t = Tables(spark, sf_dir)
    joined = join_customers(V.v_orders(t), V.v_customers(t))
    return joined.withColumn("segment", F.coalesce(C("segment"), F.lit("UNKNOWN")))


def q_dimension_key_conflicts(spark, sf_dir):
    """D2 guard as a report: customer keys that repeat once updates are stacked."""
    t = Tables(spark, sf_dir)
    return key_conflicts(V.v_customers(t).unionByName(V.v_customer_updates(t)), "customer_id")


def q_order_conflicts(spark, sf_dir):
    """Repeated order ids whose cleaned rows differ."""
    t = Tables(spark, sf_dir)
    return order_conflicts(clean_orders(join_customers(V.v_orders_repeated(t), V.v_customers(t))))


def q_dedup_identical_orders(spark, sf_dir):
    """H1 + B9: strict de-duplication of exact repeats."""
    t = Tables(spark, sf_dir)
    copies = join_customers(in_file_order(V.v_orders_copies(t)), V.v_customers(t))
    return dedup_strict(clean_orders(copies), FILE_ORDER)


def q_monthly_segment_base(spark, sf_dir):
    """E9 + I2."""
    return agg.month_segment_base(orders_enriched(Tables(spark, sf_dir))).orderBy("order_month", "segment")


def q_monthly_totals_additive(spark, sf_dir):
    """E8 + G3 + G4: month ALL rows summed over segments, with windows."""
    base = agg.month_segment_base(orders_enriched(Tables(spark, sf_dir)))
    totals = agg.monthly_totals_additive(base).withColumns({"segment": F.lit(agg.ALL), "is_total": F.lit(True)})
    return add_running_metrics(totals).drop("is_total")


def q_monthly_segment_report(spark, sf_dir):
    """E7 + G1-G4 + I4 (flagship): monthly report with true distinct customers."""
    return monthly_segment_report(orders_enriched(Tables(spark, sf_dir))).orderBy("order_month", "is_total", "segment")


def q_monthly_report_additive(spark, sf_dir):
    """E8 report form (J5): month customers summed over segments."""
    return monthly_report_additive(orders_enriched(Tables(spark, sf_dir)))


def q_monthly_segment_dense(spark, sf_dir):
    """Calendar months with zeros."""
    return monthly_report_dense(orders_enriched(Tables(spark, sf_dir)))


def q_monthly_report_printable(spark, sf_dir):
    """Report with one blank row per month, in print order."""
    printable = printable_report(monthly_segment_report(orders_enriched(Tables(spark, sf_dir))))
    return printable.orderBy(*printable_order()).drop("_month", "_rank")


def q_latest_order_version(spark, sf_dir):
    """H2 + I6: latest valid version per order over all batches."""
    t = Tables(spark, sf_dir)
    return latest_order_version(clean_orders(join_customers(V.v_order_batches(t), V.v_customers(t))))


def q_state_upsert(spark, sf_dir):
    """H3: state before the run, upserted with the run's new versions."""
    t = Tables(spark, sf_dir)
    customers = V.v_customers(t)
    return upsert(batch_versions(t, customers, new=False), batch_versions(t, customers, new=True))


def q_customer_upsert(spark, sf_dir):
    """H4: customer table after the update file."""
    t = Tables(spark, sf_dir)
    return customer_upsert(V.v_customers(t), V.v_customer_updates(t))


def q_scd1_segment_refresh(spark, sf_dir):
    """State rows take their customer's current segment."""
    t = Tables(spark, sf_dir)
    customers = V.v_customers(t)
    state = batch_versions(t, customers, new=False)
    return refresh_segment(state, customer_upsert(customers, V.v_customer_updates(t)))


def q_ingest_batches(spark, sf_dir):
    """A1 + A3-A6: rows of the batch files, with name parts and row number."""
    rows = with_row_index(file_flow.batch_rows(spark, sf_dir))
    version = C("ingestion_date")
    return rows.select(
        "file_name",
        "ingestion_date",
        batch_day(version).alias("batch_day"),
        batch_seq(version).alias("batch_seq"),
        "order_id",
        "customer_id",
        "order_date",
        "quantity",
        "unit_price",
        "row_index",
    )


def q_raw_archive(spark, sf_dir):
    """A9 + C9: the job's archive, its dated folder and row count per batch file."""
    rows = file_flow.archived_files(spark, sf_dir)
    dated = F.regexp_extract("path", r"/year=(\d+)/month=(\d+)/day=(\d+)/", 0)
    folder = F.array_join(F.regexp_extract_all(dated, F.lit(r"=(\d+)"), F.lit(1)), "/")
    per_file = rows.select("file_name", folder.alias("archive_dir")).groupBy("file_name", "archive_dir")
    return per_file.agg(F.count(F.lit(1)).alias("row_count")).select(
        "file_name",
        "archive_dir",
        F.concat_ws("/", "archive_dir", "file_name").alias("archive_path"),
        (archive_dir(C("file_name")) == C("archive_dir")).alias("by_name"),
        "row_count",
    )


def q_affected_months(spark, sf_dir):
    """K3 + HP-5: months the job's next batch must recompute."""
    months = [(m,) for m in file_flow.touched_months(spark, sf_dir)]
    return spark.createDataFrame(months, "order_month string")


def q_incremental_report(spark, sf_dir):
    """K1-K7: the job's report after a batch of corrections and a customer
    update over the state of the regular files; equals a full rebuild."""
    return file_flow.incremental_report(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_sales": q_scan_sales,
    "group_region_product": q_group_region_product,
    "filter_region_metrics": q_filter_region_metrics,
    "filter_region_product_metrics": q_filter_region_product_metrics,
    "coerce_numeric": q_coerce_numeric,
    "parse_order_date": q_parse_order_date,
    "clean_sales_lines": q_clean_sales_lines,
    "dq_counters": q_dq_counters,
    "enrich_sales_products": q_enrich_sales_products,
    "line_profit": q_line_profit,
    "profit_by_region_category": q_profit_by_region_category,
    "profit_grand_total": q_profit_grand_total,
    "profit_report": q_profit_report,
    "pivot_region_category": q_pivot_region_category,
    "pivot_with_totals": q_pivot_with_totals,
    "enrich_orders": q_enrich_orders,
    "dimension_key_conflicts": q_dimension_key_conflicts,
    "order_conflicts": q_order_conflicts,
    "dedup_identical_orders": q_dedup_identical_orders,
    "monthly_segment_base": q_monthly_segment_base,
    "monthly_totals_additive": q_monthly_totals_additive,
    "monthly_segment_report": q_monthly_segment_report,
    "monthly_report_additive": q_monthly_report_additive,
    "monthly_segment_dense": q_monthly_segment_dense,
    "monthly_report_printable": q_monthly_report_printable,
    "latest_order_version": q_latest_order_version,
    "state_upsert": q_state_upsert,
    "customer_upsert": q_customer_upsert,
    "scd1_segment_refresh": q_scd1_segment_refresh,
    "ingest_batches": q_ingest_batches,
    "raw_archive": q_raw_archive,
    "affected_months": q_affected_months,
    "incremental_report": q_incremental_report,
}

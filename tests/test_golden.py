"""The seven reference jobs on their golden rows (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import aggregate as agg
from revlens.operators.clean import clean_orders, clean_sales_lines
from revlens.operators.enrich import join_customers, join_products
from revlens.operators.pivot import pivot_with_totals
from revlens.operators.report import (
    REPORT_ORDER,
    add_order_metrics,
    monthly_report_additive,
    monthly_segment_report,
)
from revlens.operators.versions import dedup_strict, latest_order_version
from revlens.plans.queries import FILE_ORDER, in_file_order
from revlens.sources.csv import scan_csv
from revlens.sources.files import read_batches

from golden_data import (
    CUSTOMERS_INC,
    CUSTOMERS_MONTHLY,
    INCREMENTAL_REPORT_J6,
    MONTHLY_REPORT_J5,
    ORDER_BATCHES,
    ORDERS_MONTHLY,
    PRODUCTS,
    SALES_CATEGORY,
    SALES_EIGHT,
    SALES_PRODUCTS,
    SALES_SMALL,
)

REPORT_COLS = ["order_month", "segment", "orders_count", "customers_count", "total_revenue",
               "cumulative_revenue", "rolling_avg_revenue"]


def _sales(spark, write_csv_file, text, name="sales.csv"):
    df = scan_csv(spark, write_csv_file(name, text), required={"region", "product", "revenue"})
    return df.withColumn("revenue", F.col("revenue").cast("double"))


def test_j0_filter_region(spark, write_csv_file):
    out = agg.filter_metrics(_sales(spark, write_csv_file, SALES_SMALL), {"region": "EU"}).collect()
    assert [tuple(r) for r in out] == [("EU", 3, 3400.0, 3400 / 3)]


def test_j1_filter_region_product(spark, write_csv_file):
    out = agg.filter_metrics(_sales(spark, write_csv_file, SALES_SMALL), {"region": "EU", "product": "A"}).collect()
    assert [tuple(r) for r in out] == [("EU", "A", 2, 1900.0, 950.0)]


def test_j1_empty_filter_gives_one_row(spark, write_csv_file):
    out = agg.filter_metrics(_sales(spark, write_csv_file, SALES_SMALL), {"region": "MARS"}).collect()
    assert [tuple(r) for r in out] == [("MARS", 0, 0.0, None)]


def test_j2_group_region_product(spark, write_csv_file):
    out = agg.group_metrics(_sales(spark, write_csv_file, SALES_EIGHT)).orderBy("region", "product").collect()
    assert [tuple(r) for r in out] == [
        ("EU", "A", 3, 2300.0, 766.67),
        ("EU", "B", 2, 2300.0, 1150.0),
        ("US", "A", 2, 1500.0, 750.0),
        ("US", "B", 1, 1100.0, 1100.0),
    ]


def test_j3_profit_report(spark, write_csv_file):
    sales = scan_csv(spark, write_csv_file("sales.csv", SALES_PRODUCTS))
    products = scan_csv(spark, write_csv_file("products.csv", PRODUCTS))
    lines = agg.line_metrics(
        clean_sales_lines(join_products(sales, products), numeric=("quantity", "unit_price", "unit_cost"))
    )
    out = agg.profit_report(lines).orderBy(*agg.profit_report_order()).drop("is_total").collect()
    assert [tuple(r) for r in out] == [
        ("ALL", "ALL", 6, 855.0, 302.0, 553.0, 0.65),
        ("APAC", "Services", 1, 180.0, 72.0, 108.0, 0.6),
        ("EU", "Hardware", 2, 275.0, 110.0, 165.0, 0.6),
        ("US", "Hardware", 1, 60.0, 24.0, 36.0, 0.6),
        ("US", "Services", 1, 240.0, 96.0, 144.0, 0.6),
        ("US", "UNKNOWN", 1, 100.0, 0.0, 100.0, 1.0),
    ]


def test_j4_pivot_with_totals(spark, write_csv_file):
    sales = scan_csv(spark, write_csv_file("sales.csv", SALES_CATEGORY))
    rev = clean_sales_lines(sales).withColumn("revenue", F.col("quantity") * F.col("unit_price"))
    out = pivot_with_totals(rev).orderBy("is_total", "region").drop("is_total").collect()
    assert [tuple(r) for r in out] == [
        ("APAC", 120.0, 0.0, 260.0, 380.0),
        ("EU", 200.0, 180.0, 200.0, 580.0),
        ("US", 150.0, 220.0, 300.0, 670.0),
        ("ALL", 470.0, 400.0, 760.0, 1630.0),
    ]


def _j5_enriched(spark, write_csv_file):
    orders = scan_csv(spark, write_csv_file("orders.csv", ORDERS_MONTHLY))
    customers = scan_csv(spark, write_csv_file("customers.csv", CUSTOMERS_MONTHLY))
    return add_order_metrics(dedup_strict(clean_orders(join_customers(in_file_order(orders), customers)), FILE_ORDER))


@pytest.mark.parametrize("builder", [monthly_report_additive, monthly_segment_report])
def test_j5_monthly_report(spark, write_csv_file, builder):
    out = builder(_j5_enriched(spark, write_csv_file)).orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()
    assert [tuple(r) for r in out] == MONTHLY_REPORT_J5


def test_j6_one_run_batch_form(spark, write_csv_file, tmp_path):
    paths = [write_csv_file(f"drop/{n}", t) for n, t in sorted(ORDER_BATCHES.items())]
    batches = read_batches(spark, paths)
    customers = scan_csv(spark, write_csv_file("customers.csv", CUSTOMERS_INC))
    cleaned = clean_orders(join_customers(batches.drop("file_name"), customers))
    state = add_order_metrics(latest_order_version(cleaned, version=("ingestion_date", "line")))
    out = monthly_segment_report(state).orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()
    assert [tuple(r) for r in out] == INCREMENTAL_REPORT_J6


def test_j5_calendar_variant(spark, write_csv_file):
    from revlens.operators.report import monthly_report_dense

    out = monthly_report_dense(_j5_enriched(spark, write_csv_file)).orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()
    got = [tuple(r) for r in out]
    expected = [
        ("2024-01", "Enterprise", 1, 1, 200.0, 200.0, 200.0),
        ("2024-01", "SMB", 1, 1, 200.0, 200.0, 200.0),
        ("2024-01", "ALL", 2, 2, 400.0, 400.0, 400.0),
        ("2024-02", "Enterprise", 2, 2, 600.0, 800.0, 400.0),
        ("2024-02", "SMB", 0, 0, 0.0, 200.0, 100.0),
        ("2024-02", "UNKNOWN", 1, 1, 500.0, 500.0, 500.0),
        ("2024-02", "ALL", 3, 3, 1100.0, 1500.0, 750.0),
        ("2024-03", "Enterprise", 0, 0, 0.0, 800.0, 800.0 / 3),
        ("2024-03", "SMB", 0, 0, 0.0, 200.0, 200.0 / 3),
        ("2024-03", "UNKNOWN", 1, 1, 240.0, 740.0, 370.0),
        ("2024-03", "ALL", 1, 1, 240.0, 1740.0, 580.0),
    ]
    assert got == expected


def test_j5_printable_form(spark, write_csv_file):
    from revlens.operators.report import printable_order, printable_report

    report = monthly_report_additive(_j5_enriched(spark, write_csv_file))
    out = printable_report(report).orderBy(*printable_order()).select(*REPORT_COLS).collect()
    got = [tuple(r) for r in out]
    blank = (None,) * len(REPORT_COLS)
    expected = (MONTHLY_REPORT_J5[0:3] + [blank] + MONTHLY_REPORT_J5[3:6] + [blank]
                + MONTHLY_REPORT_J5[6:8] + [blank])
    assert got == expected

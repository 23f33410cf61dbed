"""Edge cases the reference names in prose (FIXTURES.md section 2)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.functions.scalar import coerce_numeric, normalize_missing, parse_date_strict, round_half_even, safe_ratio
from revlens.operators import aggregate as agg
from revlens.operators.clean import clean_orders, dq_counters
from revlens.operators.enrich import join_customers, join_products, refresh_segment
from revlens.operators.pivot import pivot_sum
from revlens.operators.report import REPORT_ORDER, add_order_metrics, monthly_segment_report
from revlens.operators.versions import customer_upsert, dedup_strict, latest_order_version, order_conflicts, upsert
from revlens.operators.aggregate import month_segment_base
from revlens.operators.report import month_segment_rollup
from revlens.operators.windows import dense_months
from revlens.plans.queries import FILE_ORDER, in_file_order
from revlens.sources.csv import MissingColumnsError, require_columns, scan_csv
from revlens.sources.files import archive_dir, batch_version, read_batches

C = F.col


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(C("x"))).collect()]


def test_number_text(spark):
    good = _col(spark, ["1e3", " 5 ", "+3"], coerce_numeric)
    assert good == [1000.0, 5.0, 3.0]
    bad = _col(spark, ["1_000", "0x10", "12abc", "1,5", "5d", "nan", ""], coerce_numeric)
    assert bad == [None] * 7
    assert _col(spark, ["inf"], coerce_numeric) == [float("inf")]


def test_date_text(spark):
    assert _col(spark, ["2024-01-05"], parse_date_strict) == [dt.date(2024, 1, 5)]
    bad = ["2024-1-5", "2024-02-30", "2024-01-05 10:00:00", "20240105", "2024/01/05", ""]
    assert _col(spark, bad, parse_date_strict) == [None] * len(bad)
    assert _col(spark, ["2024-1-5"], lambda c: parse_date_strict(c, lenient=True)) == [dt.date(2024, 1, 5)]


def test_rounding_half_even(spark):
    vals = [0.125, 2.675, 1.005, 0.575, -0.125]
    assert _col(spark, vals, round_half_even, "double") == [0.12, 2.68, 1.0, 0.57, -0.12]


def test_margin_guard(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-5.0, 0.0), (0.0, 3.0)], "p double, r double")
    assert [r[0] for r in df.select(safe_ratio("p", "r")).collect()] == [0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(safe_ratio("p", "r", inf_margin=True)).collect()] == [0.0, float("-inf"), 0.0]


def test_missing_markers(spark):
    vals = ["NA", "N/A", "null", "None", "nan", "", "x"]
    assert _col(spark, vals, normalize_missing) == [None] * 6 + ["x"]


def test_zero_price_kept_null_key_and_all_null_values(spark):
    df = spark.createDataFrame(
        [("EU", "A", None), ("EU", "A", None), (None, "A", 5.0)], "region string, product string, revenue double"
    )
    out = [tuple(r) for r in agg.group_metrics(df).collect()]
    assert out == [("EU", "A", 2, 0.0, None)]  # NULL key dropped; all-NULL sum 0, mean NULL


def test_grand_total_counts_null_region_and_empty_input(spark):
    df = spark.createDataFrame(
        [(1, None, "X", 10.0, 4.0, 6.0)], "order_id int, region string, category string, revenue double, cost double, profit double"
    )
    tot = agg.profit_total(df).collect()[0]
    assert tot["orders_count"] == 1 and tot["region"] == "ALL"
    assert agg.profit_by_group(df).count() == 0
    empty = agg.profit_total(df.where("false")).collect()
    assert [tuple(r) for r in empty] == [("ALL", "ALL", 0, 0.0, 0.0, 0.0, 0.0, True)]


def test_null_join_keys_match_and_conflict(spark):
    facts = spark.createDataFrame([(None, "o1")], "customer_id string, order_id string")
    dim = spark.createDataFrame([(None, "SMB")], "customer_id string, segment string")
    assert join_customers(facts, dim).collect()[0]["segment"] == "SMB"
    dim2 = dim.unionByName(spark.createDataFrame([(None, "X")], "customer_id string, segment string"))
    with pytest.raises(PySparkException, match="Key conflict"):
        join_customers(facts, dim2).collect()


def test_blank_attribute_of_known_product(spark):
    sales = spark.createDataFrame([("1", "p1", "EU", "1", "10"), ("2", "p2", "EU", "1", "10")],
                                  "order_id string, product_id string, region string, quantity string, unit_price string")
    products = spark.createDataFrame([("p1", "W", None, None), ("p2", "V", "Hardware", "x")],
                                     "product_id string, product_name string, category string, unit_cost string")
    rows = {r["order_id"]: r for r in join_products(sales, products).collect()}
    assert rows["1"]["category"] == "UNKNOWN" and rows["1"]["unit_cost"] == "0"
    assert coerce_numeric(F.lit(rows["2"]["unit_cost"])) is not None  # 'x' is later dropped by coercion


def test_category_outside_domain(spark):
    df = spark.createDataFrame([("ZZ", "Other", 5.0), ("EU", "Hardware", 2.0)], "region string, category string, revenue double")
    rows = {r["region"]: tuple(r)[1:] for r in pivot_sum(df).collect()}
    assert rows["ZZ"] == (0.0, 0.0, 0.0)
    assert rows["EU"] == (2.0, 0.0, 0.0)


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_date string, quantity string, unit_price string, segment string")


def test_same_id_same_and_other_data(spark):
    same = _orders(spark, [("o1", "c", "2024-01-01", "1", "5", "S"), ("o1", "c", "2024-01-01", "1", "5", "S")])
    assert dedup_strict(clean_orders(in_file_order(same)), FILE_ORDER).count() == 1
    other = _orders(spark, [("o1", "c", "2024-01-01", "1", "5", "S"), ("o1", "c", "2024-01-01", "2", "5", "S")])
    with pytest.raises(PySparkException, match="Rows of one id differ: o1"):
        dedup_strict(clean_orders(in_file_order(other)), FILE_ORDER).collect()


def test_first_row_of_an_id_survives_whole(spark):
    rows = spark.createDataFrame([("1", None, 5.0), ("1", "c", 5.0), (None, "x", 1.0), (None, "y", 2.0)],
                                 "order_id string, customer_id string, unit_price double").coalesce(1)
    got = sorted(map(str, (tuple(r) for r in dedup_strict(in_file_order(rows), FILE_ORDER).collect())))
    assert got == ["('1', None, 5.0)", "(None, 'x', 1.0)"]


def test_missing_keys_form_no_group_and_missing_revenue_is_zero(spark):
    rows = [("1", "c1", None, 5.0, "2024-01"), ("2", "c1", "A", None, "2024-01"), ("3", "c2", "A", None, "2024-01"),
            ("4", None, "B", 7.0, "2024-01"), ("5", "c3", "B", 1.0, None)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, segment string, revenue double, order_month string")
    got = {(r["order_month"], r["segment"], r["is_total"]): tuple(r)[2:5] for r in month_segment_rollup(df).collect()}
    assert got == {
        ("2024-01", "A", False): (2, 2, 0.0),
        ("2024-01", "B", False): (1, 0, 7.0),
        ("2024-01", "ALL", True): (4, 2, 12.0),
    }
    base = {(r["order_month"], r["segment"]): tuple(r)[2:5] for r in month_segment_base(df).collect()}
    assert base == {k[:2]: v for k, v in got.items() if not k[2]}


def test_calendar_fill_runs_no_job_and_fills_to_the_last_month(spark):
    rows = [("2023-11", "A", 1, 1, 3.0, False), ("2024-02", "A", 2, 1, 6.0, False), ("2023-12", "B", 1, 1, 9.0, False)]
    df = spark.createDataFrame(rows, "order_month string, segment string, orders_count long, customers_count long, "
                                     "total_revenue double, is_total boolean")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("dense", "dense")
    dense = dense_months(df, ("is_total", "segment"))
    assert tracker.getJobIdsForGroup("dense") == []
    spark.sparkContext.setJobGroup("other", "other")
    got = sorted((r["segment"], r["order_month"], r["orders_count"], r["total_revenue"]) for r in dense.collect())
    assert got == [("A", "2023-11", 1, 3.0), ("A", "2023-12", 0, 0.0), ("A", "2024-01", 0, 0.0), ("A", "2024-02", 2, 6.0),
                   ("B", "2023-12", 1, 9.0), ("B", "2024-01", 0, 0.0), ("B", "2024-02", 0, 0.0)]
    assert dense_months(df.where("false")).count() == 0


def test_conflict_with_missing_values(spark):
    both = spark.createDataFrame([("o1", None, 1.0), ("o1", None, 1.0)], "order_id string, customer_id string, q double")
    one = spark.createDataFrame([("o1", None, 1.0), ("o1", "c", 1.0)], "order_id string, customer_id string, q double")
    assert [r["conflict_columns"] for r in order_conflicts(both).collect()] == ["customer_id"]
    assert order_conflicts(one).count() == 0


def test_two_versions_in_one_file_and_late_invalid_correction(spark):
    rows = spark.createDataFrame(
        [("o1", "c", "2024-01-01", "1", "5", "S", "2024-01-01-0000", 0),
         ("o1", "c", "2024-01-01", "3", "5", "S", "2024-01-01-0000", 1),
         ("o1", "c", "2024-01-01", "0", "5", "S", "2024-02-01-0000", 0)],
        "order_id string, customer_id string, order_date string, quantity string, unit_price string, segment string, "
        "ingestion_date string, row_index int",
    )
    out = latest_order_version(clean_orders(rows)).collect()
    assert len(out) == 1 and out[0]["quantity"] == 3.0  # later line wins; invalid correction ignored


def test_upsert_new_wins_at_equal_version_and_replay(spark):
    state = spark.createDataFrame([("o1", "a", "v1")], "order_id string, val string, ingestion_date string")
    new = spark.createDataFrame([("o1", "b", "v1")], "order_id string, val string, ingestion_date string")
    once = upsert(state, new)
    assert once.collect()[0]["val"] == "b"
    twice = upsert(once, new)
    assert [tuple(r) for r in twice.collect()] == [tuple(r) for r in once.collect()]


def test_segment_cleared(spark):
    cur = spark.createDataFrame([("1", "Enterprise")], "customer_id string, segment string")
    upd = spark.createDataFrame([("1", None)], "customer_id string, segment string")
    customers = customer_upsert(cur, upd)
    assert customers.collect()[0]["segment"] is None
    state = spark.createDataFrame([("o1", "1", "Enterprise")], "order_id string, customer_id string, segment string")
    assert refresh_segment(state, customers).collect()[0]["segment"] == "Enterprise"
    assert refresh_segment(state, customers, clear_segment=True).collect()[0]["segment"] == "UNKNOWN"


def test_customer_in_two_segments_counts_once_in_all(spark):
    rows = spark.createDataFrame(
        [("o1", "c1", dt.date(2024, 1, 2), 1.0, 10.0, "Enterprise"), ("o2", "c1", dt.date(2024, 1, 9), 1.0, 10.0, "UNKNOWN")],
        "order_id string, customer_id string, order_date date, quantity double, unit_price double, segment string",
    )
    rep = {(r["segment"], r["is_total"]): r for r in monthly_segment_report(add_order_metrics(rows)).collect()}
    assert rep[("ALL", True)]["customers_count"] == 1
    assert rep[("Enterprise", False)]["customers_count"] == 1


def test_segment_named_all_stays_apart(spark):
    rows = spark.createDataFrame(
        [("o1", "c1", dt.date(2024, 1, 2), 1.0, 10.0, "ALL"), ("o2", "c2", dt.date(2024, 1, 9), 1.0, 5.0, "SMB")],
        "order_id string, customer_id string, order_date date, quantity double, unit_price double, segment string",
    )
    out = monthly_segment_report(add_order_metrics(rows)).orderBy(*REPORT_ORDER).collect()
    assert [(r["segment"], r["is_total"], r["total_revenue"]) for r in out] == [
        ("ALL", False, 10.0), ("SMB", False, 5.0), ("ALL", True, 15.0)
    ]


def test_columns_in_other_order_matched_by_name(spark, write_csv_file):
    a = write_csv_file("d/orders-2024-01-01-0000.csv", "order_id,quantity\n1,5\n")
    b = write_csv_file("d/orders-2024-01-02-0000.csv", "quantity,order_id\n7,2\n")
    rows = {r["order_id"]: r["quantity"] for r in read_batches(spark, [a, b]).collect()}
    assert rows == {"1": "5", "2": "7"}


def test_short_and_long_lines(spark, write_csv_file):
    short = scan_csv(spark, write_csv_file("s.csv", "a,b\n3\n"))
    assert [tuple(r) for r in short.collect()] == [("3", None)]
    long = scan_csv(spark, write_csv_file("l.csv", "a,b\n4,5,6\n"))
    with pytest.raises(PySparkException, match="too many fields"):
        long.collect()


def test_missing_and_empty_files(spark, write_csv_file, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(ValueError, match="empty"):
        scan_csv(spark, write_csv_file("e.csv", ""))
    assert scan_csv(spark, write_csv_file("h.csv", "a,b\n")).count() == 0
    with pytest.raises(MissingColumnsError):
        require_columns(scan_csv(spark, write_csv_file("h2.csv", "a,b\n")), {"a", "c"})


def test_file_name_parts(spark):
    df = spark.createDataFrame([("orders-2024-03-15-0000.csv",), ("orders-abcd-03-15-0000.csv",)], "f string")
    out = df.select(batch_version(C("f")), archive_dir(C("f"))).collect()
    assert tuple(out[0]) == ("2024-03-15-0000", "2024/03/15")
    assert out[1][0] is None


def test_dq_counters_cascade(spark):
    rows = _orders(spark, [
        ("o1", "c", "2024-01-01", "1", "5", None),       # missing segment, kept
        ("o2", "c", "2024-01-01", "abc", "5", "S"),      # non-numeric
        ("o3", "c", "2024-01-01", "0", "-1", "S"),       # quantity <= 0 and price < 0
        ("o4", "c", "bad", "1", "5", "S"),               # bad date
        ("o1", "c", "2024-01-02", "2", "5", "S"),        # repeated id
    ])
    out = dq_counters(rows).collect()[0].asDict()
    assert out == {"rows_in": 5, "missing_segment": 1, "non_numeric": 1, "non_positive_quantity": 1,
                   "negative_price": 1, "bad_date": 1, "duplicate_ids": 1, "rows_out": 1}


def test_observe_rows_without_extra_job(spark):
    from revlens.operators.clean import observe_rows

    df, obs = observe_rows(spark.range(7).withColumn("x", F.col("id") * 2), "step")
    assert df.where("x > 4").count() == 4
    assert obs.get["rows"] == 7


def test_csv_sink_single_ordered_file(spark, tmp_path):
    from revlens.sources.csv import write_csv

    out = str(tmp_path / "out")
    write_csv(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"), out, order_by=["k"], single_file=True)
    files = [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".csv")]
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["k,v", "1,a", "2,b"]


def test_profit_report_single_pass_edges(spark):
    schema = "order_id int, region string, category string, revenue double, cost double, profit double"
    df = spark.createDataFrame([(1, None, "X", 10.0, 4.0, 6.0), (None, "EU", "X", 5.0, 1.0, 4.0)], schema)
    rows = {(r["region"], r["is_total"]): tuple(r) for r in agg.profit_report(df).collect()}
    assert rows[("EU", False)][2] == 0  # count of non-missing ids
    assert rows[("ALL", True)][2:6] == (2, 15.0, 5.0, 10.0)  # total counts rows, null key included
    assert len(rows) == 2
    empty = [tuple(r) for r in agg.profit_report(df.where("false")).collect()]
    assert empty == [("ALL", "ALL", 0, 0.0, 0.0, 0.0, 0.0, True)]


def test_repeated_key_count_counts_null_keys_once(spark):
    from revlens.operators.versions import repeated_key_count

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "order_id string")
    assert repeated_key_count(df).collect()[0][0] == 2  # one repeat of 'a', one of NULL
    assert repeated_key_count(df.where("false")).collect()[0][0] == 0


def test_customer_upsert_last_line_of_update_file_wins(spark):
    cur = spark.createDataFrame([("1", "SMB"), ("2", "SMB")], "customer_id string, segment string")
    upd = spark.createDataFrame([("1", "Enterprise", 0), ("1", "Retail", 1)], "customer_id string, segment string, line long")
    out = {r["customer_id"]: r["segment"] for r in customer_upsert(cur, upd, ordinal="line").collect()}
    assert out == {"1": "Retail", "2": "SMB"}


def test_pivot_other_column_and_totals_last(spark):
    df = spark.createDataFrame([("EU", "Hardware", 2.0), ("EU", "Other", 5.0)], "region string, category string, revenue double")
    row = pivot_sum(df, other="OTHER").collect()[0].asDict()
    assert row == {"region": "EU", "Hardware": 2.0, "Services": 0.0, "Software": 0.0, "OTHER": 5.0}
    lines = spark.createDataFrame([(1, "AAA", "X", 1.0, 0.0, 1.0)],
                                  "order_id int, region string, category string, revenue double, cost double, profit double")
    ordered = agg.profit_report(lines).orderBy(*agg.profit_report_order(totals_last=True)).collect()
    assert [r["is_total"] for r in ordered] == [False, True]

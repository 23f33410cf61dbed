"""The streaming incremental job on files derived from the driver tables (sf0.001).

Run 1 loads every regular batch file; run 2 brings the customer update file
and the two correction batches, so it recomputes only touched months. The
report must equal the one of the same state built operator by operator.
"""

import csv
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.enrich import refresh_segment
from revlens.operators.report import REPORT_ORDER, monthly_segment_report
from revlens.operators.versions import customer_upsert, upsert
from revlens.plans.queries import NEW_BATCHES_FROM, batch_versions
from revlens.sources import views as V
from revlens.sources.snapshots import SnapshotTable
from revlens.sources.tables import Tables
from revlens.streaming.incremental import IncrementalReport, Layout

SF = "/root/testdata/sf0.001"
COLS = ["order_id", "customer_id", "order_date", "quantity", "unit_price"]
REPORT_COLS = ["order_month", "segment", "orders_count", "customers_count", "total_revenue",
               "cumulative_revenue", "rolling_avg_revenue", "is_total"]


def _write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def test_streaming_equals_batch_form(spark, tmp_path):
    t = Tables(spark, SF)
    batches = V.v_order_batches(t).select(*COLS, "ingestion_date", "row_index").collect()
    layout = Layout(str(tmp_path / "job"))
    os.makedirs(layout.drop)
    _write_csv(layout.customers_csv, ["customer_id", "segment"],
               [tuple(r) for r in V.v_customers(t).collect()])

    by_file: dict[str, list] = {}
    for r in sorted(batches, key=lambda r: (r["ingestion_date"], r["row_index"])):
        by_file.setdefault(r["ingestion_date"], []).append(tuple(r[c] for c in COLS))
    old = {v: rows for v, rows in by_file.items() if v < NEW_BATCHES_FROM}
    new = {v: rows for v, rows in by_file.items() if v >= NEW_BATCHES_FROM}

    for version, rows in old.items():
        _write_csv(os.path.join(layout.drop, f"orders-{version}.csv"), COLS, rows)
    job = IncrementalReport(spark, layout, publish_csv=False)
    assert job.run()

    _write_csv(layout.customer_updates, ["customer_id", "segment"],
               [tuple(r) for r in V.v_customer_updates(t).collect()])
    for version, rows in new.items():
        _write_csv(os.path.join(layout.drop, f"orders-{version}.csv"), COLS, rows)
    assert job.run()

    got = [tuple(r) for r in job.current_report().orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()]
    customers = V.v_customers(t)
    customers_now = customer_upsert(customers, V.v_customer_updates(t))
    refreshed = refresh_segment(batch_versions(t, customers, new=False), customers_now)
    state = upsert(refreshed, batch_versions(t, customers_now, new=True))
    want = [tuple(r) for r in monthly_segment_report(state).orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()]
    assert len(got) == len(want) > 0
    assert got == want


def test_file_flow_equals_the_full_rebuild_and_touches_few_months(spark):
    from revlens.plans import file_flow

    report = file_flow.incremental_report(spark, SF)
    rebuilt = file_flow.full_rebuild(spark, SF).select(*report.columns)
    rows = sorted(map(tuple, report.collect()))
    assert rows == sorted(map(tuple, rebuilt.collect()))
    months = {r[0] for r in rows}
    assert 0 < len(file_flow.touched_months(spark, SF)) < len(months) / 2
    # only touched months have a folder in the second version of the state
    job = file_flow.started_job(spark, SF).job
    written = {p.partition("snapshot_part=")[2] for p in job.state.paths(before=2) if "/v=1/" in p}
    assert written and written <= set(file_flow.touched_months(spark, SF))


def test_report_takes_corrections_and_customer_changes_of_all_months(spark):
    from revlens.plans import file_flow

    report = file_flow.incremental_report(spark, SF).collect()
    assert set(file_flow.touched_months(spark, SF, whole=True)) > set(file_flow.touched_months(spark, SF))
    t = Tables(spark, SF)
    customers_now = customer_upsert(V.v_customers(t), V.v_customer_updates(t))
    refreshed = refresh_segment(batch_versions(t, V.v_customers(t), new=False), customers_now)
    state = upsert(refreshed, batch_versions(t, customers_now, new=True))
    want = monthly_segment_report(state).select(*report[0].asDict()).collect()
    assert sorted(map(tuple, report)) == sorted(map(tuple, want))


def test_copies_of_rows_stay_in_generated_code(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    out = V._with_copies(rows, [(F.col("k") % 2 == 0, {"v": F.lit("x")}), (F.col("k") > 0, {})], ["k", "v"])
    got = sorted(map(str, map(tuple, out.collect())))
    assert got == sorted(map(str, [(1, "a"), (1, "a"), (2, "b"), (2, "x"), (2, "b"), (None, "c")]))
    # a lambda would have every expression of the row interpreted
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_file_name_and_version_take_few_expressions(spark):
    from pyspark.sql import functions as F

    from revlens.sources.files import batch_version, file_name

    paths = ["file:/a%20b/orders-2024-03-10-0007.csv", "/x/a%2Bb+c%20d.csv", "orders-2024-03-10-00071.csv", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(file_name(F.col("p")).alias("n"))
    out = df.select("n", batch_version(F.col("n")).alias("v"))
    assert [tuple(r) for r in out.collect()] == [
        ("orders-2024-03-10-0007.csv", "2024-03-10-0007"),
        ("a+b+c d.csv", None),
        ("orders-2024-03-10-00071.csv", None),
        (None, None),
    ]
    assert "regexp_extract" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_part_is_written_by_few_tasks(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, part_col="k")
    rows = spark.range(0, 4000, 1, 8).select((F.col("id") % 5).cast("string").alias("k"), F.col("id").alias("n"))
    table.write(rows, 0)
    assert table.read().agg(F.count("n"), F.sum("n")).first() == (4000, sum(range(4000)))
    for folder in table.paths():
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1

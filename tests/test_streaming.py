"""Incremental job on the streaming file source (K1-K7) with the J6 golden files."""

import os
import random
import re

import pytest

from revlens.operators.report import REPORT_ORDER
from revlens.streaming.incremental import IncrementalReport, Layout

from golden_data import CUSTOMERS_INC, INCREMENTAL_REPORT_J6, ORDER_BATCHES

REPORT_COLS = ["order_month", "segment", "orders_count", "customers_count", "total_revenue",
               "cumulative_revenue", "rolling_avg_revenue"]


def _layout(tmp_path, name="job") -> Layout:
    layout = Layout(str(tmp_path / name))
    os.makedirs(layout.drop, exist_ok=True)
    with open(layout.customers_csv, "w") as f:
        f.write(CUSTOMERS_INC)
    return layout


def _drop(layout: Layout, names):
    for n in names:
        with open(os.path.join(layout.drop, n), "w") as f:
            f.write(ORDER_BATCHES[n])


def _report(job):
    return [tuple(r) for r in job.current_report().orderBy(*REPORT_ORDER).select(*REPORT_COLS).collect()]


def test_one_run_over_all_files(spark, tmp_path):
    layout = _layout(tmp_path)
    _drop(layout, ORDER_BATCHES)
    job = IncrementalReport(spark, layout, publish_csv=True)
    assert job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6
    # published CSV exists with a header row
    parts = [p for p in os.listdir(layout.result_csv) if p.endswith(".csv")]
    assert len(parts) == 1


def test_one_file_per_run_and_replay(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    for name in sorted(ORDER_BATCHES):
        _drop(layout, [name])
        assert job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6
    # nothing new: clean no-op, report unchanged
    assert not job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6
    # the same file offered again is not processed twice
    _drop(layout, ["orders-2024-03-15-0000.csv"])
    assert not job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6


def test_any_arrival_order(spark, tmp_path):
    names = sorted(ORDER_BATCHES)
    rng = random.Random(7)
    order = names[:]
    rng.shuffle(order)
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    # two runs: a random split of the files, in random order
    _drop(layout, order[:2])
    job.run()
    _drop(layout, order[2:])
    job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6


def test_customer_update_moves_old_orders(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    _drop(layout, ["orders-2024-01-10-0000.csv"])
    job.run()
    # customer 2 becomes Enterprise; a new file arrives in the same run
    with open(layout.customer_updates, "w") as f:
        f.write("customer_id,segment\n2,Enterprise\n")
    _drop(layout, ["orders-2024-02-05-0000.csv"])
    job.run()
    rows = {(r[0], r[1]): r for r in _report(job)}
    # January: both orders now Enterprise (old order refreshed), ALL counts 2 customers
    assert rows[("2024-01", "Enterprise")][2:5] == (2, 2, 400.0)
    assert ("2024-01", "SMB") not in rows
    assert rows[("2024-01", "ALL")][2:5] == (2, 2, 400.0)


def test_edited_customers_file_moves_old_orders(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    _drop(layout, ["orders-2024-01-10-0000.csv"])
    job.run()
    # no update file: customers.csv itself is edited, customer 2 becomes Enterprise
    with open(layout.customers_csv, "w") as f:
        f.write(re.sub(r"(?m)^2,.*$", "2,Enterprise", CUSTOMERS_INC))
    _drop(layout, ["orders-2024-02-05-0000.csv"])
    job.run()
    rows = {(r[0], r[1]): r for r in _report(job)}
    assert rows[("2024-01", "Enterprise")][2:5] == (2, 2, 400.0)
    assert ("2024-01", "SMB") not in rows
    assert {r["segment"] for r in job.current_state().where("customer_id = '2'").collect()} == {"Enterprise"}
    # an update file of another customer, then a second edit, over the snapshot
    with open(layout.customer_updates, "w") as f:
        f.write("customer_id,segment\n1,Startup\n")
    with open(layout.customers_csv, "w") as f:
        f.write(re.sub(r"(?m)^2,.*$", "2,SMB", CUSTOMERS_INC))
    _drop(layout, [sorted(ORDER_BATCHES)[-1]])
    job.run()
    state = job.current_state()
    assert {r["segment"] for r in state.where("customer_id = '2'").collect()} == {"SMB"}
    assert {r["segment"] for r in state.where("customer_id = '1'").collect()} == {"Startup"}


def test_wholly_rejected_batch_changes_nothing(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    _drop(layout, ["orders-2024-01-10-0000.csv"])
    job.run()
    before = _report(job)
    with open(os.path.join(layout.drop, "orders-2024-04-01-0000.csv"), "w") as f:
        f.write("order_id,customer_id,order_date,quantity,unit_price\n2001,1,2024-04-01,0,100\n2002,1,bad,1,1\n")
    assert job.run()
    assert _report(job) == before


def test_missing_customers_is_an_error(spark, tmp_path):
    layout = Layout(str(tmp_path / "nocust"))
    os.makedirs(layout.drop)
    with pytest.raises(FileNotFoundError):
        IncrementalReport(spark, layout).run()


def test_archive_without_state_is_an_error(spark, tmp_path):
    layout = _layout(tmp_path, "gate")
    spark.range(1).write.parquet(layout.archive)
    with pytest.raises(FileNotFoundError, match="state is missing"):
        IncrementalReport(spark, layout).check_preconditions()


def test_file_with_columns_in_other_order(spark, tmp_path):
    layout = _layout(tmp_path, "swapped")
    swapped = {}
    for name, text in ORDER_BATCHES.items():
        rows = [line.split(",") for line in text.strip().splitlines()]
        if name == "orders-2024-02-05-0000.csv":  # same data, columns reversed
            rows = [list(reversed(r)) for r in rows]
        swapped[name] = "\n".join(",".join(r) for r in rows) + "\n"
    for name, text in swapped.items():
        with open(os.path.join(layout.drop, name), "w") as f:
            f.write(text)
    job = IncrementalReport(spark, layout, publish_csv=False)
    job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6


def test_one_run_in_several_micro_batches(spark, tmp_path):
    layout = _layout(tmp_path, "multi")
    _drop(layout, ORDER_BATCHES)
    job = IncrementalReport(spark, layout, publish_csv=False, max_files_per_trigger=2)
    assert job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6
    assert job.state.latest_version() >= 2  # three micro-batches: ids 0, 1, 2


def test_unparsable_file_name_goes_to_quarantine(spark, tmp_path):
    layout = _layout(tmp_path, "quarantine")
    _drop(layout, ["orders-2024-01-10-0000.csv"])
    job = IncrementalReport(spark, layout, publish_csv=False)
    job.run()
    before = _report(job)
    # passes the glob (? is any character) but has no valid version
    with open(os.path.join(layout.drop, "orders-abcd-01-10-0000.csv"), "w") as f:
        f.write("order_id,customer_id,order_date,quantity,unit_price\n9001,1,2024-01-05,2,100\n")
    assert job.run()
    assert _report(job) == before
    q = spark.read.parquet(os.path.join(layout.quarantine, "batch=1"))
    assert [r["order_id"] for r in q.collect()] == ["9001"]


# ------------------------------------------------ state machine, ledger, faults

HEAD = "order_id,customer_id,order_date,quantity,unit_price\n"


def _file(layout, name, text):
    with open(os.path.join(layout.drop, name), "w") as f:
        f.write(HEAD + text)


def test_rejected_first_batch_then_a_good_one(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout)
    _file(layout, "orders-2024-01-01-0000.csv", "1,1,2024-01-01,0,100\n2,1,never,1,1\n")
    assert job.run()
    # the empty state is a committed one: neither an error nor a report
    assert job.state.exists() and job.current_state().count() == 0 and _report(job) == []
    _drop(layout, ORDER_BATCHES)
    assert job.run()
    assert _report(job) == INCREMENTAL_REPORT_J6


def test_update_file_applies_once_and_a_later_edit_wins(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False)
    names = sorted(ORDER_BATCHES)
    _drop(layout, names[:1])
    job.run()
    with open(layout.customer_updates, "w") as f:
        f.write("customer_id,segment\n2,Enterprise\n")
    _drop(layout, names[1:2])
    job.run()
    assert not os.path.exists(layout.customer_updates)  # put away with its change time
    assert [n for n in os.listdir(layout.consumed) if n.startswith("customers-")]

    def segments():
        return {r["segment"] for r in job.current_state().where("customer_id = '2'").collect()}

    assert segments() == {"Enterprise"}
    # the same update file once more, as if it had not been put away; then an edit
    source = os.path.join(layout.consumed, [n for n in os.listdir(layout.consumed) if n.startswith("customers-")][0])
    when = int(re.search(r"customers-(\d+)", source)[1]) / 1000
    with open(source) as f, open(layout.customer_updates, "w") as g:
        g.write(f.read())
    os.utime(layout.customer_updates, (when, when))
    with open(layout.customers_csv, "w") as f:
        f.write(re.sub(r"(?m)^2,.*$", "2,Consumer", CUSTOMERS_INC))
    _drop(layout, names[2:3])
    job.run()
    assert segments() == {"Consumer"}
    # both pending: the later change is applied last
    with open(layout.customers_csv, "w") as f:
        f.write(re.sub(r"(?m)^2,.*$", "2,Edited", CUSTOMERS_INC))
    with open(layout.customer_updates, "w") as f:
        f.write("customer_id,segment\n2,Updated\n")
    os.utime(layout.customers_csv, (4e9, 4e9))
    _drop(layout, names[3:])
    job.run()
    assert segments() == {"Edited"}


def test_index_reads_only_the_buckets_a_batch_hits(spark, tmp_path):
    layout = _layout(tmp_path)
    job = IncrementalReport(spark, layout, publish_csv=False, index_buckets=16)
    _file(layout, "orders-2024-01-01-0000.csv", "".join(f"{i},1,2024-01-05,1,10\n" for i in range(200)))
    job.run()
    # order 7 moves to March, order 9 gets an older version that must lose, order 999 is new
    _file(layout, "orders-2024-03-01-0000.csv", "7,1,2024-03-02,1,10\n999,1,2024-03-02,1,10\n")
    job.run()
    new = spark.createDataFrame([("7", "2024-03"), ("7", "2024-03")], "order_id string, order_month string")
    bucket = [r[0] for r in new.select(job._bucket(new["order_id"])).collect()][:1]
    hit = job.index_of(new, bucket, 2)
    assert {tuple(r)[:2] for r in hit.collect()} == {("7", "2024-03")}
    buckets = {p.split("snapshot_part=")[1].split("/")[0] for p in hit.inputFiles()}
    assert len(buckets) == 1  # of sixteen
    assert len({p.split("snapshot_part=")[1] for p in job.index.paths()}) == 16
    _file(layout, "orders-2023-12-01-0000.csv", "9,1,2023-12-05,1,99\n")
    job.run()
    state = {r["order_id"]: r["order_month"] for r in job.current_state().collect()}
    assert state["9"] == "2024-01" and state["7"] == "2024-03" and len(state) == 201
    nine = new.limit(1).selectExpr("'9' order_id")
    bucket = [r[0] for r in nine.select(job._bucket(nine["order_id"])).collect()]
    assert {r["order_month"] for r in job.index_of(nine, bucket, 3).collect()} == {"2024-01"}


def test_counters_of_a_batch_equal_the_counting_query(spark, tmp_path):
    from revlens.operators.clean import dq_counters
    from revlens.operators.enrich import join_customers
    from revlens.sources.csv import scan_csv

    layout = _layout(tmp_path)
    text = "1,1,2024-01-01,1,100\n1,1,2024-01-02,1,100\n2,99,2024-01-01,x,1\n3,1,2024-01-01,0,-1\n4,1,bad,1,1\n,1,2024-01-01,2,2\n"
    _file(layout, "orders-2024-01-01-0000.csv", text)
    job = IncrementalReport(spark, layout, publish_csv=False)
    rows = scan_csv(spark, os.path.join(layout.drop, "orders-2024-01-01-0000.csv"))
    want = dq_counters(join_customers(rows, scan_csv(spark, layout.customers_csv))).first().asDict()
    job.run()
    _file(layout, "orders-2024-01-02-0000.csv", "5,1,2024-01-01,0,100\n")
    job.run()
    first, rejected = job.batch_counters()
    assert first == {"batch": 0} | want
    assert (rejected["rows_in"], rejected["non_positive_quantity"], rejected["rows_out"]) == (1, 1, 0)


def test_one_large_day_is_archived_by_several_tasks(spark, tmp_path):
    layout = _layout(tmp_path)
    rng = random.Random(1)
    _file(layout, "orders-2024-01-01-0000.csv",
          "".join(f"{i},{rng.random()},2024-01-05,{rng.random()},{rng.random()}\n" for i in range(20000)))
    keep = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        IncrementalReport(spark, layout, publish_csv=False).run()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    day = os.path.join(layout.archive, "batch=0", "year=2024", "month=01", "day=01")
    assert len([n for n in os.listdir(day) if n.endswith(".parquet")]) > 1
    assert spark.read.parquet(day).count() == 20000


class _Crash(Exception):
    pass


def test_replay_after_a_crash_behind_every_write(spark, tmp_path, monkeypatch):
    """Attempt k of one batch dies right behind its k-th write; the last one
    gets through. All tables then equal those of a job that never died."""
    from pyspark.sql.readwriter import DataFrameWriter

    from revlens.sources import hadoop_fs

    def prepared(name):
        layout = _layout(tmp_path, name)
        names = sorted(ORDER_BATCHES)
        _drop(layout, names[:2])
        job = IncrementalReport(spark, layout, publish_csv=True)
        job.run()
        before = (layout.result_csv + "/revenue_summary.csv")
        with open(layout.customer_updates, "w") as f:
            f.write("customer_id,segment\n2,Enterprise\n3,\n")
        with open(layout.customers_csv, "w") as f:
            f.write(re.sub(r"(?m)^1,.*$", "1,Startup", CUSTOMERS_INC))
        os.utime(layout.customers_csv, (1e9, 1e9))
        folder = tmp_path / f"{name}-files"
        os.makedirs(folder)
        for n in names[2:]:
            (folder / n).write_text(ORDER_BATCHES[n])
        return job, spark.read.text(str(folder)), before

    def outcome(job):
        archive = spark.read.parquet(job.layout.archive + "/batch=1").drop("year", "month", "day")
        tables = [t.read() for t in job.tables] + [archive]
        with open(job.layout.result_csv + "/revenue_summary.csv") as f:
            return [sorted(map(str, map(tuple, t.collect()))) for t in tables] + [f.read(), job.batch_counters()]

    calm, batch, _ = prepared("calm")
    calm.process_batch(batch, 1)
    want = outcome(calm)

    job, batch, published = prepared("crashing")
    left = {"writes": 0}

    def counted(real):
        def call(*args, **kwargs):
            out = real(*args, **kwargs)
            left["writes"] -= 1
            if left["writes"] == 0:
                raise _Crash
            return out

        return call

    for name in ("parquet", "csv"):
        monkeypatch.setattr(DataFrameWriter, name, counted(getattr(DataFrameWriter, name)))
    for name in ("replace", "delete"):
        monkeypatch.setattr(hadoop_fs, name, counted(getattr(hadoop_fs, name)))
    crashes = 0
    with open(published) as f:
        old = f.read()
    while True:
        left["writes"] = crashes + 1
        try:
            job.process_batch(batch, 1)
            break
        except _Crash:
            crashes += 1
            with open(published) as f:  # the old report or the new one, never none
                assert f.read() in (old, want[-2])
    monkeypatch.undo()
    assert crashes >= 15
    assert outcome(job) == want

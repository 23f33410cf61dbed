"""The incremental job over real batch files, for the registered queries.

Spark writes the order batches of the driver tables as CSV files named by their
version, one file per quarter and sequence number, and the customer tables beside
them. The job of ``revlens.streaming.incremental`` then runs over them: batch 0 takes the
regular files and is the state that an incremental run starts from, batch 1 takes the two
correction files and the customer update. There are two sets of files: the report runs
over the ``whole`` one, with corrections and customer changes of all months, the other
queries over one whose corrections touch a few months only. Files and state are kept for
the session, so repeated queries time the incremental run and not the initial load; every
call runs batch 1 anew (a replay).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.clean import ORDER_COLUMNS, clean_orders
from revlens.operators.enrich import join_customers, refresh_segment
from revlens.operators.report import REPORT_COLUMNS, add_order_metrics, finish_report, month_segment_rollup
from revlens.operators.versions import customer_upsert, latest_by, upsert
from revlens.session import scratch_path
from revlens.sources import hadoop_fs
from revlens.sources import views as V
from revlens.sources.csv import describe_files, scan_csv
from revlens.sources.files import BATCH_GLOB, read_batches, read_files
from revlens.sources.records import FileFact
from revlens.sources.tables import Tables
from revlens.streaming.incremental import CUSTOMER_COLUMNS, STATE_COLUMNS, IncrementalReport, Layout

C = F.col

FIRST, SECOND = 0, 1  # batch ids
MOVERS = 16  # renames at a time


def write_batch_files(batches: DataFrame, folder: str) -> None:
    """CSV files ``orders-<version>.csv`` in ``folder``: rows of a version in
    one file by order key."""
    spark = batches.sparkSession
    aside = f"{folder}/_aside"
    (
        batches.repartition("ingestion_date")
        .sortWithinPartitions("ingestion_date", "row_key")
        .select(*ORDER_COLUMNS, "ingestion_date")
        .write.option("header", True)
        .option("escape", '"')
        .partitionBy("ingestion_date")
        .csv(aside)
    )

    def put_in_place(name: str) -> None:
        version = name.partition("=")[2]
        part = next(x.name for x in hadoop_fs.entries(spark, f"{aside}/{name}") if x.name.endswith(".csv"))
        hadoop_fs.replace(spark, f"{aside}/{name}/{part}", f"{folder}/orders-{version}.csv")

    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(put_in_place, [e.name for e in hadoop_fs.entries(spark, aside) if e.is_dir]))
    hadoop_fs.delete(spark, aside)


def _write_customers(customers: DataFrame, path: str) -> None:
    spark = customers.sparkSession
    customers.coalesce(1).write.option("header", True).csv(f"{path}.aside")
    part = next(x.name for x in hadoop_fs.entries(spark, f"{path}.aside") if x.name.endswith(".csv"))
    hadoop_fs.replace(spark, f"{path}.aside/{part}", path)
    hadoop_fs.delete(spark, f"{path}.aside")


@dataclass
class FileFlow:
    """Files of the two batches and a job that has processed the first."""

    old: str
    new: str
    job: IncrementalReport | None = None

    def rows(self) -> DataFrame:
        """All rows of all batch files."""
        spark = SparkSession.active()
        return read_batches(spark, [f"{self.old}/{BATCH_GLOB}", f"{self.new}/{BATCH_GLOB}"], ORDER_COLUMNS)

    def new_files(self) -> list[FileFact]:
        return describe_files(self.job.spark, [f"{self.new}/{BATCH_GLOB}"])


_FLOWS: dict[tuple[str, str, str, bool], FileFlow] = {}


def _flow(spark: SparkSession, sf_dir: str, whole: bool = False) -> FileFlow:
    key = (spark.sparkContext.applicationId, scratch_path(spark, ""), sf_dir, whole)
    if key not in _FLOWS:
        t = Tables(spark, sf_dir)
        root = scratch_path(spark, f"batch-files/{spark.sparkContext.applicationId}-{len(_FLOWS)}")
        flow = FileFlow(f"{root}/old", f"{root}/new")
        batches = V.v_all_batch_files(t) if whole else V.v_batch_files(t)
        late = C("ingestion_date") >= F.lit(V.CORRECTIONS_FROM)
        write_batch_files(batches.where(~late), flow.old)
        write_batch_files(batches.where(late), flow.new)
        _FLOWS[key] = flow
    return _FLOWS[key]


def batch_rows(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Rows of all batch files of the session's file set."""
    return _flow(spark, sf_dir, whole).rows()


def started_job(spark: SparkSession, sf_dir: str, whole: bool = False) -> FileFlow:
    """The flow with batch 0 processed and the customer update in its place."""
    flow = _flow(spark, sf_dir, whole)
    if flow.job is None:
        t = Tables(spark, sf_dir)
        layout = Layout(f"{flow.old}-job")
        _write_customers(V.v_file_customers(t), layout.customers_csv)
        job = IncrementalReport(spark, layout)
        job.process_files(describe_files(spark, [f"{flow.old}/{BATCH_GLOB}"]), FIRST)
        updates = V.v_customer_updates(t) if whole else V.v_file_customer_updates(t)
        _write_customers(updates, layout.customer_updates)
        flow.job = job
    return flow


def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report after the second batch, which recomputes the months it touches:
    with corrections and changed customers in all of them, every month."""
    flow = started_job(spark, sf_dir, whole=True)
    flow.job.process_files(flow.new_files(), SECOND)
    return flow.job.report.read(before=SECOND + 1).select(*REPORT_COLUMNS)


def touched_months(spark: SparkSession, sf_dir: str, whole: bool = False) -> list[str]:
    """Months that the second batch, which is run for it, had to recompute."""
    flow = started_job(spark, sf_dir, whole)
    return flow.job.process_files(flow.new_files(), SECOND).touched


def archived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived raw rows of both batches with the folder they lie in."""
    flow = started_job(spark, sf_dir)
    flow.job.archive(read_files(spark, flow.new_files(), ORDER_COLUMNS), SECOND)
    folders = [f"{flow.job.layout.archive}/batch={b}" for b in (FIRST, SECOND)]
    rows = spark.read.option("basePath", flow.job.layout.archive).schema("file_name string").parquet(*folders)
    return rows.select("file_name", C("_metadata.file_path").alias("path"))


def full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from all batch files at once, for comparison."""
    flow = started_job(spark, sf_dir, whole=True)
    layout = flow.job.layout
    customers, updates = (
        scan_csv(spark, p, CUSTOMER_COLUMNS).select(*CUSTOMER_COLUMNS)
        for p in (layout.customers_csv, layout.customer_updates)
    )
    now = customer_upsert(customers, updates)
    rows = flow.rows().drop("file_name", "file_path")
    late = C("ingestion_date") >= F.lit(V.CORRECTIONS_FROM)

    def versions(part: DataFrame, dimension: DataFrame) -> DataFrame:
        latest = latest_by(clean_orders(join_customers(part, dimension)), "order_id", ["ingestion_date", "line"])
        return add_order_metrics(latest).select(*STATE_COLUMNS)

    state = upsert(refresh_segment(versions(rows.where(~late), customers), now), versions(rows.where(late), now))
    return finish_report(month_segment_rollup(state))

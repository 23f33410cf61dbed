"""Incremental monthly report over a drop folder of order files.

New ``orders-YYYY-MM-DD-NNNN.csv`` files are picked up once by the streaming
file source (its checkpoint records consumed files) and processed with
``trigger(availableNow=True)`` + ``foreachBatch``. Each micro-batch:

1. takes over what changed in ``customers.csv`` since the last batch and the
   customer update files that no earlier batch consumed (H4), in the order of their changes;
   the segment refresh (D4) touches only orders of customers whose segment changed (HP-5);
2. enriches and cleans the new rows, keeps the latest version of each order
   inside the batch by (file version, line) (H2), and counts what cleaning
   removed on the way (L1, L2);
3. finds the touched months: months of the new versions, of the versions they
   replace and of refreshed orders (K3). Replaced versions are looked up in an index from order to
   month, of which a batch reads the hash buckets its orders fall in;
4. upserts those months of the order state (H3) and writes them as a new
   snapshot version (only touched months are written);
5. rebuilds the report rows of the touched months, re-runs the windows over
   the small month x segment table (K4, K5), writes and publishes the report;
6. archives the raw rows by batch day (A9).

Late data has no bound (K2): no watermark is used; the keyed state table
absorbs any old order date. Every table is versioned by batch id, every batch commits every
table (also without a change), and readers of batch ``b`` only see versions
``< b``. So a batch that died between any two of its writes recomputes the same output when the source
offers it again (K6, HP-4).
"""

from __future__ import annotations

import json
import logging
import time
from contextlib import contextmanager
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.clean import ORDER_COLUMNS, QualityCounts, clean_orders, typed_orders
from revlens.operators.enrich import guarded_unique, join_customers, left_join
from revlens.operators.report import (
    REPORT_COLUMNS,
    REPORT_ORDER,
    add_order_metrics,
    finish_report,
    month_segment_rollup,
)
from revlens.operators.versions import customer_upsert, latest_by, upsert
from revlens.sources import hadoop_fs
from revlens.sources.csv import scan_csv, write_csv
from revlens.sources.files import BATCH_GLOB, batch_day, empty_files, read_files, version_of
from revlens.sources.records import FileFact, file_facts, with_place
from revlens.sources.snapshots import SnapshotTable

C = F.col
log = logging.getLogger(__name__)

CUSTOMER_COLUMNS = ["customer_id", "segment"]

STATE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("segment", T.StringType()),
        T.StructField("ingestion_date", T.StringType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("order_month", T.StringType()),
    ]
)
STATE_COLUMNS = [f.name for f in STATE_SCHEMA.fields]
CUSTOMER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CUSTOMER_COLUMNS])
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("order_month", T.StringType()),
        T.StructField("ingestion_date", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)
ROWS_SCHEMA = T.StructType(
    [
        T.StructField("order_month", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("orders_count", T.LongType()),
        T.StructField("customers_count", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("is_total", T.BooleanType()),
    ]
)
REPORT_SCHEMA = T.StructType(
    ROWS_SCHEMA.fields[:5]
    + [T.StructField("cumulative_revenue", T.DoubleType()), T.StructField("rolling_avg_revenue", T.DoubleType())]
    + ROWS_SCHEMA.fields[5:]
)


@dataclass
class Layout:
    """Folders of one incremental job (all on shared storage)."""

    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def drop(self) -> str:
        """Incoming order files and an optional ``customers.csv`` update."""
        return self._p("to_process")

    @property
    def customers_csv(self) -> str:
        """Customer table; rows edited between runs replace the snapshot's."""
        return self._p("customers.csv")

    @property
    def customer_updates(self) -> str:
        return f"{self.drop}/customers.csv"

    @property
    def customers(self) -> str:
        return self._p("customers")

    @property
    def customers_seen(self) -> str:
        """``customers.csv`` as the last batch found it."""
        return self._p("customers_seen")

    @property
    def updates_applied(self) -> str:
        """One file per customer update file that a batch consumed."""
        return self._p("updates_applied")

    @property
    def state(self) -> str:
        return self._p("state")

    @property
    def order_index(self) -> str:
        return self._p("order_index")

    @property
    def report_rows(self) -> str:
        return self._p("report_rows")

    @property
    def report(self) -> str:
        return self._p("report")

    @property
    def archive(self) -> str:
        return self._p("archive")

    @property
    def quarantine(self) -> str:
        return self._p("quarantine")

    @property
    def metrics(self) -> str:
        """Row counters of each batch, one JSON file per batch."""
        return self._p("metrics")

    @property
    def consumed(self) -> str:
        """Raw files moved out of the drop folder."""
        return self._p("consumed")

    @property
    def result_csv(self) -> str:
        return self._p("result")

    @property
    def work(self) -> str:
        """Tables of the batch in progress."""
        return self._p("_work")

    @property
    def checkpoint(self) -> str:
        return self._p("_checkpoints/orders")


REPORT_FILE = "revenue_summary.csv"


def _having(state: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows of ``state`` whose key occurs in ``df``; a NULL key counts as a
    key. Adaptive execution picks the join from the measured size of the keys."""
    keys = df.select(F.col(key).alias("_key")).distinct()
    return state.join(keys, state[key].eqNullSafe(keys["_key"]), "left_semi")


def _unmatched(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``columns`` occur in no row of ``other``; a NULL
    equals a NULL."""
    keys = other.select(*[F.col(c).alias(f"_{c}") for c in columns]).distinct()
    on = [df[c].eqNullSafe(keys[f"_{c}"]) for c in columns]
    return df.join(keys, on, "left_anti")


class BatchPlan(NamedTuple):
    """New versions, what the index knew of their orders, orders whose customer
    moves them to another segment (None if no customer changed), touched months."""

    new: DataFrame
    known: DataFrame
    refreshed: DataFrame | None
    touched: list[str]


class IncrementalReport:
    """The incremental job over one :class:`Layout`.

    ``max_files_per_trigger`` bounds a micro-batch; one run still drains every
    file. ``index_buckets`` is fixed by a job's first batch: take about the number of orders
    divided by a million.
    """

    def __init__(self, spark: SparkSession, layout: Layout, publish_csv: bool = True,
                 clear_segment: bool = False, max_files_per_trigger: int = 1000, index_buckets: int = 16,
                 lenient_dates: bool = False):
        self.spark = spark
        self.max_files_per_trigger = max_files_per_trigger
        self.index_buckets = index_buckets
        self.layout = layout
        self.publish_csv = publish_csv
        self.clear_segment = clear_segment
        self.lenient_dates = lenient_dates
        self.customers = SnapshotTable(spark, layout.customers, CUSTOMER_SCHEMA)
        self.customers_seen = SnapshotTable(spark, layout.customers_seen, CUSTOMER_SCHEMA)
        self.state = SnapshotTable(spark, layout.state, STATE_SCHEMA, part_col="order_month")
        self.index = SnapshotTable(spark, layout.order_index, INDEX_SCHEMA, part_col="bucket", append=True)
        self.rows = SnapshotTable(spark, layout.report_rows, ROWS_SCHEMA)
        self.report = SnapshotTable(spark, layout.report, REPORT_SCHEMA)
        self.tables = (self.customers, self.customers_seen, self.state, self.index, self.rows, self.report)

    @contextmanager
    def _step(self, name: str, batch_id: int):
        """One step of a micro-batch; its wall time is logged at INFO."""
        start = time.perf_counter()
        yield
        log.info("batch %s: %s took %.2fs", batch_id, name, time.perf_counter() - start)

    # ------------------------------------------------------------- gate (A10)

    def check_preconditions(self) -> None:
        """Customer data must exist somewhere. A committed state, be it empty,
        and the archive belong together: without the archive a warning, without the state an error."""
        layout, spark = self.layout, self.spark
        if not self.customers.exists() and not any(
            hadoop_fs.exists(spark, p) for p in (layout.customers_csv, layout.customer_updates)
        ):
            raise FileNotFoundError(
                f"No customer table: put one at {layout.customers_csv} or {layout.customer_updates}"
            )
        archived = bool(hadoop_fs.entries(spark, layout.archive))
        if self.state.exists() and not archived:
            log.warning("Orders are kept in %s, but %s holds no raw rows.", layout.state, layout.archive)
        if archived and not self.state.exists():
            raise FileNotFoundError(
                f"{layout.archive} holds raw rows, but the order state is missing: {layout.state}. "
                f"Offer the order files again in {layout.drop}."
            )
        blank = empty_files(spark, [f"{layout.drop}/{BATCH_GLOB}"])
        if blank:
            raise ValueError(f"No header line in: {', '.join(blank)}")

    # ------------------------------------------------------------ customers

    def _csv(self, path: str) -> DataFrame | None:
        if not hadoop_fs.exists(self.spark, path):
            return None
        return scan_csv(self.spark, path, required=CUSTOMER_COLUMNS).select(*CUSTOMER_COLUMNS)

    def _ledger_path(self, update: hadoop_fs.Entry) -> str:
        return f"{self.layout.updates_applied}/{update.modified}-{update.length}.json"

    def _applied_in(self, update: hadoop_fs.Entry) -> int | None:
        """The batch that consumed an update file, told by its change time and length."""
        path = self._ledger_path(update)
        if not hadoop_fs.exists(self.spark, path):
            return None
        return json.loads(hadoop_fs.read_text(self.spark, path))["batch"]

    def _pending_update(self, batch_id: int) -> hadoop_fs.Entry | None:
        update = hadoop_fs.stat(self.spark, self.layout.customer_updates)
        if update is None:
            return None
        applied = self._applied_in(update)
        return update if applied is None or applied >= batch_id else None

    def _seen_path(self, version: int) -> str:
        return f"{self.layout.customers_seen}/_csv/{version}.json"

    def _note_seen(self, csv: hadoop_fs.Entry | None, batch_id: int) -> None:
        """Change time and length of ``customers.csv`` as a batch found it."""
        note = [csv.modified, csv.length] if csv else None
        hadoop_fs.write_text(self.spark, self._seen_path(batch_id), json.dumps(note))

    def _seen_before(self, batch_id: int) -> list[int] | None:
        version = self.customers_seen.latest_version(before=batch_id)
        if version is None or not hadoop_fs.exists(self.spark, self._seen_path(version)):
            return None
        return json.loads(hadoop_fs.read_text(self.spark, self._seen_path(version)))

    def _refresh_customers(self, batch_id: int) -> tuple[DataFrame, DataFrame | None]:
        """(customer table, customers whose segment changed since the last
        batch, None for none). The first batch has no earlier table to compare
        with, so all of its customers count as changed.

        An update file applies in one batch only; where ``customers.csv`` was
        edited as well, the later change is applied last."""
        update = self._pending_update(batch_id)
        edit = hadoop_fs.stat(self.spark, self.layout.customers_csv)
        as_before = edit is not None and self._seen_before(batch_id) == [edit.modified, edit.length]
        csv = None if as_before else self._csv(self.layout.customers_csv)
        before = self.customers.read(before=batch_id) if self.customers.exists(batch_id) else None
        seen = self.customers_seen.read(before=batch_id) if self.customers_seen.exists(batch_id) else None
        edited = None
        self._note_seen(edit, batch_id)
        if before is not None and seen is not None and csv is not None:
            rows = _unmatched(csv, seen, CUSTOMER_COLUMNS).unionByName(_unmatched(seen, csv, CUSTOMER_COLUMNS))
            edited = None if rows.isEmpty() else rows
        if before is not None and edited is None and update is None:
            self.customers.write(None, batch_id)
            self.customers_seen.write(None, batch_id)
            return before, None

        def with_edits(now: DataFrame) -> DataFrame:
            if before is None:
                return csv if csv is not None else now
            if edited is None:
                return now
            # all rows of an edited customer, so the uniqueness guard sees repeats
            return _unmatched(now, edited, ["customer_id"]).unionByName(_having(csv, edited, "customer_id"))

        def with_update(now: DataFrame) -> DataFrame:
            if update is None:
                return now
            rows = self._csv(self.layout.customer_updates).withColumn("_line", F.monotonically_increasing_id())
            return customer_upsert(now, rows, ordinal="_line")

        now = before if before is not None else self.customers.empty()
        edit_last = before is not None and update and edit and edit.modified > update.modified
        for change in (with_update, with_edits) if edit_last else (with_edits, with_update):
            now = change(now)
        self.customers.write(now, batch_id)
        if csv is not None and (edited is not None or seen is None):
            self.customers_seen.write(csv, batch_id)
        else:
            self.customers_seen.write(None, batch_id)
        if update is not None:
            note = {"file": self.layout.customer_updates, "modified": update.modified, "batch": batch_id}
            hadoop_fs.write_text(self.spark, self._ledger_path(update), json.dumps(note))
        now = self.customers.read(before=batch_id + 1)
        changed = now if before is None else _unmatched(now, before, CUSTOMER_COLUMNS)
        return now, changed.select("customer_id", C("segment").alias("_new_segment"))

    # --------------------------------------------------------------- index

    def _bucket(self, order_id: Column) -> Column:
        """Hash bucket of an order; NULL ids have one as well."""
        return F.pmod(F.xxhash64(order_id), F.lit(self.index_buckets)).cast("string")

    def index_of(self, new: DataFrame, buckets: list[str], batch_id: int) -> DataFrame:
        """(order_id, order_month, ingestion_date) that the batch's orders had
        before it. Reads the ``buckets`` that these orders fall in, of which there are
        at most ``index_buckets``."""
        known = _having(self.index.read(before=batch_id, parts=buckets), new, "order_id")
        latest = F.max_by(F.struct("order_month", "ingestion_date"), "version").alias("at")
        return known.groupBy("order_id").agg(latest).select("order_id", "at.*")

    # --------------------------------------------------------------- batch

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of text lines; see :meth:`process_files`."""
        self.process_files(file_facts(with_place(batch)), batch_id)

    def process_files(self, files: list[FileFact], batch_id: int) -> BatchPlan:
        """One micro-batch of order files; returns what it changed. What several steps read, the batch's
        new versions, is written once to the work folder; nothing is kept in
        executors, so a lost one costs a task and not the batch."""
        good = [f for f in files if version_of(f.path)]
        bad = [f for f in files if not version_of(f.path)]
        raw = read_files(self.spark, good, required=ORDER_COLUMNS)

        if bad:
            with self._step("quarantine", batch_id):
                read_files(self.spark, bad).drop("line", "file_path").write.mode("overwrite").parquet(
                    f"{self.layout.quarantine}/batch={batch_id}"
                )
        plan = self.plan_batch(raw, batch_id)
        with self._step("state", batch_id):
            self._write_state(plan.new, plan.refreshed, plan.touched, batch_id)
        with self._step("index", batch_id):
            self._write_index(plan.new, plan.known, batch_id)
        with self._step("report", batch_id):
            self._write_report(plan.touched, batch_id)
        with self._step("publish", batch_id):
            if self.publish_csv:
                self._publish(batch_id)
        with self._step("archive", batch_id):
            self.archive(raw, batch_id)
        with self._step("clean up", batch_id):
            for table in self.tables:
                table.drop_superseded()
        return plan

    def plan_batch(self, raw: DataFrame, batch_id: int) -> BatchPlan:
        """What a batch of raw rows changes: customers are taken over, new
        versions written to the work folder, touched months found."""
        with self._step("customers", batch_id):
            customers, changed = self._refresh_customers(batch_id)
        with self._step("new versions", batch_id):
            new, counts = self._new_versions(raw, customers, batch_id)
        with self._step("touched months", batch_id):
            known = self.index_of(new, counts.values("buckets"), batch_id)
            refreshed = None if changed is None else self._refreshed(changed, batch_id)
            touched = self.touched_months(counts.values("months"), known, refreshed, batch_id)
        return BatchPlan(new, known, refreshed, touched)

    def _new_versions(
        self, raw: DataFrame, customers: DataFrame, batch_id: int
    ) -> tuple[DataFrame, QualityCounts]:
        """Latest version of each order of the batch (H2), with the counters of
        its cleaning (L1), its months and index buckets taken from the same pass."""
        typed = typed_orders(join_customers(raw.drop("file_name", "file_path"), customers), self.lenient_dates)
        counts = QualityCounts(typed)
        latest = latest_by(clean_orders(counts.observed, typed=True), "order_id", ["ingestion_date", "line"]).drop("line")
        path = f"{self.layout.work}/new-{batch_id}"
        out = counts.observe_rows_out(
            add_order_metrics(latest).select(*STATE_COLUMNS), months=C("order_month"), buckets=self._bucket(C("order_id"))
        )
        out.write.mode("overwrite").parquet(path)
        hadoop_fs.write_text(self.spark, f"{self.layout.metrics}/{batch_id}.json", json.dumps(counts.result()))
        return self.spark.read.schema(STATE_SCHEMA).parquet(path), counts

    def _refreshed(self, changed: DataFrame, batch_id: int) -> DataFrame:
        """Orders of the state whose customer's new segment changes them."""
        prior = self.state.read(before=batch_id)
        hit = left_join(
            _having(prior, changed, "customer_id"), guarded_unique(changed, "customer_id", "customers"), "customer_id"
        )
        if self.clear_segment:
            segment = F.coalesce(C("_new_segment"), F.lit("UNKNOWN"))
        else:
            segment = F.coalesce(C("_new_segment"), C("segment"))
        return hit.withColumn("_segment", segment).where(~C("_segment").eqNullSafe(C("segment")))

    def touched_months(
        self, months: list[str], known: DataFrame, refreshed: DataFrame | None, batch_id: int
    ) -> list[str]:
        """Months whose report rows can change (K3): those of the new versions
        and of the ones they replace, and of refreshed orders. One entry per
        calendar month at most."""
        if not self.state.paths(before=batch_id):
            return months
        others = known.select("order_month")
        if refreshed is not None:
            others = others.unionByName(refreshed.select("order_month"))
        return sorted({r[0] for r in others.distinct().collect()}.union(months))

    def _write_state(self, new: DataFrame, refreshed: DataFrame | None, touched: list[str], batch_id: int) -> None:
        """Upsert of the touched months (H3); only their folders are read and written."""
        if not touched:
            self.state.write(None, batch_id)
            return
        prior = self.state.read(before=batch_id, parts=touched)
        if refreshed is not None:
            fixes = refreshed.select("order_id", "_segment")
            prior = left_join(prior, fixes, "order_id").withColumn("segment", F.coalesce(C("_segment"), C("segment")))
        self.state.write(upsert(prior.select(*STATE_COLUMNS), new), batch_id, parts=touched)

    def _write_index(self, new: DataFrame, known: DataFrame, batch_id: int) -> None:
        """Adds the orders whose version this batch brings to the state; one
        that is older than the state's (a late file) leaves the index as it is."""
        before = known.select("order_id", C("ingestion_date").alias("_before"))
        won = left_join(new, before, "order_id").where(
            C("_before").isNull() | (C("ingestion_date") >= C("_before"))
        )
        rows = won.select(
            self._bucket(C("order_id")).alias("bucket"), "order_id", "order_month", "ingestion_date",
            F.lit(batch_id).cast("long").alias("version"),
        )
        self.index.write(rows, batch_id)

    def _write_report(self, touched: list[str], batch_id: int) -> None:
        """Report rows of touched months, windows over the small table (K4, K5)."""
        if not touched:
            self.rows.write(None, batch_id)
            self.report.write(None, batch_id)
            return
        fresh = month_segment_rollup(self.state.read(before=batch_id + 1, parts=touched))
        kept = self.rows.read(before=batch_id).where(~C("order_month").isin(touched))
        self.rows.write(kept.unionByName(fresh.select(*kept.columns)), batch_id)
        self.report.write(finish_report(self.rows.read(before=batch_id + 1)), batch_id)

    def _publish(self, batch_id: int) -> None:
        """The report as one CSV file: written aside, then renamed over the old
        one in one step (A8). What a run left aside when it died is dropped."""
        spark, folder = self.spark, self.layout.result_csv
        if not self.report.paths(before=batch_id + 1):
            return  # no order has ever been valid
        for e in hadoop_fs.entries(spark, folder):
            if e.name.startswith("_next"):
                hadoop_fs.delete(spark, f"{folder}/{e.name}")
        aside = f"{folder}/_next-{batch_id}"
        write_csv(self.report.read(before=batch_id + 1), aside, order_by=REPORT_ORDER, single_file=True)
        part = next(e.name for e in hadoop_fs.entries(spark, aside) if e.name.endswith(".csv"))
        hadoop_fs.replace(spark, f"{aside}/{part}", f"{folder}/{REPORT_FILE}")
        hadoop_fs.delete(spark, aside)

    def archive(self, raw: DataFrame, batch_id: int) -> None:
        """Raw rows by batch day (A9): ``<archive>/batch=<id>/year=/month=/day=``,
        file name kept as a column. A replayed batch overwrites only its own
        folder. The rebalance hint lets Spark split a large day over tasks and
        put small days together."""
        day = batch_day(C("ingestion_date"))
        parts = ("year", "month", "day")
        dated = raw.select(*ORDER_COLUMNS, "file_name", "ingestion_date").withColumns(
            {name: F.date_format(day, form) for name, form in zip(parts, ("yyyy", "MM", "dd"), strict=True)}
        )
        dated.hint("rebalance", *[C(p) for p in parts]).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(*parts).parquet(f"{self.layout.archive}/batch={batch_id}")

    # ----------------------------------------------------------------- run

    def run(self) -> bool:
        """Process all new files once; returns whether any batch ran."""
        self.check_preconditions()
        ran = {"any": False}

        def each(batch: DataFrame, batch_id: int) -> None:
            ran["any"] = True
            self.process_batch(batch, batch_id)

        # Text source: each micro-batch parses its files by their own header
        # (a CSV source would map columns by position). Consumed files are
        # moved out of the drop folder by the source itself (kept verbatim
        # under ``consumed``), so listings stay small.
        stream = (
            self.spark.readStream.format("text")
            .option("lineSep", "\n")
            .option("pathGlobFilter", BATCH_GLOB)
            .option("cleanSource", "archive")
            .option("sourceArchiveDir", self.layout.consumed)
            .option("maxFilesPerTrigger", self.max_files_per_trigger)
            .load(self.layout.drop)
            .select("value", "_metadata")
        )
        query = (
            stream.writeStream.foreachBatch(each)
            .option("checkpointLocation", self.layout.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        self._put_away_update()
        return ran["any"]

    def _put_away_update(self) -> None:
        """Move a consumed customer update file out of the drop folder. Its
        batch is committed; a run that died before this finds it in the ledger."""
        update = hadoop_fs.stat(self.spark, self.layout.customer_updates)
        if update is not None and self._applied_in(update) is not None:
            target = f"{self.layout.consumed}/customers-{update.modified}.csv"
            hadoop_fs.replace(self.spark, self.layout.customer_updates, target)

    def current_report(self) -> DataFrame:
        return self.report.read().select(*REPORT_COLUMNS)

    def current_state(self) -> DataFrame:
        return self.state.read()

    def batch_counters(self) -> list[dict[str, int]]:
        """Cleaning counters of every batch, with its id (L1, L2)."""
        out = []
        for e in hadoop_fs.entries(self.spark, self.layout.metrics):
            if e.name.endswith(".json"):
                text = hadoop_fs.read_text(self.spark, f"{self.layout.metrics}/{e.name}")
                out.append({"batch": int(e.name[:-5])} | json.loads(text))
        return sorted(out, key=lambda m: m["batch"])


def run_incremental(spark: SparkSession, root: str, **options) -> DataFrame:
    """Run the incremental job once over ``root`` and return the current report."""
    job = IncrementalReport(spark, Layout(root), **options)
    job.run()
    return job.current_report()

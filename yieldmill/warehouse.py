"""The jobs of the warehouse, each one call: stage, dimensions, facts and marts.

Plant, load mode, window and as-of time are arguments; one method stands for the
daily, initial, rerun and ad-hoc variants of a job.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldmill.functions.prodtime import in_window, production_window, shift_zone, span_window
from yieldmill.operators import loads
from yieldmill.operators.audit import Batch, current_batch, next_batch, scalar_max, with_audit
from yieldmill.operators.loads import LoadReport
from yieldmill.operators.merge import Merge
from yieldmill.plans import dims, facts, marts, schemas, staging, telemetry
from yieldmill.session import materialise
from yieldmill.sources.files import read_csv
from yieldmill.sources.lake import Lake, Table
from yieldmill.streaming import BY_BATCH, STREAM_BATCH, stream_append, stream_json, stream_text

# Session, source and table names of the telemetry jobs.
TELEMETRY_SESSION = "process_FACT_DATA_CON_TRANSACTION"
ADHOC_SESSION = "process_FACT_DATA_CON_TRANSACTION_ADHOC"
RERUN_SOURCE = "FACT_DATA_CON_TRANSACTION"
ARRIVALS = "STAGING_DTC_TRANSACTION_REDIS"
COLLECTED = "STAGING_DTC_TRANSACTION"

# Slice of fact rows that a reload wrote, and not a load of a stream's slice.
RELOADED = 0
COMPACTED = "compacted"
YIELD_FACT, YIELD_MART = "SFC_WIP_RUNCARD_FACT", "CUMULATIVE_YIELD"


@dataclass(frozen=True)
class MergeReport:
    """Rows of a dimension that a refresh updated and inserted."""

    updated: int
    inserted: int


@dataclass(frozen=True)
class Slice:
    """A half-open range of arrival times that is loaded as one."""

    number: int
    after: datetime | None
    upto: datetime


@dataclass(frozen=True)
class Warehouse:
    """A lakehouse and the session that works on it."""

    spark: SparkSession
    lake: Lake

    # --- set-up and batch control ---------------------------------------------

    def create(self) -> None:
        """Create all tables, or empty them: the reset before an initial load."""
        loads.truncate_all(self.spark, schemas.all_tables(self.lake))

    def open_batch(self, as_of: datetime, user: str = "admin") -> Batch:
        """Add the batch of the last production day unless it is there; the latest is current."""
        table = schemas.control_table(self.lake)
        control = table.read(self.spark)
        loads.append(table, materialise(next_batch(control, as_of.date()), "batch"))
        return Batch(current_batch(table.read(self.spark)), as_of, user)

    # --- staging ----------------------------------------------------------------

    def stage(
        self,
        name: str,
        plant: str,
        source: DataFrame,
        batch: Batch,
        span: tuple[date, date] | None = None,
        initial: bool = False,
    ) -> LoadReport:
        """Load a source table of one plant in the mode that belongs to it.

        Move tables are loaded by production day, for a ``span`` of days in a rerun
        and up to the last 07:00 initially; all others are refreshed whole.
        """
        table = schemas.staging_table(self.lake, name, source.schema)
        if name not in staging.BY_DAY:
            return staging.stage_full(table, source, name, plant, batch)
        if initial:
            return staging.stage_initial(table, source, name, plant, batch)
        if span is not None:
            return staging.stage_span(table, source, name, plant, batch, *span)
        return staging.stage_day(table, source, name, plant, batch)

    def staged(self, name: str, plant: str) -> DataFrame:
        """Staged rows of a plant, with the columns that the plans use."""
        table = schemas.staging_table(self.lake, name)
        return table.read(self.spark).filter(F.col("PLANT") == plant)

    def master(self, name: str) -> DataFrame:
        return schemas.master_table(self.lake, name).read(self.spark)

    # --- dimensions ---------------------------------------------------------------

    def refresh_dates(self, first: date, last: date, batch: Batch, plant: str = "WN") -> LoadReport:
        """Add the production days from ``first`` to ``last``."""
        days = dims.production_days(first, last, self.spark)
        weeks = self.staged("EIS_WORK_WEEK", plant)
        return self._append(
            "MFG_DATE_DIM", dims.dim_date(weeks, days, self.master("MFG_DATE_DIM"), batch, plant)
        )

    def refresh_base_dims(
        self, plant: str, batch: Batch, initial: bool = False
    ) -> dict[str, MergeReport]:
        """Lines, machines, operations and products of a plant."""
        reports = {}
        lines = dims.merge_line(
            self.staged("EIS_JIT_CELL", plant), self.master("MFG_LINE_DIM"), batch, plant
        )
        reports["MFG_LINE_DIM"] = self._merge_plant("MFG_LINE_DIM", lines, plant)
        machines = self.staged("EIS_MACHINE", plant)
        added = self._append(
            "MFG_MACHINE_DIM",
            dims.dim_machine(machines, self.master("MFG_MACHINE_DIM"), batch, plant),
        )
        reports["MFG_MACHINE_DIM"] = MergeReport(0, added.inserted)
        operations = self.staged("EIS_OPERATION", plant)
        added = self._append(
            "MFG_OPERATION_DIM",
            dims.dim_operation(operations, self.master("MFG_OPERATION_DIM"), batch, plant),
        )
        reports["MFG_OPERATION_DIM"] = MergeReport(0, added.inserted)
        products = dims.merge_product(
            self.staged("EIS_PRODUCT_OVERALL", plant),
            self.staged("EIS_PRODUCT_FAMILY", plant),
            self.staged("EIS_PRODUCT_PART", plant),
            self.master("MFG_PRODUCT_DIM"),
            batch,
            plant,
            initial,
        )
        reports["MFG_PRODUCT_DIM"] = self._merge_plant("MFG_PRODUCT_DIM", products, plant)
        return reports

    def refresh_routing(self, plant: str, batch: Batch) -> LoadReport:
        """Routing steps; needs the products."""
        source = dims.routing_source(
            self.staged("EIS_ROUTING_OPERATION", plant),
            self.staged("EIS_OPERATION", plant),
            self.staged("EIS_DOCUMENT_EER", plant),
            self.staged("EIS_WIP_FA_START_OPERATION", plant),
            self.master("MFG_PRODUCT_DIM"),
            plant,
        )
        name = "MFG_ROUTING_OPERATION_DIM"
        return self._append(name, dims.dim_routing(source, self.master(name), batch, plant))

    def refresh_runcards(
        self, plant: str, batch: Batch, window: tuple[datetime, datetime] | None = None
    ) -> LoadReport:
        """Run cards created in the window, the last production day by default."""
        source = dims.runcard_source(
            self.staged("EIS_WIP_FA_RUNCARD", plant),
            self.staged("EIS_DOCUMENT_EER", plant),
            self.master("MFG_PRODUCT_DIM"),
            self.master("MFG_LINE_DIM"),
            window or production_window(batch.as_of.date()),
            batch.as_of,
            plant,
        )
        name = "SFC_RUNCARD_DIM"
        return self._append(name, dims.dim_runcard(source, self.master(name), batch, plant))

    def reload_runcards(
        self, plant: str, batch: Batch, window: tuple[datetime, datetime], whole: bool = False
    ) -> LoadReport:
        """Drop the run cards created in the window, or all of the plant, and load them again."""
        table = schemas.master_table(self.lake, "SFC_RUNCARD_DIM")
        none = self.spark.createDataFrame([], table.schema)
        if whole:
            gone = loads.replace_values(table, none, {"PLANT": plant})
        else:
            inside = (F.col("PLANT") == plant) & in_window("CREATED_DATE", window)
            gone = loads.replace_where(table, none, inside)
        return LoadReport(gone.deleted, self.refresh_runcards(plant, batch, window).inserted)

    def convert_runs(
        self,
        plant: str,
        batch: Batch,
        window: tuple[datetime, datetime] | None = None,
        latest: str = "max",
    ) -> LoadReport:
        """Rename run cards converted in the window to their current run.

        A card carries its current run, so the next window's conversions start from
        it: the work follows the window's conversions, and only blocks of keys with a
        converted card are written.
        """
        table = schemas.master_table(self.lake, "SFC_RUNCARD_DIM")
        target = table.read(self.spark).filter(F.col("PLANT") == plant)
        converted = dims.converted_runs(
            target,
            self.staged("EIS_RUNCARD_CONVERT", plant),
            self.staged("EIS_DOCUMENT_EER", plant),
            self.master("MFG_PRODUCT_DIM"),
            self.master("MFG_LINE_DIM"),
            window or production_window(batch.as_of.date()),
            plant,
            latest,
        )
        keys, changed = dims.lineage_changes(target, materialise(converted, "converted"), plant)
        return loads.replace_by_keys(table, changed, keys, keys.columns)

    # --- facts and marts ------------------------------------------------------------

    def runcard_fact(
        self, plant: str, batch: Batch, window: tuple[datetime, datetime]
    ) -> DataFrame:
        """Fact rows of a window with audit columns."""
        moves = facts.all_moves(
            self.staged("EIS_WIP_FA", plant),
            self.staged("EIS_WIP_FA_WIP_TRANS", plant),
            self.staged("EIS_WIP_FA_RUNCARD", plant),
            self.staged("EIS_DOCUMENT_EER", plant),
            self.staged("EIS_OPERATION", plant),
            self.staged("EIS_WIP_FA_START_OPERATION", plant),
            window,
            batch.as_of.date(),
            material=plant in facts.WITH_MATERIAL,
        )
        fact = facts.fact_runcard(
            moves,
            self.master("MFG_DATE_DIM"),
            self.master("MFG_LINE_DIM"),
            self.master("MFG_PRODUCT_DIM"),
            self.master("MFG_ROUTING_OPERATION_DIM"),
            self.master("SFC_RUNCARD_DIM"),
            self.master("MFG_MACHINE_DIM"),
            datetime.combine(batch.as_of.date(), datetime.min.time()),
            plant,
        )
        return facts.audited_fact(fact, batch, plant)

    def load_runcard_fact(self, plant: str, batch: Batch) -> LoadReport:
        """Daily load, replacing an earlier load of the batch."""
        rows = self.runcard_fact(plant, batch, production_window(batch.as_of.date()))
        table = schemas.process_table(self.lake, YIELD_FACT)
        session = self._fact_session(plant)
        return loads.replace_batch(table, rows, batch.batch_id, session, before=self._log_days)

    def rerun_runcard_fact(
        self, plant: str, batch: Batch, first: date, last: date
    ) -> LoadReport:
        """Replace the production days of a span; other plants keep theirs."""
        window = span_window(first, last)
        rows = self.runcard_fact(plant, batch, window)
        days = self.master("MFG_DATE_DIM").filter(
            (F.col("DATE_BEGIN") >= F.lit(first)) & (F.col("DATE_BEGIN") < F.lit(last))
        )
        keys = days.select(F.lit(self._fact_session(plant)).alias("INF_SESS_NAME"), "DATE_KEY")
        table = schemas.process_table(self.lake, YIELD_FACT)
        return loads.replace_by_keys(table, rows, keys, keys.columns, before=self._log_days)

    def reload_runcard_fact(self, plant: str, batch: Batch, start: date) -> LoadReport:
        """Initial load from ``start``, replacing all rows of the plant's session."""
        rows = self.runcard_fact(plant, batch, span_window(start, batch.as_of.date()))
        table = schemas.process_table(self.lake, YIELD_FACT)
        session = self._fact_session(plant)
        self._log_days(self.spark.range(1).select(F.lit(None).cast("int").alias("DATE_KEY")))
        return loads.replace_values(table, rows, {"INF_SESS_NAME": session})

    def build_yield_mart(self, whole: bool = False) -> LoadReport:
        """Bring the cumulative-yield mart up to date.

        Loads of the fact log the days they change before they write.  A build takes the
        days logged since the last one, reads their partitions of the fact and replaces
        theirs of the mart.  The first build, one after a reload of a session, and
        ``whole`` (after dimensions have changed) create the mart anew.  Builds and loads
        of the fact must not overlap.
        """
        changes = schemas.change_table(self.lake).read(self.spark).filter(F.col("TABLE_NAME") == YIELD_FACT)
        builds = schemas.build_table(self.lake)
        seen = scalar_max(builds.read(self.spark), "CHANGE", F.col("MART") == YIELD_MART)
        latest = scalar_max(changes, "CHANGE")
        days = changes.filter(F.col("CHANGE") > (seen or 0)).select("DATE_KEY").distinct()
        days = materialise(days, "changed-days")
        if whole or seen is None or not days.filter(F.col("DATE_KEY").isNull()).isEmpty():
            report = loads.load_full(schemas.mart_table(self.lake, YIELD_MART), self._yield_mart())
        else:
            report = self._rebuild_days(days)
        done = self.spark.createDataFrame([(YIELD_MART, latest or 0)], builds.schema)
        loads.append(builds, done)
        return report

    def _rebuild_days(self, days: DataFrame) -> LoadReport:
        dates = self.master("MFG_DATE_DIM")
        # The comparison marks the days as selective, so other partitions are skipped.
        named = days.filter(F.col("DATE_KEY") > 0)
        wanted = dates.join(named, "DATE_KEY", "left_semi").select("DATE_BEGIN")
        table = schemas.mart_table(self.lake, YIELD_MART)
        return loads.replace_by_keys(table, self._yield_mart(named), wanted, ["DATE_BEGIN"])

    def _yield_mart(self, days: DataFrame | None = None) -> DataFrame:
        """Rows of the mart, of all days or of some date keys."""
        fact = schemas.process_table(self.lake, YIELD_FACT).read(self.spark)
        if days is not None:
            fact = fact.join(days, "DATE_KEY", "left_semi")
        return marts.mart_yield(
            fact,
            self.master("MFG_ROUTING_OPERATION_DIM"),
            self.master("MFG_PRODUCT_DIM"),
            self.master("MFG_LINE_DIM"),
            self.master("MFG_DATE_DIM"),
        )

    # --- telemetry --------------------------------------------------------------------

    def load_limits(self, path: str, batch: Batch) -> LoadReport:
        """Refresh the control limits from a CSV file."""
        limits = telemetry.control_limits(read_csv(self.spark, path, schemas.LIMIT_COLUMNS))
        name = "DATA_CON_PARAM_SPEC"
        rows = with_audit(limits, name, f"master_{name}", batch, ["MachineNo", "VariableName"])
        return loads.load_full(schemas.master_table(self.lake, name), rows)

    def stream_logs(
        self,
        path: str,
        checkpoint: str,
        batch: Batch,
        zone: str | None = None,
        every: str | None = None,
        archive_dir: str | None = None,
        shadow: bool = False,
    ):
        """Stream log lines into staging, or into the trial table (``shadow``).

        Consumed files go to ``archive_dir`` once their micro-batch is committed.
        """
        table = schemas.telemetry_staging_table(self.lake, COLLECTED + ("_TEST" if shadow else ""))
        lines = stream_text(self.spark, path, archive_dir)
        events = telemetry.extract_events(lines.select("value"), zone)
        arrival = shift_zone(F.current_timestamp(), zone)
        rows = self._audited(events, table, batch, arrival)
        return stream_append(rows, table, checkpoint, every)

    def compact_logs(self, day: date) -> LoadReport:
        """Merge what the micro-batches of a past day left into one partition per machine."""
        table = schemas.telemetry_staging_table(self.lake, COLLECTED)
        rows = table.read(self.spark).filter(F.col("COLLECTED_DAY") == F.lit(day))
        return loads.replace_values(
            table, rows.withColumn(STREAM_BATCH, F.lit(COMPACTED)), {"COLLECTED_DAY": day}
        )

    def stream_messages(
        self,
        path: str,
        checkpoint: str,
        batch: Batch,
        zone: str | None = None,
        every: str | None = None,
    ):
        """Stream JSON messages into the staging table that feeds the incremental fact."""
        table = schemas.telemetry_staging_table(self.lake, ARRIVALS)
        messages = stream_json(self.spark, path, schemas.TELEMETRY_MESSAGE)
        events = telemetry.explode_values(messages)
        arrival = shift_zone(F.current_timestamp(), zone)
        rows = self._audited(events, table, batch, arrival)
        return stream_append(rows, table, checkpoint, every)

    def stage_logs(
        self, lines: DataFrame, batch: Batch, machine: str | None = None, day: date | None = None
    ) -> LoadReport:
        """Load log lines as a batch; with machine and day replace what they hold."""
        table = schemas.telemetry_staging_table(self.lake, COLLECTED)
        events = telemetry.extract_events(lines.select("value"))
        rows = self._audited(events, table, batch, session=f"{COLLECTED}_ADHOC")
        if machine is None and day is None:
            return loads.append(table, rows)
        if day is None:
            raise ValueError("a machine's lines are replaced by day: state the day")
        where = telemetry.collected_on(day, machine)
        return loads.replace_where(table, rows.filter(where), where)

    def load_events(self, batch: Batch, shadow: bool = False) -> LoadReport:
        """Add the telemetry that arrived since the last load, each row exactly once.

        The slice of arrival times is written to the control table before it is loaded,
        and its rows stand in partitions of its number.  A load that died is repeated by
        the next one with the same bounds and number, and so overwrites what it left.
        A trial (``shadow``) reads the trial staging table, matches exact variable
        names and writes the trial fact; production tables stay as they are.
        """
        table = self._events_table(shadow)
        name = COLLECTED + "_TEST" if shadow else ARRIVALS
        part = self._open_slice(name, table, batch.as_of)
        if part is None:
            return LoadReport(0, 0)
        staged = schemas.telemetry_staging_table(self.lake, name).read(self.spark)
        rows = telemetry.incremental_slice(staged, part.after, part.upto)
        source = RERUN_SOURCE if shadow else name
        events = self._event_rows(rows, batch, source, not shadow, part.number)
        report = loads.overwrite_partitions(table, events)
        self._mark_slice(name, table, part, done=True)
        return report

    def reload_events(
        self, batch: Batch, day: date, machine: str | None = None
    ) -> LoadReport:
        """Replace the telemetry of a day, of one machine (exact names) or of all.

        The rows of a machine carry the labels of a rerun, those of all machines the
        labels of an ad-hoc load.
        """
        staged = schemas.telemetry_staging_table(self.lake, COLLECTED).read(self.spark)
        rows = self._event_rows(
            staged.filter(telemetry.collected_on(day, machine)),
            batch,
            COLLECTED if machine is None else RERUN_SOURCE,
            ignore_case=machine is None,
            session=ADHOC_SESSION if machine is None else TELEMETRY_SESSION,
        )
        values = {"Date": day} if machine is None else {"MachineNo": machine, "Date": day}
        return loads.replace_values(self._events_table(False), rows, values)

    def load_spc_mart(
        self,
        day: date,
        machine: str | None = None,
        shadow: bool = False,
        limits_from_master: bool = False,
    ) -> LoadReport:
        """Replace a day of the process-control mart, of one machine or of all."""
        values = {"Date": day} if machine is None else {"MachineNo": machine, "Date": day}
        fact = self._events_table(shadow).read(self.spark)
        for name, value in values.items():
            fact = fact.filter(F.col(name) == F.lit(value))
        mart = marts.mart_spc(fact, self.master("DATA_CON_PARAM_SPEC"), limits_from_master)
        name = "DATA_CON_TRANSACTION" + ("_TEST" if shadow else "")
        table = schemas.mart_table(self.lake, name)
        return loads.replace_values(table, mart, values)

    # --- helpers --------------------------------------------------------------------

    def _open_slice(self, stream: str, target: Table, as_of: datetime) -> Slice | None:
        """The slice to load: one that was opened and not finished, else the next, else None.

        It ends with the current minute.  The control table has two rows per load, so no
        load scans its target for a maximum.
        """
        rows = schemas.slice_table(self.lake).read(self.spark)
        mine = rows.filter((F.col("STREAM") == stream) & (F.col("TARGET") == target.path))
        states = mine.groupBy("SLICE").agg(
            F.max("AFTER").alias("AFTER"), F.max("UPTO").alias("UPTO"), F.bool_or("DONE").alias("DONE")
        )
        last = states.orderBy(F.desc("SLICE")).limit(1).first()
        if last is not None and not last.DONE:
            return Slice(last.SLICE, last.AFTER, last.UPTO)
        minute = as_of.replace(second=0, microsecond=0)
        if last is not None and minute <= last.UPTO:
            return None
        new = Slice(1, None, minute) if last is None else Slice(last.SLICE + 1, last.UPTO, minute)
        self._mark_slice(stream, target, new, done=False)
        return new

    def _mark_slice(self, stream: str, target: Table, part: Slice, done: bool) -> None:
        table = schemas.slice_table(self.lake)
        row = (stream, target.path, part.number, part.after, part.upto, done)
        loads.append(table, self.spark.createDataFrame([row], table.schema))

    def _log_days(self, touched: DataFrame) -> None:
        """Note the days of the fact that a load is about to change."""
        table = schemas.change_table(self.lake)
        change = (scalar_max(table.read(self.spark), "CHANGE") or 0) + 1
        days = touched.select(F.lit(YIELD_FACT).alias("TABLE_NAME"), "DATE_KEY").distinct()
        loads.append(table, days.withColumn("CHANGE", F.lit(change)))

    def _append(self, name: str, rows: DataFrame) -> LoadReport:
        return loads.append(schemas.master_table(self.lake, name), rows)

    def _merge_plant(self, name: str, found: Merge, plant: str) -> MergeReport:
        loads.replace_values(schemas.master_table(self.lake, name), found.rows, {"PLANT": plant})
        return MergeReport(found.updated, found.inserted)

    @staticmethod
    def _fact_session(plant: str) -> str:
        return f"process_SFC_WIP_RUNCARD_FACT_{plant}"

    def _events_table(self, shadow: bool) -> Table:
        name = "FACT_DATA_CON_TRANSACTION" + ("_TEST" if shadow else "")
        return schemas.process_table(self.lake, name)

    def _event_rows(
        self,
        staged: DataFrame,
        batch: Batch,
        source: str,
        ignore_case: bool = True,
        part: int = RELOADED,
        session: str = TELEMETRY_SESSION,
    ) -> DataFrame:
        limits = self.master("DATA_CON_PARAM_SPEC")
        rows = telemetry.fact_events(staged, limits, batch, session, source, ignore_case)
        return rows.withColumn("INF_SLICE_ID", F.lit(part).cast("long"))

    @staticmethod
    def _audited(
        events: DataFrame,
        table: Table,
        batch: Batch,
        arrival: Column | None = None,
        session: str | None = None,
    ) -> DataFrame:
        session = session or table.name
        rows = telemetry.audited_events(events, session, batch, arrival=arrival)
        days = {
            "COLLECTED_DAY": F.to_date("COLLECTEDDATE"),
            "CREATE_DATE": F.to_date("DM_CREATED_DATE"),
            STREAM_BATCH: F.lit(BY_BATCH),
        }
        return rows.withColumns(days).select(*table.columns)

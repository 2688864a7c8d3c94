"""The warehouse: bronze, silver and gold tables under one root, and the build that refreshes them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from hashlib import md5

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.clock import as_of_column, label, use_utc, utc
from tidemark.operators.contract import contract_violations
from tidemark.operators.dimensions import dim_products, dim_users
from tidemark.operators.facts import fact_events, null_id_rows
from tidemark.operators.incremental import anti_append, upsert
from tidemark.operators.ingest import file_ledger, skip_ingested_files, to_bronze, with_lineage
from tidemark.operators.marts import GRAIN, marketing_report, on_dates
from tidemark.operators.quality import (
    duplicate_mart_grain,
    fact_totals_by_date,
    failed_fact_checks,
    metrics_from,
    summary_of_totals,
)
from tidemark.sources.csv_files import by_header, file_lines, list_csv, read_events, rejected_rows
from tidemark.sources.files import delete, exists, move_into
from tidemark.sources.json_messages import decode_events, malformed_messages
from tidemark.sources.tables import Table

MART_MODES = ("merge", "replace_dates")


class QualityError(Exception):
    """A check found violations. Tables built before it are kept, later ones are not built."""

    def __init__(self, violations: dict[str, int]):
        super().__init__(f"Data quality checks failed: {violations}")
        self.violations = violations


@dataclass
class BuildResult:
    as_of: datetime
    fact_rows: int
    violations: dict[str, int] = field(default_factory=dict)


def by_date(rows: DataFrame, column: str = "event_date") -> DataFrame:
    """Rows of a date meet in few files; AQE splits a date that is too large for one task."""
    return rows.hint("rebalance", F.col(column))


class Warehouse:
    """Bronze, silver and gold. One ingest or build writes at a time; readers may come at any time.

    Every table is one folder of Parquet files in Spark's own partitions: bronze, quarantine and ledger by load, the
    fact by event date, the mart by report date. Builds overwrite the dates they touch and no others, so the number
    of files follows the dates, not the builds.

    A load counts once its files stand in the ledger, which is written last; a build consumes the loads of the ledger
    that no finished build took. The build log tells how far builds came. Of a build that was given up, the next one
    takes the loads again and replaces what was written of it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        null_id: str = "collapse",
        mart_mode: str = "merge",
        on_violation: str = "raise",
    ):
        """
        ``null_id``: keep one row without event id per build (``collapse``) or set all aside (``quarantine``).
        ``mart_mode``: ``merge`` keeps mart rows whose group no longer occurs on a recomputed date, as a merge
        without delete does; ``replace_dates`` drops them.
        ``on_violation``: ``raise`` stops before gold, ``record`` only reports.
        """
        if mart_mode not in MART_MODES:
            raise ValueError(f"mart_mode must be one of {MART_MODES}")
        use_utc(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.null_id = null_id
        self.mart_mode = mart_mode
        self.on_violation = on_violation
        load, build, step = (T.StructField(c, T.StringType()) for c in ("load", "build", "step"))
        event_date, report_date = (T.StructField(c, T.DateType()) for c in ("event_date", "report_date"))
        self.ledger = self._table("ingest_ledger", schemas.LEDGER, load)
        self.bronze = self._table("bronze_raw_events", schemas.BRONZE, load, self._loads)
        self.quarantine = self._table("bronze_quarantine", schemas.QUARANTINE, load, self._loads)
        self.log = self._table("build_log", schemas.BUILD_LOG, step)
        self.consumed = self._table("consumed_loads", schemas.CONSUMED, build, self._finished)
        self.touched = self._table("touched_dates", schemas.TOUCHED, build)
        self.staged = self._table("staged_events", schemas.FACT_EVENTS, event_date)
        self.fresh = self._table("fresh_events", schemas.FACT_EVENTS, event_date)
        self.fact = self._table("fact_events", schemas.FACT_EVENTS, event_date)
        self.totals = self._table("fact_totals", schemas.FACT_TOTALS, event_date)
        self.null_ids = self._table("fact_events_without_id", schemas.FACT_EVENTS, build, self._finished)
        self.products = self._table("dim_products", schemas.DIM_PRODUCTS)
        self.users = self._table("dim_users", schemas.DIM_USERS)
        self.mart = self._table("marketing_report", schemas.MARKETING_REPORT, report_date)
        self.metrics = self._table("dq_pipeline_metrics", schemas.DQ_METRICS)

    def _table(self, name: str, schema: T.StructType, partition: T.StructField | None = None, committed=None) -> Table:
        return Table(self.spark, self.root, name, schema, partition, committed)

    def _loads(self) -> DataFrame:
        return self.ledger.read().select("load").distinct()

    def _finished(self) -> DataFrame:
        """Builds whose silver tables are whole."""
        return self.log.read().where("phase = 'silver'").select("build")

    # -- ingest

    def append_bronze(self, rows: DataFrame, load: str, rejected: DataFrame | None = None) -> bool:
        """Add rows with lineage columns as one load; repeating a load changes nothing.

        ``rejected`` (value and lineage columns) goes to quarantine with it. The ledger gets one row per file name.
        """
        if self._knows(load):
            return False
        self._write_load(rows, rejected, load)
        loaded = self.bronze_of([load])
        aside = self._of(self.quarantine, [load]) if rejected is not None else None
        self.ledger.write(file_ledger(loaded, aside).withColumn("load", F.lit(load)).coalesce(1))
        return True

    def append_messages(self, messages: DataFrame, load: str) -> bool:
        """Add the well-formed messages of ``value`` as one load and set the others aside.

        Both are counted while the load is written, so the ledger's row costs no job, and only a load with malformed
        messages is read a second time.
        """
        if self._knows(load):
            return False
        every, good = Observation(), Observation()
        count = F.count(F.lit(1)).alias("rows")
        decoded = decode_events(messages.observe(every, count)).observe(good, count)
        self._write_load(with_lineage(decoded, load, None), None, load)
        loaded, rejected = good.get["rows"], every.get["rows"] - good.get["rows"]
        if rejected:
            aside = with_lineage(malformed_messages(messages), load, None)
            self.quarantine.write(aside.withColumn("load", F.lit(load)))
        now = self.spark.createDataFrame([(load, loaded, rejected, load)], "_file_name string, rows_loaded long, rows_rejected long, load string")
        self.ledger.write(now.withColumn("_ingested_at", as_of_column(None)).coalesce(1))
        return True

    def _knows(self, load: str) -> bool:
        return not self.ledger.read().where(F.col("load") == load).isEmpty()

    def _write_load(self, rows: DataFrame, rejected: DataFrame | None, load: str) -> None:
        if rejected is not None:
            self.quarantine.write(rejected.withColumn("load", F.lit(load)))
        self.bronze.write(to_bronze(rows).withColumn("load", F.lit(load)))

    def bronze_of(self, loads: list[str]) -> DataFrame:
        """The rows of some loads, by a partition filter, whether the ledger has them yet or not."""
        return self._of(self.bronze, loads)

    def _of(self, table: Table, loads: list[str]) -> DataFrame:
        return Table(self.spark, self.root, table.path.rsplit("/", 1)[1], table.schema, table.schema["load"]).read().where(
            F.col("load").isin(loads)
        )

    def ingest_csv(
        self,
        directory: str,
        as_of: datetime,
        archive_dir: str | None = None,
        on_bad_row: str = "raise",
        multi_line: bool = False,
        on_bad_layout: str = "raise",
    ) -> dict[str, int]:
        """Load the directory's CSV files that the ledger does not know by name; rows per loaded file.

        Only files whose load is whole move to ``archive_dir``; skipped files stay where they are (``known_files``
        lists them). See ``load_files`` for the rest.
        """
        paths = [r.path for r in skip_ingested_files(list_csv(self.spark, directory), self.ledger.read()).collect()]
        return self.load_files(paths, as_of, archive_dir, on_bad_row, multi_line, on_bad_layout)

    def load_files(
        self,
        paths: list[str],
        as_of: datetime | None,
        archive_dir: str | None = None,
        on_bad_row: str = "raise",
        multi_line: bool = False,
        on_bad_layout: str = "raise",
    ) -> dict[str, int]:
        """Load CSV files; rows per file.

        Files of one header are one load, whose label tells the files, so that a repetition replaces what a lost job
        left. Rows that do not fit the header fail the call, or go to the quarantine table with
        ``on_bad_row="quarantine"``. A file without the required columns raises after the other files are loaded, or
        goes to quarantine line by line with ``on_bad_layout="quarantine"``. The ledger gets a row for each file,
        also for one without a single good row, and is what tells that a file was loaded.
        """
        counts: dict[str, int] = {}
        errors: list[Exception] = []
        for group in by_header(self.spark, paths):
            load = f"csv_{md5(chr(10).join(sorted(group)).encode()).hexdigest()}"
            rejected = None
            try:
                rows = read_events(self.spark, group, multi_line=multi_line, on_bad_row=on_bad_row)
                if on_bad_row == "quarantine":
                    rejected = rejected_rows(self.spark, group, multi_line=multi_line)
            except ValueError as error:
                if on_bad_layout != "quarantine":
                    errors.append(error)
                    continue
                rows, rejected = None, file_lines(self.spark, group)
            names = self.spark.createDataFrame([(p.rsplit("/", 1)[1],) for p in group], "_file_name string")
            if rejected is not None:
                rejected = with_lineage(rejected, F.col("_file_name"), as_of)
            empty = self.spark.createDataFrame([], schemas.BRONZE)
            self._write_load(empty if rows is None else with_lineage(rows, F.col("_file_name"), as_of), rejected, load)
            aside = None if rejected is None else self._of(self.quarantine, [load])
            entries = file_ledger(self.bronze_of([load]), aside, names, as_of)
            self.ledger.write(entries.withColumn("load", F.lit(load)).coalesce(1))
            if archive_dir:
                move_into(self.spark, group, archive_dir)
            done = self.ledger.read().where(F.col("load") == load)
            counts |= {r["_file_name"]: r["rows_loaded"] for r in done.collect()}
        if errors:
            raise ValueError(f"Files not loaded: {[str(e) for e in errors]}") from errors[0]
        return counts

    def known_files(self, directory: str) -> list[str]:
        """Names of the directory's CSV files that an ingest passes over because the ledger holds them."""
        listed = list_csv(self.spark, directory).select("_file_name")
        known = listed.join(self.ledger.read(), "_file_name", "left_semi").distinct()
        return sorted(r["_file_name"] for r in known.collect())

    # -- build

    def build(self, as_of: datetime, full_refresh: bool = False) -> BuildResult:
        """Refresh silver, check it, refresh gold. Each layer is written before the next reads it.

        ``as_of`` stamps every row and may not go back from build to build. A build that was interrupted may be
        repeated with its own ``as_of``, or left to the next one, and goes on where it stopped; an interrupted full
        refresh is made anew. A full refresh takes all of bronze, whatever time it is stamped with.
        """
        for table in (self.fact, self.products, self.users, self.mart):
            table.settle()
        log = self.log.read().collect()
        done = {phase: sorted(r["build"] for r in log if r["phase"] == phase) for phase in ("refresh", "silver", "gold")}
        newest = {phase: builds[-1] if builds else "" for phase, builds in done.items()}
        build = label(as_of)
        if build < newest["silver"]:
            raise ValueError(f"build at {as_of} is not after the last build, {newest['silver']}")
        full_refresh = full_refresh or not newest["silver"] or newest["refresh"] > newest["silver"]
        if full_refresh:
            self._note("refresh", build, as_of)
            for phase in ("silver", "gold"):
                delete(self.spark, f"{self.log.path}/step={build}_{phase}")
        if full_refresh or build not in done["silver"]:
            mark = max((utc(r["as_of"]) for r in log if r["phase"] == "silver"), default=None)
            self._build_silver(build, as_of, mark, full_refresh)
        whole = full_refresh or newest["refresh"] > newest["gold"]
        dates = self.touched.read().where(F.col("build") > newest["gold"]).select("event_date").distinct()
        if whole:
            self.totals.write(fact_totals_by_date(self.fact.read()), whole=True)
        else:
            self.totals.write(fact_totals_by_date(self._on_dates(dates)))
        summary = summary_of_totals(self.totals.read()).first()
        violations = failed_fact_checks(summary)
        drift = self.contract_violations(None if whole else dates).count()
        if drift:
            violations["contract"] = drift
        self._stop_on(violations)

        self._build_mart(as_of, None if whole else dates)
        # Groups of other dates were checked when these were written.
        fresh = self.mart.read().where(F.col("_refreshed_at") == as_of_column(as_of))
        surplus = duplicate_mart_grain(fresh).agg(F.sum(F.col("row_count") - 1)).first()[0]
        if surplus:
            violations["mart_grain_unique"] = surplus
            self._stop_on(violations)

        one_row = self.spark.createDataFrame([summary], summary_of_totals(self.totals.read()).schema)
        self.metrics.write(metrics_from(one_row, as_of).coalesce(1))
        self._note("gold", build, as_of)
        built = self.log.read().where((F.col("phase") == "silver") & (F.col("build") == build)).first()
        return BuildResult(as_of, built["fact_rows"], violations)

    def _note(self, phase: str, build: str, as_of: datetime, fact_rows: int | None = None) -> None:
        row = self.spark.createDataFrame([(phase, build, utc(as_of), fact_rows, f"{build}_{phase}")], self.log.schema)
        self.log.write(row.coalesce(1))

    def _build_silver(self, build: str, as_of: datetime, mark: datetime | None, full_refresh: bool) -> None:
        """Fact and dimensions from the loads that no finished build took, or from all for a full refresh."""
        loads = self._loads()
        if not full_refresh:
            loads = loads.join(self.consumed.read(), "load", "left_anti")
        labels = sorted(r["load"] for r in loads.collect())
        delta = self.bronze_of(labels)
        if labels or full_refresh:
            fact_rows = self._build_fact(delta, build, as_of, mark, full_refresh)
            self._build_dimension(self.products, dim_products, "product_id", delta, full_refresh)
            self._build_dimension(self.users, dim_users, "user_id", delta, full_refresh)
            if self.null_id == "quarantine":
                aside = null_id_rows(delta).withColumns({"_loaded_at": as_of_column(as_of), "build": F.lit(build)})
                self.null_ids.write(aside, whole=full_refresh)
            taken = self.spark.createDataFrame([(x, build) for x in labels], self.consumed.schema).coalesce(1)
            self.consumed.write(taken)
        else:
            fact_rows = 0
        self._note("silver", build, as_of, fact_rows)

    def _build_fact(self, delta: DataFrame, build: str, as_of: datetime, mark: datetime | None, full_refresh: bool) -> int:
        """Replace the dates that get new rows by what finished builds left there and the new rows."""
        event_date = F.to_date("event_timestamp")
        rows = fact_events(delta, as_of, null_id=self.null_id).withColumn("event_date", event_date)
        if full_refresh:
            self.fact.write(by_date(rows), whole=True)
            return self.fact.read().count()
        # The deduplicated delta is used for its dates and its rows.
        self.staged.write(by_date(rows), whole=True)
        staged = self.staged.read()
        finished = F.col("_loaded_at") <= as_of_column(mark)
        # Equal ids have equal event times, so history is read on the delta's dates only.
        history = self._on_dates(staged.where("_loaded_at IS NOT NULL").select("event_date").distinct()).where(finished)
        self.fresh.write(by_date(anti_append(staged, history, "event_id")), whole=True)
        fresh = self.fresh.read()
        # The dates of a build that was given up are written again as well, without its rows.
        lost = self.touched.read().join(self._finished(), "build", "left_anti").select("event_date")
        dates = fresh.select("event_date").unionByName(lost).distinct()
        self.touched.write(dates.withColumn("build", F.lit(build)).coalesce(1))
        own = self.touched.read().where(F.col("build") == build).select("event_date")
        self.fact.rewrite(by_date(self._on_dates(own).where(finished).unionByName(fresh)))
        return fresh.count()

    def _build_dimension(self, table: Table, latest, key: str, delta: DataFrame, full_refresh: bool) -> None:
        if full_refresh:
            table.write(latest(delta))
        else:
            table.rewrite(upsert(table.read(), latest(delta), [key]))

    def _build_mart(self, as_of: datetime, dates: DataFrame | None) -> None:
        products = self.products.read()
        if dates is None:
            self.mart.write(marketing_report(self.fact.read(), products, as_of), whole=True)
            return
        report_dates = dates.withColumnRenamed("event_date", "report_date")
        report = marketing_report(on_dates(self.fact.read(), report_dates), products, as_of)
        if self.mart_mode == "merge":
            before = self.mart.read().join(report_dates, "report_date", "left_semi")
            self.mart.rewrite(by_date(upsert(before, report, GRAIN), "report_date"))
        else:
            self.mart.write(by_date(report, "report_date"))

    def _on_dates(self, dates: DataFrame) -> DataFrame:
        """Facts of the given ``event_date`` values, NULL included: a semi-join by which Spark prunes partitions when
        it runs, and the partition without a date if it is asked for."""
        fact = self.fact.read()
        dated = fact.join(dates, "event_date", "left_semi").select(*fact.columns)
        without: Column = F.col("event_date").isNull()
        return dated if dates.where(without).isEmpty() else dated.unionByName(fact.where(without))

    # -- guards

    def contract_violations(self, dates: DataFrame | None = None) -> DataFrame:
        """What silver files say of themselves against the contract: both dimensions, and the fact, whole or only the
        partitions of ``event_date`` values that a build touched."""
        paths = [self.fact.path]
        if dates is not None:
            paths = [self.fact.partition_path(r["event_date"]) for r in dates.collect()]
        of_fact = contract_violations(self.spark, "fact_events", [p for p in paths if exists(self.spark, p)], "event_date")
        of_products = contract_violations(self.spark, "dim_products", [self.products.path])
        return of_fact.unionByName(of_products).unionByName(contract_violations(self.spark, "dim_users", [self.users.path]))

    def _stop_on(self, violations: dict[str, int]) -> None:
        if violations and self.on_violation == "raise":
            raise QualityError(violations)

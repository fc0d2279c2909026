"""The whole run: extracts, staging, history, intermediate tables, marts, checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultspan.functions import stamp
from vaultspan.operators.asof import AsOfIndex
from vaultspan.operators.calendar import Calendar, month_end_calendar
from vaultspan.operators.incremental import upsert
from vaultspan.operators.quality import Observed, run_checks
from vaultspan.operators.scd2 import roll_open_versions
from vaultspan.plans import intermediate, marts
from vaultspan.plans.check_state import CheckState, Growing
from vaultspan.plans.checks import declared_checks
from vaultspan.plans.point_in_time import MonthlyTable, changed_codes, maintained, months_showing, touched_months
from vaultspan.plans.staging import Run, StagedFact, stage_upsert
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.schemas import DIMENSIONS, FACTS, RATES
from vaultspan.types import assert_same_columns

RUN_LOG = "run_log"
ROW_COUNTS = "check_row_counts"

# The date a fact is filed under.
FACT_DAY = {"fct_ast": "dt_fct", "fct_ptf": "dt_fct", "fct_ope": "dt_cta", "fct_mvt": "dt_cta"}

# Tables that runs add to, the versions of clients and portfolios, and tables kept by month; all others are written whole
# by each run.
APPENDED = tuple(f"{layer}_{name}" for layer in ("stg", "int") for name in FACTS)
HISTORIES = ("history_cli", "history_ptf")
MONTHLY = ("int_cli", "int_ptf")
OPEN = "_open"

CONVERT: dict[str, Callable[..., DataFrame]] = {
    "fct_ast": intermediate.int_fct_ast,
    "fct_ptf": intermediate.int_fct_ptf,
    "fct_ope": intermediate.int_fct_ope,
    "fct_mvt": intermediate.int_fct_mvt,
}


def _split_history(versions: DataFrame) -> DataFrame:
    """Versions with the column they are stored apart by: 1 while open, 0 once closed."""
    return versions.withColumn(OPEN, F.col("valid_to").isNull().cast("int"))


def _whole_history(store: LoadedTable, attempts: list[str], schema: StructType) -> DataFrame:
    """The closed versions of all attempts and the open ones of the last."""
    closed = store.read(attempts, schema).filter(F.col(OPEN) == 0)
    return closed.unionByName(store.read(attempts[-1:], schema).filter(F.col(OPEN) == 1)).drop(OPEN)


@dataclass(frozen=True)
class Settings:
    """Start of the calendar, reporting date and optional year of the asset marts.

    A ``full_refresh`` stages and converts as if nothing had been staged before,
    so ids start from 1 and corrected rates reach all facts. The history of
    clients and portfolios cannot be rebuilt from an extract and goes on.
    """

    start_date: date
    as_of: date
    aum_year: int | None = None
    full_refresh: bool = False


@dataclass(frozen=True, order=True)
class Finished:
    """A finished run: its time, the folder its last attempt wrote, and whether it started anew."""

    run_ts: str
    run_id: str
    attempt: str
    full_refresh: bool


def finished_runs(spark: SparkSession, root: str) -> list[Finished]:
    """Finished runs in the order of their time; of a repeated run only the last attempt counts.

    The log has one row per attempt that came to its end.
    """
    log = LoadedTable(spark, f"{root}/{RUN_LOG}")
    entries = log.read(log.loads())
    last = {}
    for row in sorted(entries.collect() if entries is not None else [], key=lambda r: r["number"]):
        last[row["run_id"]] = Finished(row["run_ts"], row["run_id"], row["attempt"], row["full_refresh"])
    return sorted(last.values())


def _since_refresh(runs: list[Finished]) -> list[str]:
    """Attempts from the last full refresh on: those that make up an append-only table."""
    starts = [i for i, run in enumerate(runs) if run.full_refresh]
    return [run.attempt for run in runs[starts[-1] if starts else 0 :]]


class Pipeline:
    """One run over the state below ``root``.

    Every attempt at a run writes each table once, into a folder of its own,
    and reads it back from there. An attempt counts only after its last step
    has been logged. One that fails half-way leaves nothing that is ever
    read, also when it repeats a finished run, and repeating it is safe.
    """

    def __init__(
        self, spark: SparkSession, extract: Callable[[str], DataFrame], root: str, run: Run, settings: Settings
    ) -> None:
        self.spark = spark
        self.extract = extract
        self.root = root
        self.run = run
        self.settings = settings
        self.attempt = f"{run.run_id}.{uuid4().hex[:12]}"
        self.run_ts = run.run_ts.isoformat(timespec="microseconds")
        before = [r for r in finished_runs(spark, root) if r.run_id != run.run_id]
        later = [r.run_id for r in before if r.run_ts >= self.run_ts]
        if later:
            raise ValueError(f"run {run.run_id} is older than finished runs {later}")
        self.before = [r.attempt for r in before]
        self.times = [(r.attempt, r.run_ts) for r in before]
        self.earlier = [] if settings.full_refresh else _since_refresh(before)
        self.tables: dict[str, DataFrame] = {}
        self.checks = declared_checks()
        self.violations: dict[str, int] = {}
        self.parts: dict[str, DataFrame] = {}
        self.growing = {
            f"{layer}_{name}": Growing.at(spark, f"{root}/{layer}_{name}", table.key, table.id_column if layer == "stg" else None)
            for name, table in FACTS.items()
            for layer in ("stg", "int")
        }

    def stored(self, name: str) -> LoadedTable:
        return LoadedTable(self.spark, f"{self.root}/{name}")

    def newest(self, name: str) -> DataFrame | None:
        """The version the last finished run wrote."""
        return self.stored(name).read(self.earlier[-1:])

    def appended(self, name: str) -> DataFrame | None:
        """Everything finished runs appended."""
        return self.stored(name).read(self.earlier)

    def keep(self, name: str, rows: DataFrame, by: list[str | Column] | None = None) -> DataFrame:
        """Store this run's version of a table."""
        self.tables[name] = self._write(name, rows, by or ())
        return self.tables[name]

    def _write(self, name: str, rows: DataFrame, by: Sequence[str | Column]) -> DataFrame:
        """Write this run's rows of a table; the same job counts what breaks its row rules."""
        observed = Observed([c for c in self.checks if c.table == name])
        part = self.stored(name).write(self.attempt, rows, by, watch=observed.watch)
        self.violations |= observed.violations()
        return part

    def append(self, name: str, rows: DataFrame, day: str) -> DataFrame:
        """Store and index this run's part of an append-only table; returns that part.

        Columns that differ from those stored before are refused.
        """
        held = self.appended(name)
        if held is not None:
            assert_same_columns(held, rows, name)
        part = self.parts[name] = self._write(name, rows, [F.trunc(day, "MM")])
        self.growing[name].index.add(self.attempt, part)
        self.tables[name] = self.stored(name).read([*self.earlier, self.attempt])
        return part

    # Layers

    def stage(self) -> dict[str, DataFrame]:
        """Code tables, rates and calendar are merged; facts only grow. Returns the new facts."""
        for table in (*DIMENSIONS.values(), RATES):
            self.keep(table.staged, stage_upsert(self.extract(table.name), table, self.run, self.newest(table.staged)))
        days = month_end_calendar(self.spark, self.settings.start_date, self.settings.as_of)
        self.keep("stg_set_cal", upsert(self.newest("stg_set_cal"), days, "dt_fct"))
        fresh = {}
        for name, table in FACTS.items():
            staged = StagedFact(self.spark, f"{self.root}/{table.staged}", table)
            rows = staged.fresh(self.extract(name), self.run, self.earlier)
            fresh[name] = self.append(table.staged, rows, FACT_DAY[name])
        return fresh

    def roll(self, name: str) -> tuple[date | None, Callable[[date | None], DataFrame]]:
        """Roll the open versions of clients or portfolios.

        Returns the first day that a version closed or opened by this run covers, and the versions
        in force on or after a day. Each run stores the versions it closed apart from those it leaves
        open, so the open ones of one run and the closed ones of the runs since that day are read.
        """
        store, batch, key = self.stored(f"history_{name}"), self.tables[f"stg_{name}"], f"cd_{name}"
        schema = _split_history(roll_open_versions(None, batch, key, "ts_stg")).schema
        last = store.read(self.before[-1:], schema)
        still_open = None if last is None else last.filter(F.col(OPEN) == 1).drop(OPEN)
        rolled = store.write(self.attempt, _split_history(roll_open_versions(still_open, batch, key, "ts_stg")), split=OPEN)
        moved = (F.col(OPEN) == 0) | (F.col("valid_from") >= stamp(self.run.run_ts))
        since = rolled.where(moved).agg(F.to_date(F.min("valid_from")).alias("day")).first()["day"]

        def versions(day: date | None) -> DataFrame:
            # a version ends at the time of the run that closed it
            late = [a for a, ts in self.times if day is None or ts[:10] >= day.isoformat()]
            return _whole_history(store, [*late, self.attempt], schema)

        return since, versions

    def point_in_time(self, name: str, calendar: Calendar, lookups: dict[str, DataFrame]) -> None:
        """Clients or portfolios per calendar date; only the months that this run changes are written."""
        table, labels, build = {
            "cli": ("int_cli", intermediate.CLIENT_LABELS, intermediate.int_cli),
            "ptf": ("int_ptf", intermediate.PORTFOLIO_LABELS, intermediate.int_ptf),
        }[name]
        store, before = MonthlyTable(self.spark, f"{self.root}/{table}"), self.earlier[-1] if self.earlier else None
        since, versions = self.roll(name)
        touched = None
        if before is not None:
            changed = {
                code: changed_codes(self.newest(f"stg_{lookup}"), lookups[lookup], f"cd_{lookup}", columns)
                for code, (lookup, columns) in labels.items()
            }
            shown = months_showing(store.read(before), changed)
            touched = touched_months(calendar, self.newest("stg_set_cal"), since, shown)
        by = ["dt_fct", f"cd_{name}"]
        built = lambda part: build(versions(part.first and part.first.replace(day=1)), part, lookups)
        self.tables[table] = maintained(store, self.attempt, before, calendar, touched, built, by)

    def convert(self, name: str, fresh: DataFrame, rates: AsOfIndex) -> None:
        """Convert the new facts, and earlier ones whose portfolio was unknown until now.

        A staged fact is either converted or waiting, so only the waiting ones
        and the new ones are looked at, never the whole table.
        """
        waiting = self.newest(f"waiting_{name}")
        candidates = fresh if waiting is None else waiting.unionByName(fresh)
        portfolios = self.tables["stg_ptf"]
        self.append(f"int_{name}", CONVERT[name](candidates, portfolios, rates), FACT_DAY[name])
        self.keep(f"waiting_{name}", candidates.join(portfolios.select("cd_ptf"), "cd_ptf", "left_anti"))

    def intermediate(self, fresh: dict[str, DataFrame]) -> Calendar:
        calendar = Calendar.of(self.tables["stg_set_cal"])
        lookups = {name: self.tables[f"stg_{name}"] for name in DIMENSIONS}
        self.tables["int_set_cal"] = intermediate.int_set_cal(calendar.days)
        self.point_in_time("cli", calendar, lookups)
        self.point_in_time("ptf", calendar, lookups)
        self.keep("int_ins", intermediate.int_ins(lookups["ins"], lookups["ins_grp"]))
        rates = intermediate.rate_index(self.tables["stg_fct_xrt"])
        for name, rows in fresh.items():
            self.convert(name, rows, rates)
        return calendar

    def marts(self, calendar: Calendar) -> None:
        t, as_of, year, now = self.tables, self.settings.as_of, self.settings.aum_year, self.run.run_ts
        positions, ins, cli, ptf = t["int_fct_ast"], t["int_ins"], t["int_cli"], t["int_ptf"]
        built = {
            "mart_aum_ytd": marts.mart_aum_ytd(positions, cli, ptf, calendar, as_of, year, now),
            "mart_client_exposure": marts.mart_client_exposure(positions, cli, ptf, ins),
            "mart_portfolio_performance": marts.mart_portfolio_performance(positions, ptf, ins, now),
            "mart_ptf_detail": marts.mart_ptf_detail(t["int_fct_ptf"], ptf),
            "mart_rm_performance": marts.mart_rm_performance(positions, cli, ptf, calendar, as_of, year, now),
        }
        for name, rows in built.items():
            self.keep(name, rows, marts.layout(name))

    def counted(self) -> dict[str, int]:
        """Violations of row rules by check, as counted when the rows were written.

        The counts of each attempt are stored. Those of a table that only grows are added up, so
        its earlier loads are not read again. A rule that some load was not counted for is left out.
        """
        store = self.stored(ROW_COUNTS)
        held = set(store.loads()) if self.earlier else set()
        attempts = [a for a in self.earlier if a in held]
        earlier: dict[str, int] = {}
        if attempts and len(attempts) == len(self.earlier):
            sums = store.read(attempts).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("violations").alias("violations"))
            # a row per declared check
            earlier = {r["name"]: r["violations"] for r in sums.where(F.col("n") == len(attempts)).collect()}
        grows = {c.name for c in self.checks if c.table in APPENDED} if self.earlier else set()
        return {
            name: found + (earlier[name] if name in grows else 0)
            for name, found in self.violations.items()
            if name not in grows or name in earlier
        }

    def check(self) -> DataFrame:
        state = CheckState(self.spark, self.root, self.checks, self.growing)
        counted = self.counted() | state.carry(self.attempt, self.earlier, self.parts, self.tables.__getitem__)
        own = self.spark.createDataFrame(list(self.violations.items()), "name string, violations bigint")
        self.stored(ROW_COUNTS).write(self.attempt, own.coalesce(1))
        return self.keep("check_summary", run_checks(self.checks, self.tables.__getitem__, counted))

    def finish(self) -> None:
        """Log the attempt; from now on it counts."""
        log = self.stored(RUN_LOG)
        entry = (len(log.loads()), self.run.run_id, self.attempt, self.run_ts, self.settings.full_refresh)
        columns = ("number", "run_id", "attempt", "run_ts", "full_refresh")
        line = self.spark.range(1).select(*(F.lit(value).alias(name) for name, value in zip(columns, entry)))
        log.write(self.attempt, line.coalesce(1))

    def execute(self) -> DataFrame:
        """All layers in order; returns one row per declared check."""
        fresh = self.stage()
        calendar = self.intermediate(fresh)
        self.marts(calendar)
        summary = self.check()
        self.finish()
        return summary


def run_pipeline(
    spark: SparkSession, extract: Callable[[str], DataFrame], root: str, run: Run, settings: Settings
) -> DataFrame:
    """Run every layer once; see ``Pipeline``."""
    return Pipeline(spark, extract, root, run, settings).execute()


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as the last finished run left it; an append-only one with all that runs appended."""
    runs = finished_runs(spark, root)
    if not runs:
        raise ValueError(f"no finished run below {root}")
    table = LoadedTable(spark, f"{root}/{name}")
    if name in APPENDED:
        return table.read(_since_refresh(runs))
    if name in MONTHLY:
        return MonthlyTable(spark, f"{root}/{name}").read(runs[-1].attempt)
    if name in HISTORIES:
        key = name.removeprefix("history_")
        staged = LoadedTable(spark, f"{root}/stg_{key}").read([runs[-1].attempt])
        schema = _split_history(roll_open_versions(None, staged, f"cd_{key}", "ts_stg")).schema
        return _whole_history(table, [run.attempt for run in runs], schema)
    return table.read([runs[-1].attempt])

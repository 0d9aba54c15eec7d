"""Where landed tables live: catalog tables of a namespace, or Parquet folders under a shared root.

Every write goes to a place of its own, and a version of the store (``dropforge.sinks.manifest``) says which places
count. ``Store.commit()`` collects the writes of a run and publishes them together, so a run that fails or is killed
leaves every table and its history as they were, a day that was loaded before included.

A version holds ``history``: by table and day the loads that count, with their numbers of rows and their columns (one
load a day, more where drops are added as they come), ``tables``: by name the day whose last load is the current table,
or the write of a table that was saved by itself, and ``streams``: the last batch that each stream has loaded.

    <root>/z<table>/date_ingestion=<day>/load=<id>    a load, in the history and, for the current day, the table
    <root>/<table>/save=<id>                          a table that was saved by itself
    <root>/_versions/v<number>.json                   the versions

In a namespace the loads are partitions of the catalog table ``z<table>__loads``, and the versions lie under the
database. ``z<table>`` and ``<table>`` are views over it for SQL; they are replaced one by one right after a commit. A
table saved by itself is a plain table there, and is replaced when it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dropforge.sinks.manifest import Manifests
from dropforge.sources.schemas import SOURCES, Source

HISTORY_PREFIX = "z"
INGESTED_ON = "date_ingestion"
LOAD, SAVE = "load", "save"
LOADS = "__loads"
_SHAPING = Lock()


def _id() -> str:
    return f"r{uuid.uuid4().hex}"  # a letter first, so that no reader takes it for a number


@dataclass
class Commit:
    """Writes of one run: each one is there when its call returns, none is seen before the run is published."""

    store: Store
    changes: list[tuple[str, str, str | None, dict]] = field(default_factory=list)

    def append_history(self, df: DataFrame, table: str, day: date, *, beside: bool = False) -> int:
        """Add a load to the history of ``table``, in place of those of that day or ``beside`` them; gives its number of rows."""
        counted, load_id = Observation(), _id()
        self.store._write_load(df.observe(counted, F.count(F.lit(1)).alias("rows")), table, day, load_id)
        rows = counted.get["rows"]
        entry = {LOAD: load_id, "rows": rows, "columns": df.columns}
        self.changes.append(("added" if beside else "history", table, day.isoformat(), entry))
        return rows

    def load(self, df: DataFrame, table: str, day: date, *, beside: bool = False) -> int:
        """Make ``df`` a load of ``day`` and the current table. Its rows are written once, into the history."""
        rows = self.append_history(df, table, day, beside=beside)
        self.changes.append(("tables", table, None, {"day": day.isoformat()}))
        return rows

    def save(self, df: DataFrame, table: str) -> None:
        """Replace a table by itself."""
        self.changes.append(("tables", table, None, self.store._write_table(df, table, _id())))

    def declare(self, source: Source) -> None:
        """Create the table of a source if it is not there yet."""
        if not self.store.has(source.name):
            self.save(self.store.spark.createDataFrame([], source.schema), source.name)

    def written(self, table: str, day: date) -> DataFrame:
        """The load of ``table`` for ``day`` that this run has written last, published or not."""
        own = [e for kind, name, on, e in self.changes if kind in ("history", "added") and (name, on) == (table, day.isoformat())]
        return self.store._load_files(table, day.isoformat(), own[-1])

    def passed(self, stream: str, batch: int) -> None:
        """Keep with the loads of this run that ``stream`` has got as far as ``batch``."""
        self.changes.append(("streams", stream, None, {"batch": batch}))

    def apply(self, version: dict) -> None:
        for kind, name, day, entry in self.changes:
            if kind in ("tables", "streams"):
                version[kind][name] = entry
                continue
            days = version["history"].setdefault(name, {})
            days[day] = [*days.get(day, []), entry] if kind == "added" else [entry]


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    namespace: str | None = None
    root: str | None = None

    # ---- Places ----

    def _location(self, table: str) -> str:
        if self.root:
            return f"{self.root.rstrip('/')}/{table}"
        return f"{self.namespace}.{table}" if self.namespace else table

    def _load_folder(self, table: str, day: str, load_id: str) -> str:
        return f"{self._location(HISTORY_PREFIX + table)}/{INGESTED_ON}={day}/{LOAD}={load_id}"

    def _load_files(self, table: str, day: str, entry: dict) -> DataFrame:
        if self.root:
            return self.spark.read.parquet(self._load_folder(table, day, entry[LOAD]))
        own = self.spark.table(self._loads(table)).where((F.col(INGESTED_ON) == F.lit(day).cast("date")) & (F.col(LOAD) == entry[LOAD]))
        return own.select(*[F.col(f"`{c}`") for c in entry["columns"]])

    def _loads(self, table: str) -> str:
        return self._location(HISTORY_PREFIX + table + LOADS)

    @cached_property
    def _home(self) -> str:
        return self.root or self.spark.catalog.getDatabase(self.namespace or self.spark.catalog.currentDatabase()).locationUri

    @cached_property
    def _manifests(self) -> Manifests:
        return Manifests(self.spark, self._home)

    # ---- Reading ----

    def version(self) -> dict:
        return self._manifests.latest()[1]

    def read(self, table: str) -> DataFrame:
        return self._read(self.version(), table)

    def snapshot(self):
        """``read`` as of now: all tables from one version, whatever is published later."""
        version = self.version()
        return lambda table: self._read(version, table)

    def _read(self, version: dict, table: str) -> DataFrame:
        entry = version["tables"].get(table)
        if entry is None:  # a table that something else put there
            at = self._location(table)
            return self.spark.read.parquet(at) if self.root else self.spark.table(at)
        if SAVE in entry:
            return self.spark.read.parquet(f"{self._location(table)}/{SAVE}={entry[SAVE]}") if self.root else self.spark.table(self._location(table))
        return self._load_files(table, entry["day"], version["history"][table][entry["day"]][-1])

    def history(self, table: str, *, merge_columns: bool = True) -> DataFrame:
        """All loads of a table, with the columns of all of them.

        ``merge_columns=False`` saves reading the footers of folders whose loads are known to have the same columns.
        """
        days = self.version()["history"].get(table)
        if days is None:
            raise ValueError(f"no load of {table} was published")
        if not self.root:
            # Never null; said this way, the days a reader asks for are the first thing partitions are pruned by.
            counts = F.coalesce(F.col(LOAD), F.lit("")).isin([e[LOAD] for loads in days.values() for e in loads])
            return self.spark.table(self._loads(table)).where(counts).drop(LOAD)
        reader = self.spark.read.option("mergeSchema", merge_columns).option("basePath", self._location(HISTORY_PREFIX + table))
        return reader.parquet(*[self._load_folder(table, day, e[LOAD]) for day, loads in sorted(days.items()) for e in loads]).drop(LOAD)

    def has(self, table: str) -> bool:
        return table in self.version()["tables"] or self._foreign(table)

    def _foreign(self, table: str) -> bool:
        """Whether something else put a table there; writes that were not published are none."""
        at = self._location(table)
        if not self.root:
            return self.spark.catalog.tableExists(at)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        fs = self._manifests._fs
        names = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
        return any(not n.startswith((f"{SAVE}=", ".", "_")) for n in names)

    def has_history(self, table: str) -> bool:
        return table in self.version()["history"]

    def load_counts(self) -> DataFrame:
        """``table_name, date_ingestion, row_count`` of every day in the history, without opening a file."""
        rows = [
            (t, date.fromisoformat(d), sum(e["rows"] for e in loads)) for t, days in self.version()["history"].items() for d, loads in days.items()
        ]
        return self.spark.createDataFrame(rows, f"table_name string, {INGESTED_ON} date, row_count long")

    # ---- Writing ----

    def begin(self) -> Commit:
        """Writes that nobody publishes yet; ``commit`` takes over their ``changes``."""
        return Commit(self)

    @contextmanager
    def commit(self) -> Iterator[Commit]:
        """Writes that are published together, if nothing fails until the end of the block."""
        run = self.begin()
        yield run
        if run.changes:
            version = self._manifests.publish(run.apply)
            if not self.root:
                self._show(version, dict.fromkeys(name for kind, name, _, _ in run.changes if kind != "streams"))

    def declare(self, source: Source) -> None:
        """Create the table of a source if it is not there yet."""
        with self.commit() as run:
            run.declare(source)

    def declare_all(self) -> None:
        with self.commit() as run:
            for source in SOURCES.values():
                if source.fields is not None:
                    run.declare(source)

    def save(self, df: DataFrame, table: str) -> None:
        """Replace a table."""
        with self.commit() as run:
            run.save(df, table)

    def load(self, df: DataFrame, table: str, day: date) -> None:
        """Make ``df`` the load of ``day`` and the current table. Its rows are written once, into the history."""
        with self.commit() as run:
            run.load(df, table, day)

    def append_history(self, df: DataFrame, table: str, day: date) -> None:
        """Add a load to the history of ``table``. Loading a day again replaces that day, also by an empty load.

        A column that is new is null in earlier loads, one that is gone is null in this one.
        """
        with self.commit() as run:
            run.append_history(df, table, day)

    def copy_to(self, target: Store, names: dict[str, str]) -> None:
        """Copy tables of one version into another store under new names, published together."""
        read = self.snapshot()
        with target.commit() as run:
            for table, renamed in names.items():
                run.save(read(table), renamed)

    def clean(self) -> list[str]:
        """Delete the loads and saved tables under ``root`` that no kept version names; gives their folders.

        To be called when no load is running: what a running one has written is not named yet.
        """
        if not self.root:
            raise ValueError("only folders are cleaned; drop partitions of a catalog table with SQL")
        versions = [self._manifests.read(n) for n in self._manifests.numbers()]
        named = {self._load_folder(t, d, e[LOAD]) for v in versions for t, days in v["history"].items() for d, loads in days.items() for e in loads}
        named |= {f"{self._location(t)}/{SAVE}={e[SAVE]}" for v in versions for t, e in v["tables"].items() if SAVE in e}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs, gone = self._manifests._fs, []
        tables = {t for v in versions for t in v["tables"]} | {HISTORY_PREFIX + t for v in versions for t in v["history"]}
        for table in sorted(tables):
            base = self._location(table)
            for pattern in (f"{SAVE}=*", f"{INGESTED_ON}=*/{LOAD}=*"):
                for status in fs.globStatus(path(f"{base}/{pattern}")) or ():
                    at = status.getPath().toUri().getPath()
                    folder = base + at[at.rindex(f"/{table}/") + len(table) + 1 :]
                    if folder not in named:
                        fs.delete(status.getPath(), True)
                        gone.append(folder)
        return gone

    def _write_load(self, df: DataFrame, table: str, day: date, load_id: str) -> None:
        if self.root:
            df.write.parquet(self._load_folder(table, day.isoformat(), load_id))
            return
        at = self._loads(table)
        with _SHAPING:  # several loads of one table may be under way
            if not self.spark.catalog.tableExists(at):
                empty = self.spark.createDataFrame([], df.schema).withColumns({INGESTED_ON: F.lit(day).cast("date"), LOAD: F.lit(load_id)})
                empty.write.format("parquet").partitionBy(INGESTED_ON, LOAD).saveAsTable(at)
            known = {f.name.lower(): f for f in self.spark.table(at).schema if f.name not in (INGESTED_ON, LOAD)}
            new = [f for f in df.schema if f.name.lower() not in known]
            if new:
                self.spark.sql(f"ALTER TABLE {at} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
                known |= {f.name.lower(): f for f in new}
        # The files of a partition of its own, then the partition: nothing that counts is touched, and loads don't meet.
        kinds = [F.col(f"`{c}`").cast(known[c.lower()].dataType).alias(known[c.lower()].name) for c in df.columns]
        part = f"{INGESTED_ON}={day.isoformat()}/{LOAD}={load_id}"
        df.select(*kinds).write.parquet(f"{self._home.rstrip('/')}/{(HISTORY_PREFIX + table + LOADS).lower()}/{part}")
        self.spark.sql(f"ALTER TABLE {at} ADD PARTITION ({INGESTED_ON} = DATE '{day.isoformat()}', {LOAD} = '{load_id}')")

    def _write_table(self, df: DataFrame, table: str, load_id: str) -> dict:
        at = self._location(table)
        if self.root:
            df.write.parquet(f"{at}/{SAVE}={load_id}")
        else:
            self._drop_view(at)
            df.write.mode("overwrite").format("parquet").saveAsTable(at)
        return {SAVE: load_id}

    # ---- Views over a catalog's loads ----

    def _drop_view(self, at: str) -> None:
        if self.spark.catalog.tableExists(at) and self.spark.catalog.getTable(at).tableType == "VIEW":
            self.spark.sql(f"DROP VIEW {at}")

    def _show(self, version: dict, tables) -> None:
        for table in tables:
            days = version["history"].get(table)
            if days is None:
                continue
            names = ", ".join(f"`{c}`" for c in self.spark.table(self._loads(table)).columns if c not in (INGESTED_ON, LOAD))
            loads = ", ".join(f"'{e[LOAD]}'" for own in days.values() for e in own)
            self._view(HISTORY_PREFIX + table, f"SELECT {names}, {INGESTED_ON} FROM {self._loads(table)} WHERE {LOAD} IN ({loads})")
            entry = version["tables"].get(table, {})
            if "day" in entry:
                current = days[entry["day"]][-1]
                names = ", ".join(f"`{c}`" for c in current["columns"])
                where = f"{INGESTED_ON} = DATE '{entry['day']}' AND {LOAD} = '{current[LOAD]}'"
                self._view(table, f"SELECT {names} FROM {self._loads(table)} WHERE {where}")

    def _view(self, table: str, query: str) -> None:
        at = self._location(table)
        if self.spark.catalog.tableExists(at) and self.spark.catalog.getTable(at).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {at}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {at} AS {query}")

"""Stored tables: immutable folders, one manifest per publish.

Rows lie in ``<root>/<table>/lote=<n>[/<partition>]``; a folder is written once and never
changed. ``<root>/_manifest/<n>.json`` names, for every table, the folders that make it up.
A manifest appears by one atomic rename, so readers see all tables of a run or none,
and a run that changes few partitions writes only these: the others stay where they are.
Appending adds folders, retention leaves folders out without reading them.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructType

from ledgerline import constants as K
from ledgerline.schemas import MONTH, TABLES, conform, empty

LOG_FOLDERS = 64  # an unpartitioned table is rewritten as one folder when appends have left more
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class EmptySource(RuntimeError):
    """A run collected nothing at all."""


class AccessDenied(PermissionError):
    """The role may not read the table."""


class MissingValue(ValueError):
    """A required column holds NULL."""


class ConcurrentRun(RuntimeError):
    """Another run published a table that this run has read."""


@dataclass(frozen=True)
class State:
    """What one manifest says: the folders of every table, and how far streams have come (``marks``)."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, list[int]] = field(default_factory=dict)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- files ---------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_manifest/{number:012d}.json"

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.root}/_manifest") if re.fullmatch(r"\d+\.json", n))

    def _load(self, number: int) -> State:
        fs, p = self._fs(self._manifest(number))
        stream = fs.open(p)
        try:
            said = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return State(number, said["folders"], said["marks"])

    def _create(self, state: State) -> bool:
        """Writes a manifest beside its place and renames it; False if that number is taken."""
        sc = self.spark.sparkContext
        fs, place = self._fs(self._manifest(state.number))
        _, beside = self._fs(f"{self.root}/_manifest/_{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        out.write(json.dumps({"folders": state.folders, "marks": state.marks}).encode())
        out.close()
        options = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
        plain = sc._gateway.new_array(options, 1)
        plain[0] = options.NONE
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(beside), fs.makeQualified(place), plain)
        except Exception:
            fs.delete(beside, False)
            if fs.exists(place):
                return False
            raise
        return True

    # --- readers -------------------------------------------------------------

    def state(self) -> State:
        """The newest manifest. One state read once gives all tables of the same run."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else State()

    def version(self, table: str) -> int | None:
        """Number of the last snapshot that a stream took over."""
        return self.state().marks.get(table, [None])[0]

    def read(
        self,
        table: str,
        role: str = "user",
        state: State | None = None,
        since: dt.date | None = None,
        until: dt.date | None = None,
    ) -> DataFrame:
        """The published rows; restricted tables need a role that may see them.

        ``since`` and ``until`` bound the date that a table is partitioned by (a month for the ledger).
        """
        check_access(table, role)
        spec = TABLES[table]
        folders = (state or self.state()).folders.get(table, [])
        day = spec.month or (spec.partition[0] if spec.partition else None)
        if day is None or (since is None and until is None):
            return self.read_folders(table, folders)
        first = since.replace(day=1) if since and spec.month else since
        value = {f: _value(f) for f in folders}
        kept = [f for f, v in value.items() if v and (first is None or v >= first) and (until is None or v <= until)]
        rows = self.read_folders(table, kept)
        if since is not None:
            rows = rows.filter(F.col(day) >= F.lit(since))
        return rows if until is None else rows.filter(F.col(day) <= F.lit(until))

    def read_folders(self, table: str, folders: list[str]) -> DataFrame:
        spec = TABLES[table]
        if not folders:
            return empty(self.spark, table)
        schema = StructType(spec.schema.fields).add("lote", IntegerType())
        if spec.month:
            schema = schema.add(MONTH, DateType())
        base = f"{self.root}/{table}"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
        return rows.select(*spec.columns)

    # --- writers -------------------------------------------------------------

    def write_version(self, table: str, df: DataFrame) -> tuple[list[str], int]:
        """Writes rows that nobody reads yet. Returns (folders, rows).

        Rows and NULLs in required columns are counted by the write itself; a NULL stops it
        before anything can be published. Rows are dealt by partition with large ones split,
        so a partition gets few files.
        """
        spec = TABLES[table]
        out = conform(df, table)
        required = [f.name for f in spec.schema if not f.nullable]
        seen = Observation()
        out = out.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        parts = [MONTH] if spec.month else list(spec.partition)
        if spec.month:
            out = out.withColumn(MONTH, F.trunc(spec.month, "month"))
        if parts:
            out = out.hint("rebalance", *parts)
        if parts or spec.sort:
            out = out.sortWithinPartitions(*parts, *spec.sort)
        lote = 1 + max([int(n[5:]) for n in self._names(f"{self.root}/{table}") if re.fullmatch(r"lote=\d+", n)], default=0)
        place = f"{self.root}/{table}/lote={lote}"
        out.write.partitionBy(*parts).parquet(place)
        got = observed(seen, ["n", *required])
        if nulls := [c for c in required if got[c]]:
            raise MissingValue(f"{table}: NULL in {', '.join(nulls)}")
        if not got["n"]:
            return [], 0
        folders = [f"lote={lote}/{n}" for n in sorted(self._names(place)) if "=" in n] if parts else [f"lote={lote}"]
        return folders, int(got["n"])

    def hold(self, df: DataFrame, **metrics) -> tuple[DataFrame, dict]:
        """Writes rows for the duration of a run and reads them back, with metrics counted by that write."""
        place = f"{self.root}/_apoio/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n"), *[m.alias(k) for k, m in metrics.items()]).write.parquet(place)
        return self.spark.read.schema(df.schema).parquet(place), observed(seen, ["n", *metrics])

    def publish(
        self,
        replaced: dict[str, list[str]] | None = None,
        appended: dict[str, list[str]] | None = None,
        base: State | None = None,
        marks: dict[str, list[int]] | None = None,
    ) -> State:
        """Makes folders visible, all at once.

        ``base`` is the state that the replaced tables were made from: if one of them has changed
        since, nothing is published. Appends of others in between are kept.
        """
        while True:
            now = self.state()
            for table in replaced or {}:
                if base is not None and now.folders.get(table) != base.folders.get(table):
                    raise ConcurrentRun(f"{table} was published by another run")
            folders = now.folders | (replaced or {})
            for table, more in (appended or {}).items():
                folders = folders | {table: folders.get(table, []) + more}
            then = State(now.number + 1, folders, now.marks | (marks or {}))
            if self._create(then):
                return then

    def replace(self, table: str, df: DataFrame) -> int:
        """Full replace; an empty frame changes nothing and returns 0."""
        folders, n = self.write_version(table, df)
        if n:
            self.publish({table: folders})
        return n

    def append(self, table: str, df: DataFrame) -> int:
        """Adds rows; no folder that is there is read or touched, unless many small ones are put together."""
        folders, n = self.write_version(table, df)
        state = self.publish(appended={table: folders}) if n else self.state()
        if not TABLES[table].partition and not TABLES[table].month and len(state.folders.get(table, [])) > LOG_FOLDERS:
            whole, _ = self.write_version(table, self.read_folders(table, state.folders[table]).coalesce(1))
            self.publish({table: whole}, base=state)
        return n

    def retained(self, table: str, folders: list[str], as_of: dt.date, months: int = K.HISTORY_RETENTION_MONTHS) -> list[str]:
        """The folders that retention keeps, by their names alone."""
        oldest = months_before(as_of, months)
        return [f for f in folders if (_value(f) or dt.date.max) >= oldest]

    def vacuum(self, keep: int = 3) -> list[str]:
        """Deletes folders that none of the newest ``keep`` manifests names, and older manifests.

        Folders numbered after a table's newest published one stay: a run may be writing them.
        """
        numbers = self._numbers()
        kept = [self._load(n) for n in numbers[-keep:]]
        gone = []
        for table in TABLES:
            named = {f for s in kept for f in s.folders.get(table, [])}
            newest = max([int(f[5:].partition("/")[0]) for f in named], default=0)
            base = f"{self.root}/{table}"
            for lote in self._names(base):
                if not re.fullmatch(r"lote=\d+", lote) or lote in named or int(lote[5:]) > newest:
                    continue
                inner = [f"{lote}/{p}" for p in self._names(f"{base}/{lote}") if "=" in p]
                gone += [f"{table}/{f}" for f in inner if f not in named] if set(inner) & named else [f"{table}/{lote}"]
        for path in gone:
            self._delete(f"{self.root}/{path}")
        for n in numbers[:-keep]:
            self._delete(self._manifest(n))
        return gone

    def release(self) -> None:
        """Removes what runs have held; only when no run is at work."""
        self._delete(f"{self.root}/_apoio")

    def ensure_schema(self) -> list[str]:
        """Typed empty state of every table that does not exist yet, in one publish; returns the created names."""
        have = self.state().folders
        made = [t for t in TABLES if t not in have]
        if made:
            self.publish({t: [] for t in made})
        return made

    # --- catalog -------------------------------------------------------------

    def create_sql_tables(self, database: str) -> None:
        """Views over the published state; call again after a publish, each view is replaced at once.

        Restricted tables are views of a second database, ``<database>_restrito``, so that rights can be
        given by database. ``v_historico_saldos`` is the balance history without repeats.
        """
        state = self.state()
        for name in (database, restricted_database(database)):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        for table, spec in TABLES.items():
            home = restricted_database(database) if spec.restricted else database
            about = ", ".join(
                f"{f.name} COMMENT '{f.metadata['comment']}'" if "comment" in f.metadata else f.name for f in spec.schema
            )
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {home}.{table} ({about}) COMMENT '{spec.about}' AS {self._select(table, state)}"
            )
        key = ", ".join(TABLES["historico_saldos"].key)
        cols = ", ".join(TABLES["historico_saldos"].columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.v_historico_saldos AS SELECT {cols} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY sync_timestamp DESC) AS _n FROM {database}.historico_saldos) WHERE _n = 1"
        )

    def _select(self, table: str, state: State) -> str:
        spec, folders = TABLES[table], state.folders.get(table, [])
        kinds = [(f.name, f.dataType.simpleString()) for f in spec.schema]
        if not folders:
            return "SELECT " + ", ".join(f"CAST(NULL AS {k}) AS {c}" for c, k in kinds) + " WHERE false"
        part = MONTH if spec.month else (spec.partition[0] if spec.partition else None)
        by_lote = defaultdict(list)
        for f in folders:
            by_lote[int(f[5:].partition("/")[0])].append(_value(f))
        chosen = []
        for lote, values in by_lote.items():
            dates = ", ".join(f"DATE '{v}'" for v in values if v)
            among = [f"{part} IN ({dates})"] if dates and part else []
            among += [f"{part} IS NULL"] if part and None in values else []
            chosen.append(f"(lote = {lote}" + (f" AND ({' OR '.join(among)})" if among else "") + ")")
        cols = ", ".join(f"CAST({c} AS {k}) AS {c}" for c, k in kinds)
        return f"SELECT {cols} FROM parquet.`{self.root}/{table}` WHERE {' OR '.join(chosen)}"


def observed(seen: Observation, names: list[str]) -> dict[str, int]:
    """Counts of a write that is done. Where Spark has proved the rows empty it drops the counting too: zeros."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def _value(folder: str) -> dt.date | None:
    """The date in a folder's name."""
    value = folder.rpartition("=")[2]
    return dt.date.fromisoformat(value) if "/" in folder and value != NULL_PARTITION else None


def months_before(day: dt.date, months: int) -> dt.date:
    """The same day so many months earlier, or that month's last day."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))


def restricted_database(database: str) -> str:
    return f"{database}_restrito"


def check_access(table: str, role: str) -> None:
    if role != "exec" and table in TABLES and TABLES[table].restricted:
        raise AccessDenied(f"{table} is restricted")


def visible_tables(role: str) -> list[str]:
    return [t for t, spec in TABLES.items() if role == "exec" or not spec.restricted]


def nonempty_guard(ledger: DataFrame | int, balances: DataFrame | int) -> None:
    """Stops a run that collected neither titles nor balances, before anything is published.

    A run passes the row counts of its writes; frames are looked into for a first row.
    """
    none = lambda x: x == 0 if isinstance(x, int) else x.isEmpty()
    if none(ledger) and none(balances):
        raise EmptySource("neither titles nor balances were collected")


def within_retention(
    history: DataFrame, as_of: dt.date | str, months: int = K.HISTORY_RETENTION_MONTHS, day: str = "sync_date"
) -> DataFrame:
    """Rows that retention keeps. On the partition column this prunes whole folders."""
    day_of = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return history.filter(F.col(day) >= F.add_months(F.lit(day_of), -months))


def log_rows(runs: DataFrame) -> DataFrame:
    """Run events in the shape of the log.

    ``runs``: sync_id, started_at, finished_at (NULL while it runs), error (NULL for a success) and any counts.
    """
    open_, failed = F.col("finished_at").isNull(), F.col("error").isNotNull()
    rows = runs.withColumns(
        {
            "status": F.when(open_, "running").when(failed, "failed").otherwise("success"),
            "duration_seconds": F.timestamp_diff("SECOND", "started_at", "finished_at"),
            "error_message": F.when(~open_, F.substring("error", 1, K.MAX_ERROR_CHARS)),
            "is_incremental": F.lit(False),
        }
    )
    return conform(rows, "sync_log")


RUN = "sync_id STRING, started_at TIMESTAMP, finished_at TIMESTAMP, error STRING"


def log_start(spark: SparkSession, sync_id: str, started_at: dt.datetime) -> DataFrame:
    return log_rows(spark.createDataFrame([(sync_id, started_at, None, None)], RUN))


def log_success(
    spark: SparkSession, sync_id: str, started_at: dt.datetime, finished_at: dt.datetime, counts: dict[str, int]
) -> DataFrame:
    counted = {f"{k}_count": F.lit(counts.get(k, 0)) for k in ("lancamentos", "saldos", "clientes", "projetos", "categorias")}
    return log_rows(spark.createDataFrame([(sync_id, started_at, finished_at, None)], RUN).withColumns(counted))


def log_failure(
    spark: SparkSession, sync_id: str, started_at: dt.datetime, finished_at: dt.datetime, error: str
) -> DataFrame:
    return log_rows(spark.createDataFrame([(sync_id, started_at, finished_at, str(error))], RUN))

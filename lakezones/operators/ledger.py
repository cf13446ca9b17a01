"""The run ledger: one row per run of one table.

The ledger is an append-only table of one-line JSON run records (plus
Parquet compaction snapshots) read with a fixed schema, so an empty or
missing ledger is simply an empty frame.  A data batch becomes
visible only once its success row is in the ledger: the row *is* the commit.

Every question asked of the ledger is a frame function (``*_of``) that works
on any frame with ``LEDGER_SCHEMA``; the ``Ledger`` class binds them to a
stored ledger and turns one-row answers into Python scalars.  Lookups for all
tables at once are ``groupBy`` aggregates with map-side combine, never a loop
over ``collect()``.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from ..functions import COMPACT_ACTION, SUCCESS_STATUS, as_date, json_field, zero_if_null

LEDGER_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("db_name", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("action", StringType(), True),
    StructField("zone", StringType(), True),
    StructField("status", StringType(), True),
    StructField("last_row_number", LongType(), True),
    StructField("details", StringType(), True),
    StructField("job_date", DateType(), True),
    StructField("job_start", TimestampNTZType(), True),
    StructField("job_end", TimestampNTZType(), True),
])

KEY_COLUMNS = ("zone", "db_name", "table_name", "action")
# Parts of a run's details that are JSON values of their own.
DETAIL_JSON = ("schema", "layout", "digests")
# Newest run first: job_end, then run_id to make ties deterministic.
RUN_ORDER = ("job_end", "run_id")


def utcnow() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def new_run_id(when: _dt.datetime | None = None) -> str:
    """Sortable run id: UTC time to the microsecond plus a random suffix."""
    when = when or utcnow()
    return f"{when:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


# --------------------------------------------------------------------------
# Frame functions (work on the stored ledger or on any derived ledger frame)
# --------------------------------------------------------------------------

def runs_where(ledger: DataFrame, **equalities: Any) -> DataFrame:
    """conjunction of equality predicates; ``None`` values are skipped.

    Built as one ``Column`` so Catalyst pushes it into the Parquet scan.
    """
    cond: Column | None = None
    for name, value in equalities.items():
        if value is None:
            continue
        if name == "job_date":
            value = as_date(value)
        term = F.col(name) == F.lit(value)
        cond = term if cond is None else cond & term
    return ledger if cond is None else ledger.filter(cond)


def watermarks_of(ledger: DataFrame, keys=KEY_COLUMNS, status: str = SUCCESS_STATUS) -> DataFrame:
    """A5 for every table at once: highest ``last_row_number`` of runs with
    ``status`` per key, 0 for keys that only have other runs."""
    hit = F.when(F.col("status") == status, F.col("last_row_number"))
    return ledger.groupBy(*keys).agg(zero_if_null(F.max(hit)).cast("long").alias("watermark"))


def checkpoints_of(ledger: DataFrame, keys=KEY_COLUMNS, status: str = SUCCESS_STATUS) -> DataFrame:
    """O1 for every table: ``sink_path`` of the newest run with ``status``
    (the JSON is parsed after the aggregate: once per table, not per run)."""
    newest = F.max_by(F.struct("details", "job_end"), F.struct(*[F.col(c) for c in RUN_ORDER]))
    return (runs_where(ledger, status=status).groupBy(*keys)
            .agg(newest.alias("_n"))
            .select(*keys, json_field("_n.details", "sink_path").alias("sink_path"),
                    F.col("_n.job_end").alias("job_end")))


def row_numbers_on_date_of(ledger: DataFrame, keys=KEY_COLUMNS, status: str = SUCCESS_STATUS) -> DataFrame:
    """A6 for every table and day: row number of the newest run of that day."""
    newest = F.max_by(F.col("last_row_number"), F.struct(*[F.col(c) for c in RUN_ORDER]))
    return (runs_where(ledger, status=status).groupBy(*keys, "job_date")
            .agg(zero_if_null(newest).cast("long").alias("last_row_number")))


def run_counts_of(ledger: DataFrame, keys=("zone", "db_name", "table_name")) -> DataFrame:
    """A7/F3 for every table and day: number of runs of any status."""
    return (ledger.groupBy(*keys, "job_date")
            .agg(F.count(F.lit(1)).alias("n_runs"),
                 F.count(F.when(F.col("status") == SUCCESS_STATUS, 1)).alias("n_succeeded")))


def zone_paths_of(ledger: DataFrame, zone: str | None = None, job_date=None, db_name: str | None = None,
                  status: str | None = SUCCESS_STATUS) -> DataFrame:
    """Distinct ``(table_name, sink_path)`` written by a zone (on a day).

    Unlike the reference this keeps only successful runs of one db and
    removes repeated paths, so failed or repeated runs are not reprocessed.
    """
    runs = runs_where(ledger, zone=zone, job_date=job_date, db_name=db_name, status=status)
    runs = runs.filter(F.col("action").isNull() | (F.col("action") != COMPACT_ACTION))
    return (runs.select("db_name", "table_name", "job_date",
                        json_field("details", "sink_path").alias("sink_path"), "job_end")
            .groupBy("db_name", "table_name", "job_date", "sink_path")
            .agg(F.max("job_end").alias("job_end")))


# --------------------------------------------------------------------------
# The stored ledger
# --------------------------------------------------------------------------

@dataclass
class RunRecord:
    run_id: str
    db_name: str
    table_name: str
    action: str
    zone: str
    status: str
    last_row_number: int
    details: dict
    job_date: _dt.date
    job_start: _dt.datetime
    job_end: _dt.datetime

    def as_json(self) -> str:
        def ts(v: _dt.datetime) -> str:
            return v.strftime("%Y-%m-%d %H:%M:%S.%f")

        return json.dumps({"run_id": self.run_id, "db_name": self.db_name, "table_name": self.table_name,
                           "action": self.action, "zone": self.zone, "status": self.status,
                           "last_row_number": int(self.last_row_number),
                           "details": json.dumps(self.details, sort_keys=True, default=str),
                           "job_date": self.job_date.isoformat(), "job_start": ts(self.job_start),
                           "job_end": ts(self.job_end)})



@dataclass
class TableRuns:
    """Every run of one table in one zone, oldest first, read with one query.

    A pipeline step asks several questions of the same table's history
    (watermark, committed batches, a day's run and row number); this holds
    the answer rows once (metadata: one short row per run of one table) and
    answers them in Python with the same rules as the frame functions above.
    """

    rows: list

    def hits(self, action: str | None = None, status: str | None = SUCCESS_STATUS, job_date=None) -> list:
        """Runs matching the given action, status (None: any) and day, oldest first."""
        day = as_date(job_date) if job_date is not None else None
        return [r for r in self.rows if (status is None or r["status"] == status)
                and (action is None or r["action"] == action) and (day is None or r["job_date"] == day)]

    def watermark(self, action: str | None = None, status: str = SUCCESS_STATUS) -> int:
        """A5."""
        return max((r["last_row_number"] for r in self.hits(action, status)
                    if r["last_row_number"] is not None), default=0)

    def exists(self, job_date) -> bool:
        """a run of any status on ``job_date``."""
        return bool(self.hits(status=None, job_date=job_date))

    def row_number_on_date(self, job_date, action: str | None = None, status: str = SUCCESS_STATUS) -> int:
        """Row number of the newest such run of the day, 0 if none."""
        hits = self.hits(action, status, job_date)
        return int(hits[-1]["last_row_number"] or 0) if hits else 0

    def committed_batches(self) -> list[tuple[str, str]]:
        """Paths of successful data batches, oldest first (compaction
        snapshots are not listed: they repeat earlier rows)."""
        seen, out = set(), []
        for r in self.hits():
            if r["sink_path"] is not None and r["action"] != COMPACT_ACTION and r["sink_path"] not in seen:
                seen.add(r["sink_path"])
                out.append((r["sink_path"], r["run_id"]))
        return out

    def add(self, rec: "RunRecord") -> None:
        """Take a run this process just logged into the history (one writer
        per table, so nothing else lands in between; it is the newest run)."""
        info = rec.details or {}
        top = info.get("max_row_number")
        self.rows.append({"run_id": rec.run_id, "action": rec.action, "status": rec.status,
                          "last_row_number": rec.last_row_number, "sink_path": info.get("sink_path"),
                          "source_path": info.get("source_path"),
                          "max_row_number": None if top is None else int(top),
                          **{c: json.dumps(info[c]) if c in info else None for c in DETAIL_JSON},
                          "job_date": rec.job_date, "job_end": rec.job_end})

    def details_of(self, path: str) -> dict:
        """What the newest successful run that wrote ``path`` recorded of ``DETAIL_JSON`` (JSON text or ``None``)."""
        for r in reversed(self.hits()):
            if r["sink_path"] == path:
                return {c: r.get(c) for c in DETAIL_JSON}
        return dict.fromkeys(DETAIL_JSON)

    def promoted_sources(self) -> set[str]:
        """Source batch paths that successful runs of this zone promoted."""
        return {r["source_path"] for r in self.hits() if r["source_path"] is not None}

    def snapshot_and_after(self) -> tuple[str | None, list[str]]:
        """Newest compaction snapshot and the data batches committed after it
        (all batches when never compacted)."""
        snapshot, after, seen = None, [], set()
        for r in self.hits():
            if r["sink_path"] is None:
                continue
            if r["action"] == COMPACT_ACTION:
                snapshot, after, seen = r["sink_path"], [], set()
            elif r["sink_path"] not in seen:
                seen.add(r["sink_path"])
                after.append(r["sink_path"])
        return snapshot, after


class Ledger:
    """Append-only run ledger stored below ``path``.

    Layout: ``runs/<run_id>.json`` holds one run record as one JSON line.  It
    is written by the driver through the Hadoop file system (a hidden
    ``_``-prefixed file, then a rename), which is one small file operation
    instead of a Spark write job.  Spark's readers skip hidden files, so a
    record appears whole or not at all, and runs of different tables may
    commit concurrently.  ``compact()`` folds all runs into one Parquet table
    under ``compacted/<id>/`` and then removes exactly the run files it
    listed before reading, so lookups read a handful of files instead of
    one per run.  Readers de-duplicate by ``run_id`` while a compaction
    snapshot exists, so a crash between the snapshot and the clean-up cannot
    double-count.
    """

    RUNS = "runs"
    COMPACTED = "compacted"
    READ_ATTEMPTS = 3
    TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # file-system helpers (driver-side metadata calls) ----------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _glob(self, pattern: str) -> list[str]:
        fs, hpath = self._fs(pattern)
        found = fs.globStatus(hpath)
        return [] if found is None else [str(st.getPath().toString()) for st in found]

    def _has(self, pattern: str) -> bool:
        fs, hpath = self._fs(pattern)
        found = fs.globStatus(hpath)
        return found is not None and len(found) > 0

    # K5 -------------------------------------------------------------------
    def record(self, *, db_name: str, table_name: str, action: str, zone: str, status: str,
               last_row_number: int = 0, details: Mapping[str, Any] | None = None,
               job_date, job_start: _dt.datetime, job_end: _dt.datetime | None = None,
               run_id: str | None = None) -> RunRecord:
        rec = RunRecord(run_id=run_id or new_run_id(job_start), db_name=db_name, table_name=table_name,
                        action=action, zone=zone, status=status, last_row_number=int(last_row_number or 0),
                        details=dict(details or {}), job_date=as_date(job_date), job_start=job_start,
                        job_end=job_end or utcnow())
        fs, final = self._fs(f"{self.path}/{self.RUNS}/{rec.run_id}.json")
        _, hidden = self._fs(f"{self.path}/{self.RUNS}/_{rec.run_id}.json.tmp")
        out = fs.create(hidden, False)
        try:
            out.write(bytearray((rec.as_json() + "\n").encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(hidden, final):
            fs.delete(hidden, False)
            raise OSError(f"could not commit ledger record {rec.run_id}")
        return rec

    def frame(self) -> DataFrame:
        """All run records.  A file that vanishes between listing and reading (a
        compaction's clean-up) means list again; a ledger is empty only if
        it has no files."""
        error = None
        for _ in range(self.READ_ATTEMPTS):
            compacted = self._has(f"{self.path}/{self.COMPACTED}/*")
            has_runs = self._has(f"{self.path}/{self.RUNS}/*.json")
            if not (compacted or has_runs):
                if error is not None:
                    break
                return self.spark.createDataFrame([], LEDGER_SCHEMA)
            try:
                return self._read(compacted, has_runs)
            except AnalysisException as exc:
                error = exc
        raise error

    def _read(self, compacted: bool, has_runs: bool) -> DataFrame:
        parts = []
        if compacted:
            parts.append(self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/{self.COMPACTED}/*"))
        if has_runs:  # the folder, so the listing skips hidden in-flight files
            parts.append(self.spark.read.schema(LEDGER_SCHEMA).option("timestampNTZFormat", self.TS_FORMAT)
                         .option("mode", "FAILFAST").json(f"{self.path}/{self.RUNS}"))
        df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return df.dropDuplicates(["run_id"]) if compacted else df

    # F1 -------------------------------------------------------------------
    def runs(self, **equalities) -> DataFrame:
        return runs_where(self.frame(), **equalities)

    # A5 -------------------------------------------------------------------
    def watermark(self, *, zone: str, db_name: str, table_name: str, action: str | None = None,
                  status: str = SUCCESS_STATUS) -> int:
        row = (self.runs(zone=zone, db_name=db_name, table_name=table_name, action=action, status=status)
               .agg(zero_if_null(F.max("last_row_number")).alias("w")).first())
        return int(row["w"])

    # O1 -------------------------------------------------------------------
    def last_checkpoint(self, *, zone: str, db_name: str, table_name: str, action: str | None = None,
                        status: str = SUCCESS_STATUS) -> str | None:
        runs = self.runs(zone=zone, db_name=db_name, table_name=table_name, action=action, status=status)
        row = runs.agg(F.max_by("details", F.struct(*[F.col(c) for c in RUN_ORDER])).alias("d")) \
            .select(json_field("d", "sink_path").alias("p")).first()
        return row["p"]

    # A6 -------------------------------------------------------------------
    def row_number_on_date(self, *, zone: str, db_name: str, table_name: str, job_date,
                           action: str | None = None, status: str = SUCCESS_STATUS) -> int:
        runs = self.runs(zone=zone, db_name=db_name, table_name=table_name, action=action, status=status,
                         job_date=job_date)
        row = runs.agg(zero_if_null(F.max_by("last_row_number", F.struct(*[F.col(c) for c in RUN_ORDER])))
                       .alias("r")).first()
        return int(row["r"])

    # A7 / F3 --------------------------------------------------------------
    def count_runs(self, **equalities) -> int:
        return self.runs(**equalities).count()

    def exists(self, *, zone: str, db_name: str, table_name: str, job_date) -> bool:
        return not self.runs(zone=zone, db_name=db_name, table_name=table_name, job_date=job_date).isEmpty()

    # S9 -------------------------------------------------------------------
    def zone_paths(self, zone: str, job_date=None, db_name: str | None = None) -> DataFrame:
        return zone_paths_of(self.frame(), zone=zone, job_date=job_date, db_name=db_name)

    def histories(self, *, db_name: str, tables) -> dict[tuple[str, str], TableRuns]:
        """Run histories of several ``(zone, table_name)`` pairs of one db,
        each oldest first, read with one query (one row per run of those
        tables: metadata, not data)."""
        pairs = list(dict.fromkeys((z, t) for z, t in tables))
        which = F.lit(False)
        for zone, table in pairs:
            which = which | ((F.col("zone") == zone) & (F.col("table_name") == table))
        rows = (runs_where(self.frame(), db_name=db_name).filter(which)
                .select("zone", "table_name", "run_id", "action", "status", "last_row_number",
                        json_field("details", "sink_path").alias("sink_path"),
                        json_field("details", "source_path").alias("source_path"),
                        json_field("details", "max_row_number").cast("long").alias("max_row_number"),
                        *[json_field("details", c).alias(c) for c in DETAIL_JSON], "job_date", "job_end")
                .orderBy(*RUN_ORDER).collect())
        out = {pair: TableRuns([]) for pair in pairs}
        for r in rows:
            d = r.asDict()
            pair = (d.pop("zone"), d.pop("table_name"))
            out[pair].rows.append(d)
        return out

    def table_runs(self, *, zone: str, db_name: str, table_name: str) -> TableRuns:
        """All runs of one table in one zone, oldest first (one query)."""
        return self.histories(db_name=db_name, tables=[(zone, table_name)])[(zone, table_name)]

    def committed_batches(self, *, zone: str, db_name: str, table_name: str) -> list[tuple[str, str]]:
        """Paths of successful data batches of one table, oldest first."""
        return self.table_runs(zone=zone, db_name=db_name, table_name=table_name).committed_batches()

    def snapshot_and_after(self, *, zone: str, db_name: str, table_name: str) -> tuple[str | None, list[str]]:
        """Newest compaction snapshot of a table and the data batches
        committed after it (all batches when never compacted)."""
        return self.table_runs(zone=zone, db_name=db_name, table_name=table_name).snapshot_and_after()

    def compact(self) -> str:
        """Fold every run record into one snapshot, then delete the
        older snapshots and the run folders the new snapshot contains.

        Run it when no pipeline is writing (one writer, as for tables): a
        reader that listed the old files just before the clean-up may fail
        and must retry.  Returns the snapshot path.
        """
        # List first, then read: every folder listed here is in the snapshot
        # (runs that land in between are read too and de-duplicated later).
        before = self._glob(f"{self.path}/{self.COMPACTED}/*")
        run_folders = self._glob(f"{self.path}/{self.RUNS}/*.json")  # committed records only
        target = f"{self.path}/{self.COMPACTED}/{new_run_id()}"
        self.frame().write.mode("errorifexists").parquet(target)
        for old in before + run_folders:
            fs, hpath = self._fs(old)
            fs.delete(hpath, True)
        return target

"""Lake zones: batch layout, append, replace, committed reads, text sink.

Layout (K6 / K7)::

    <root>/<zone>/<db>/<schema>/<table>/ingest_date=YYYY-MM-DD/batch_id=<run id>/part-*.parquet
    <root>/<zone>/<table>/ingest_date=.../batch_id=...          (warehouse tables)

Every write goes to a *new* batch directory (``errorifexists``), and a batch
is visible only when the ledger holds its success row.  A crash between the
two steps leaves an orphan directory no reader lists.  ``replace`` (K2) never
overwrites in place: the table is its newest committed batch.  Readers pass
the committed batch paths with ``basePath`` so ``ingest_date`` and
``batch_id`` come back as partition columns; batch ids sort in commit order.
Every batch is read with the schema that its run recorded, and batches of
several schemas are one table of their merged schema (``operators/schemas.py``).

One writer per table at a time is assumed (as with the reference); concurrent
writers to one table are out of scope.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType, StructType

from ..functions import COMPACT_ACTION, SUCCESS_STATUS, as_date, date_text
from ..operators.keyed_state import BucketedState, write_bucketed
from ..operators.ledger import Ledger, TableRuns, new_run_id, utcnow
from ..operators.schemas import conform, merge_schemas, recorded_schema, renamed, schema_record

BATCH_COLUMNS = ("ingest_date", "batch_id")


def table_root(root: str, zone: str, table: str, db_name: str | None = None,
               schema: str | None = None) -> str:
    parts = [root.rstrip("/"), zone]
    if db_name:
        parts.append(db_name)
    if schema:
        parts.append(schema)
    parts.append(table)
    return "/".join(parts)


def batch_path(root_of_table: str, run_date, batch_id: str) -> str:
    return f"{root_of_table}/ingest_date={date_text(run_date)}/batch_id={batch_id}"


def write_batch_observed(df: DataFrame, path: str, fmt: str = "parquet",
                         max_of: str | None = None) -> tuple[int, int | None]:
    """K1: write ``df`` to a new batch directory; returns the row count and the
    highest value of ``max_of`` (``None`` if absent or empty).

    Both are taken by an ``Observation`` during the write itself (A2, A3), so
    the plan runs once and the batch is never scanned again for them.
    """
    return write_slices_observed([df], path, fmt, max_of)[:2]


def write_slices_observed(parts: Iterable[DataFrame], path: str, fmt: str = "parquet",
                          max_of: str | None = None) -> tuple[int, int | None, StructType]:
    """``write_batch_observed`` of a batch that comes in slices, one job each; also returns their schema."""
    rows, tops, schema = 0, [], StructType()
    for i, df in enumerate(parts):
        schema, obs = df.schema, Observation("batch")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if max_of and max_of in df.columns:
            metrics.append(F.max(max_of).cast("long").alias("max"))
        # nobody reads the batch before its ledger row, which comes after the last slice
        df.observe(obs, *metrics).write.format(fmt).mode("append" if i else "errorifexists").save(path)
        rows += int(obs.get["rows"])
        tops.append(obs.get.get("max"))
    return rows, max((int(t) for t in tops if t is not None), default=None), schema


def write_batch(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """K1: write ``df`` to a new batch directory; returns the row count."""
    return write_batch_observed(df, path, fmt)[0]


def read_batches(spark: SparkSession, paths: list[str], base: str, fmt: str = "parquet",
                 with_batch_columns: bool = False, schema: StructType | None = None) -> DataFrame:
    """The bag union of the given batches (one scan, many paths).  With the batches' ``schema`` no
    file is opened to infer it."""
    reader = spark.read.format(fmt).option("basePath", base)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    df = reader.load(paths)
    return df if with_batch_columns else df.drop(*BATCH_COLUMNS)


@dataclass
class LakeTable:
    """One table of one zone, with its ledger."""

    spark: SparkSession
    ledger: Ledger
    root: str
    zone: str
    table: str
    db_name: str | None = None
    schema: str | None = None
    action: str = "extract"
    fmt: str = "parquet"
    logged_db: str | None = None  # the db in the ledger where the path has none (warehouse tables)
    renames: Mapping[str, str] = field(default_factory=dict)  # earlier column names: today's
    fill: Mapping[str, Any] = field(default_factory=dict)  # values of columns that a batch does not have

    @property
    def base(self) -> str:
        return table_root(self.root, self.zone, self.table, self.db_name, self.schema)

    @property
    def ledger_db(self) -> str:
        return self.logged_db or self.db_name or ""

    def new_batch_path(self, run_date, batch_id: str | None = None) -> tuple[str, str]:
        batch_id = batch_id or new_run_id()
        return batch_path(self.base, run_date, batch_id), batch_id

    def runs(self) -> TableRuns:
        """This table's run history (one ledger query)."""
        return self.ledger.table_runs(zone=self.zone, db_name=self.ledger_db, table_name=self.table)

    def committed_paths(self, job_date=None, runs: TableRuns | None = None) -> list[str]:
        batches = (runs or self.runs()).committed_batches()
        if job_date is not None:
            marker = f"/ingest_date={date_text(job_date)}/"
            batches = [b for b in batches if marker in b[0]]
        return [p for p, _ in batches]

    def _by_schema(self, paths: list[str], runs: TableRuns) -> list[tuple[StructType, list[str]]]:
        """Paths by the schema that their runs recorded; files without a record are asked for theirs."""
        groups: dict[str, tuple[StructType, list[str]]] = {}
        unknown = []
        for p in paths:
            schema = recorded_schema(runs.details_of(p)["schema"])
            if schema is None:
                unknown.append(p)
            else:
                groups.setdefault(schema.json(), (schema, []))[1].append(p)
        out = list(groups.values())
        if unknown:
            out.insert(0, (read_batches(self.spark, unknown, self.base, self.fmt).schema, unknown))
        return out

    def schema_of(self, paths: list[str], runs: TableRuns | None = None) -> StructType:
        """Merged schema of batches under today's names."""
        groups = self._by_schema(paths, runs or self.runs())
        return merge_schemas((renamed(s, self.renames) for s, _ in groups), self.table)

    def current_schema(self, runs: TableRuns | None = None) -> StructType | None:
        """Merged schema of all committed batches; ``None`` when nothing is committed yet."""
        runs = runs or self.runs()
        paths = self.committed_paths(runs=runs)
        return self.schema_of(paths, runs) if paths else None

    def read_paths(self, paths: list[str], *, runs: TableRuns | None = None, with_batch_columns: bool = False) -> DataFrame:
        """The given batches as one table, one scan for each schema among them."""
        groups = self._by_schema(paths, runs or self.runs())
        whole = merge_schemas((renamed(s, self.renames) for s, _ in groups), self.table)
        parts = []
        for schema, some in groups:
            rows = read_batches(self.spark, some, self.base, self.fmt, with_batch_columns=True, schema=schema)
            kinds = {f.name: f for f in rows.schema.fields}
            target = StructType([*whole.fields, *(kinds[c] for c in BATCH_COLUMNS if c in kinds and c not in whole.names)])
            parts.append(conform(rows, target, self.renames, self.fill))
        df = reduce(DataFrame.unionByName, parts)
        return df if with_batch_columns else df.drop(*BATCH_COLUMNS)

    def read(self, *, latest_only: bool = False, job_date=None, with_batch_columns: bool = False,
             runs: TableRuns | None = None) -> DataFrame | None:
        """Committed rows (all batches, or the newest for ``replace``
        tables); ``None`` when nothing is committed yet.  ``runs`` reuses a
        history already read in this step."""
        runs = runs or self.runs()
        paths = self.committed_paths(job_date, runs)
        if not paths:
            return None
        if latest_only:
            paths = paths[-1:]
        return self.read_paths(paths, runs=runs, with_batch_columns=with_batch_columns)

    def read_state_inputs(self, runs: TableRuns | None = None) -> DataFrame | None:
        """Rows a current state is computed from: the newest compaction
        snapshot plus the batches committed after it (with batch columns).
        Without compaction this is every committed batch."""
        runs = runs or self.runs()
        snapshot, after = runs.snapshot_and_after()
        paths = ([snapshot] if snapshot else []) + after
        return self.read_paths(paths, runs=runs, with_batch_columns=True) if paths else None

    def bucketed_state(self, runs: TableRuns | None = None) -> tuple[BucketedState, DataFrame | None] | None:
        """The newest snapshot, if it was written bucketed, and the rows committed after it (with batch columns)."""
        runs = runs or self.runs()
        snapshot, after = runs.snapshot_and_after()
        kept = runs.details_of(snapshot) if snapshot else {}
        layout, schema = json.loads(kept.get("layout") or "null"), recorded_schema(kept.get("schema"))
        if not layout or schema is None:
            return None
        later = self.read_paths(after, runs=runs, with_batch_columns=True) if after else None
        return BucketedState(self.spark, snapshot, schema, layout["key"], layout["buckets"], self.fmt), later

    def compact(self, run_date, primary_key=(), buckets: int = 0) -> int:
        """Write the table's current state (newest version per key; all rows
        for keyless tables) as one snapshot batch and commit it with action
        ``compact``.  Later diffs read the snapshot plus newer batches, so
        their cost follows the table's size, not its history.  Plain reads
        still return every appended version.  With ``buckets`` the snapshot is
        bucketed and sorted by key, so a diff does not shuffle it."""
        from ..operators.changes import current_state

        inputs = self.read_state_inputs()
        if inputs is None:
            return 0
        state = current_state(inputs, primary_key) if primary_key else inputs
        start = utcnow()
        path, batch_id = self.new_batch_path(run_date, new_run_id(start))
        state = state.drop(*BATCH_COLUMNS)
        info = {"sink_path": path, "primary_key": list(primary_key), "schema": schema_record(state.schema)}
        if buckets and primary_key and self.fmt != "delta":
            obs = Observation("state")
            write_bucketed(state.observe(obs, F.count(F.lit(1)).alias("rows")), path, primary_key, buckets, self.fmt)
            rows, info["layout"] = int(obs.get["rows"]), {"buckets": buckets, "key": list(primary_key)}
        else:
            rows = write_batch(state, path, self.fmt)
        self.ledger.record(db_name=self.ledger_db, table_name=self.table, action=COMPACT_ACTION, zone=self.zone,
                           status=SUCCESS_STATUS, last_row_number=rows, details=info,
                           job_date=as_date(run_date), job_start=start, job_end=utcnow(), run_id=batch_id)
        return rows

    def _commit(self, path: str, batch_id: str, rows: int, run_date, start: _dt.datetime,
                last_row_number: int | None, details: dict | None) -> int:
        info = {"sink_path": path}
        info.update(details or {})
        self.ledger.record(db_name=self.ledger_db, table_name=self.table, action=self.action, zone=self.zone,
                           status=SUCCESS_STATUS, last_row_number=rows if last_row_number is None else last_row_number,
                           details=info, job_date=as_date(run_date), job_start=start, job_end=utcnow(),
                           run_id=batch_id)
        return rows

    def append(self, df: DataFrame, run_date, *, last_row_number: int | None = None,
               details: dict | None = None, commit_empty: bool = False) -> int:
        """K1 + K5: write a new batch and commit it.  Empty batches are left
        uncommitted unless ``commit_empty``."""
        start = utcnow()
        path, batch_id = self.new_batch_path(run_date, new_run_id(start))
        rows = write_batch(df, path, self.fmt)
        if rows == 0 and not commit_empty:
            return 0
        return self._commit(path, batch_id, rows, run_date, start, last_row_number,
                            {"schema": schema_record(df.schema), **(details or {})})

    def replace(self, df: DataFrame, run_date, *, last_row_number: int | None = None,
                details: dict | None = None) -> int:
        """K2: the new batch becomes the whole table (read with ``latest_only``)."""
        return self.append(df, run_date, last_row_number=last_row_number, details=details, commit_empty=True)


def _python_string(c: Column) -> Column:
    """``repr`` of a string: quotes and backslashes as Python chooses them, control characters escaped."""
    use_double = c.contains("'") & ~c.contains('"')
    esc = F.regexp_replace(c, r"\\", r"\\\\")
    for char, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        esc = F.regexp_replace(esc, char, rf"\\{name}")
    hexed = F.array_join(F.transform(F.split(esc, ""), lambda ch: F.when(
        ch.rlike(r"[\x00-\x1f\x7f]"), F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(F.ascii(ch)), 2, "0")))).otherwise(ch)), "")
    esc = F.when(esc.rlike(r"[\x00-\x1f\x7f]"), hexed).otherwise(esc)
    return F.when(use_double, F.concat(F.lit('"'), esc, F.lit('"'))) \
        .otherwise(F.concat(F.lit("'"), F.regexp_replace(esc, "'", r"\\'"), F.lit("'")))


def _python_float(c: Column) -> Column:
    """``repr`` of a double: plain digits from 1e-4 to below 1e16, else an exponent of two digits or more.

    The digits are the JVM's (before Java 19 a few values, such as the smallest, have others than Python's).
    """
    text = c.cast("string")
    plain = F.concat(F.regexp_replace(text.cast("decimal(38, 21)").cast("string"), r"0+$", ""), F.lit(""))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    power = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(-?)(\d)$", r"E$10$2")
    power = F.regexp_replace(F.regexp_replace(power, "E-", "e-"), "E", "e+")
    size = F.abs(c)
    zero = F.when(text.startswith("-"), "-0.0").otherwise("0.0")
    return (F.when(F.isnan(c), "nan").when(c == float("inf"), "inf").when(c == float("-inf"), "-inf").when(c == 0, zero)
            .when((size >= 1e-4) & (size < 1e16), plain).otherwise(power))


def python_tuple_text(*cols) -> Column:
    """Format columns like Python's ``repr`` of a tuple: ``('Java', 20000)``.

    Strings, booleans, doubles, integers and decimals without an exponent come out as
    ``repr`` writes them (ASCII control characters escaped; other unprintable
    characters stay); a float is shown as its double.  All other
    types are quoted text.
    """
    parts = []
    for c, dtype in cols:
        c = F.col(c) if isinstance(c, str) else c
        if isinstance(dtype, StringType):
            text = _python_string(c)
        elif isinstance(dtype, BooleanType):
            text = F.when(c, "True").otherwise("False")
        elif isinstance(dtype, (DoubleType, FloatType)):
            text = _python_float(c.cast("double"))
        elif isinstance(dtype, NumericType):
            text = c.cast("string")
        else:
            text = F.concat(F.lit("'"), c.cast("string"), F.lit("'"))
        parts.append(F.when(c.isNull(), "None").otherwise(text))
    inner = F.concat_ws(", ", *parts)
    if len(parts) == 1:
        inner = F.concat(inner, F.lit(","))
    return F.concat(F.lit("("), inner, F.lit(")"))


def write_text_counted(df: DataFrame, path: str, columns: list[str] | None = None) -> int | None:
    """K3 + A4: save rows as Python-tuple text lines and count them in the
    same pass; ``None`` if the path exists (it is not overwritten)."""
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    lines = df.select(python_tuple_text(*[(c, types[c]) for c in columns]).alias("value"))
    obs = Observation("text")
    try:
        lines.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").text(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return None
    return int(obs.get["rows"])


def write_text(df: DataFrame, path: str, columns: list[str] | None = None) -> bool:
    """K3: save rows as Python-tuple text lines; an existing path is not
    overwritten (the reference logs and swallows that error: returns False)."""
    return write_text_counted(df, path, columns) is not None

"""Zone promotion raw -> staging.

For one day (``job_date``) and each table, the raw batches committed that
day and not yet promoted are taken oldest first; for each, ``m`` is its
highest row number (A2):

* no staging run of any status for that day (F3): if ``m`` exceeds the
  day's staging row number (A6, 0 if none) all incoming rows are appended;
* a staging run exists: only incoming rows missing from staging's current
  state are appended (or, unless the key is unique and non-null in the batch,
  from all committed staging rows); nothing if there are none.

Several pending batches of a day are promoted in one pass over staging
(``_promote_together``): against the current state where keys are unique and
non-null in every batch, else by the first version of each whole row.

Keys or whole rows are compared a slice at a time (``operators/slices.py``) and shuffle files go when their query ends.

Batches and staging are compared in their merged schema (``operators/schemas.py``).

Each promoted batch logs a complete success row with ``m`` and the raw
``source_path`` (the reference never sets ``details`` on this path and its
log call fails after the data is written).  Raw batches already named as a
``source_path`` are skipped, so a re-run does not promote twice, and failed
or repeated raw runs are not reprocessed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import COMPACT_ACTION, EXTRACT_ACTION, RAW_ZONE, STAGING_ZONE, SUCCESS_STATUS, as_date
from ..operators.changes import business_columns, changed_rows, current_state, join_rows, new_values, row_key
from ..operators.ledger import Ledger, TableRuns, new_run_id, utcnow
from ..operators.rownum import key_profile
from ..operators.schemas import conform, merge_schemas, schema_record
from ..operators.slices import slice_count, value_slice
from ..session import shuffles_removed
from ..sources.lake import LakeTable, batch_path, write_slices_observed
from ..specs import TableSpec
from .runs import NO_CHANGES, NOT_NEWER, WRITTEN, Outcome, each_table, log, record_error


def pending_batches(ledger: Ledger, *, db_name: str, table_name: str, job_date, from_zone: str,
                    to_zone: str, target_runs: TableRuns | None = None,
                    source_runs: TableRuns | None = None) -> list[tuple[str, int | None]]:
    """Raw batches of ``job_date`` with no staging success naming them,
    oldest first, with the highest row number the extract observed while
    writing each (``None`` for batches logged without it).  Answered from
    the two zones' histories of this table (metadata: one row per run)."""
    source = source_runs or ledger.table_runs(zone=from_zone, db_name=db_name, table_name=table_name)
    done = (target_runs or ledger.table_runs(zone=to_zone, db_name=db_name, table_name=table_name)) \
        .promoted_sources()
    seen, out = set(), []
    for r in source.hits(job_date=job_date):
        path = r["sink_path"]
        if r["action"] == COMPACT_ACTION or path is None or path in done or path in seen:
            continue
        seen.add(path)
        out.append((path, r["max_row_number"]))
    return out


def promote_table(spark: SparkSession, lake_root: str, ledger: Ledger, *, db_name: str, schema: str,
                  table_name: str, job_date, primary_key: Sequence[str] = (), from_zone: str = RAW_ZONE,
                  to_zone: str = STAGING_ZONE, action: str = EXTRACT_ACTION, base: str = "current",
                  fmt: str = "parquet", renames: Mapping[str, str] | None = None,
                  fill: Mapping[str, Any] | None = None) -> list[Outcome]:
    job_date = as_date(job_date)
    source, target = (LakeTable(spark, ledger, lake_root, zone, table_name, db_name, schema, action, fmt, renames=renames or {},
                                fill=fill or {}) for zone in (from_zone, to_zone))
    outcomes = []
    # one ledger query: pending raw batches, promoted sources, F3, A6 and the base batches
    both = ledger.histories(db_name=db_name, tables=[(from_zone, table_name), (to_zone, table_name)])
    staged_runs, raw_runs = both[(to_zone, table_name)], both[(from_zone, table_name)]
    pending = pending_batches(ledger, db_name=db_name, table_name=table_name, job_date=job_date, from_zone=from_zone,
                              to_zone=to_zone, target_runs=staged_runs, source_runs=raw_runs)
    key = list(primary_key)
    if len(pending) > 1 and base == "current" and all(top is not None for _, top in pending):
        try:
            batches = [source.read_paths([p], runs=raw_runs) for p, _ in pending]
            whole = _merged(batches, target, staged_runs)
            batches = [conform(b, whole, fill=target.fill) for b in batches]
            with shuffles_removed(spark):
                unique = bool(key) and all(key_profile(b, key)[1] for b in batches)
        except Exception as exc:  # noqa: BLE001 - the loop below meets it again and logs it
            log.warning("batches of %s.%s cannot be read together: %s", db_name, table_name, exc)
        else:
            return _promote_together(target, staged_runs, pending, batches, key if unique else [], job_date, action)
    for raw_path, top in pending:
        start = utcnow()
        path, batch_id = target.new_batch_path(job_date)
        details = {"sink_path": path, "source_path": raw_path}
        m = 0
        try:
            incoming = source.read_paths([raw_path], runs=raw_runs)
            incoming = conform(incoming, _merged([incoming], target, staged_runs), fill=target.fill)
            # A2: observed while the batch was written; scanned only for older ledger rows
            m = top if top is not None else int(incoming.agg(F.coalesce(F.max("ROW_NUMBER"), F.lit(0))).first()[0])
            if not staged_runs.exists(job_date):
                r = staged_runs.row_number_on_date(job_date, action)
                if m <= r:
                    outcomes.append(Outcome(table_name, NOT_NEWER, last_row_number=m))
                    continue
                parts = [incoming]
            else:
                compare = business_columns(incoming)
                with shuffles_removed(spark):
                    keyed = base == "current" and bool(primary_key) and key_profile(incoming, primary_key)[1]
                staged = target.read_state_inputs(staged_runs) if keyed else target.read(runs=staged_runs)
                parts = _new_in_slices(incoming, staged, compare, list(primary_key) if keyed else [], target.fill)
            with shuffles_removed(spark):
                rows, written_top, written = write_slices_observed(parts, path, target.fmt, max_of="ROW_NUMBER")
            details.update(max_row_number=written_top, schema=schema_record(written))
            if rows == 0:
                outcomes.append(Outcome(table_name, NO_CHANGES, last_row_number=m))
                continue
            staged_runs.add(ledger.record(db_name=db_name, table_name=table_name, action=action, zone=to_zone,
                                          status=SUCCESS_STATUS, last_row_number=m, details=details,
                                          job_date=job_date, job_start=start, job_end=utcnow(), run_id=batch_id))
            log.info("promoted %s.%s: %d rows from %s", db_name, table_name, rows, raw_path)
            outcomes.append(Outcome(table_name, WRITTEN, rows_written=rows, last_row_number=m, sink_path=path,
                                    details=details))
        except Exception as exc:  # noqa: BLE001
            outcomes.append(record_error(ledger, db_name=db_name, table_name=table_name, action=action,
                                         zone=to_zone, job_date=job_date, job_start=start, error=exc,
                                         last_row_number=m, details=details))
            staged_runs = target.runs()  # an error row is a run of that day too (re-read: rare path)
    return outcomes


def _merged(batches: list[DataFrame], target: LakeTable, staged_runs: TableRuns) -> StructType:
    """Schema of the target once it holds the batches."""
    known = target.current_schema(staged_runs)
    return merge_schemas([*(b.schema for b in batches), *([known] if known is not None else [])], target.table)


def _new_in_slices(incoming: DataFrame, staged: DataFrame | None, compare: list[str], key: list[str],
                   fill: Mapping[str, Any]) -> Iterator[DataFrame]:
    """Rows of ``incoming`` that staging does not have, all copies of them: against its current state by ``key``, else all its rows."""
    wanted, slices = incoming.select(*compare).schema, slice_count(incoming, staged)
    for i in range(slices if staged is not None else 0):
        if key:
            old = conform(current_state(value_slice(staged, key, slices, i, like=incoming), key), wanted, fill=fill)
            yield changed_rows(value_slice(incoming, key, slices, i), old, compare, base_unique=True, key=key)
        else:
            some, old = (value_slice(x, compare, slices, i) for x in (incoming, conform(staged, wanted, fill=fill)))
            yield join_rows(some, row_key(some, compare), new_values(some, old, compare, "__row"), "__row", "left_semi")
    if staged is None:
        yield incoming


def _first_by_key(versions: DataFrame, state: DataFrame | None, compare: list[str], key: list[str]) -> DataFrame:
    """Rows that differ from the version of their key before them; one shuffle by key."""
    every = versions if state is None else versions.unionByName(state, allowMissingColumns=True)
    row = row_key(every, compare)
    before = F.lag(row).over(Window.partitionBy(*key).orderBy("__v"))
    return every.withColumn("__new", ~F.coalesce(row == before, F.lit(False))).where("__v > 0")


def _first_by_row(versions: DataFrame, staged: DataFrame | None, compare: list[str]) -> DataFrame:
    """Rows of the first version that has a row with the same values, all copies of it.

    The versions of a value combine before they are shuffled.  Rows meet them in a plain shuffle join by digest, as in
    ``changed_rows``, so a hot value is split.
    """
    seen = versions if staged is None else versions.unionByName(staged, allowMissingColumns=True)
    first = seen.select(row_key(seen, compare).alias("__row"), "__v").groupBy("__row").agg(F.min("__v").alias("__first"))
    first = first.where("__first > 0")  # values of staging are not new in any version
    met = join_rows(versions, row_key(versions, compare), first, "__row", "left")
    return met.select(*versions.columns, F.coalesce(F.col("__first") == F.col("__v"), F.lit(False)).alias("__new"))


def _promote_together(target: LakeTable, staged_runs: TableRuns, pending: list[tuple[str, int]], batches: list[DataFrame],
                      key: list[str], job_date, action: str) -> list[Outcome]:
    """Several pending batches of one schema in one pass over staging.

    Staging is version 0 and the batches are versions 1, 2, ...  With a
    ``key`` (unique and non-null in every batch) staging is its current state and a row is kept if it differs from the version
    before it; without one all committed rows count, and a row is kept in the first version that has its values.
    That equals promoting one batch after the other.  All batches are written by one job for each slice of the keys or
    rows, each into its own folder, and each gets its own ledger row; if the ledger fails half-way, only the batches without a row count as failed.
    Without a staging run on that day the first batch above the day's row number is kept whole, and batches before
    it are not newer.
    """
    start, name, db = utcnow(), target.table, target.ledger_db
    whole, out = 0, []  # number of the batch that is kept whole
    if not staged_runs.exists(job_date):
        r = staged_runs.row_number_on_date(job_date, action)
        whole = next((i for i, (_, m) in enumerate(pending, 1) if m > r), len(pending) + 1)
        out = [Outcome(name, NOT_NEWER, last_row_number=m) for _, m in pending[:whole - 1]]
    todo = [(i, p, m, new_run_id()) for i, (p, m) in enumerate(pending, 1) if i >= whole]
    if not todo:
        return out
    todo = [(i, p, m, b) for (i, p, m, _), b in zip(todo, sorted(t[3] for t in todo))]  # ids sort in commit order
    folder = batch_path(target.base, job_date, "").rsplit("/", 1)[0]
    ended: set[str] = set()
    try:
        compare = business_columns(batches[0])
        wanted = batches[0].select(*compare).schema
        versions = reduce(DataFrame.unionByName, [batches[i - 1].withColumn("__v", F.lit(i)) for i, *_ in todo])
        state = target.read_state_inputs(staged_runs) if key else target.read(runs=staged_runs)
        metrics = [f(F.when(F.col("__v") == i, c)).alias(f"{what}{i}") for i, *_ in todo
                   for what, f, c in (("rows", F.count, F.lit(1)), ("top", F.max, F.col("ROW_NUMBER")))]
        ids = F.create_map(*[F.lit(x) for i, _, _, b in todo for x in (i, b)])
        slices = slice_count(versions, state)
        got: list[dict] = []
        for n in range(slices):
            some, old = value_slice(versions, key or compare, slices, n), state
            if old is not None:
                old = current_state(value_slice(old, key, slices, n, like=versions), key) if key else old
                old = conform(old, wanted, fill=target.fill).withColumn("__v", F.lit(0))
                old = old if key else value_slice(old, compare, slices, n)
            marked = _first_by_key(some, old, compare, key) if key else _first_by_row(some, old, compare)
            kept = marked.where(F.col("__new") | (F.col("__v") == whole)).drop("__new")
            obs = Observation("promotion")
            with shuffles_removed(target.spark):
                (kept.observe(obs, *metrics).withColumn("batch_id", ids[F.col("__v")]).drop("__v")
                 .write.format(target.fmt).mode("append").partitionBy("batch_id").save(folder))
            got.append(obs.get)
        for i, raw_path, m, batch_id in todo:
            rows, path = sum(int(g[f"rows{i}"]) for g in got), f"{folder}/batch_id={batch_id}"
            if rows == 0:
                out.append(Outcome(name, NO_CHANGES, last_row_number=m))
                ended.add(batch_id)
                continue
            details = {"sink_path": path, "source_path": raw_path, "max_row_number": max(int(t) for g in got if (t := g[f"top{i}"]) is not None),
                       "schema": schema_record(batches[0].schema)}
            staged_runs.add(target.ledger.record(db_name=db, table_name=name, action=action, zone=target.zone,
                                                 status=SUCCESS_STATUS, last_row_number=m, details=details,
                                                 job_date=job_date, job_start=start, job_end=utcnow(), run_id=batch_id))
            ended.add(batch_id)
            out.append(Outcome(name, WRITTEN, rows_written=rows, last_row_number=m, sink_path=path, details=details))
    except Exception as exc:  # noqa: BLE001
        out += [record_error(target.ledger, db_name=db, table_name=name, action=action, zone=target.zone,
                             job_date=job_date, job_start=start, error=exc, last_row_number=m,
                             details={"source_path": p}) for _, p, m, batch_id in todo if batch_id not in ended]
    return out


def run_promote(spark: SparkSession, lake_root: str, ledger: Ledger, *, db_name: str, schema: str, job_date,
                primary_keys: dict[str, Sequence[str]] | None = None, single_table: str | None = None,
                specs: Mapping[str, TableSpec] | None = None, parallel: int = 1, **options) -> list[Outcome]:
    """I2 for every table the source zone wrote on ``job_date`` (S9).  ``specs`` gives keys, renames and fills at
    once; ``parallel`` tables are in work at a time."""
    from_zone = options.get("from_zone", RAW_ZONE)
    tables = sorted({r["table_name"] for r in
                     ledger.zone_paths(from_zone, job_date=job_date, db_name=db_name).select("table_name")
                     .distinct().collect()})
    if single_table is not None:
        tables = [t for t in tables if t == single_table]
    specs = specs or {}

    def one(t: str) -> list[Outcome]:
        spec = specs.get(t)
        key = (primary_keys or {}).get(t, spec.primary_key if spec else ())
        more = {"renames": spec.renames, "fill": spec.fill} if spec else {}
        return promote_table(spark, lake_root, ledger, db_name=db_name, schema=schema, table_name=t, job_date=job_date,
                             primary_key=key, **more, **options)

    return [o for outs in each_table(spark, tables, one, parallel) for o in outs]

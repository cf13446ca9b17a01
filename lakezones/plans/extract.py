"""Incremental extract of source tables into the raw zone.

Decision table (``c`` = source rows, ``w`` = watermark of earlier successes):

=====================  ==================  ===================
state                  written             ledger
=====================  ==================  ===================
source empty           nothing             nothing
``w == 0``             whole table         success, ``c``
``c >= w > 0``, diff   changed rows only   success, ``c``
``c >= w > 0``, none   nothing             nothing
``c < w``              nothing             nothing (``skipped`` row
                                           with ``log_skipped``)
read/write/log fails   (orphan batch)      error row
=====================  ==================  ===================

Differences from the reference, each a fix of a trap it has:

* The diff compares **business columns only**; row number and audit stamps
  are added after (``legacy=True`` compares all columns, as it does).
* Row numbers are dense and deterministic (``dense_row_number``), not
  ``monotonically_increasing_id``.
* The base of the diff is the table's **current state** by primary key over
  all committed batches, so a row that goes A -> B -> A is found.  That holds
  only for a key that is unique and non-null in the snapshot (checked on every
  run, by the aggregate that counts the source); with repeated or null keys,
  and without a key, whole rows are compared with all committed rows, so an
  unchanged snapshot never appends again.  ``base="day_path"`` keeps the
  reference's one-day base.
* With repeated or null keys, or none, whole rows are compared and numbered a slice
  at a time (``operators/slices.py``), and shuffle files go when their query ends: the disk
  in use follows a slice.  Rows that did not change are numbered by their order columns alone.
* The diff is evaluated once: it is written straight into a new batch
  directory while an ``Observation`` counts it; an empty result is never
  committed.
* The columns may change: the new snapshot and the committed batches are
  compared in their merged schema (``operators/schemas.py``).  A column the
  source no longer has counts as null (or the contract's ``fill``).  A type that
  does not hold the earlier values ends as an error row, before anything is written.
* Rows are tested against a typed contract in the aggregate that counts the
  source (``operators/contracts.py``).  Broken rows fail the run or, by the contract, go
  to the ``rejected`` zone; the source count still counts them.
* With key buckets in the contract the run keeps a digest of every bucket
  (``operators/keyed_state.py``): the next run compares only buckets whose digest moved, an
  unchanged snapshot reads nothing of the lake, and a bucketed state is not shuffled.
* A source that can change between reads (JDBC) is snapshotted once with a
  reliable checkpoint, so count, numbering and diff see the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from ..functions import (CORRUPT, EXTRACT_ACTION, RAW_ZONE, REJECTED_ZONE, SKIPPED_STATUS, SUCCESS_STATUS,
                         as_date)
from ..operators.changes import (ROW_NUMBER, TECHNICAL_COLUMNS, add_audit_columns, changed_rows,
                                 current_state, join_rows, new_values, row_key)
from ..operators.contracts import REASONS, ROW, BrokenRowsError, contract_profile, split_broken, typed
from ..operators.keyed_state import (BucketedState, bucket_digests, bucket_of, can_digest, changed_by_state, moved_buckets,
                                     signature)
from ..operators.ledger import Ledger, TableRuns, utcnow
from ..operators.rownum import attach_row_numbers, dense_row_number, key_profile, numbered_in_slices, row_hash
from ..operators.schemas import conform, merge_schemas, schema_record
from ..operators.slices import slice_count, value_slice
from ..session import ensure_checkpoint_dir, scratch_table, shuffles_removed
from ..sources.files import TableSource
from ..sources.lake import LakeTable, write_slices_observed
from ..specs import REJECT, ContractError, TableSpec, select_table
from .runs import NO_CHANGES, SKIPPED_EMPTY, SOURCE_SHRANK, WRITTEN, Outcome, each_table, log, record_error

NUMBERED_SHARE = 0.6  # numbering moves whole rows once, a comparison the rows of two tables


def diff_base(table: LakeTable, spec: TableSpec, schema: StructType, *, base: str, run_date, keyed: bool,
              pre_check_last_checkpoint: bool = False, runs: TableRuns | None = None) -> DataFrame | None:
    """The committed rows a new snapshot is compared with, in ``schema``
    (``None`` = none): the current state if ``keyed``, else every committed row."""
    if base == "day_path":
        day = table.read(job_date=run_date, runs=runs)
        if day is None and pre_check_last_checkpoint:
            last = table.ledger.last_checkpoint(zone=table.zone, db_name=table.ledger_db, table_name=table.table)
            if last:
                day = table.spark.read.format(table.fmt).option("basePath", table.base).load(last) \
                    .drop("ingest_date", "batch_id")
        return None if day is None else conform(day, schema, table.renames, table.fill)
    if base == "current" and keyed:
        versions = table.read_state_inputs(runs)
        if versions is None:
            return None
        return conform(current_state(versions, spec.primary_key), schema, fill=table.fill)
    committed = table.read(runs=runs)
    return None if committed is None else conform(committed, schema, fill=table.fill)


def _digests(table: LakeTable, spec: TableSpec, df: DataFrame, business: list[str], batch_id: str,
             runs: TableRuns) -> tuple[dict, list[int] | None]:
    """This snapshot's digests, stored beside the batches: their record, and the buckets that moved
    since the newest run (``None``: it kept none that can be compared)."""
    key = list(spec.primary_key)
    record = {"path": f"{table.base}/_digests/{batch_id}", **signature(df.schema, business, key, spec.buckets)}
    bucket_digests(df, business, key, spec.buckets).coalesce(1).write.parquet(record["path"])
    now = table.spark.read.parquet(record["path"])
    # only the newest run tells what the lake holds now
    before = json.loads((runs.hits(table.action) or [{}])[-1].get("digests") or "null")
    if before and all(before.get(k) == v for k, v in record.items() if k != "path"):
        return record, moved_buckets(now, table.spark.read.parquet(before["path"]))
    return record, None


def _changed_in_buckets(table: LakeTable, spec: TableSpec, df: DataFrame, business: list[str], runs: TableRuns,
                        moved: list[int] | None, state: BucketedState | None, later: DataFrame | None) -> DataFrame:
    """Rows of ``df`` that changed, compared in the buckets that moved only."""
    key, wanted = list(spec.primary_key), df.select(*business).schema

    def inside(rows: DataFrame) -> DataFrame:
        return rows if moved is None else rows.where(bucket_of(key, spec.buckets).isin(moved))

    same_key = state is not None and state.key == key and all(state.schema[c].dataType == df.schema[c].dataType
                                                              for c in key if c in state.schema.names)
    if same_key and set(key) <= set(state.schema.names):
        few = moved is not None and state.buckets == spec.buckets and 2 * len(moved) < spec.buckets
        base = state.rows_of(moved) if few else state.rows()
        newest = None if later is None else conform(current_state(inside(later), key), wanted, fill=table.fill)
        return changed_by_state(inside(df), conform(base, wanted, table.renames, table.fill), newest, business, key)
    versions = table.read_state_inputs(runs)
    base = None if versions is None else conform(current_state(inside(versions), key), wanted, fill=table.fill)
    return changed_rows(inside(df), base, business, base_unique=True, key=key)


def _changed_values(df: DataFrame, base: DataFrame | None, columns: list[str], slices: int, place: str) -> DataFrame:
    """The different values of the rows of ``df`` that are not in ``base``, stored at ``place``; compared a slice of the values at a time."""
    for i in range(slices):
        some, old = (x if x is None else value_slice(x, columns, slices, i) for x in (df, base))
        changed = new_values(some, old, columns, "__changed")
        changed.write.mode("append").parquet(place)
    return df.sparkSession.read.schema(changed.schema).parquet(place)


def _keep_broken(table: LakeTable, broken: DataFrame, run_date) -> int:
    """Append broken rows that the table's side table does not hold yet."""
    side = LakeTable(table.spark, table.ledger, table.root, REJECTED_ZONE, table.table, table.db_name, table.schema,
                     table.action, table.fmt)
    return side.append(changed_rows(broken, side.read(), [REASONS, ROW]), run_date)


def extract_table(spark: SparkSession, lake_root: str, ledger: Ledger, source: TableSource, spec: TableSpec, *,
                  db_name: str, schema: str, run_date, zone: str = RAW_ZONE, action: str = EXTRACT_ACTION,
                  base: str = "current", legacy: bool = False, pre_check_last_checkpoint: bool = False,
                  snapshot: bool | None = None, log_skipped: bool = False,
                  history: TableRuns | None = None, fmt: str = "parquet") -> Outcome:
    """I1 for one table (decision table in the module docstring).

    ``log_skipped`` logs a ``skipped`` ledger row (with the source count and
    the watermark) when the source has fewer rows than the watermark; the
    reference logs nothing there, and a skipped row never moves the
    watermark.  ``history`` is the table's run history when the caller has
    already read it (``run_extract`` reads all tables' histories at once).
    Every failure becomes an error row; only a broken contract stops the run.
    """
    start = utcnow()
    run_date = as_date(run_date)
    table = LakeTable(spark, ledger, lake_root, zone, spec.name, db_name, schema, action, fmt, renames=spec.renames, fill=spec.fill)
    path, batch_id = table.new_batch_path(run_date)
    details = {"sink_path": path, **spec.config()}
    pk, c = list(spec.primary_key), 0
    stack = ExitStack()
    try:
        stack.enter_context(shuffles_removed(spark))
        df = source.read(spark)
        if snapshot if snapshot is not None else not source.stable:
            ensure_checkpoint_dir(spark)
            df = df.checkpoint(eager=True)
        df = df.withColumnsRenamed({old: new for old, new in spec.renames.items() if new not in df.columns})
        # The count is needed for every non-empty source; with a key the same
        # narrow aggregate tells whether the key is unique and non-null.
        broken = None
        if spec.checks_rows or CORRUPT in df.columns:
            spec.check(df)
            profile = contract_profile(df, spec)
            c, unique = profile.rows, profile.unique
            if profile.broken:
                details["broken"] = profile.broken
                if spec.on_broken == REJECT:
                    raise BrokenRowsError(f"rows of {spec.name} break its contract: {profile.broken}")
                df, broken = split_broken(df, spec, profile)
                unique = unique or spec.unique_key
            else:
                df = typed(df, spec)
        elif pk and set(pk) <= set(df.columns):
            c, unique = key_profile(df, pk)
        else:
            c, unique = (source.count(spark, df) if source.stable else df.count()), False
        if c == 0:
            log.info("extract ignored, source empty: %s.%s", db_name, spec.name)
            return Outcome(spec.name, SKIPPED_EMPTY)
        spec.check(df)
        business = [x for x in df.columns if x not in TECHNICAL_COLUMNS]
        history = history or table.runs()  # one ledger query answers the watermark and the base batches
        w = history.watermark(action)
        if 0 < w and c < w:
            log.info("extract skipped, %s.%s has %d rows < watermark %d", db_name, spec.name, c, w)
            if log_skipped:
                ledger.record(db_name=db_name, table_name=spec.name, action=action, zone=zone, status=SKIPPED_STATUS,
                              last_row_number=c, details={"reason": SOURCE_SHRANK, "watermark": w},
                              job_date=run_date, job_start=start, job_end=utcnow())
            return Outcome(spec.name, SOURCE_SHRANK, last_row_number=c)
        known = table.current_schema(history)
        if known is not None:
            own = StructType([f for f in known.fields if f.name not in TECHNICAL_COLUMNS])
            whole = merge_schemas([StructType([df.schema[x] for x in business]), own], spec.name)
            technical = [df.schema[x] for x in df.columns if x in TECHNICAL_COLUMNS]
            df, business = conform(df, StructType([*whole.fields, *technical]), fill=spec.fill), whole.names
        if broken is not None:
            details["rejected_rows"] = _keep_broken(table, broken, run_date)

        def stamp(numbered: DataFrame) -> DataFrame:
            return add_audit_columns(numbered, run_date, created=spec.make_created_at, updated=spec.make_updated_at,
                                     legacy=legacy)

        def hashed_order() -> tuple[DataFrame, list[str]]:
            order = [*(k for k in pk if k in df.columns), "__row_hash"]  # equal rows keep their scan order
            return df.withColumn("__row_hash", row_hash(business)), order

        def numbered_whole() -> DataFrame:
            if unique:
                return stamp(dense_row_number(df, pk, unique=True))
            return stamp(dense_row_number(*hashed_order()).drop("__row_hash"))

        keyed = unique and base == "current" and not legacy
        buckets = keyed and spec.buckets > 0 and can_digest(df.schema, business)
        moved = None
        if buckets:
            details["digests"], moved = _digests(table, spec, df, business, batch_id, history)
            if w > 0 and moved == []:
                log.info("extract found no bucket changed: %s.%s", db_name, spec.name)
                return Outcome(spec.name, NO_CHANGES, last_row_number=c)
        if w == 0 and unique:
            parts = [numbered_whole()]
        elif w == 0:
            rows_in_order, order = hashed_order()
            slices = slice_count(df, rows=c, share=NUMBERED_SHARE)
            parts = map(stamp, numbered_in_slices(rows_in_order, order, df.columns, slices, c, ROW_NUMBER))
        elif buckets:
            stored = table.bucketed_state(history)
            if stored is not None:
                stack.enter_context(stored[0])
            changed = _changed_in_buckets(table, spec, df, business, history, moved, *(stored or (None, None)))
            parts = [stamp(attach_row_numbers(changed, df, pk, name=ROW_NUMBER))]
        elif not unique and not legacy:
            # which rows changed, before any is numbered: an unchanged snapshot is not numbered at all
            base_df = diff_base(table, spec, df.select(*business).schema, base=base, run_date=run_date, keyed=False,
                                pre_check_last_checkpoint=pre_check_last_checkpoint, runs=history)
            slices = slice_count(df, base_df, rows=c)
            # a column of no type is null on both sides, and cannot be stored
            compare = [x for x in business if not isinstance(df.schema[x].dataType, NullType)]
            changed = _changed_values(df, base_df, compare, slices, stack.enter_context(scratch_table(spark, "changed")))
            values = changed.count()
            if values == 0:
                log.info("extract found no changes: %s.%s", db_name, spec.name)
                return Outcome(spec.name, NO_CHANGES, last_row_number=c)
            # rows at the place of a changed value in the order keep their columns; whole rows decide once these are numbered
            rows_in_order, order = hashed_order()
            own = [x for x in order if x in compare or x not in business]
            found = changed.select(*[F.col("__changed")[x].cast(df.schema[x].dataType).alias(x) for x in compare])
            places = found.withColumn("__row_hash", row_hash(compare)).select(F.struct(*own).alias("__place")).dropDuplicates()

            def place_only(part: DataFrame) -> DataFrame:  # rows at no changed place count, but carry nothing else
                met = join_rows(part, F.struct(*own), places, "__place", "left")
                row = F.when(F.col("__place").isNotNull(), F.struct(*[F.col(x) for x in df.columns]))
                return met.select(*[x for x in part.columns if x not in df.columns or x in order], row.alias("__row"))

            def changed_only(numbered: DataFrame) -> DataFrame:
                rows = numbered.where(F.col("__row").isNotNull()).select("__row.*", ROW_NUMBER)
                return stamp(join_rows(rows, row_key(rows, compare), changed, "__changed", "left_semi"))

            carried = min(1.0, (len(order) + 2) / len(df.columns) + values / c)
            slices = slice_count(df, rows=c, share=NUMBERED_SHARE * carried)
            numbered = numbered_in_slices(rows_in_order, order, ["__row"], slices, c, ROW_NUMBER, place_only)
            parts = map(changed_only, numbered)
        else:
            # With a unique key the unnumbered rows are compared, then the key
            # alone is numbered and joined back: full rows move once, by key.
            fresh = df if unique and not legacy else numbered_whole()
            compare = fresh.columns if legacy else business
            base_df = diff_base(table, spec, fresh.select(*compare).schema, base=base, run_date=run_date, keyed=keyed,
                                pre_check_last_checkpoint=pre_check_last_checkpoint, runs=history)
            to_write = changed_rows(fresh, base_df, compare, base_unique=keyed, key=pk if keyed else ())
            if fresh is df:
                to_write = stamp(attach_row_numbers(to_write, df, pk, name=ROW_NUMBER))
            parts = [to_write]
        rows, top, written = write_slices_observed(parts, path, table.fmt, max_of=ROW_NUMBER)
        details["schema"] = schema_record(written)
        details["max_row_number"] = top  # A2 for the promotion, observed during the write
        if rows == 0:
            log.info("extract found no changes: %s.%s", db_name, spec.name)
            return Outcome(spec.name, NO_CHANGES, last_row_number=c)
        ledger.record(db_name=db_name, table_name=spec.name, action=action, zone=zone, status=SUCCESS_STATUS,
                      last_row_number=c, details=details, job_date=run_date, job_start=start, job_end=utcnow(),
                      run_id=batch_id)
        return Outcome(spec.name, WRITTEN, rows_written=rows, last_row_number=c, sink_path=path, details=details)
    except ContractError:
        raise
    except Exception as exc:  # noqa: BLE001 - every failure becomes an error row
        return record_error(ledger, db_name=db_name, table_name=spec.name, action=action, zone=zone,
                            job_date=run_date, job_start=start, error=exc, last_row_number=c, details=details)
    finally:
        stack.close()


def run_extract(spark: SparkSession, lake_root: str, ledger: Ledger, sources: Mapping[str, TableSource],
                specs: Mapping[str, TableSpec], *, db_name: str, schema: str, run_date,
                single_table: str | None = None, parallel: int = 1, **options) -> list[Outcome]:
    """I1 over every configured table (or one, P7), each a distributed job; ``parallel`` tables are in work at a time."""
    if single_table is not None:
        specs = {single_table: select_table(specs, single_table)}
    zone = options.get("zone", RAW_ZONE)
    # every table's history in one ledger query; each run writes only its own table's runs
    histories = ledger.histories(db_name=db_name, tables=[(zone, spec.name) for spec in specs.values()])

    def one(name: str) -> Outcome:
        spec = specs[name]
        return extract_table(spark, lake_root, ledger, sources[name], spec, db_name=db_name, schema=schema,
                             run_date=run_date, history=histories[(zone, spec.name)], **options)

    return each_table(spark, list(specs), one, parallel)

"""Transform-and-load template (I3) and the wide-table job (I4).

``TransformLoad.load`` runs the user's ``transform``, writes the result as a
new warehouse batch (replace semantics: the newest committed batch is the
table) while counting it with an ``Observation`` (A3, no second pass, no
``show``), and logs a success row with the count, or an error row with
``table_name=''`` and 0 rows.  Arguments are keyword-only, so zone and
action cannot be swapped (the reference's concrete job passes them the
wrong way round).
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import STAGING_ZONE, SUCCESS_STATUS, TRANSFORM_ACTION, WAREHOUSE_ZONE, as_date
from ..operators.changes import TECHNICAL_COLUMNS, current_state
from ..operators.joins import Dim, wide_join
from ..operators.ledger import Ledger, utcnow
from ..sources.lake import LakeTable, write_batch
from .runs import WRITTEN, Outcome, record_error


class TransformLoad(ABC):
    def __init__(self, spark: SparkSession, lake_root: str, ledger: Ledger, *, db_name: str,
                 zone: str = WAREHOUSE_ZONE, action: str = TRANSFORM_ACTION, fmt: str = "parquet"):
        self.spark = spark
        self.lake_root = lake_root
        self.ledger = ledger
        self.db_name = db_name
        self.zone = zone
        self.action = action
        self.fmt = fmt

    @abstractmethod
    def transform(self, **kwargs) -> tuple[DataFrame, str]:
        """Return the output frame and the output table name."""

    def output(self, table_name: str) -> LakeTable:
        # the warehouse layout (K7) has no db level; its ledger rows carry the db
        return LakeTable(self.spark, self.ledger, self.lake_root, self.zone, table_name, None, None, self.action,
                         self.fmt, logged_db=self.db_name)

    def read_output(self, table_name: str) -> DataFrame | None:
        return self.output(table_name).read(latest_only=True)

    def load(self, run_date, **kwargs) -> Outcome:
        start = utcnow()
        run_date = as_date(run_date)
        try:
            df, table_name = self.transform(**kwargs)
            target = self.output(table_name)
            path, batch_id = target.new_batch_path(run_date)
            rows = write_batch(df, path, target.fmt)
            details = {"sink_path": path}
            self.ledger.record(db_name=self.db_name, table_name=table_name, action=self.action, zone=self.zone,
                               status=SUCCESS_STATUS, last_row_number=rows, details=details, job_date=run_date,
                               job_start=start, job_end=utcnow(), run_id=batch_id)
            return Outcome(table_name, WRITTEN, rows_written=rows, last_row_number=rows, sink_path=path,
                           details=details)
        except Exception as exc:  # noqa: BLE001
            return record_error(self.ledger, db_name=self.db_name, table_name="", action=self.action,
                                zone=self.zone, job_date=run_date, job_start=start, error=exc)


@dataclass
class DimTable:
    """A staging table joined into a wide table."""

    table: str
    fact_key: str | Sequence[str]
    dim_key: str | Sequence[str]
    columns: Sequence[str] | None = None
    primary_key: Sequence[str] = ()


class WideTable(TransformLoad):
    """I4: fact ⋈ dimensions read from a zone, projected and de-duplicated
    by name (P1/P2).  ``current=True`` joins each table's current state by
    primary key instead of all appended versions; ``transform(job_date=...)``
    (or ``load(run_date, job_date=...)``) reads the batches of one day only,
    picked by their paths.  Every column the caller lists is in the output."""

    def __init__(self, spark, lake_root, ledger, *, db_name: str, schema: str, output_table: str, fact: str,
                 fact_columns: Sequence[str], dims: Sequence[DimTable], fact_key: Sequence[str] = (),
                 source_zone: str = STAGING_ZONE, current: bool = False, **kw):
        super().__init__(spark, lake_root, ledger, db_name=db_name, **kw)
        self.schema = schema
        self.output_table = output_table
        self.fact = fact
        self.fact_columns = list(fact_columns)
        self.fact_key = list(fact_key)
        self.dims = list(dims)
        self.source_zone = source_zone
        self.current = current

    def read_source(self, table: str, primary_key: Sequence[str], runs=None, job_date=None) -> DataFrame:
        t = LakeTable(self.spark, self.ledger, self.lake_root, self.source_zone, table, self.db_name, self.schema,
                      fmt=self.fmt)
        if self.current and primary_key and job_date is None:
            versions = t.read_state_inputs(runs)  # newest compaction snapshot + later batches
            if versions is None:
                raise ValueError(f"no committed batch of {self.source_zone}.{table}")
            df = current_state(versions, primary_key)
        else:
            df = t.read(runs=runs, job_date=job_date)
            if df is None:
                raise ValueError(f"no committed batch of {self.source_zone}.{table}")
        return df.drop(*[c for c in TECHNICAL_COLUMNS if c in df.columns])

    def transform(self, job_date=None, **kwargs) -> tuple[DataFrame, str]:
        # the histories of every source table in one ledger query
        hist = self.ledger.histories(db_name=self.db_name,
                                     tables=[(self.source_zone, t) for t in [self.fact, *[d.table for d in self.dims]]])
        fact = self.read_source(self.fact, self.fact_key, hist[(self.source_zone, self.fact)], job_date)
        # Join keys of later dimensions may come from earlier dimensions.
        keys = [k for d in self.dims for k in ([d.fact_key] if isinstance(d.fact_key, str) else d.fact_key)]
        needed = list(dict.fromkeys(self.fact_columns + [k for k in keys if k in fact.columns]))
        dims = [Dim(self.read_source(d.table, d.primary_key, hist[(self.source_zone, d.table)], job_date), d.fact_key,
                    d.dim_key, d.columns) for d in self.dims]
        out = wide_join(fact.select(*needed), dims)
        keep = self.fact_columns + [c for c in out.columns if c not in needed]
        return out.select(*keep), self.output_table

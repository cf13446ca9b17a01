"""Run outcome capture (I5): every run ends as a complete ledger row or as an
explicit, logged non-event.  ``each_table`` runs a job over many tables at once."""

from __future__ import annotations

import datetime as _dt
import logging
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from ..functions import ERROR_STATUS
from ..operators.ledger import Ledger, utcnow

log = logging.getLogger("lakezones")

# Outcome kinds (ledger rows are written only for WRITTEN and ERROR).
WRITTEN = "written"
SKIPPED_EMPTY = "skipped_empty"        # source has no rows
NO_CHANGES = "no_changes"              # diff against the base is empty
SOURCE_SHRANK = "source_shrank"        # fewer source rows than the watermark
NOT_NEWER = "not_newer"                # promotion: nothing above the day's row number
ERROR = "error"


@dataclass
class Outcome:
    table: str
    kind: str
    rows_written: int = 0
    last_row_number: int = 0
    sink_path: str | None = None
    error: str | None = None
    details: dict = field(default_factory=dict)


_SECRETS = re.compile(r"(?i)((?:password|passwd|pwd|user|token|secret|key)\s*=\s*)[^\s;&,]+|(//)[^/@\s]+@")


def error_text(error: BaseException) -> str:
    """Class and message of an error, without any stack and with credentials masked."""
    message = str(error).split("JVM stacktrace:")[0].strip()
    lines = [line for line in message.split("\n") if not re.match(r"\s*(at |\.\.\. \d+ more|File \"|Traceback)", line)]
    return f"{type(error).__name__}: " + _SECRETS.sub(lambda m: f"{m[1] or m[2]}***" + ("@" if m[2] else ""), " ".join(lines))[:2000]


def record_error(ledger: Ledger, *, db_name: str, table_name: str, action: str, zone: str, job_date,
                 job_start: _dt.datetime, error: BaseException, last_row_number: int = 0,
                 details: dict | None = None) -> Outcome:
    """Log a failed run with every ledger field set (the reference's error
    rows miss fields and use a key the logger does not read)."""
    info = dict(details or {})
    info["error_message"] = error_text(error)
    log.warning("run failed: %s.%s (%s): %s", db_name, table_name, zone, info["error_message"])
    ledger.record(db_name=db_name, table_name=table_name, action=action, zone=zone, status=ERROR_STATUS,
                  last_row_number=last_row_number, details=info, job_date=job_date, job_start=job_start,
                  job_end=utcnow())
    return Outcome(table=table_name, kind=ERROR, last_row_number=last_row_number,
                   sink_path=info.get("sink_path"), error=info["error_message"], details=info)


T = TypeVar("T")
POOL = "spark.scheduler.pool"


def each_table(spark: SparkSession, tables: Sequence[str], job: Callable[[str], T], parallel: int = 1) -> list[T]:
    """``job`` for every table, results in the order of ``tables``.

    With ``parallel`` above 1 so many tables are in work at a time, each thread in a scheduler pool of its table's name
    (under ``spark.scheduler.mode=FAIR`` the pools share the executors evenly, and pools that no file
    configures have equal weight).  Every table ends before the first exception, if any, is raised.
    """
    if parallel <= 1 or len(tables) <= 1:
        return [job(t) for t in tables]

    def pooled(name: str) -> T:
        context = spark.sparkContext
        context.setLocalProperty(POOL, name)
        try:
            return job(name)
        finally:
            context.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="lakezones-table") as pool:
        # a wrapper for each task: it copies the caller's local properties
        running = [pool.submit(inheritable_thread_target(spark)(pooled), t) for t in tables]
    return [r.result() for r in running]

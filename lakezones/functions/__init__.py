"""Column helpers (scalar functions N1-N7 and the hash fraction used by splits).

All of them return built-in ``Column`` expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same outputs.
SUCCESS_STATUS = "succeed"
ERROR_STATUS = "error"
SKIPPED_STATUS = "skipped"      # our own, opt-in: a run that wrote nothing on purpose
RAW_ZONE = "raw"
CORRUPT = "_corrupt_record"  # text of a line that a reader could not parse
REJECTED_ZONE = "rejected"  # rows that break a contract
STAGING_ZONE = "staging"
WAREHOUSE_ZONE = "warehouse"
EXTRACT_ACTION = "extract"
TRANSFORM_ACTION = "transform"
COMPACT_ACTION = "compact"      # our own: rewrite of a table's current state

DATE_TEXT_FORMAT = "yyyy-MM-dd"


def as_date(value: _dt.date | str) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(value)


def date_text(value: _dt.date | str) -> str:
    """Run date as ``yyyy-MM-dd`` text (driver-side constant)."""
    return as_date(value).strftime("%Y-%m-%d")


def date_text_col(c: Column | str) -> Column:
    """N3 as a column expression."""
    return F.date_format(c, DATE_TEXT_FORMAT)


def unpadded_date_key(value: _dt.date | str) -> str:
    """The reference's ``Y-M-D`` key without zero padding (``2024-3-8``)."""
    d = as_date(value)
    return f"{d.year}-{d.month}-{d.day}"


def unpadded_date_key_col(c: Column | str) -> Column:
    """N4 as a column: ``concat_ws('-', year, month, day)``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat_ws("-", F.year(c).cast("string"), F.month(c).cast("string"), F.dayofmonth(c).cast("string"))


def json_details(**fields: Column) -> Column:
    """Encode run details as JSON text."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def json_field(details: Column | str, key: str) -> Column:
    """Read one top-level key of a JSON text column."""
    details = F.col(details) if isinstance(details, str) else details
    return F.get_json_object(details, f"$.{key}")


def zero_if_null(c: Column) -> Column:
    """Coalesce-to-zero."""
    return F.coalesce(c, F.lit(0))


def hash_hex8(seed: int | str, keys: Iterable[str | Column]) -> Column:
    """First 8 hex digits of ``md5(seed|key...)``: a per-row uniform value that
    depends only on the row's key, never on partitioning, and that DuckDB
    computes identically (``md5`` + ``concat_ws``)."""
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)


def fraction_threshold(fraction: float) -> str:
    """Hex bound so that ``hash_hex8 < bound`` holds for ``fraction`` of keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    value = min(int(round(fraction * 16 ** 8)), 16 ** 8)
    return "g" if value == 16 ** 8 else f"{value:08x}"

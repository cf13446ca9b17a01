"""Collection -> count -> text job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.lake import write_text_counted


def count_and_save_text(df: DataFrame, path: str, columns: list[str] | None = None) -> tuple[int, bool]:
    """A4 + K3: count the rows while saving them as Python-tuple text lines.

    Returns ``(count, written)``; ``written`` is False when ``path`` already
    exists (the error is logged and swallowed, as in the reference).
    """
    n = write_text_counted(df, path, columns)
    return (df.count(), False) if n is None else (n, True)

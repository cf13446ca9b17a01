"""Column summaries and counts.

``describe`` is Spark's own (strings for every statistic).  ``describe_numeric``
is its typed twin: one aggregation pass over all columns (partial aggregates
combine map-side), unpivoted to one row per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Spark's ``describe`` (count, mean, stddev, min, max; all text)."""
    return df.describe(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """A8, typed: ``column, count, mean, stddev, min, max`` as numbers.

    Mean and standard deviation (sample) are rounded to ``digits`` so two
    engines with different summation orders agree.
    """
    columns = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                     F.round(F.col(f"a{i}"), digits).alias("mean"), F.round(F.col(f"s{i}"), digits).alias("stddev"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A3/A4 for many tables: ``table_name, row_count`` (one count job per
    table, unioned; Parquet counts read no column data)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

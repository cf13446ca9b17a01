"""JDBC sources (S1, S2) and the source-side row count (A1).

The reference reads every table as one JDBC partition.  Here a table read
takes ``partition_column`` / bounds / ``num_partitions`` so a large table is
read by many tasks in parallel; when bounds are not given they are fetched
with one ``MIN``/``MAX`` query pushed to the database.  Keys that are text, or numbers
with gaps, are read in ``even`` ranges: the database itself cuts its keys into ranges of
as many rows, and each range is one task's predicate.  Predicates and column
pruning reach the database through Catalyst's JDBC pushdown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

DEFAULT_PARTITIONS = 8


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = dict(self.properties)
        opts["url"] = self.url
        if self.driver:
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        return opts

    def __repr__(self) -> str:  # never print credentials
        return f"JdbcConnection(url={self.url!r}, driver={self.driver!r}, user={'***' if self.user else None})"


def table_options(conn: JdbcConnection, table: str, *, partition_column: str | None = None,
                  lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                  fetch_size: int | None = None) -> dict[str, str]:
    opts = conn.options()
    opts["dbtable"] = table
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(int(num_partitions)))
    if fetch_size:
        opts["fetchsize"] = str(int(fetch_size))
    return opts


def query_options(conn: JdbcConnection, sql: str) -> dict[str, str]:
    opts = conn.options()
    opts["query"] = sql
    return opts


def read_query(spark: SparkSession, conn: JdbcConnection, sql: str) -> DataFrame:
    """Run a statement in the database and scan its result."""
    return spark.read.format("jdbc").options(**query_options(conn, sql)).load()


def boundary_sql(table: str, column: str, ranges: int) -> str:
    """The least key of each of ``ranges`` ranges of as many rows, in the database's own order; null keys are left out."""
    return (f"SELECT tile, MIN(k) AS k FROM (SELECT {column} AS k, NTILE({int(ranges)}) OVER (ORDER BY {column}) AS tile "
            f"FROM {table} WHERE {column} IS NOT NULL) t GROUP BY tile")


def sql_literal(value) -> str:
    """A key as a standard SQL literal."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, date, str)):
        raise TypeError(f"a key of type {type(value).__name__} has no literal")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, starts: Sequence) -> list[str]:
    """One predicate a range, given the least keys of the ranges in ascending order.

    Every row fits exactly one: the first takes all keys below the second range and null keys, the last has no end.
    A key that fills several ranges starts only one.
    """
    cuts = [sql_literal(v) for i, v in enumerate(starts) if i and v != starts[i - 1]]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def read_table(spark: SparkSession, conn: JdbcConnection, table: str, *,
               partition_column: str | None = None, num_partitions: int | None = None,
               lower_bound=None, upper_bound=None, fetch_size: int | None = 10_000, even: bool = False) -> DataFrame:
    """Scan a whole table, in ``num_partitions`` (default
    ``DEFAULT_PARTITIONS``) ranges of ``partition_column`` if that is a number
    or a date; a text column, an empty table or none given is one plain read.

    ``even``: ranges of as many rows, for a key of any type that has an order (text too).  Their ends come from one
    query in the database (``NTILE``), ``num_partitions`` rows back."""
    if partition_column and even:
        rows = read_query(spark, conn, boundary_sql(table, partition_column, num_partitions or DEFAULT_PARTITIONS)).collect()
        starts = [r[1] for r in sorted(rows, key=lambda r: r[0])]
        properties = {k: v for k, v in table_options(conn, table, fetch_size=fetch_size).items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(conn.url, table, predicates=range_predicates(partition_column, starts), properties=properties)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            bounds = read_query(spark, conn, f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                                             f"FROM {table}").first()
            lower_bound, upper_bound = bounds["lo"], bounds["hi"]
        if not isinstance(lower_bound, (int, float, Decimal, date)):
            partition_column = None
    opts = table_options(conn, table, partition_column=partition_column, lower_bound=lower_bound,
                         upper_bound=upper_bound, num_partitions=num_partitions or DEFAULT_PARTITIONS,
                         fetch_size=fetch_size)
    return spark.read.format("jdbc").options(**opts).load()


def count_rows(spark: SparkSession, conn: JdbcConnection, table: str) -> int:
    """A1: ``COUNT(*)`` evaluated inside the database, one row back."""
    return int(read_query(spark, conn, f"SELECT COUNT(*) AS n FROM {table}").first()[0])

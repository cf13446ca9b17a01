"""Dense, deterministic row numbers (P4 / W1) without a single-partition window.

The reference numbers rows with ``monotonically_increasing_id() + 1``, which
is dense only on one partition.  A global ``row_number()`` window is dense
but moves every row into one task.  One path serves all sizes:

1. A range shuffle on *all* order columns plus a scan-position tie breaker,
   as wide as ``spark.sql.shuffle.partitions``.  Neither a hot leading value
   nor copies of one row pile up in one partition: the tie breaker tells
   them apart.
2. A reliable ``checkpoint()`` in the shared folder fixes the partitions.
3. Rows per partition (one number each) become offsets; a row's number is
   its partition's offset plus its place in the partition.

When the order columns are a unique, non-null key (``key_profile`` tells, with
one aggregate), only the key is shuffled, checkpointed and numbered, and the
numbers are joined back on it.  Otherwise the rows are carried whole.

``numbered_in_slices`` does the same a range of order values at a time: each
slice is fixed in a scratch table that is deleted once its rows are written, and
the next goes on with its numbers.  Columns that are not written need not be carried.

Equal order values (only possible without a unique key) are numbered in scan
order.  ``row_hash`` is a good leading column for tables without a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_table, shuffles_removed
from .slices import range_slices

_TIE = "__rn_tie"
_PART = "__rn_part"
_POS = "__rn_pos"
_OFFSET = "__rn_offset"
# monotonically_increasing_id keeps the record number within a partition in
# its lower 33 bits
_IN_PARTITION = (1 << 33) - 1


def dense_row_number(df: DataFrame, order_by: Sequence[str], name: str = "ROW_NUMBER",
                     unique: bool = False) -> DataFrame:
    """``1..n`` in ``order_by`` order, nulls first.  ``unique``: the order
    columns are known to be a unique, non-null key."""
    order_by = list(order_by)
    if not order_by:
        raise ValueError("dense_row_number needs order columns")
    if unique and set(df.columns) != set(order_by):
        return attach_row_numbers(df, df, order_by, name)
    return _numbered(df, order_by, name)


def _numbered(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    fixed = _placed(df.withColumn(_TIE, F.monotonically_increasing_id()), order_by, width).checkpoint(eager=True)
    return _with_offsets(fixed, df.columns, name)[0]


def _placed(tied: DataFrame, order_by: Sequence[str], width: int) -> DataFrame:
    """Rows in order, with their partition and their place in it."""
    order = [F.col(c).asc_nulls_first() for c in order_by] + [F.col(_TIE).asc()]
    return (tied.repartitionByRange(width, *order)
            .sortWithinPartitions(*order)
            .withColumn(_PART, F.spark_partition_id())
            .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))))


def _with_offsets(fixed: DataFrame, columns: Sequence[str], name: str, before: int = 0) -> tuple[DataFrame, int]:
    """The numbers of fixed rows, which follow ``before``, and the last of them."""
    offsets, running = [], before
    for row in sorted(fixed.groupBy(_PART).count().collect(), key=lambda r: r[_PART]):  # one row a partition
        offsets.append((row[_PART], running))
        running += row["count"]
    offset_rows = fixed.sparkSession.createDataFrame(offsets, f"{_PART} int, {_OFFSET} long")
    out = fixed.join(F.broadcast(offset_rows), _PART)  # as many rows as shuffle partitions
    return out.withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(1).cast("long")).select(*columns, name), running


def numbered_in_slices(df: DataFrame, order_by: Sequence[str], columns: Sequence[str], slices: int, rows: int, name: str = "ROW_NUMBER",
                       carry: Callable[[DataFrame], DataFrame] | None = None) -> Iterator[DataFrame]:
    """``columns`` of ``dense_row_number(df, order_by)``, a frame for each of so many ranges of the order.

    A frame must be written before the next is asked for.  ``carry`` may change the ``columns`` of a slice, but neither its rows nor
    its other columns.
    """
    spark, before = df.sparkSession, 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    width = max(-(-width // slices), min(width, spark.sparkContext.defaultParallelism))
    for part in range_slices(df.withColumn(_TIE, F.monotonically_increasing_id()), order_by, slices, rows):
        with scratch_table(spark, "numbering") as path:
            placed = _placed(carry(part) if carry else part, order_by, width).select(*columns, _PART, _POS)
            with shuffles_removed(spark):
                placed.write.parquet(path)
            out, last = _with_offsets(spark.read.schema(placed.schema).parquet(path), columns, name, before)
            if last > before:
                yield out
            before = last


def key_profile(df: DataFrame, key: Sequence[str]) -> tuple[int, bool]:
    """Row count of ``df`` and whether ``key`` is unique and non-null there:
    one aggregate over the key columns, combined before the shuffle."""
    null_key = F.lit(False)
    for c in key:
        null_key = null_key | F.col(c).isNull()
    row = (df.groupBy(*key).count()
           .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.max("count").alias("most"),
                F.max(null_key).alias("nulls")).first())
    return int(row["n"]), row["most"] in (None, 1) and not row["nulls"]


def attach_row_numbers(rows: DataFrame, universe: DataFrame, key: Sequence[str],
                       name: str = "ROW_NUMBER") -> DataFrame:
    """Give ``rows`` their position in ``key`` order of ``universe`` (which
    holds every row of ``rows``; ``key`` unique and non-null there, see
    ``key_profile``).

    Only the key columns are numbered; the numbers are joined back on the
    key.  When ``rows`` is already hash-partitioned by the key (the output of
    a diff joined on it) only the narrow numbers move.
    """
    key = list(key)
    numbers = _numbered(universe.select(*key), key, name)
    return rows.join(numbers, key, "inner").select(*rows.columns, name)


def row_hash(columns: Sequence[str]) -> Column:
    """A well-spread leading order column for tables without a primary key:
    numbering by ``(row_hash, *columns)`` is repeatable (only fully identical
    rows share a hash)."""
    return F.xxhash64(*[F.col(c) for c in columns])

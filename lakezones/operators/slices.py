"""Large tables worked on a slice at a time, so that shuffles and scratch tables hold one slice, not the table.

Every row is in exactly one slice, by its own values: a slice is the same rows in whatever order or partitions a
frame comes.  ``value_slice`` keeps equal rows together, ``range_slices`` cuts in the order of some columns.  The number of
slices follows the table's size up to ``MOST_SLICES``, as every slice reads the table again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StructField, StructType

SLICE_BYTES = 128 << 20
MOST_SLICES = 4
_UNKNOWN = 1 << 60  # Spark takes a frame of unknown size for at least as large
_PACKED = 3  # bytes of a row in memory for one in a file, about
_PER_CUT = 500  # sampled rows; they only decide where to cut


def slice_count(*frames: DataFrame | None, rows: int = 0, share: float = 1.0) -> int:
    """Slices for a job over the frames, by the files below them; ``rows``, if known, are those of the first.

    ``share`` is what the job keeps on disk for a row against a comparison of whole rows.
    """
    size = 0
    for df in frames:
        if df is not None:
            leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
            below = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
            size += _PACKED * sum(b for b in below if b < _UNKNOWN)
    if frames and frames[0] is not None:
        size = max(size, 8 * rows * len(frames[0].columns))
    return max(1, ceil(min(MOST_SLICES, size / SLICE_BYTES) * share))


def value_slice(df: DataFrame, columns: Sequence[str], slices: int, number: int, like: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose values of ``columns`` fall into slice ``number``: equal rows (null = null, -0.0 = 0.0) share one.

    Frames that are to meet need equal types; ``like`` has those to compare in, where ``df`` has others.
    """
    if slices == 1:
        return df
    types = (df if like is None else like).schema
    return df.where(F.pmod(F.xxhash64(*[_plain(F.col(c).cast(types[c].dataType), types[c].dataType) for c in columns]), F.lit(slices)) == number)


def _plain(column: Column, kind: DataType) -> Column:
    return column + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else column


def range_slices(df: DataFrame, order_by: Sequence[str], slices: int, rows: int) -> Iterator[DataFrame]:
    """``df`` (of about ``rows`` rows) cut into ranges of ``order_by``, lowest first, nulls first.

    Rows of one order value share a slice, so there may be fewer slices.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    cuts: list = []
    if slices > 1:
        some = df.select(order.alias("o")).sample(min(1.0, _PER_CUT * slices / max(1, rows)), seed=0).sort("o").collect()  # bounded
        for i in range(1, slices if some else 0):
            cut = some[len(some) * i // slices]["o"]
            if cut not in cuts:
                cuts.append(cut)
    if not cuts:
        yield df
        return
    kind = ArrayType(df.select(order.alias("o")).schema["o"].dataType)
    names = [f"__cut{i}" for i in range(len(cuts))]
    bounds = df.sparkSession.createDataFrame([(cuts,)], StructType([StructField("c", kind)])).select(F.sort_array("c").alias("c"))
    bounds = bounds.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)])
    for low, high in zip([None, *names], [*names, None]):
        inside = [order >= F.col(low)] if low else []
        inside += [order < F.col(high)] if high else []
        one_row = F.broadcast(bounds.select(*[n for n in (low, high) if n]))
        yield df.join(one_row, reduce(Column.__and__, inside)).select(*df.columns)

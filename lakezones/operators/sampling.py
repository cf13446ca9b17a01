"""Splits and samples (M1, M2, O2).

``random_split`` / ``bernoulli_sample`` are Spark's own (as in the
reference); their result depends on how the input is partitioned.
``hash_split`` / ``hash_sample`` decide per row from ``md5(seed|key)``, so a
row lands in the same part however the data is partitioned, and the same
rule runs in DuckDB.  Both are narrow (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fraction_threshold, hash_hex8


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """M1: Spark's ``randomSplit``."""
    return df.randomSplit(list(weights), seed=seed)


def bernoulli_sample(df: DataFrame, fraction: float = 0.1, seed: int = 0) -> DataFrame:
    """M2: Spark's ``sample`` without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _bounds(weights: Sequence[float]) -> list[tuple[str | None, str | None]]:
    total = float(sum(weights))
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    cum, out, lo = 0.0, [], None
    for i, w in enumerate(weights):
        cum += w / total
        hi = None if i == len(weights) - 1 else fraction_threshold(min(cum, 1.0))
        out.append((lo, hi))
        lo = hi
    return out


def split_part(key: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = 42):
    """Index of the part a row belongs to (0-based), as a column."""
    h = hash_hex8(seed, key)
    bounds = _bounds(weights)
    expr = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        expr = F.when(h < F.lit(bounds[i][1]), F.lit(i)).otherwise(expr)
    return expr.cast("int")


def hash_split(df: DataFrame, key: Sequence[str], weights: Sequence[float] = (0.7, 0.3),
               seed: int = 42) -> list[DataFrame]:
    """M1, partition independent: part ``i`` holds rows whose hash falls in
    the ``i``-th cumulative slice of ``weights``."""
    part = split_part(key, weights, seed)
    return [df.filter(part == F.lit(i)) for i in range(len(weights))]


def hash_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """M2, partition independent."""
    return df.filter(hash_hex8(seed, key) < F.lit(fraction_threshold(fraction)))


def sample_limit(df: DataFrame, key: Sequence[str], fraction: float, n: int, seed: int = 0) -> DataFrame:
    """M2 + O2: a sample cut to ``n`` rows, ordered by key first so the
    result is repeatable (planned as a per-partition top-n, then a merge)."""
    return hash_sample(df, key, fraction, seed).orderBy(*key).limit(n)

"""Wide-table joins.

``wide_join`` chains inner equi-joins of a fact frame with dimension frames
and projects columns per side, resolving clashing names the way the
reference does (keep the fact's ``id``, drop the dimension's key and
technical columns).

No broadcast hint is given: Catalyst broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans a sort-merge join into a broadcast join at run time from the
*measured* shuffle size.  Both are size checks with a shuffle join beyond
them, so a dimension that grows with the data is never broadcast blindly.
Skewed join keys (one customer with a third of the orders) are split by
AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Dim:
    """One dimension of a wide join: ``fact[fact_key] == dim[dim_key]``."""

    frame: DataFrame
    fact_key: str | Sequence[str]
    dim_key: str | Sequence[str]
    columns: Sequence[str] | None = None        # dimension columns to keep (None = all but drop)
    drop: Sequence[str] = field(default_factory=tuple)   # dimension columns to drop (P2)
    how: str = "inner"


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def wide_join(fact: DataFrame, dims: Sequence[Dim], fact_columns: Sequence[str] | None = None) -> DataFrame:
    """J1/J2 + P1/P2: ``fact`` ⋈ every dimension in order.

    Rows whose key is null or unmatched vanish (inner join).  Each join adds
    only the projected dimension columns; name clashes are an error rather
    than silently ambiguous.
    """
    out = fact.select(*fact_columns) if fact_columns else fact
    for i, dim in enumerate(dims):
        fk, dk = _keys(dim.fact_key), _keys(dim.dim_key)
        if len(fk) != len(dk):
            raise ValueError("fact_key and dim_key must have the same length")
        keep = list(dim.columns) if dim.columns is not None else \
            [c for c in dim.frame.columns if c not in set(dim.drop) and c not in dk]
        clash = [c for c in keep if c in out.columns]
        if clash:
            raise ValueError(f"dimension {i} would duplicate columns {clash}; drop or rename them")
        aliases = {c: f"__d{i}_{c}" for c in dk}
        right = dim.frame.select(*[F.col(c).alias(aliases[c]) for c in dk], *keep)
        cond = [out[a] == right[aliases[b]] for a, b in zip(fk, dk)]
        out = out.join(right, cond, dim.how).drop(*aliases.values())
    return out

"""Schemas of batches: what each was written with, and one table over all of them.

Every batch's schema is kept with its run in the ledger.  A table's schema is the merge of its batches': a
column that is new is added, a type may grow as long as no value is lost, and a column that a batch does not have
is filled (null, or the contract's ``fill``).  Batches of one schema are one scan; only where schemas
differ is there a union, and its projections keep pruning and pushdown.

=====================================  =====================================
types                                  common type
=====================================  =====================================
byte, short, int, long                 the longer
byte, short, int with double           double
byte, short with float                 float
float with double                      double
whole numbers or decimals, decimal     decimal that holds all digits of both
date with timestamp without zone       timestamp without zone
null type with any                     the other
equal types of any kind                the same
=====================================  =====================================

Any other pair (text and number, long and double, decimal over 38 digits) is a ``SchemaChangeError``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType,
                               ShortType, StructField, StructType, TimestampNTZType)


class SchemaChangeError(ValueError):
    """A column changed to a type that does not hold its earlier values."""


MAX_DIGITS = 38  # of a decimal
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}  # decimal digits


def _digits(t: DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(t, DecimalType):
        return t.precision - t.scale, t.scale
    return (_WHOLE[type(t)], 0) if type(t) in _WHOLE else None


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds every value of both; ``None`` if there is none."""
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return a if _WHOLE[type(a)] > _WHOLE[type(b)] else b
    x, y = _digits(a), _digits(b)
    if x and y:
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return DecimalType(before + after, after) if before + after <= MAX_DIGITS else None
    for narrow, wide in ((a, b), (b, a)):
        if isinstance(wide, DoubleType) and isinstance(narrow, (ByteType, ShortType, IntegerType, FloatType)):
            return wide
        if isinstance(wide, FloatType) and isinstance(narrow, (ByteType, ShortType)):
            return wide
        if isinstance(wide, TimestampNTZType) and isinstance(narrow, DateType):
            return wide
    return None


def renamed(schema: StructType, renames: Mapping[str, str]) -> StructType:
    """``schema`` under today's names; ``renames`` maps earlier names to them."""
    return StructType([StructField(renames.get(f.name, f.name), f.dataType, True) for f in schema.fields])


def merge_schemas(schemas: Iterable[StructType], table: str = "table") -> StructType:
    """One schema that holds the rows of all, in order of first appearance."""
    types: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            known = types.get(f.name, f.dataType)
            common = common_type(known, f.dataType)
            if common is None:
                raise SchemaChangeError(f"{table}.{f.name} is {f.dataType.simpleString()} in one batch and {known.simpleString()} in another, "
                                        "and neither type holds the other's values")
            types[f.name] = common
    return StructType([StructField(n, t, True) for n, t in types.items()])


def conform(df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None,
            fill: Mapping[str, Any] | None = None) -> DataFrame:
    """``df`` as rows of ``schema``: columns renamed, widened, and filled where ``df`` has none; others are left out.

    A frame that already has the schema comes back as it is.
    """
    now = {(renames or {}).get(c, c): c for c in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = now.get(f.name)
        if own is None:
            out.append(F.lit((fill or {}).get(f.name)).cast(f.dataType).alias(f.name))
        elif types[own] == f.dataType:
            out.append(F.col(f"`{own}`").alias(f.name) if own != f.name else F.col(f"`{own}`"))
        else:
            out.append(F.col(f"`{own}`").cast(f.dataType).alias(f.name))
    same = df.columns == schema.names and all(types[f.name] == f.dataType for f in schema.fields)
    return df if same else df.select(*out)


def schema_record(schema: StructType) -> dict:
    """A schema as plain values for a run's details."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields]).jsonValue()


def recorded_schema(text: str | None) -> StructType | None:
    """The schema in a run's details (``None`` for runs that recorded none)."""
    return None if text is None else StructType.fromJson(json.loads(text))

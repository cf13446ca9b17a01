"""Typed table contracts (P6): types, nulls and keys, tested in the aggregate that profiles the key.

A rule gives each row that breaks it a reason:

=================  ==========================================================
reason             the row
=================  ==========================================================
``type:<column>``  has a value that the declared type does not hold
``null:<column>``  has no value in a column that must have one
``key:null``       has a null in its primary key (``unique_key``)
``key:repeated``   shares its primary key with another row (``unique_key``)
``malformed``      comes from a line the reader could not parse (alone: its other values mean nothing)
=================  ==========================================================

A value of a declared type passes as it is; a text is parsed, a number must keep its value.  ``contract_profile`` counts rows,
distinct keys and every reason in one aggregate over the key, combined before the shuffle; frames
without a broken row (the usual case) cost nothing more.  ``split_broken`` then parts the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from ..functions import CORRUPT
from ..specs import TableSpec
from .schemas import common_type

REASONS, ROW = "reasons", "row"
KEY_NULL, KEY_REPEATED, MALFORMED = "key:null", "key:repeated", "malformed"
_AS_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "ignoreNullFields": "false"}


class BrokenRowsError(ValueError):
    """Rows break a contract that rejects the whole run."""


def _value(df: DataFrame, name: str, declared: DataType) -> tuple[Column, Column]:
    """The value in its declared type, and whether it does not fit."""
    col, own = F.col(f"`{name}`"), df.schema[name].dataType
    if own == declared:
        return col, F.lit(False)
    if common_type(own, declared) == declared:  # every value fits
        return col.cast(declared), F.lit(False)
    text = F.trim(col) if isinstance(own, StringType) else col
    value = text.try_cast(declared)
    lost = value.isNull()
    if isinstance(own, NumericType) and isinstance(declared, NumericType):
        lost = lost | (value.cast("double") != col.cast("double")) | (value.try_cast(own) != col)
    return value, col.isNotNull() & F.coalesce(lost, F.lit(True))


def _declared(df: DataFrame, spec: TableSpec) -> dict[str, DataType]:
    return {c: DataType.fromDDL(r["type"]) for c, r in spec.columns.items() if r.get("type") and c in df.columns}


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` in the declared types (null where a value does not fit)."""
    types = _declared(df, spec)
    if CORRUPT not in df.columns and all(df.schema[c].dataType == t for c, t in types.items()):
        return df
    return df.select(*[_value(df, c, types[c])[0].alias(c) if c in types else F.col(f"`{c}`") for c in df.columns if c != CORRUPT])


def row_rules(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Reason and condition of every rule that one row can break alone."""
    rules = {}
    for c, declared in _declared(df, spec).items():
        rules[f"type:{c}"] = _value(df, c, declared)[1]
    for c, rule in spec.columns.items():
        if not rule.get("nullable", True):
            rules[f"null:{c}"] = F.col(f"`{c}`").isNull() if c in df.columns else F.lit(True)
    if spec.unique_key:
        null = F.lit(False)
        for c in spec.primary_key:
            null = null | F.col(f"`{c}`").isNull()
        rules[KEY_NULL] = null
    if CORRUPT in df.columns:
        parsed = F.col(CORRUPT).isNull()
        rules = {MALFORMED: ~parsed, **{reason: parsed & c for reason, c in rules.items()}}
    return rules


@dataclass
class ContractProfile:
    """Rows of a frame, whether its key is unique and non-null, and rows by broken rule."""

    rows: int
    unique: bool
    broken: dict[str, int] = field(default_factory=dict)


def _key(df: DataFrame, spec: TableSpec) -> list[Column]:
    types = _declared(df, spec)
    return [(_value(df, c, types[c])[0] if c in types else F.col(f"`{c}`")).alias(f"_k{i}") for i, c in enumerate(spec.primary_key)]


def contract_profile(df: DataFrame, spec: TableSpec) -> ContractProfile:
    """Row count, key uniqueness and every rule in one aggregate over the key."""
    rules = list(row_rules(df, spec).items())
    key = _key(df, spec) if spec.primary_key and set(spec.primary_key) <= set(df.columns) else []
    flags = [c.cast("int").alias(f"_r{i}") for i, (_, c) in enumerate(rules)]
    names = [f"_k{i}" for i in range(len(key))]
    sums = [F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rules))]
    parsed = F.col(CORRUPT).isNull() if CORRUPT in df.columns else F.lit(True)  # other lines have no key
    key = [F.when(parsed, c).alias(n) for c, n in zip(key, names)]
    groups = df.select(*key, *flags, parsed.alias("_ok")).groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("ok"), *sums)
    null = F.lit(False)
    for c in names:
        null = null | F.col(c).isNull()
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["n", *(f"_r{i}" for i in range(len(rules)))]]
    row = groups.agg(*total, F.max("n").alias("most"), F.max(null & (F.col("ok") > 0)).alias("nulls"),
                     F.coalesce(F.sum(F.when((F.col("n") > 1) & ~null, F.col("n"))), F.lit(0)).alias("repeated")).first()
    broken = {reason: int(row[f"_r{i}"]) for i, (reason, _) in enumerate(rules) if row[f"_r{i}"]}
    if spec.unique_key and row["repeated"]:
        broken[KEY_REPEATED] = int(row["repeated"])
    return ContractProfile(int(row["n"]), bool(key) and row["most"] in (None, 1) and not row["nulls"], broken)


def split_broken(df: DataFrame, spec: TableSpec, profile: ContractProfile) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, in its types; and the others as ``reasons`` (array of text) and ``row`` (JSON as it came, or the line).

    Only repeated keys need a join: with the repeated keys alone.
    """
    rules = row_rules(df, spec)
    reasons = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]), lambda x: x.isNotNull()) if rules \
        else F.array().cast("array<string>")
    flagged = df.withColumn("__reasons", reasons)
    if KEY_REPEATED in profile.broken:
        names = [f"_k{i}" for i in range(len(spec.primary_key))]
        sound = df.where(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else df
        keys = sound.select(*_key(df, spec)).groupBy(*names).count().where("count > 1").select(*names, F.lit(True).alias("__more"))
        flagged = flagged.withColumns(dict(zip(names, _key(df, spec)))).join(keys, names, "left").drop(*names)
        more = F.col("__more") & F.col(CORRUPT).isNull() if CORRUPT in df.columns else F.col("__more")
        again = F.when(more, F.array(F.lit(KEY_REPEATED))).otherwise(F.array().cast("array<string>"))
        flagged = flagged.withColumn("__reasons", F.concat("__reasons", again))
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != CORRUPT]), _AS_TEXT)
    if CORRUPT in df.columns:
        text = F.coalesce(CORRUPT, text)
    good = typed(flagged.where(F.size("__reasons") == 0).select(*df.columns), spec)
    return good, flagged.where(F.size("__reasons") > 0).select(F.col("__reasons").alias(REASONS), text.alias(ROW))

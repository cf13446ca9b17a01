"""Table contracts.

A contract lists, per load mode and table, the primary key, the columns a
source frame must carry, and which audit columns to stamp.  It may also say
what rows must meet (``columns``, ``unique_key``; ``operators/contracts.py``), what
becomes of rows that do not (``on_broken``), and how columns changed
(``renames``, ``fill``; ``operators/schemas.py``).  Contracts are job
configuration: they are loaded on the driver, never shipped with data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, asdict
from typing import Any

DEFAULT_MODE = "full_load"
REJECT = "reject"          # one broken row fails the run, nothing is written
QUARANTINE = "quarantine"  # broken rows go to a side table, the others load


class ContractError(ValueError):
    """A table contract is malformed or a frame does not satisfy it."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    required_columns: tuple[str, ...]
    primary_key: tuple[str, ...] = ()
    make_created_at: bool = True
    make_updated_at: bool = True
    extra: Mapping[str, Any] = field(default_factory=dict)
    #: ``{column: {"type": "decimal(12,2)", "nullable": False}}``
    columns: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    unique_key: bool = False          # no null and no repeated primary key
    on_broken: str = REJECT           # or QUARANTINE
    renames: Mapping[str, str] = field(default_factory=dict)  # earlier column names: today's
    fill: Mapping[str, Any] = field(default_factory=dict)     # values of a column in batches that do not have it
    buckets: int = 0  # key buckets of the stored state and of the digests of a snapshot (0: none)

    def __post_init__(self):
        if not self.required_columns:
            # The reference's "mandatory" error can never fire (an empty list
            # passes the subset test); we reject it when the spec is built.
            raise ContractError(f"table {self.name!r}: required_columns is mandatory and must not be empty")
        if self.on_broken not in (REJECT, QUARANTINE):
            raise ContractError(f"table {self.name!r}: on_broken is {REJECT!r} or {QUARANTINE!r}, not {self.on_broken!r}")
        if self.unique_key and not self.primary_key:
            raise ContractError(f"table {self.name!r}: unique_key needs a primary_key")

    @property
    def checks_rows(self) -> bool:
        return bool(self.columns) or self.unique_key

    def config(self) -> dict[str, Any]:
        """The spec as plain JSON-able values (goes into ledger details)."""
        out = asdict(self)
        out.pop("name")
        for optional in ("columns", "unique_key", "on_broken", "renames", "fill", "buckets"):
            if out[optional] in ({}, False, REJECT):
                del out[optional]
        out["required_columns"] = list(self.required_columns)
        out["primary_key"] = list(self.primary_key)
        out.update(out.pop("extra"))
        return out

    def missing_columns(self, columns) -> list[str]:
        present = set(columns)
        return [c for c in self.required_columns if c not in present]

    def check(self, df_or_columns) -> None:
        """Raise if any required column is missing."""
        columns = getattr(df_or_columns, "columns", df_or_columns)
        missing = self.missing_columns(columns)
        if missing:
            raise ContractError(f"Dataframe of {self.name} is missing {missing}")


def _as_tuple(value) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, str):
        return (value,)
    return tuple(value)


def spec_from_dict(name: str, raw: Mapping[str, Any]) -> TableSpec:
    known = {"primary_key", "required_columns", "make_created_at", "make_updated_at", "columns", "unique_key", "on_broken",
             "renames", "fill", "buckets"}
    return TableSpec(
        name=name,
        required_columns=_as_tuple(raw.get("required_columns")),
        primary_key=_as_tuple(raw.get("primary_key")),
        make_created_at=bool(raw.get("make_created_at", False)),
        make_updated_at=bool(raw.get("make_updated_at", False)),
        extra={k: v for k, v in raw.items() if k not in known},
        columns=dict(raw.get("columns") or {}),
        unique_key=bool(raw.get("unique_key", False)),
        on_broken=raw.get("on_broken", REJECT),
        renames=dict(raw.get("renames") or {}),
        fill=dict(raw.get("fill") or {}),
        buckets=int(raw.get("buckets", 0)),
    )


def load_specs(source: Mapping[str, Any] | str, mode: str = DEFAULT_MODE,
               table: str | None = None) -> dict[str, TableSpec]:
    """Contracts of one load mode, optionally restricted to one table.

    ``source`` is a mapping ``{mode: {table: {...}}}`` or a YAML file path.
    """
    if isinstance(source, str):
        import yaml  # only needed for file-based contracts

        with open(source, encoding="utf-8") as fh:
            source = yaml.safe_load(fh)
    if mode not in source:
        raise ContractError(f"load mode {mode!r} not in contracts ({sorted(source)})")
    tables = {name: spec_from_dict(name, raw or {}) for name, raw in source[mode].items()}
    if table is not None:
        return {table: select_table(tables, table)}
    return tables


def select_table(specs: Mapping[str, TableSpec], table: str) -> TableSpec:
    """One configured table, error if unknown."""
    if table not in specs:
        raise ContractError(f"{table} does not exist")
    return specs[table]

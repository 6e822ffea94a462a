"""The column contract of a table: what the target must look like and where each column comes from."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from freightlane.functions.types import SIZED_TYPES, spark_type, split_type


@dataclass(frozen=True)
class ColumnSpec:
    """One target column. `transform` is an SQL expression over source columns, used instead of `source`."""

    target: str
    canonical: str
    source: str = ""
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    role: str | None = None
    transform: str | None = None

    @property
    def source_name(self) -> str:
        return self.source or self.target

    @property
    def base(self) -> str:
        return split_type(self.canonical)[0]

    @property
    def dtype(self) -> T.DataType:
        return spark_type(self.canonical, self.precision, self.scale)

    @property
    def required(self) -> bool:
        return not self.nullable or self.role == "primary_key"

    @property
    def field(self) -> T.StructField:
        metadata = {"canonical": self.base}
        if self.role:
            metadata["role"] = self.role
        if self.length:
            metadata["max_length"] = self.length
        return T.StructField(self.target, self.dtype, not self.required, metadata)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent_table: str
    parent_column: str


@dataclass(frozen=True)
class Contract:
    source_table: str
    target_table: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __post_init__(self) -> None:
        """Columns of the declared key are key columns, and so required, whatever their entries say."""
        columns = tuple(replace(c, role="primary_key") if c.target in self.primary_key else c for c in self.columns)
        object.__setattr__(self, "columns", columns)

    @property
    def name(self) -> str:
        """Target table without its schema."""
        return self.target_table.rsplit(".", 1)[-1]

    @property
    def targets(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def key(self) -> list[str]:
        """Declared primary key, or else the columns whose role says so."""
        return list(self.primary_key) or [c.target for c in self.columns if c.role == "primary_key"]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.field for c in self.columns])


def column_spec(raw: Mapping[str, Any], key: Iterable[str] = ()) -> ColumnSpec:
    """A column entry of an approved mapping. Sizes come from the entry or from its target type text."""
    target = raw.get("target") or raw.get("source") or raw["name"]
    canonical = raw.get("canonical_type") or "TEXT"
    base, params = split_type(canonical)
    if not params:
        params = split_type(raw.get("target_type") or "")[1]
    role = raw.get("role")
    if target in key:
        role = "primary_key"
    length = raw.get("length") or (params[0] if params else None)
    precision = raw.get("precision") or (params[0] if params else None)
    scale = raw.get("scale")
    if scale is None and len(params) > 1:
        scale = params[1]
    sized, decimal = base in SIZED_TYPES, base == "DECIMAL"
    return ColumnSpec(
        target=target,
        canonical=base,
        source=raw.get("source") or target,
        length=length if sized else None,
        precision=precision if decimal else None,
        scale=scale if decimal else None,
        nullable=raw.get("nullable", True) is not False,
        role=None if role in (None, "", "null") else role,
        transform=raw.get("transform") or None,
    )


def contract_from(mapping: Mapping[str, Any]) -> Contract:
    """A contract from an approved mapping as stored in JSON."""
    columns = mapping.get("columns", [])
    renamed = {c["source"]: c["target"] for c in columns if c.get("source") and c.get("target")}
    targets = set(renamed.values())
    key = tuple(k if k in targets else renamed.get(k, k) for k in mapping.get("primary_key") or ())
    source = mapping.get("source_table", "")
    return Contract(
        source_table=source,
        target_table=mapping.get("target_table") or source,
        columns=tuple(column_spec(c, key) for c in columns),
        primary_key=key,
        foreign_keys=tuple(
            ForeignKey(f["column"], f["parent_table"], f["parent_column"])
            for f in mapping.get("foreign_keys") or ()
        ),
    )


def read_contracts(folder: str | Path, tables: Iterable[str] | None = None) -> list[Contract]:
    """All contracts in a folder of mapping files, by file name; `tables` keeps only these source tables."""
    wanted = set(tables) if tables else None
    found = [contract_from(json.loads(p.read_text("utf-8"))) for p in sorted(Path(folder).glob("*.json"))]
    return [c for c in found if wanted is None or c.source_table in wanted]

"""Declarative description of a silver table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from silvermill.functions.checks import check_sentinel
from silvermill.operators.normalize import normalize_json_array
from silvermill.operators.project import typed_projection

@dataclass(frozen=True)
class ColumnSpec:
    """One output column: its name, type, and where it comes from."""

    name: str
    type: str
    source: str | None = None
    date_format: str | None = None

    @property
    def origin(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class ArraySpec:
    """A JSON array column, the fields of its elements, and which ones to keep."""

    column: str
    element: Mapping[str, str]
    fields: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """How one bronze table becomes one silver table.

    `sentinels` fill missing key values. `slice_by` names the keys that decide
    where a row is stored; by default all of them.
    """

    name: str
    source: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    array: ArraySpec | None = None
    sentinels: Mapping[str, object] = field(default_factory=dict)
    slice_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        types = self.output_types()
        names = [c.name for c in self.columns]
        if self.array is not None:
            unknown = [f for f in self.array.fields if f not in self.array.element]
            if unknown:
                raise ValueError(f"{self.name}: fields {unknown} are not in the element")
            names += list(self.array.fields)
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: a column name occurs twice in {names}")
        if not self.keys:
            raise ValueError(f"{self.name}: a table needs a key")
        for key in (*self.keys, *self.slice_by):
            if key not in types:
                raise ValueError(f"{self.name}: key {key} is not a column")
        if not set(self.slice_by) <= set(self.keys):
            raise ValueError(f"{self.name}: slice_by must be among the keys")
        for column, value in self.sentinels.items():
            if column not in types:
                raise ValueError(f"{self.name}: sentinel column {column} is unknown")
            check_sentinel(column, types[column], value)

    def output_types(self) -> dict[str, str]:
        types = {c.name: c.type for c in self.columns}
        if self.array is not None:
            types.update({f: self.array.element[f] for f in self.array.fields
                          if f in self.array.element})
        return types

    @property
    def column_names(self) -> list[str]:
        return list(self.output_types())

    def transform(self, bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Rows of this table; `carry` columns pass through unchanged."""
        if self.array is None:
            return typed_projection(bronze, self.columns, self.sentinels, carry)
        return normalize_json_array(
            bronze,
            parents=self.columns,
            array=self.array.column,
            element=self.array.element,
            fields=self.array.fields,
            sentinels=self.sentinels,
            carry=carry,
        )

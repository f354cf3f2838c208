"""Descriptions of tables and keys that callers hand to the operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

PRIMARY = "PRIMARY_KEY"
UNIQUE = "UNIQUE"


def _column_tuple(columns, what: str) -> tuple[str, ...]:
    names = (columns,) if isinstance(columns, str) else tuple(columns)
    if not names:
        raise ValueError(f"{what} must name at least one column")
    return names


@dataclass(frozen=True)
class Key:
    """A primary or unique key: a name and its ordered columns."""

    name: str
    columns: tuple[str, ...]
    kind: str = PRIMARY

    def __post_init__(self):
        object.__setattr__(self, "columns", _column_tuple(self.columns, f"key {self.name}"))
        if self.kind not in (PRIMARY, UNIQUE):
            raise ValueError(f"key {self.name}: unknown kind {self.kind}")


@dataclass(frozen=True)
class ForeignKey:
    """A reference from ``child`` to ``parent``.

    ``match`` is ``"simple"`` (a key with any null column is not checked) or
    ``"full"`` (a composite key must be all null or all set).
    """

    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    match: str = "simple"

    def __post_init__(self):
        object.__setattr__(self, "columns", _column_tuple(self.columns, f"foreign key {self.name}"))
        object.__setattr__(
            self, "parent_columns", _column_tuple(self.parent_columns, f"foreign key {self.name}")
        )
        if len(self.columns) != len(self.parent_columns):
            raise ValueError(f"foreign key {self.name}: columns and parent columns differ in number")
        if self.match not in ("simple", "full"):
            raise ValueError(f"foreign key {self.name}: match must be 'simple' or 'full'")


@dataclass(frozen=True)
class Table:
    """A table with its keys; ``scales`` gives the decimals kept of double columns, and
    ``fingerprint`` the method of its checksums (``"md5"`` or ``"xxhash64"``)."""

    name: str
    schema: str = ""
    keys: tuple[Key, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    scales: Mapping[str, int] = field(default_factory=dict)
    excluded: bool = False
    fingerprint: str = "md5"

    @property
    def primary_key(self) -> tuple[str, ...]:
        for key in self.keys:
            if key.kind == PRIMARY:
                return key.columns
        return ()


@dataclass(frozen=True)
class Rule:
    """A data-quality rule: rows for which ``bad`` is true break it."""

    code: str
    severity: str
    column: str
    bad: Column
    should_stop: bool = False
    description: str = ""

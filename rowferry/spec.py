"""What a run consists of. Plain data, no behaviour beyond defaults and name lookups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

OPERATIONS = (
    "Insert",
    "Update",
    "Upsert",
    "Readonly",
    "Delete",
    "DeleteSource",
    "DeleteHierarchy",
    "HardDelete",
)


@dataclass(frozen=True)
class LookupSpec:
    """A foreign key: ``column`` holds ids of the table ``parent``.

    ``reference`` names the column with the parent's external key, if the child carries one.
    """

    column: str
    parent: str
    reference: str | None = None


@dataclass(frozen=True)
class ValueRule:
    """One value mapping. ``raw`` is a literal or ``/regex/``; ``value`` may be ``eval(sql)``."""

    table: str
    column: str
    raw: str
    value: str


@dataclass(frozen=True)
class MockField:
    """How one column is anonymised, see ``operators.mocking``."""

    name: str
    pattern: str
    included: str = ""
    excluded: str = ""
    exclude_names: tuple[str, ...] = ()
    locale: str = ""


@dataclass(frozen=True)
class TableSpec:
    """One table of a run.

    ``order_by`` replaces the row order that file and record-list tools take for granted. The
    columns must together identify a row, so that first-wins and last-wins give the same
    answer on every run.

    ``unique_id=False`` says that ids may repeat; the first row of each is then kept. A table
    that is not ``master`` takes part only as far as related rows are selected.

    A part of ``key`` is a column, a lookup column (it stands for the parent's whole key) or a path
    ``lookup.part`` into the parent, over any number of parents. Keys may form rings.
    """

    name: str
    id: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    operation: str = "Readonly"
    lookups: tuple[LookupSpec, ...] = ()
    order_by: tuple[str, ...] = ()
    source_filter: str | None = None
    target_filter: str | None = None
    prepared_filter: str | None = None
    delete_old_data: bool = False
    delete_filter: str | None = None
    hard_delete: bool = False
    master: bool = True
    unique_id: bool = True
    skip_existing: bool = False
    always_update: bool = False
    not_insertable: tuple[str, ...] = ()
    not_updateable: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    mock: tuple[MockField, ...] = ()
    value_rules: tuple[ValueRule, ...] = ()
    before_update: Callable[[DataFrame], DataFrame] | None = None
    record_filter: Callable[[DataFrame], DataFrame] | None = None
    after_update: Callable[[DataFrame], None] | None = None

    def __post_init__(self) -> None:
        if self.operation not in OPERATIONS:
            raise ValueError(f"unknown operation {self.operation!r} for table {self.name}")

    @property
    def order(self) -> tuple[str, ...]:
        return self.order_by or (self.id,)

    @property
    def target_id(self) -> str:
        """The name of the id column in the target."""
        return self.rename.get(self.id, self.id)

    @property
    def lookup_columns(self) -> tuple[str, ...]:
        return tuple(lookup.column for lookup in self.lookups)


@dataclass(frozen=True)
class MigrationSpec:
    """The tables of a run, parents first where the relations allow it."""

    tables: tuple[TableSpec, ...]
    max_hops: int | None = None

    def table(self, name: str) -> TableSpec:
        for table in self.tables:
            if table.name.lower() == name.lower():
                return table
        raise KeyError(name)

    def position(self, name: str) -> int:
        return [table.name for table in self.tables].index(self.table(name).name)

"""Table synchronisation on Spark: read, match, remap, transform, plan and write related tables."""

from rowferry.spec import LookupSpec, MigrationSpec, MockField, TableSpec, ValueRule
from rowferry.session import tune

__all__ = ["LookupSpec", "MigrationSpec", "MockField", "TableSpec", "ValueRule", "tune"]

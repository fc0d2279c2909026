"""Column types shared by every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType, StructType

# Precision and scale of the data model.
ID = DecimalType(15, 0)
MONEY = DecimalType(19, 4)
RATE = DecimalType(26, 11)

DDL = {
    "text": "string",
    "date": "date",
    "id": "decimal(15,0)",
    "money": "decimal(19,4)",
    "rate": "decimal(26,11)",
}


class SchemaDrift(ValueError):
    """The incoming columns differ from the columns of the target table."""


def assert_same_columns(target: DataFrame | StructType, incoming: DataFrame | StructType, name: str) -> None:
    """Fail before a merge when the column sets (or their types) differ."""
    want = target if isinstance(target, StructType) else target.schema
    have = incoming if isinstance(incoming, StructType) else incoming.schema
    wanted = {f.name: f.dataType for f in want}
    found = {f.name: f.dataType for f in have}
    missing = sorted(wanted.keys() - found.keys())
    extra = sorted(found.keys() - wanted.keys())
    retyped = sorted(c for c in wanted.keys() & found.keys() if wanted[c] != found[c])
    if missing or extra or retyped:
        raise SchemaDrift(f"{name}: missing {missing}, unexpected {extra}, retyped {retyped}")

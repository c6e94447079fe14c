"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z"


def safe_float(raw: Column) -> Column:
    """Text or an extended-JSON double to a finite double; anything else is null."""
    wrapped = F.get_json_object(raw, "$.$numberDouble")
    plain = F.trim(F.when(raw.startswith("{"), wrapped).otherwise(raw))
    number = F.when(plain.rlike(_DECIMAL), plain.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)

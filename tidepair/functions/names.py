"""Functions on series names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric_prefix(name: Column) -> Column:
    """The integer of up to 38 digits before the first dot of a name, null if there is none."""
    number = F.split_part(name, F.lit("."), F.lit(1))
    return F.when(number.rlike(r"^\s*[+-]?[0-9]+\s*$"), number.try_cast("decimal(38,0)"))

"""Value rendering used by reconciliation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_value(value: Column, unit: Column) -> Column:
    """USD -> $1,234 ; percent -> 12.34% ; other -> 1,234.5678 unit."""
    return (F.when(unit == "USD", F.concat(F.lit("$"), F.format_number(value, 0)))
            .when(unit == "percent", F.concat(F.regexp_replace(F.format_number(value, 2), ",", ""),
                                              F.lit("%")))
            .otherwise(F.concat(F.format_number(value, 4), F.lit(" "), unit)))

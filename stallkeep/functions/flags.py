"""0/1 flags with the reference's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def flag_unless_null(subject: Column, condition: Column) -> Column:
    """Three-valued flag: NULL while ``subject`` is missing, else ``flag``."""
    return F.when(subject.isNotNull(), flag(condition))


def matches(condition: Column) -> Column:
    """Number of rows where the condition holds (0, not NULL, on no rows)."""
    return F.count(F.when(condition, 1))

"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(name: str) -> Column:
    """Neither null nor empty. Blank text such as ``' '`` counts as filled."""
    return F.col(name).isNotNull() & (F.col(name) != "")

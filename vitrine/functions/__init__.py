"""Column functions: every one takes and returns ``Column`` and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_case(pairs: Iterable[tuple[Column, object]]) -> Column:
    """CASE expression over (condition, value) pairs; append ``otherwise`` as needed."""
    (condition, value), *rest = pairs
    case = F.when(condition, value)
    for condition, value in rest:
        case = case.when(condition, value)
    return case

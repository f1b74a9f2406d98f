"""CASE ladders (first matching branch wins, NULL falls to ``otherwise``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify(branches: Sequence[tuple[Column, object]], otherwise) -> Column:
    expr = None
    for cond, value in branches:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise)

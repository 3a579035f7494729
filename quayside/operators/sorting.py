"""Report ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sort_keys(
    columns: Sequence[str], descending: Sequence[str] = (), nulls: str = "last"
) -> list[Column]:
    """Sort columns with one explicit placement of missing values."""
    keys = []
    for name in columns:
        c = F.col(name)
        if name in descending:
            keys.append(c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last())
        else:
            keys.append(c.asc_nulls_first() if nulls == "first" else c.asc_nulls_last())
    return keys

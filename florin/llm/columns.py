"""Names for columns an operator adds for itself while it carries a caller's columns along."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name

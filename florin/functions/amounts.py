"""Decimal policy: sums never depend on row order.

Measures become DECIMAL before they are summed; DOUBLE appears only in final
projections, rounded to cents.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"  # one source measure
FACT = "decimal(28,4)"  # a sum of measures
LINE = "decimal(30,8)"  # a statement line, after currency conversion


def amount(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(AMOUNT)


def line(sql: str) -> str:
    """SQL of a value at statement precision."""
    return f"CAST({sql} AS {LINE})"


def convert(balance: str, rate: str) -> str:
    """SQL of balance times exchange rate, both narrowed so that the product stays exact."""
    return line(f"CAST({balance} AS DECIMAL(20,4)) * CAST({rate} AS DECIMAL(14,4))")


def total(names: Iterable[str]) -> str:
    """SQL of a row-wise total, NULL counted as zero, without losing scale on the way."""
    return reduce(lambda a, b: line(f"{a} + {b}"), [line(f"COALESCE({n}, 0)") for n in names])


def money(sql: str) -> str:
    """SQL of a final amount: cents, as DOUBLE."""
    return f"CAST(ROUND({sql}, 2) AS DOUBLE)"


def drop_last_two(text: Column) -> Column:
    """Numeric text without its last two digits, as FACT; NULL where nothing numeric remains.

    A number too large for FACT fails the run, with ANSI mode or without.
    """
    kept = F.substring(text, F.lit(1), F.length(text) - 2)
    size = F.abs(kept.try_cast("double"))
    is_number = size.isNotNull() & ~F.isnan(size) & (size < F.lit(float("inf")))
    message = F.concat(F.lit("amount out of range: "), kept)
    return F.when(is_number, F.coalesce(kept.try_cast(FACT), F.raise_error(message).cast(FACT)))


def second_token_int(name: Column) -> Column:
    """Integer between the first and the second dot; NULL for malformed names."""
    return F.get(F.split(name, r"\."), F.lit(1)).try_cast("int")

"""Rounding and ratio helpers as Spark SQL expression text.

Expressions are written as SQL text and turned into Columns with one
``F.expr`` call each: building the same tree through the Column API costs
dozens of driver-to-JVM round trips per KPI, which dominated plan
construction.  The text is still parsed into ordinary Catalyst expressions,
so execution (codegen) is identical.

Decimal ratios are rounded once, HALF_UP, from the exact quotient: both sides
are cast to ``decimal(22,2)`` so Spark's decimal division keeps 16 fractional
digits whatever the input precision (a wide input such as ``decimal(35,2)``
would otherwise leave only 6 digits and round twice).  ``decimal(22,2)``
holds up to 10^20, far above any report total.
"""

from __future__ import annotations

RATIO_OPERAND = "DECIMAL(22,2)"


def q(name: str) -> str:
    """Quote an identifier."""
    return f"`{name}`"


def round_ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """``round(numerator / denominator, digits)`` HALF_UP on exact decimals."""
    return (f"round(CAST({numerator} AS {RATIO_OPERAND}) / "
            f"CAST({denominator} AS {RATIO_OPERAND}), {digits})")


def guarded(denominator: str, value: str) -> str:
    """0 when the denominator is 0, else ``value`` (a null denominator gives null)."""
    return f"CASE WHEN {denominator} = 0 THEN 0 ELSE {value} END"


def clamp(value: str, limit: int) -> str:
    """Clamp to ``[-limit, limit]``."""
    return f"least({limit}, greatest({value}, -{limit}))"

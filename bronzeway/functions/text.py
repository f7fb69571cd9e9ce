"""Text cleaning and display expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_token(c: Column, tokens: Sequence[str], fill: str | None = None) -> Column:
    """NULL or one of ``tokens`` (exact, untrimmed) becomes ``fill``."""
    if fill is None:
        return F.when(~c.isin(*tokens), c)
    return F.when(c.isNull() | c.isin(*tokens), F.lit(fill)).otherwise(c)


def lower_without(c: Column, removed: str) -> Column:
    """Lower-case text with every literal occurrence of ``removed`` taken out."""
    return F.replace(F.lower(c), F.lit(removed), F.lit(""))


def digit_mask(c: Column) -> Column:
    """The format of a value: every digit shown as ``D``."""
    return F.translate(c, "0123456789", "DDDDDDDDDD")


def cut_label(c: Column, width: int = 35) -> Column:
    """Text shorter than ``width`` is kept, other text is cut and marked."""
    return F.when(F.length(c) < width, c).otherwise(
        F.concat(F.substring(c, 1, width), F.lit("..."))
    )


def number_text(c: Column, style: str = "grouped") -> Column:
    """A number as shown to a reader.

    ``grouped``    1234567 -> 1,234,567
    ``mil``        12345 -> 12 mil; below 1000 the whole part (999.7 -> 999)
    ``mil_round``  the same, below 1000 rounded half to even (999.7 -> 1000)
    ``k1``         12345 -> 12.3
    ``pct1``       0.1234 -> 12.3%
    """

    def pattern(value: Column, text: str) -> Column:
        return F.call_function("format_number", value, F.lit(text))

    if style == "grouped":
        return pattern(c, "#,##0")
    if style in ("mil", "mil_round"):
        thousands = F.floor(c / F.lit(1000)).cast("bigint").cast("string")
        small = c.cast("double")
        small = F.bround(small, 0) if style == "mil_round" else small
        return F.when(c >= 1000, F.concat(thousands, F.lit(" mil"))).otherwise(
            small.cast("bigint").cast("string")
        )
    if style == "k1":
        return pattern(c / F.lit(1000.0), "0.0")
    if style == "pct1":
        return F.concat(pattern(c * F.lit(100.0), "0.0"), F.lit("%"))
    raise ValueError(f"unknown number style: {style}")

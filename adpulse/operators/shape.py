"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """Keep the computed columns of ``df`` from being copied into the filters above it.

    Catalyst moves a filter below a projection by writing the projected expressions into the
    condition. For columns that are costly or used by many rules (parsed JSON, derived ids) that
    computes them once per use, and the generated method can outgrow what the JVM compiles. A
    generator is not crossed by filters, so rows pass through ``inline`` of a one-element array.

    Select the needed columns first: column pruning does not cross it either.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))

"""Action parsing and membership."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACTIONS, Side, side_of


def parse_action(col: Column | str, strict: bool = False) -> Column:
    """Read an action name in any case; an unknown name gives null, or an error when ``strict``.

    The JSON decoder does not use this: on the wire an action must be in upper case.
    """
    text = F.col(col) if isinstance(col, str) else col
    name = F.upper(text)
    known = name.isin(*ACTIONS)
    if strict:
        unknown = F.raise_error(F.concat(F.lit("unknown action: "), F.coalesce(text, F.lit("null"))))
        return F.when(known, name).otherwise(unknown.cast("string"))
    return F.when(known, name)


def is_action_of(side: str | Side, col: Column | str = "action") -> Column:
    """True when the side allows the action. VIEW belongs to the supply side only; null is false."""
    text = F.col(col) if isinstance(col, str) else col
    return F.coalesce(text.isin(*side_of(side).actions), F.lit(False))

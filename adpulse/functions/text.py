"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: code points that count as white space. U+0085 and U+200B are not among them.
WHITE_SPACE_CODES = (
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D,
    0x001C, 0x001D, 0x001E, 0x001F, 0x0020,
    0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


_WHITE_SPACE_SQL = "".join(f"\\u{code:04x}" for code in WHITE_SPACE_CODES)


def blank_sql(text: str) -> str:
    """SQL condition: the text is empty or only white space; null counts as blank.

    Most ids begin with a printable ASCII character, which a comparison of the first byte tells.
    Only the rest is trimmed; a regular expression would decode every string instead.
    """
    return (
        f"CASE WHEN {text} >= '!' AND {text} < '\\u007f' THEN false "
        f"ELSE coalesce(ltrim('{_WHITE_SPACE_SQL}', {text}) = '', true) END"
    )


def is_blank(text: str) -> Column:
    """:func:`blank_sql` of a column name or SQL expression as a column."""
    return F.expr(blank_sql(text))

"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code points of the Unicode white-space characters (Spark's
# trim() alone strips the space character only).
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Fixed value: mark that follows a cut text.
CLIP_MARK = " …(생략)"


def clean_text(col: Column | str) -> Column:
    """Trim white space on both sides; blank becomes NULL."""
    return F.nullif(F.btrim(col, F.lit(WHITESPACE)), F.lit(""))


def clip_text(col: Column | str, limit: int = 800, mark: str = CLIP_MARK) -> Column:
    """Cut text longer than ``limit`` characters and mark the cut."""
    text = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))).otherwise(text)

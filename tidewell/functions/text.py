"""Keyword extraction as a native expression (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a word of any script, and as a run of CJK writing
WORD = r"[\p{L}\p{M}\p{N}]+"
CJK = r"぀-ヿ㐀-䶿一-鿿가-힯\x{20000}-\x{3FFFF}"


def _pairs(run: Column) -> Column:
    """Overlapping pairs of characters; a single character stands alone."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: run.substr(i, F.lit(2)))
    return F.when(F.length(run) < 2, F.array(run)).otherwise(pairs)


def keywords(text: Column | str) -> Column:
    """Words of a text: lower-case words of any script, CJK runs as character pairs."""
    lower = F.lower(F.col(text) if isinstance(text, str) else text)

    def words(of: Column) -> Column:
        return F.regexp_extract_all(of, F.lit(WORD), F.lit(0))

    # A CJK run inside a word stands apart from it.
    apart = words(F.regexp_replace(lower, f"([{CJK}]+)", " $1 "))
    cut = F.flatten(
        F.transform(
            apart, lambda p: F.when(p.rlike(f"^[{CJK}]"), _pairs(p)).otherwise(F.array(p))
        )
    )
    return F.when(lower.rlike(f"[{CJK}]"), cut).otherwise(words(lower))

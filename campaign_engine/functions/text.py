"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from campaign_engine.schemas import NULL_TOKENS

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITY = r"^[+-]?(?i:inf|infinity)$"
_SPACE = " \t\n\x0b\f\r"  # what \s matches
_OTHER_ENDS = "\x85", "\u2028", "\u2029"  # line ends that \s does not match, but before which $ does


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks.

    Texts are trimmed, which gives what the pattern does at a fraction of its time; only texts that end in another
    line end need the pattern.
    """
    text = c.cast("string")
    other = text.endswith(_OTHER_ENDS[0]) | text.endswith(_OTHER_ENDS[1]) | text.endswith(_OTHER_ENDS[2])
    return F.when(other, F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(F.trim(text, F.lit(_SPACE)))


def without_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Turn the given texts (exact case) into null."""
    return F.when(~c.isin(list(tokens)), c)


def null_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Strip, then turn the given texts into null."""
    return without_tokens(strip(c), tokens)


def to_double(c: Column) -> Column:
    """Number in the text, or null. Forms such as ``1d`` and ``1,000`` are not numbers."""
    text = strip(c.cast("string"))
    numeric = text.rlike(_NUMBER) | text.rlike(_INFINITY)
    return F.when(numeric, text.try_cast("double"))


def title(c: Column) -> Column:
    """Title case: upper-case every letter that does not follow a letter, as in ``O'Neil`` or ``3G``."""
    words = F.regexp_replace(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})", "\u0001 ")
    return F.regexp_replace(F.initcap(words), "\u0001 ", "")


def lookup(c: Column, mapping: Mapping, fallback: Column | None = None) -> Column:
    """Value of a small fixed mapping, else the fallback."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, c)
    return found if fallback is None else F.coalesce(found, fallback)


def is_human_text(c: Column) -> Column:
    """Texts worth translating: 4-220 characters, no links, paths, braces or bare identifiers."""
    t = strip(c)
    link = t.startswith("http://") | t.startswith("https://") | t.startswith("/") | t.startswith("#")
    identifier = t.contains("_") & ~t.contains(" ")
    return (
        F.length(t).between(4, 220)
        & ~link
        & ~t.rlike(r"[{}]")
        & ~identifier
        & (F.regexp_count(t, F.lit(r"\p{L}")) >= 3)
    )

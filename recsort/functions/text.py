"""Text cleaning expressions (all JVM-side, no Python UDFs).

Python's ``str.strip()`` removes Unicode whitespace; Spark's ``trim``
removes only U+0020 and Java's ``\\s`` is ASCII-only. ``strip_u`` uses
one explicit character class so every cleaner agrees with Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsort.constants import CATCH_ALL_CATEGORY, CATEGORY_SEP, WS_CLASS

_LEAD_TRAIL_WS = rf"^{WS_CLASS}+|{WS_CLASS}+$"

# Full-width ASCII variants U+FF01..U+FF5E fold onto U+0021..U+007E,
# and the ideographic space onto a plain space (built from the rule).
_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = "".join(chr(0x21 + i) for i in range(94)) + " "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_u(c) -> Column:
    """Python ``str.strip()`` on a string column (null stays null)."""
    return F.regexp_replace(_col(c), _LEAD_TRAIL_WS, "")


def clean_text(c) -> Column:
    """null -> ''; strip; the text 'nan' in any case -> ''."""
    s = strip_u(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.when(F.lower(s) == F.lit("nan"), F.lit("")).otherwise(s)


def split_categories(c) -> Column:
    """Split a '||' list (whitespace around the bars allowed) into stripped, non-empty parts."""
    parts = F.split(clean_text(c), rf"{WS_CLASS}*\|\|{WS_CLASS}*")
    return F.filter(F.transform(parts, strip_u), lambda p: p != F.lit(""))


def clean_rule_categories(c, catch_all: str = CATCH_ALL_CATEGORY) -> Column:
    """Split on '||', strip parts, drop empties and the catch-all, rejoin.

    Order kept, no de-duplication.
    """
    parts = F.filter(split_categories(c), lambda p: p != F.lit(catch_all))
    return F.array_join(parts, CATEGORY_SEP)


def flatten_ws(c) -> Column:
    """Each \\n, \\r, \\t becomes one space (1:1, runs are kept)."""
    return F.translate(_col(c), "\n\r\t", "   ")


def flatten_string_columns(df):
    """Apply ``flatten_ws`` to every top-level string column of ``df``."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "string":
            cols.append(flatten_ws(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def preview(c, n: int) -> Column:
    """Newline -> space, then the first ``n`` code points."""
    return F.substring(F.translate(_col(c), "\n", " "), 1, n)


def fold_width(c) -> Column:
    """Fold full-width ASCII variants and U+3000 to their narrow forms."""
    return F.translate(_col(c), _WIDE, _NARROW)


def natural_key(c):
    """Sort key of an id: its first digit run as a number, exact at any length.

    Returns (length, digits) with leading zeros removed: ordering by both
    equals ordering by the integer value, without decimal(38) overflow.
    No digits, or all zeros, gives ('', 0) like the integer 0.
    """
    digits = F.regexp_extract(_col(c).cast("string"), r"(?U)(\d+)", 1)
    digits = fold_width(digits)
    z = F.regexp_replace(digits, r"^0+", "")
    return F.length(z), z


def seeded_order(key, seed: int) -> Column:
    """A number below 2^60 that is random in the key and the seed, and the same in every engine with MD5: its first 15 hex digits."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(_col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("bigint")

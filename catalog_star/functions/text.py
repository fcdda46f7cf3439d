"""Text rules as native column expressions.

Python string semantics (``str.strip``, ``str.title``, ``re`` whitespace) are
reproduced with JVM-side functions only, so every rule stays inside the scan
stage and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# The characters Python treats as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_WS = r"[\s\x1c-\x1f]"  # with (?U), the same characters as a pattern

# Markers that end the lead artist's name.
COLLABORATION = rf"(?U){_WS}(?:feat\.?|with{_WS}|&{_WS})|\("

MISSING_NAME = "N/A"
UNMATCHABLE = "n/a"

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# Noncharacters: the first marks where a run of letters begins, the second protects a first one that was there.
_MARK, _GUARD = "\ufdd0", "\ufdd1"


def strip(c: Column) -> Column:
    """Drop whitespace, as Python defines it, at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_whitespace(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){_WS}+", " ")


def title_case(c: Column) -> Column:
    """Title-case every run of cased letters, restarting after any other character.

    ``initcap`` alone restarts only after a blank, which leaves ``r&b`` as ``R&b``: so a mark and a
    blank are put before each run and taken out again. Each run is lowered by itself: a capital
    sigma that ends a run becomes a final one even if a mark and more letters follow.
    """
    guarded = F.replace(c, F.lit(_MARK), F.lit(_MARK + _GUARD))
    parted = F.regexp_replace(guarded, f"(?<=[^{_CASED}])(?=[{_CASED}])", f"{_MARK} ")
    joined = F.replace(F.initcap(parted), F.lit(f"{_MARK} "), F.lit(""))
    return F.replace(joined, F.lit(_MARK + _GUARD), F.lit(_MARK))


def replace_literal(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def first_of(c: Column, separator: str = ",") -> Column:
    """First piece of a delimited string, stripped."""
    return strip(F.split_part(c, F.lit(separator), F.lit(1)))


def normalize_name(c: Column) -> Column:
    """Join key of a name: lower case, lead artist only, missing as ``n/a``."""
    lead = F.split(strip(F.lower(c)), COLLABORATION, 2)[0]
    return F.when(c.isNull() | (c == MISSING_NAME), UNMATCHABLE).otherwise(strip(lead))


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; bad sequences become U+FFFD.

    Text with characters above U+00FF cannot stem from Latin-1 and is left as is.
    """
    as_bytes = F.encode(c, "ISO-8859-1")
    return F.when(
        c.rlike(r"^[\x00-\xff]*$"), F.make_valid_utf8(as_bytes.cast("string"))
    ).otherwise(c)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold strings."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def repair_text_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({c: repair_mojibake(F.col(c)) for c in string_columns(df)})

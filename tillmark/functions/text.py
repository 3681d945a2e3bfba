"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a Unicode-aware strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Words read as booleans, and the ones that mean true.
BOOLEAN_WORDS = ("true", "false", "1", "0", "yes", "no")
TRUE_WORDS = ("true", "1", "yes")


def stripped(value: Column) -> Column:
    """Text form of any cell without surrounding whitespace; NULL stays NULL.

    Nearly all cells begin and end with a printable ASCII character. Two comparisons at
    each end find that out and skip the much slower trim by a character set.
    """
    text = value.cast("string")
    last = F.substring(text, -1, 1)
    clean = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def clean_text(value: Column) -> Column:
    """Like ``stripped`` but NULL becomes the empty string."""
    return F.coalesce(stripped(value), F.lit(""))


def text_or_null(value: Column) -> Column:
    """Stripped text, with blank read as NULL."""
    return F.nullif(stripped(value), F.lit(""))


def flag_from_text(value: Column) -> Column:
    """true / 1 / yes in any case; everything else, NULL included, is false or NULL."""
    return F.lower(value).isin(*TRUE_WORDS)


def canonical_customer_id(text: Column) -> Column:
    """Customer key of stripped, non-blank text: integral numbers lose sign noise,
    leading zeros and ``.0``; other text stays as it is."""
    plain = F.regexp_replace(text, r"^(?:[+]|(-))?0*([0-9]+)(?:[.]0*)?$", "$1$2")
    exponent = r"^[+-]?[0-9.]+[eE][+-]?[0-9]+$"
    wide = F.when(text.rlike(exponent), text.try_cast("decimal(38,18)"))
    return (
        F.when(plain == "-0", "0")
        .when(wide == F.floor(wide), wide.cast("decimal(20,0)").cast("string"))
        .otherwise(plain)
    )

"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a product text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Field texts that mean "missing" in a source file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def normalise_product(text: Column) -> Column:
    """Product text without surrounding white space, in upper case."""
    return F.upper(F.btrim(text, F.lit(WHITESPACE)))


def null_if_missing(text: Column) -> Column:
    """NULL for any spelling of a missing field."""
    return F.when(~text.isin(MISSING_TEXTS), text)

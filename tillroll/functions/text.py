"""String helpers that reproduce Python/pandas text semantics with built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every character for which str.isspace() is true
# (Unicode White_Space plus the ASCII separators U+001C..U+001F).  The set is
# derived from Python itself rather than written out.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())

# The strings pandas.read_csv treats as missing by default
# (public pandas documentation, ``na_values``), in documented order.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def pystrip(col: Column | str) -> Column:
    """Trim leading/trailing whitespace exactly like Python's ``str.strip``.

    Spark's one-argument ``trim`` removes only the space character; with an
    explicit character set it trims any of them (no regex, codegen'd).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c, F.lit(PY_WHITESPACE))


def na_to_null(col: Column | str) -> Column:
    """Map pandas' default NA tokens to SQL NULL (exact, untrimmed match)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*PANDAS_NA_TOKENS), F.lit(None).cast("string")).otherwise(c)

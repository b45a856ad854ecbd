"""Display-name normalisation for series and market names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of moving averages, and what is written for them: the
# initial of an exponential one, then the short name.
AVERAGE_NAME, AVERAGE_SHORT = "(?:Simple|(E)xponential)?MovingAverage", "$1MA"
# Fixed value: characters not allowed in a source (column) name.
FORBIDDEN_SOURCE_CHARS = "(),.*:/^"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_label(c) -> Column:
    """Underscores -> spaces, long average names shortened, outer space trimmed."""
    return _strip_ws(F.regexp_replace(F.translate(_c(c), "_", " "), AVERAGE_NAME, AVERAGE_SHORT))


def sanitize_source_name(c) -> Column:
    """Forbidden characters -> '_', runs of '_' collapsed, outer '_' removed."""
    cls = "[" + "".join("\\" + ch for ch in FORBIDDEN_SOURCE_CHARS) + "]"
    out = F.regexp_replace(_c(c), cls, "_")
    out = F.regexp_replace(out, "_{2,}", "_")
    return F.regexp_replace(out, "^_+|_+$", "")


def plot_title(c) -> Column:
    """Text before ' @ ', underscores -> dots, outer space trimmed."""
    head = F.split_part(_c(c), F.lit(" @ "), F.lit(1))
    return _strip_ws(F.replace(head, F.lit("_"), F.lit(".")))

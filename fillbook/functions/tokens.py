"""Market token and id helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_pair(clob_token_ids) -> tuple[Column, Column]:
    """JSON-array text -> (token1, token2); absent or blank ones are null.

    Brackets, double quotes and white space go, the rest is cut at commas, and
    a blank place keeps its place: ``[17,,23]`` has no second token. Nothing raises.
    """
    ids = F.split(F.translate(_c(clob_token_ids), '[]" \t\n\x0b\f\r', ""), ",")
    first, second = (F.nullif(F.get(ids, i), F.lit("")) for i in range(2))
    return first, second


def token_ids_from_struct(tokens) -> Column:
    """``tokens[].token_id`` as text; null ids skipped, a null list -> empty."""
    kept = F.filter(_c(tokens), lambda t: t["token_id"].isNotNull())
    return F.coalesce(F.transform(kept, lambda t: t["token_id"].cast("string")),
                      F.array().cast("array<string>"))


def json_string_array(ids) -> Column:
    """Text array -> JSON text in Python's default layout (``["a", "b"]``).

    Empty array -> ``''`` (the writer leaves the cell blank).
    """
    quoted = F.transform(_c(ids), lambda x: F.concat(
        F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
        F.lit('"')))
    return F.when(F.size(_c(ids)) > 0,
                  F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))).otherwise(F.lit(""))


def python_json_layout(json_text) -> Column:
    """Compact JSON (Spark's ``to_json``) -> Python ``json.dumps`` layout:
    a space after every ',' and ':' that is outside string literals.

    The text is cut at its quotes, in one pass; every other part lies outside
    literals. Escaped backslashes and quotes are masked first, by control
    characters that ``to_json`` itself only writes escaped.
    """
    t = F.replace(F.replace(_c(json_text), F.lit("\\\\"), F.lit("\u0001")), F.lit('\\"'), F.lit("\u0002"))
    spaced = F.transform(F.split(t, '"'), lambda part, i: F.when(
        i % 2 == 0, F.replace(F.replace(part, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))).otherwise(part))
    t = F.array_join(spaced, '"')
    return F.replace(F.replace(t, F.lit("\u0002"), F.lit('\\"')), F.lit("\u0001"), F.lit("\\\\"))


def flatten_cell(c, dtype: str = "string") -> Column:
    """Cell for CSV export, as Python's csv writer would print the value:
    null -> '', struct/array/map -> JSON text in Python's layout, booleans
    'True'/'False', other scalars as text. ``dtype`` is the column's Spark
    type string."""
    col = _c(c)
    if dtype == "boolean":
        text = F.when(col, F.lit("True")).when(~col, F.lit("False"))
    elif dtype.startswith(("struct", "array", "map")):
        text = python_json_layout(F.to_json(col, {"ignoreNullFields": "false"}))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))


def market_id_coalesce(condition_id, market_id) -> Column:
    """``conditionId`` or else ``id`` as text; null and blank count as absent; '' if both are.

    The text ``"0"`` is an id; a numeric column passes its zeros as null.
    """
    def present(c):
        return F.nullif(_c(c).cast("string"), F.lit(""))
    return F.coalesce(present(condition_id), present(market_id), F.lit(""))

"""Report registry: analyzer name -> function building its table.

An analyzer may supply its own report builder; anything else gets the
generic layout, its nested result flattened into (path, value) rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.operators.nested import nested_to_path_rows

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_report(name: str):
    def deco(fn: Callable[[DataFrame], DataFrame]):
        REPORTS[name] = fn
        return fn
    return deco


def generic_report(result: DataFrame, keys: list[str]) -> DataFrame:
    """Every non-key column (structs nest) -> rows (keys..., path, value)."""
    rest = [c for c in result.columns if c not in keys]
    rec = F.to_json(F.struct(*[F.col(c) for c in rest]))
    return nested_to_path_rows(result.select(*keys, rec.alias("_rec")), keys, "_rec")


def report(name: str, result: DataFrame, keys: list[str]) -> DataFrame:
    """The analyzer's own report if registered, else the generic one; both
    carry the report name."""
    fn = REPORTS.get(name)
    out = fn(result) if fn else generic_report(result, keys)
    return out.select(F.lit(name).alias("report"), *out.columns)


def _cells(result: DataFrame, used: list[str], rows: list) -> DataFrame:
    """(other columns, path, value) with one row per listed (path, value) Column pair."""
    keys = [c for c in result.columns if c not in used]
    cells = F.array(*[F.struct(p.alias("path"), v.cast("string").alias("value")) for p, v in rows])
    return result.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.*")


def table_of(rows: dict[str, dict[str, str]]) -> Callable[[DataFrame], DataFrame]:
    """Builder of a fixed table: row label -> {column label: result column}.
    Further columns of the result are keys."""
    def build(result: DataFrame) -> DataFrame:
        used = [c for cells in rows.values() for c in cells.values()]
        return _cells(result, used, [(F.lit(f"{row} - {label}"), F.col(c)) for row, cells in rows.items() for label, c in cells.items()])
    return build


def table_over(time: str, cells: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """Builder of a table with one line per ``time``: column label -> result column."""
    def build(result: DataFrame) -> DataFrame:
        line = F.coalesce(F.col(time).cast("string"), F.lit(""))
        return _cells(result, [time, *cells.values()], [(F.concat_ws(" - ", line, F.lit(label)), F.col(c)) for label, c in cells.items()])
    return build


#: The analyzers' titles and labels, and where the perf results hold each figure.
TABLES = {
    "Annual Return": table_over("period", {"Return": "ret"}),
    "Time Return": table_over("period", {"Return": "ret"}),
    "Calmar": table_over("period", {"Value": "calmar"}),
    "Gross Leverage": table_over("ts", {"Leverage": "leverage"}),
    "Transactions": table_over("ts", {"Size": "size", "Price": "price", "Instrument": "instrument", "Total Price": "total"}),
    "Sharpe-Ratio": table_of({"Sharpe-Ratio": {"Value": "sharpe"}}),
    "SystemQualityNumber": table_of({"SystemQualityNumber": {"Value": "sqn"}, "Trades": {"Value": "trades"}}),
    "Variability-Weighted Return": table_of({"VWR": {"Value": "vwr"}}),
    "Drawdown": table_of({"Length": {"Value": "len", "Maximum": "max_len"}, "Moneydown": {"Value": "moneydown", "Maximum": "max_moneydown"},
                          "Drawdown": {"Value": "drawdown", "Maximum": "max_drawdown"}}),
    "Trade Analyzer": table_of({
        "Number of Trades": {"Total": "total", "Open": "open", "Closed": "closed"},
        "Won": {"Current": "won_current", "Longest": "won_longest"}, "Lost": {"Current": "lost_current", "Longest": "lost_longest"},
        "Gross Profit": {"Total": "gross_total", "Average": "gross_average"}, "Net Profit": {"Total": "net_total", "Average": "net_average"},
        "Short": {"Total": "short_total", "Average": "short_average"}, "Long": {"Total": "long_total", "Average": "long_average"},
        "Won / Short": {"Total": "short_won_total", "Average": "short_won_average"},
        "Lost / Short": {"Total": "short_lost_total", "Average": "short_lost_average"},
        "Won / Long": {"Total": "long_won_total", "Average": "long_won_average"},
        "Lost / Long": {"Total": "long_lost_total", "Average": "long_lost_average"}}),
}
REPORTS.update(TABLES)

"""What one fill says: who paid collateral, which leg is cash, and the price.

Asset id ``'0'`` is the collateral; any other id is an outcome token. All labels
follow from one nullable flag, ``taker_pays``: true when the taker gave
collateral, false when the maker did and the token's market is known, null when
the token's market is unknown. A null flag takes the ``otherwise`` branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The collateral's id and label, decimals of both legs.
USDC_ID = "0"
USDC = "USDC"
AMOUNT_SCALE = 1e6


def taker_pays(side: str = "side", taker_id: str = "takerAssetId") -> Column:
    """The flag all labels follow from."""
    return F.when(F.col(taker_id) == USDC_ID, True).when(F.col(side).isNotNull(), False)


def nonusdc_asset_id(maker_id: str = "makerAssetId", taker_id: str = "takerAssetId") -> Column:
    """The outcome token of a fill: the maker's asset unless that is collateral (or null)."""
    return F.coalesce(F.nullif(F.col(maker_id), F.lit(USDC_ID)), F.col(taker_id))


def asset_label(asset_id: str, side: str = "side") -> Column:
    """The collateral's label, or the market side of the token (null: unknown)."""
    return F.expr(f"if({asset_id} <=> '{USDC_ID}', '{USDC}', {side})")


def amount_scale(c: str) -> Column:
    return F.col(c) / AMOUNT_SCALE


def fill_labels(flag: Column, maker_amount: Column, taker_amount: Column, strict: bool = False) -> dict[str, Column]:
    """Directions, legs and price from the flag and the two scaled amounts.

    The token leg keeps a quirk of the data model: with an unknown market and
    the maker paying, it repeats the cash leg. ``strict=True`` gives the token leg.
    A zero denominator gives a null price.
    """
    def by_flag(paid, otherwise) -> Column:
        return F.when(flag, paid).otherwise(otherwise)
    cash, token = by_flag(taker_amount, maker_amount), by_flag(maker_amount, taker_amount)
    return {
        "maker_direction": by_flag("SELL", "BUY"),
        "taker_direction": by_flag("BUY", "SELL"),
        "price": F.try_divide(cash, token).cast("double"),
        "usd_amount": cash,
        "token_amount": token if strict else F.when(~flag, taker_amount).otherwise(maker_amount),
    }


def epoch_to_ts(c) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ (UTC wall time, independent of session zone)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=col)


def epoch_to_text(c) -> Column:
    """Unix seconds -> 'YYYY-MM-DD HH:MM:SS' UTC."""
    return F.date_format(epoch_to_ts(c), "yyyy-MM-dd HH:mm:ss")

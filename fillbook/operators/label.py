"""Fills x markets -> labelled trades, and the token bookkeeping around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.functions import hexcodec as H
from fillbook.functions import labels as L
from fillbook.functions.tokens import token_pair

# The columns of a labelled trade, in order.
TRADE_COLUMNS = ["timestamp", "market_id", "maker", "taker", "nonusdc_side",
                 "maker_direction", "taker_direction", "price", "usd_amount",
                 "token_amount", "transactionHash"]


def with_tokens(markets: DataFrame, src: str = "clobTokenIds") -> DataFrame:
    """Add ``token1``/``token2`` parsed from the JSON-array text column."""
    t1, t2 = token_pair(src)
    return markets.withColumn("token1", t1).withColumn("token2", t2)


def markets_long(markets: DataFrame, id_col: str = "id", keep_nulls: bool = True) -> DataFrame:
    """(id, token1, token2) -> (market_id, side, asset_id); one row per token."""
    long = (markets.select(F.col(id_col).alias("market_id"), "token1", "token2")
            .unpivot(["market_id"], ["token1", "token2"], "side", "asset_id"))
    return long if keep_nulls else long.where(F.col("asset_id").isNotNull())


def join_fills_markets(fills: DataFrame, markets: DataFrame) -> DataFrame:
    """Left join each fill to the market owning its outcome token.

    A token listed by two markets yields two rows (as the original does).
    Physical plan: a shuffled hash join at any size, as neither side is bounded;
    the markets of a partition are hashed (the fills are not sorted), and AQE
    splits hot tokens on the fills side. Hashes and addresses cross the exchange
    as bytes. Null keys are removed from the markets side first; they could never match.
    """
    long = markets_long(markets, keep_nulls=False).hint("shuffle_hash")
    token = L.nonusdc_asset_id()  # as an expression, it takes no room beside the two ids it comes from
    j = H.packed(fills).join(long, token == long["asset_id"], "left").drop(long["asset_id"]).withColumn("nonusdc_asset_id", token)
    return H.unpacked(j).select(*fills.columns, "nonusdc_asset_id", "market_id", "side")


def label_trades(fills: DataFrame, markets: DataFrame, strict_amounts: bool = False,
                 epoch_seconds: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fills with the markets of their tokens, as the 11 trade columns.

    ``markets`` needs ``id, token1, token2``. ``fills.timestamp`` is Unix
    seconds (converted to TIMESTAMP_NTZ) unless ``epoch_seconds=False``.
    ``keep`` carries further fill columns along, such as a fill's identity.
    """
    both_cash = (F.col("makerAssetId") == L.USDC_ID) & (F.col("takerAssetId") == L.USDC_ID)
    made = L.fill_labels(L.taker_pays(), L.amount_scale("makerAmountFilled"),
                         L.amount_scale("takerAmountFilled"), strict_amounts)
    made["nonusdc_side"] = F.when(both_cash, L.USDC).otherwise(F.col("side"))
    if epoch_seconds:
        made["timestamp"] = L.epoch_to_ts("timestamp")
    return join_fills_markets(fills, markets).select(
        *[made.get(c, F.col(c)).alias(c) for c in TRADE_COLUMNS], *keep)


def traded_tokens(fills: DataFrame) -> DataFrame:
    """Distinct non-USDC asset ids seen on either side of any fill.

    One scan of two columns, one ``explode``, one distinct (partially
    aggregated before the shuffle, so a hot token costs nothing extra).
    """
    ids = fills.select(F.explode(F.array("makerAssetId", "takerAssetId")).alias("asset_id"))
    return ids.where(F.col("asset_id") != L.USDC_ID).distinct()


def known_tokens(markets: DataFrame) -> DataFrame:
    return markets_long(markets, keep_nulls=False).select("asset_id").distinct()


def missing_tokens(fills: DataFrame, markets: DataFrame) -> DataFrame:
    """Traded token ids that no market lists, sorted as text."""
    traded = traded_tokens(fills)
    known = known_tokens(markets)
    return traded.join(known, "asset_id", "left_anti").orderBy("asset_id")


def filter_non_usdc(fills: DataFrame, col: str = "makerAssetId") -> DataFrame:
    """Rows whose asset id on ``col`` is an outcome token (null ids drop too)."""
    return fills.where(F.col(col) != L.USDC_ID)

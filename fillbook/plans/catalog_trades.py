"""Queries for markets, fills, labelling and token bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillbook.functions import labels as L
from fillbook.functions.tokens import token_pair
from fillbook.operators import label as LB
from fillbook.plans.fixture_sql import fx
from fillbook.plans.registry import register
from fillbook.sources import fixtures as X
from fillbook.sources.markets import load_markets, union_first_wins

# --- shared DuckDB fragments -------------------------------------------------

MK_LEAN = r"""mk AS (
  select id,
    nullif(str_split(regexp_replace(clobTokenIds, '[\[\]"\s]', '', 'g'), ',')[1], '') as token1,
    nullif(str_split(regexp_replace(clobTokenIds, '[\[\]"\s]', '', 'g'), ',')[2], '') as token2
  from fx_markets)"""
LONG = """lng AS (
  select id as market_id, 'token1' as side, token1 as asset_id from mk where token1 is not null
  union all
  select id as market_id, 'token2' as side, token2 as asset_id from mk where token2 is not null)"""
JOINED = """j AS (
  select f.*, lng.market_id, lng.side from
   (select *, case when makerAssetId <> '0' then makerAssetId else takerAssetId end as nonusdc_asset_id
    from fx_order_filled) f
  left join lng on f.nonusdc_asset_id = lng.asset_id)"""
STEP = """s AS (
  select make_timestamp(timestamp * 1000000) as timestamp, market_id, maker, taker, makerAssetId, takerAssetId,
    case when makerAssetId = '0' then 'USDC' else side end as makerAsset,
    case when takerAssetId = '0' then 'USDC' else side end as takerAsset,
    makerAmountFilled / 1e6 as makerAmountFilled, takerAmountFilled / 1e6 as takerAmountFilled,
    transactionHash from j)"""
LABELLED = """t AS (
  select timestamp, market_id, maker, taker,
    case when makerAssetId = '0' then takerAsset else makerAsset end as nonusdc_side,
    case when takerAsset = 'USDC' then 'SELL' else 'BUY' end as maker_direction,
    case when takerAsset = 'USDC' then 'BUY' else 'SELL' end as taker_direction,
    cast(case when takerAsset = 'USDC' then takerAmountFilled / nullif(makerAmountFilled, 0)
         else makerAmountFilled / nullif(takerAmountFilled, 0) end as double) as price,
    case when takerAsset = 'USDC' then takerAmountFilled else makerAmountFilled end as usd_amount,
    case when takerAsset <> 'USDC' then takerAmountFilled else makerAmountFilled end as token_amount,
    transactionHash from s)"""
AMOUNT_COLS = "price, usd_amount, token_amount"


def trades_with(*extra: str) -> str:
    return ",\n".join([fx("fx_markets", "fx_order_filled"), MK_LEAN, LONG, JOINED, STEP, LABELLED,
                       *extra])


def _markets(spark, sf):
    return load_markets([X.fx_markets(spark, sf)], lean=True)


def _trades(spark, sf):
    return LB.label_trades(X.fx_order_filled(spark, sf), _markets(spark, sf))


# --- flagship ----------------------------------------------------------------

@register("label_trades", f"""WITH {trades_with()}
select timestamp, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction,
  {AMOUNT_COLS}, transactionHash from t""")
def q_label_trades(spark, sf):
    """Fills x markets -> 11-column labelled trades."""
    return _trades(spark, sf)


# --- markets -----------------------------------------------------------------

@register("token_pair_parse", f"""WITH {fx("fx_markets", "fx_missing_markets")},
u AS (select id, clobTokenIds from fx_markets union all select id, clobTokenIds from fx_missing_markets
      union all select 'blank', '' union all select 'null', null)
select id, clobTokenIds,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[1], '') as token1,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[2], '') as token2
from u""")
def q_token_pair_parse(spark, sf):
    m = X.fx_markets(spark, sf).select("id", "clobTokenIds").unionByName(
        X.fx_missing_markets(spark, sf).select("id", "clobTokenIds"))
    edge = spark.createDataFrame([("blank", ""), ("null", None)], "id string, clobTokenIds string")
    t1, t2 = token_pair("clobTokenIds")
    return m.unionByName(edge).select("id", "clobTokenIds", t1.alias("token1"), t2.alias("token2"))


@register("markets_unpivot", f"""WITH {fx("fx_markets")}, {MK_LEAN}
select id as market_id, 'token1' as side, token1 as asset_id from mk
union all select id as market_id, 'token2' as side, token2 as asset_id from mk""")
def q_markets_unpivot(spark, sf):
    return LB.markets_long(_markets(spark, sf), keep_nulls=True)


FULL_UNION = """u AS (
  select id, clobTokenIds, question, market_slug, cast(closed as varchar) as closed,
         null::varchar as conditionId, null::varchar as slug, 0 as prio from fx_markets
  union all
  select id, clobTokenIds, question, null, closed, conditionId, slug, 1 from fx_missing_markets),
first AS (select * exclude (prio, rn) from
  (select *, row_number() over (partition by id order by prio) as rn from u) where rn = 1)"""


@register("union_first_wins", f"""WITH {fx("fx_markets", "fx_missing_markets")}, {FULL_UNION}
select * from first""")
def q_union_first_wins(spark, sf):
    return union_first_wins([X.fx_markets(spark, sf), X.fx_missing_markets(spark, sf)], "id")


@register("src_markets_full", f"""WITH {fx("fx_markets", "fx_missing_markets")}, {FULL_UNION}
select *,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[1], '') as token1,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[2], '') as token2
from first""")
def q_src_markets_full(spark, sf):
    return load_markets([X.fx_markets(spark, sf), X.fx_missing_markets(spark, sf)])


@register("src_markets_lean", f"""WITH {fx("fx_markets", "fx_missing_markets")}, {FULL_UNION}
select id,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[1], '') as token1,
  nullif(str_split(regexp_replace(clobTokenIds, '[\\[\\]"\\s]', '', 'g'), ',')[2], '') as token2
from first""")
def q_src_markets_lean(spark, sf):
    return load_markets([X.fx_markets(spark, sf), X.fx_missing_markets(spark, sf)], lean=True)


# --- per-fill scalars --------------------------------------------------------

@register("nonusdc_asset_id", f"""WITH {fx("fx_order_filled")}
select transactionHash, makerAssetId, takerAssetId,
  case when makerAssetId <> '0' then makerAssetId else takerAssetId end as nonusdc_asset_id
from fx_order_filled""")
def q_nonusdc_asset_id(spark, sf):
    f = X.fx_order_filled(spark, sf)
    return f.select("transactionHash", "makerAssetId", "takerAssetId",
                    L.nonusdc_asset_id().alias("nonusdc_asset_id"))


@register("amount_scale", f"""WITH {fx("fx_order_filled")}
select transactionHash, makerAmountFilled / 1e6 as maker_amount,
  takerAmountFilled / 1e6 as taker_amount from fx_order_filled""")
def q_amount_scale(spark, sf):
    f = X.fx_order_filled(spark, sf)
    return f.select("transactionHash", L.amount_scale("makerAmountFilled").alias("maker_amount"),
                    L.amount_scale("takerAmountFilled").alias("taker_amount"))


@register("epoch_to_ts", f"""WITH {fx("fx_order_filled")}
select transactionHash, timestamp as epoch, make_timestamp(timestamp * 1000000) as ts
from fx_order_filled""")
def q_epoch_to_ts(spark, sf):
    f = X.fx_order_filled(spark, sf)
    return f.select("transactionHash", F.col("timestamp").alias("epoch"),
                    L.epoch_to_ts("timestamp").alias("ts"))


@register("epoch_to_text", f"""WITH {fx("fx_order_filled")}
select transactionHash, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') as ts_text
from fx_order_filled""")
def q_epoch_to_text(spark, sf):
    f = X.fx_order_filled(spark, sf)
    return f.select("transactionHash", L.epoch_to_text("timestamp").alias("ts_text"))


@register("asset_label", f"""WITH {trades_with()}
select transactionHash, makerAssetId, takerAssetId, makerAsset, takerAsset from s""")
def q_asset_label(spark, sf):
    j = LB.join_fills_markets(X.fx_order_filled(spark, sf), _markets(spark, sf))
    return j.select("transactionHash", "makerAssetId", "takerAssetId",
                    L.asset_label("makerAssetId").alias("makerAsset"),
                    L.asset_label("takerAssetId").alias("takerAsset"))


@register("trade_direction", f"""WITH {trades_with()}
select transactionHash, maker_direction, taker_direction from t""")
def q_trade_direction(spark, sf):
    return _trades(spark, sf).select("transactionHash", "maker_direction", "taker_direction")


@register("nonusdc_side", f"""WITH {trades_with()}
select transactionHash, market_id, nonusdc_side from t""")
def q_nonusdc_side(spark, sf):
    return _trades(spark, sf).select("transactionHash", "market_id", "nonusdc_side")


@register("usd_token_amount", f"""WITH {trades_with()}
select transactionHash,
  case when takerAsset = 'USDC' then takerAmountFilled else makerAmountFilled end as usd_amount,
  case when takerAsset <> 'USDC' then takerAmountFilled else makerAmountFilled end as token_amount,
  case when takerAssetId <> '0' then takerAmountFilled else makerAmountFilled end as token_amount_strict
from s""")
def q_usd_token_amount(spark, sf):
    j = LB.join_fills_markets(X.fx_order_filled(spark, sf), _markets(spark, sf))
    amounts = L.amount_scale("makerAmountFilled"), L.amount_scale("takerAmountFilled")
    made = [L.fill_labels(L.taker_pays(), *amounts, strict=strict) for strict in (False, True)]
    return j.select("transactionHash", made[0]["usd_amount"].alias("usd_amount"),
                    made[0]["token_amount"].alias("token_amount"),
                    F.when(F.col("takerAssetId") != L.USDC_ID, amounts[1]).otherwise(amounts[0]).alias("token_amount_strict"))


@register("trade_price", f"""WITH {trades_with()}
select transactionHash, price from t""")
def q_trade_price(spark, sf):
    return _trades(spark, sf).select("transactionHash", "price")


# --- joins, set operations ---------------------------------------------------

@register("join_fills_markets", f"""WITH {trades_with()}
select timestamp, maker, makerAssetId, makerAmountFilled, taker, takerAssetId, takerAmountFilled,
  transactionHash, nonusdc_asset_id, market_id, side from j""")
def q_join_fills_markets(spark, sf):
    return LB.join_fills_markets(X.fx_order_filled(spark, sf), _markets(spark, sf))


TRADED = """traded AS (
  select makerAssetId as asset_id from fx_order_filled where makerAssetId <> '0'
  union select takerAssetId from fx_order_filled where takerAssetId <> '0')"""


@register("distinct_traded_tokens", f"""WITH {fx("fx_order_filled")}, {TRADED}
select asset_id from traded""")
def q_distinct_traded_tokens(spark, sf):
    return LB.traded_tokens(X.fx_order_filled(spark, sf))


@register("missing_tokens", f"""WITH {trades_with(TRADED)}
select asset_id from traded where asset_id not in (select asset_id from lng) order by asset_id""")
def q_missing_tokens(spark, sf):
    return LB.missing_tokens(X.fx_order_filled(spark, sf), _markets(spark, sf))


@register("token_except", f"""WITH {trades_with(TRADED)}
select asset_id from traded except select asset_id from lng""")
def q_token_except(spark, sf):
    traded = LB.traded_tokens(X.fx_order_filled(spark, sf))
    return traded.subtract(LB.known_tokens(_markets(spark, sf)))


@register("sort_text_ids", f"""WITH {fx("fx_order_filled")}, {TRADED}
select asset_id from traded order by asset_id""")
def q_sort_text_ids(spark, sf):
    """Traded ids in text order: a range-partitioned global sort (no
    single-partition window)."""
    return LB.traded_tokens(X.fx_order_filled(spark, sf)).orderBy("asset_id")


# --- filters -----------------------------------------------------------------

@register("filter_non_usdc", f"""WITH {fx("fx_order_filled")}
select transactionHash, makerAssetId from fx_order_filled where makerAssetId <> '0'""")
def q_filter_non_usdc(spark, sf):
    f = X.fx_order_filled(spark, sf)
    return LB.filter_non_usdc(f).select("transactionHash", "makerAssetId")


TRADERS = ("0xa1", "0xa7", "0xa42")


@register("filter_trader", f"""WITH {trades_with()}
select timestamp, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction,
  {AMOUNT_COLS}, transactionHash from t where maker in ({", ".join(f"'{m}'" for m in TRADERS)})""")
def q_filter_trader(spark, sf):
    return _trades(spark, sf).where(F.col("maker").isin(*TRADERS))


EXCHANGE = "0xb0"  # fixture stand-in for the exchange contract address


@register("flag_intermediary", f"""WITH {trades_with()}
select transactionHash, maker, taker, taker = '{EXCHANGE}' as is_intermediary from t""")
def q_flag_intermediary(spark, sf):
    return _trades(spark, sf).select("transactionHash", "maker", "taker",
                                     (F.col("taker") == EXCHANGE).alias("is_intermediary"))


@register("market_ticks", f"""WITH {trades_with()}
select timestamp, price, usd_amount from t where market_id = '0xm1200'""")
def q_market_ticks(spark, sf):
    """One market's trade ticks (the notebook's back-test extract)."""
    return _trades(spark, sf).where(F.col("market_id") == "0xm1200") \
        .select("timestamp", "price", "usd_amount")

"""The fixture tables of ``fillbook.sources.fixtures`` written as DuckDB CTEs.

Used only by the oracle SQL. Keep in step with the DataFrame definitions.
"""

from __future__ import annotations

FX = {
    "fx_markets": """
select concat('0xm', cast(p_partkey as varchar)) as id,
  case when p_partkey % 13 = 0 then ''
       when p_partkey % 7 = 0 then concat('["', cast(2*p_partkey+1 as varchar), '"]')
       else concat('["', cast(2*p_partkey+1 as varchar), '", "', cast(2*p_partkey+2 as varchar), '"]') end as clobTokenIds,
  p_name as question, p_brand as market_slug, (p_size % 2 = 0) as closed
from part where p_partkey % 11 <> 0""",
    "fx_missing_markets": """
select concat('0xm', cast(p_partkey as varchar)) as id,
  case when p_partkey % 11 = 0
       then concat('["', cast(2*p_partkey+1 as varchar), '", "', cast(2*p_partkey+2 as varchar), '"]')
       else concat('["9', cast(2*p_partkey+1 as varchar), '", "9', cast(2*p_partkey+2 as varchar), '"]') end as clobTokenIds,
  concat('0xm', cast(p_partkey as varchar)) as conditionId,
  p_name as question, p_brand as slug,
  case when p_size % 2 = 0 then 'True' else 'False' end as closed
from part where p_partkey % 11 = 0 or p_partkey % 17 = 0""",
    "fx_order_filled": """
select cast(epoch(l_shipdate) as bigint) + (l_orderkey * 37 + l_linenumber * 11) % 86400 as timestamp,
  concat('0xa', cast(l_suppkey as varchar)) as maker,
  case when l_linestatus = 'O' then '0' else cast(2*l_partkey + 1 + l_linenumber % 2 as varchar) end as makerAssetId,
  case when l_linestatus = 'O' then cast(round(l_extendedprice*100) as bigint)
       else cast(l_quantity as bigint)*1000000 end as makerAmountFilled,
  concat('0xb', cast(l_orderkey % 997 as varchar)) as taker,
  case when l_linestatus = 'O' then cast(2*l_partkey + 1 + l_linenumber % 2 as varchar) else '0' end as takerAssetId,
  case when l_linestatus = 'O' then cast(l_quantity as bigint)*1000000
       else cast(round(l_extendedprice*100) as bigint) end as takerAmountFilled,
  concat('0x', sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))) as transactionHash
from lineitem""",
    "fx_ticks": """
select event_id as seq, concat('m', cast(user_id % 10 as varchar)) as market_id, ts as timestamp,
  value / 500.0 as price, value as usd_amount, concat('u', cast(user_id as varchar)) as maker, event_type
from events""",
    "fx_equity": """
select market_id as series, seq, timestamp as ts,
  (10000000 + sum(cast(round((usd_amount - 50) * 100) as bigint))
     over (partition by market_id order by seq)) / 1e2 as value
from fx_ticks""",
    "fx_ledger": """
select concat('s', cast(l_suppkey as varchar)) as series, l_shipdate as closed_on,
  case when l_returnflag = 'N' then 'short' else 'long' end as side,
  cast(l_quantity as bigint) as bars,
  cast(round(l_extendedprice * (l_discount - 0.05) * 100) as bigint) as pnl_cents
from lineitem""",
}

DEPS = {"fx_equity": ["fx_ticks"]}


def fx(*names: str) -> str:
    """``name AS (...)`` CTE list for the given fixtures and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS ({FX[n]})" for n in order)

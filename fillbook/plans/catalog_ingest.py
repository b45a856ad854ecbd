"""Queries for raw ingest, codecs, sources/sinks and resume logic."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillbook.functions import hexcodec as H
from fillbook.functions.names import clean_label, plot_title, sanitize_source_name
from fillbook.functions.tokens import flatten_cell, market_id_coalesce, token_ids_from_struct
from fillbook.operators import align as A
from fillbook.operators.dedupe import first_per_key
from fillbook.operators.nested import nested_to_path_rows
from fillbook.plans.catalog_series import BARS_SQL, _bars
from fillbook.plans.catalog_trades import _trades, trades_with
from fillbook.plans.fixture_sql import fx
from fillbook.plans.registry import register
from fillbook.session import scratch_path
from fillbook.sources import chain as C
from fillbook.sources import files as FS
from fillbook.sources import fixtures as X
from fillbook.sources.markets import markets_from_pages, new_markets, supplement_merge, supplement_rows

# --- raw chain logs ----------------------------------------------------------

TWO100 = "1267650600228229401496703205376"  # 2^100
LOGS_SQL = f"""li AS (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus = 'O' as is_o,
    (cast(epoch(l_shipdate) as bigint) + (l_orderkey * 37 + l_linenumber * 11) % 86400) // 2 as block,
    2 * l_partkey + 1 + l_linenumber % 2 as small,
    cast(round(l_extendedprice * 100) as bigint) as usd, cast(l_quantity as bigint) * 1000000 as qty,
    sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)) as h
  from lineitem),
dec AS (select *, cast(case when l_orderkey % 3 = 0
      then cast(l_suppkey as hugeint) * cast('{TWO100}' as hugeint) + small else small end as varchar) as token
  from li),
expected AS (
  select block * 2 as timestamp, '0x' || lower(lpad(hex(l_suppkey), 40, '0')) as maker,
    case when is_o then '0' else token end as makerAssetId,
    case when is_o then usd else qty end as makerAmountFilled,
    '0x' || lower(lpad(hex(l_orderkey % 997), 40, '0')) as taker,
    case when is_o then token else '0' end as takerAssetId,
    case when is_o then qty else usd end as takerAmountFilled,
    '0x' || h as transactionHash, block, l_orderkey, l_linenumber
  from dec)"""
KEEP = "l_orderkey % 50 <> 0 and l_linenumber <> 7"
HEAD = "(select max(block) from li)"


def _logs(spark, sf):
    return X.fx_raw_logs(spark, sf)


def _blocks(spark, sf):
    return X.fx_raw_blocks(spark, sf)


@register("src_logs_decode", f"""WITH {LOGS_SQL}
select timestamp, maker, makerAssetId, makerAmountFilled, taker, takerAssetId, takerAmountFilled,
  transactionHash from expected where {KEEP} and block <= {HEAD} - 20""")
def q_src_logs_decode(spark, sf):
    return C.logs_to_fills(_logs(spark, sf), _blocks(spark, sf), X.FX_CONTRACT, X.FX_TOPIC0)


@register("filter_event", f"""WITH {LOGS_SQL}
select transactionHash, block from expected where {KEEP}""")
def q_filter_event(spark, sf):
    """Logs are landed once; the filter is pushed into the landed files."""
    path = scratch_path(spark, "landed-logs")
    C.land_logs(_logs(spark, sf), path, blocks_per_range=1 << 23)
    ev = C.scan_logs(spark, path, X.FX_CONTRACT, X.FX_TOPIC0)
    return ev.select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                     H.hex_or_dec_int("block_number").alias("block"))


@register("filter_reorg_buffer", f"""WITH {LOGS_SQL}
select transactionHash, block from expected where block <= {HEAD} - 20""")
def q_filter_reorg_buffer(spark, sf):
    lg = C.filter_reorg_buffer(_logs(spark, sf), blocks=_blocks(spark, sf))
    return lg.select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                     F.col("block_number").alias("block"))


@register("join_log_block_time", f"""WITH {LOGS_SQL}
select transactionHash, block, timestamp from expected""")
def q_join_log_block_time(spark, sf):
    lg = _logs(spark, sf).select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                                 H.hex_or_dec_int("block_number").alias("block_number"))
    j = C.join_block_time(lg, _blocks(spark, sf))
    return j.select("transactionHash", F.col("block_number").alias("block"), "timestamp")


@register("uint256_decimal", f"""WITH {LOGS_SQL}
select '0x' || h as transactionHash, token as token_id from dec""")
def q_uint256_decimal(spark, sf):
    lg = _logs(spark, sf)
    return lg.select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                     H.uint256_decimal(H.hex_word("data", 1)).alias("token_id"))


@register("hex_or_dec_int", f"""WITH {LOGS_SQL}
select transactionHash, case when l_orderkey % 2 = 0 then '0x' || lower(hex(block))
  else cast(block as varchar) end as block_text, block from expected""")
def q_hex_or_dec_int(spark, sf):
    lg = _logs(spark, sf)
    return lg.select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                     F.col("block_number").alias("block_text"),
                     H.hex_or_dec_int("block_number").alias("block"))


@register("topic_address", f"""WITH {LOGS_SQL}
select transactionHash, maker, taker from expected""")
def q_topic_address(spark, sf):
    lg = _logs(spark, sf)
    return lg.select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                     H.topic_address(F.col("topics")[2]).alias("maker"),
                     H.topic_address(F.col("topics")[3]).alias("taker"))


@register("hash_prefix", f"""WITH {LOGS_SQL}
select l_orderkey, l_linenumber, transactionHash from expected""")
def q_hash_prefix(spark, sf):
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    h = F.sha2(key, 256)
    li = X.read_table(spark, sf, "lineitem")
    raw = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("0x"), h)).otherwise(h)
    return li.select("l_orderkey", "l_linenumber", H.hash_prefix(raw).alias("transactionHash"))


@register("side_to_assets", f"""WITH {LOGS_SQL}
select '0x' || h as transactionHash, cast(case when is_o then 0 else 1 end as bigint) as side,
  case when is_o then '0' else token end as makerAssetId, case when is_o then token else '0' end as takerAssetId
from dec""")
def q_side_to_assets(spark, sf):
    """Staged as in ``decode_fills``: side and token are decoded once per log, outside any condition."""
    word = H.hex_word("data", 1)
    dec = _logs(spark, sf).select(H.hash_prefix("transaction_hash").alias("transactionHash"),
                                  H.uint_small(H.hex_word("data", 0)).alias("side"), H.uint256_decimal(word).alias("_token"))
    return dec.select("transactionHash", "side",
                      F.when(F.col("side") == 0, F.lit("0")).otherwise(F.col("_token")).alias("makerAssetId"),
                      F.when(F.col("side") == 0, F.col("_token")).otherwise(F.lit("0")).alias("takerAssetId"))


@register("ingest_stats", f"""WITH {LOGS_SQL}
select count(*) as rows_written, strftime(make_timestamp(min(timestamp) * 1000000), '%Y-%m-%d %H:%M:%S') as first_ts,
  strftime(make_timestamp(max(timestamp) * 1000000), '%Y-%m-%d %H:%M:%S') as last_ts
from expected where {KEEP} and block <= {HEAD} - 20""")
def q_ingest_stats(spark, sf):
    from fillbook.functions.labels import epoch_to_text
    f = C.logs_to_fills(_logs(spark, sf), _blocks(spark, sf), X.FX_CONTRACT, X.FX_TOPIC0)
    s = f.agg(F.count(F.lit(1)).alias("rows_written"), F.min("timestamp").alias("_a"),
              F.max("timestamp").alias("_b"))
    return s.select("rows_written", epoch_to_text("_a").alias("first_ts"),
                    epoch_to_text("_b").alias("last_ts"))


# --- market pages, supplements ----------------------------------------------

PAGES_SQL = """pm AS (
  select p_partkey as k,
    case when p_partkey % 19 = 0 then '' when p_partkey % 23 = 0 then null
         else '0xc' || cast(p_partkey as varchar) end as condition_id,
    case when p_partkey % 13 = 0 then ''
         else '["' || cast(2*p_partkey+1 as varchar) || '", "' || cast(2*p_partkey+2 as varchar) || '"]' end as clobTokenIds,
    p_name as question, p_brand as market_slug, p_size % 2 = 0 as closed
  from part),
pmk AS (select condition_id as id, clobTokenIds, condition_id, question, market_slug, closed, k
        from pm where condition_id is not null and condition_id <> '')"""


def _pages(spark, sf):
    return X.fx_market_pages(spark, sf)


@register("src_market_pages", f"""WITH {PAGES_SQL}
select id, clobTokenIds, condition_id, question, market_slug, closed,
  case when k % 13 = 0 then '' else
  '[{{"token_id": "' || cast(2*k+1 as varchar) || '", "outcome": "Yes"}}, {{"token_id": "' || cast(2*k+2 as varchar)
  || '", "outcome": "No"}}, {{"token_id": null, "outcome": "x"}}]' end as tokens,
  'i' || cast(k as varchar) || '.png' as icon,
  '{{"min":' || cast(k % 7 as varchar) || ',"rates":[' || cast(k % 3 as varchar) || ',2]}}' as rewards from pmk""")
def q_src_market_pages(spark, sf):
    rows = markets_from_pages(_pages(spark, sf))
    return rows.select(*[c for c in rows.columns if c != "extras"], F.col("extras")["icon"].alias("icon"),
                       F.col("extras")["rewards"].alias("rewards"))


@register("src_market_incremental", f"""WITH {PAGES_SQL}
select id, clobTokenIds, condition_id, question, market_slug, closed from pmk where k >= 1000""")
def q_src_market_incremental(spark, sf):
    """Resume after page 0: re-read from the last stored page, keep unseen ids."""
    pages = _pages(spark, sf)
    stored = markets_from_pages(pages.where(F.col("page_offset") < 1000))
    fresh = markets_from_pages(pages.where(F.col("page_offset") >= 0))
    return new_markets(stored, fresh).drop("tokens", "extras")


@register("filter_blank_or_seen", f"""WITH {PAGES_SQL}
select id from pmk""")
def q_filter_blank_or_seen(spark, sf):
    rows = _pages(spark, sf).select("page_offset", F.posexplode("data").alias("pos", "m"))
    rows = rows.select("page_offset", "pos", F.col("m.condition_id").alias("id"))
    rows = rows.where(F.col("id").isNotNull() & (F.col("id") != ""))
    return first_per_key(rows, "id", [F.col("page_offset"), F.col("pos")]).select("id")


@register("token_ids_extract", f"""WITH {PAGES_SQL}
select condition_id, case when k % 13 = 0 then 0 else 2 end as n_tokens,
  case when k % 13 = 0 then '' else cast(2*k+1 as varchar) || ',' || cast(2*k+2 as varchar) end as token_ids
from pm where condition_id is not null and condition_id <> ''""")
def q_token_ids_extract(spark, sf):
    rows = _pages(spark, sf).select("page_offset", F.posexplode("data").alias("pos", "m"))
    rows = rows.where(F.col("m.condition_id").isNotNull() & (F.col("m.condition_id") != ""))
    first = first_per_key(rows.select(F.col("m.condition_id").alias("condition_id"),
                                      "page_offset", "pos", F.col("m.tokens").alias("tokens")),
                          "condition_id", [F.col("page_offset"), F.col("pos")])
    ids = token_ids_from_struct("tokens")
    return first.select("condition_id", F.size(ids).alias("n_tokens"),
                        F.array_join(ids, ",").alias("token_ids"))


@register("json_flatten_cell", f"""WITH {PAGES_SQL}
select condition_id, case when k % 13 = 0 then '' else
  '[{{"token_id": "' || cast(2*k+1 as varchar) || '", "outcome": "Yes"}}, {{"token_id": "' || cast(2*k+2 as varchar)
  || '", "outcome": "No"}}, {{"token_id": null, "outcome": "x"}}]' end as tokens_json
from pm where condition_id is not null and condition_id <> ''""")
def q_json_flatten_cell(spark, sf):
    rows = _pages(spark, sf).select("page_offset", F.posexplode("data").alias("pos", "m"))
    rows = rows.where(F.col("m.condition_id").isNotNull() & (F.col("m.condition_id") != ""))
    first = first_per_key(rows.select(F.col("m.condition_id").alias("condition_id"),
                                      "page_offset", "pos", F.col("m.tokens").alias("tokens")),
                          "condition_id", [F.col("page_offset"), F.col("pos")])
    return first.select("condition_id", flatten_cell("tokens", "array").alias("tokens_json"))


SUPP_SQL = f"""{fx("fx_missing_markets")},
it AS (select p_partkey as k, p_partkey // 40 as fetch_seq,
    case when p_partkey % 10 = 0 then cast(p_partkey as varchar) else '0xm' || cast(p_partkey as varchar) end as mid,
    '["' || cast(2*p_partkey+1 as varchar) || '", "' || cast(2*p_partkey+2 as varchar) || '"]' as clobTokenIds,
    p_name as question, p_brand as slug, case when p_size % 2 = 0 then 'true' else 'false' end as closed
  from part),
rows6 AS (select mid as id, clobTokenIds, mid as conditionId, question, slug, closed from it)"""


def _payloads(spark, sf):
    """Fetched supplement payloads: one per batch of 40 parts, in three body
    shapes; every 15th market appears twice in its batch, the stale copy first."""
    p = X.read_table(spark, sf, "part")
    k = F.col("p_partkey")
    item = F.struct(
        F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("0xm"), k.cast("string"))).alias("conditionId"),
        k.cast("string").alias("id"),
        F.concat(F.lit('["'), (2 * k + 1).cast("string"), F.lit('", "'), (2 * k + 2).cast("string"),
                 F.lit('"]')).alias("clobTokenIds"),
        F.col("p_name").alias("question"), F.col("p_brand").alias("slug"),
        F.when(F.col("p_size") % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("closed"))
    stale = item.withField("closed", F.lit("stale"))
    rows = p.select(F.floor(k / 40).alias("fetch_seq"), F.struct(k.alias("o"), F.lit(1).alias("v"), item.alias("m")).alias("e")) \
        .unionByName(p.where(k % 15 == 0).select(
            F.floor(k / 40).alias("fetch_seq"), F.struct(k.alias("o"), F.lit(0).alias("v"), stale.alias("m")).alias("e")))
    batches = rows.groupBy("fetch_seq").agg(F.sort_array(F.collect_list("e")).alias("es"))
    items = F.transform("es", lambda e: e["m"])
    shape = F.col("fetch_seq") % 3
    body = (F.when(shape == 0, F.to_json(items))
            .when(shape == 1, F.to_json(F.struct(items.alias("markets"))))
            .otherwise(F.to_json(F.struct(items.alias("data")))))
    return batches.select("fetch_seq", body.alias("body"))


@register("batch_dedupe_last", f"""WITH {SUPP_SQL}
select * from rows6""")
def q_batch_dedupe_last(spark, sf):
    return supplement_rows(_payloads(spark, sf))


@register("src_supplement_merge", f"""WITH {SUPP_SQL}
select * from rows6 where id not in (select id from fx_missing_markets)""")
def q_src_supplement_merge(spark, sf):
    return supplement_merge(X.fx_missing_markets(spark, sf), _payloads(spark, sf))


@register("market_id_coalesce", f"""WITH {SUPP_SQL}
select mid as id from it""")
def q_market_id_coalesce(spark, sf):
    p = X.read_table(spark, sf, "part")
    k = F.col("p_partkey")
    cond = F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("0xm"), k.cast("string")))
    return p.select(market_id_coalesce(cond, k.cast("string")).alias("id"))


@register("count_markets", f"""WITH {PAGES_SQL}
select count(*) as n_markets from pmk""")
def q_count_markets(spark, sf):
    return markets_from_pages(_pages(spark, sf)).agg(F.count(F.lit(1)).alias("n_markets"))


# --- names, nested records ---------------------------------------------------

NAME_SQL = f"""{fx("fx_markets")},
nm AS (select id, 'SimpleMovingAverage_' || question || ' @ (' || market_slug || '^close)' as raw from fx_markets)"""


@register("name_normalise", f"""WITH {NAME_SQL}
select id,
  regexp_replace(replace(replace(replace(replace(raw, '_', ' '), 'SimpleMovingAverage', 'MA'),
    'ExponentialMovingAverage', 'EMA'), 'MovingAverage', 'MA'), '^\\s+|\\s+$', '', 'g') as label,
  regexp_replace(regexp_replace(regexp_replace(raw, '[(),.*:/^]', '_', 'g'), '_{{2,}}', '_', 'g'),
    '^_+|_+$', '', 'g') as source_name,
  regexp_replace(replace(split_part(raw, ' @ ', 1), '_', '.'), '^\\s+|\\s+$', '', 'g') as title
from nm""")
def q_name_normalise(spark, sf):
    m = X.fx_markets(spark, sf)
    raw = F.concat(F.lit("SimpleMovingAverage_"), F.col("question"), F.lit(" @ ("),
                   F.col("market_slug"), F.lit("^close)"))
    m = m.select("id", raw.alias("raw"))
    return m.select("id", clean_label("raw").alias("label"),
                    sanitize_source_name("raw").alias("source_name"), plot_title("raw").alias("title"))


@register("nested_to_path_rows", """select event_id, 'props - k' as path,
  cast(json_extract(props, '$.k') as varchar) as value from events
union all select event_id, 'type', event_type from events
union all select event_id, 'cents', cast(cast(round(value * 100) as bigint) as varchar) from events""")
def q_nested_to_path_rows(spark, sf):
    ev = X.read_table(spark, sf, "events")
    rec = F.to_json(F.struct(F.from_json("props", "map<string,bigint>").alias("props"),
                             F.col("event_type").alias("type"),
                             F.round(F.col("value") * 100).cast("bigint").alias("cents")))
    return nested_to_path_rows(ev.select("event_id", rec.alias("rec")), ["event_id"], "rec")


# --- file sources and sinks (round trips through the shared folder) ----------

@register("src_fills_scan", f"""WITH {fx("fx_order_filled")} select * from fx_order_filled""")
def q_src_fills_scan(spark, sf):
    path = scratch_path(spark, "fills-csv")
    FS.write_fills_csv(X.fx_order_filled(spark, sf), path)
    return FS.read_fills_csv(spark, path)


@register("sink_csv_export", f"""WITH {trades_with()}
select timestamp, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction, price,
  usd_amount, token_amount, transactionHash from t""")
def q_sink_csv_export(spark, sf):
    path = scratch_path(spark, "trades-csv")
    FS.export_trades_csv(_trades(spark, sf), path, compression="gzip")
    return FS.read_trades_csv(spark, path)


@register("sink_trades_append", f"""WITH {trades_with()}
select timestamp, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction, price,
  usd_amount, token_amount, transactionHash, cast(date_trunc('month', timestamp) as date) as trade_date from t""")
def q_sink_trades_append(spark, sf):
    """Two appends (before/after 1996) into one date-partitioned table."""
    path = scratch_path(spark, "trades-parquet")
    t = _trades(spark, sf)
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    FS.append_trades(t.where(F.col("timestamp") < cut), path, "first", granularity="month")
    FS.append_trades(t.where(F.col("timestamp") >= cut), path, "second", granularity="month")
    return FS.read_trades(spark, path)


@register("src_trades_scan", f"""WITH {trades_with()}
select timestamp, market_id, price, usd_amount from t where timestamp >= TIMESTAMP '1997-01-01'""")
def q_src_trades_scan(spark, sf):
    """Scan with partition pruning on trade_date and a two-column projection."""
    path = scratch_path(spark, "trades-parquet")
    FS.append_trades(_trades(spark, sf), path, "only", granularity="month")
    t = FS.read_trades(spark, path)
    return t.where(F.col("trade_date") >= F.lit("1997-01-01").cast("date")) \
        .select("timestamp", "market_id", "price", "usd_amount")


# --- resume markers ----------------------------------------------------------

MARK_SQL = f"""{fx("fx_order_filled")},
sf AS (select *, (select 0) as z from (
  select cast(epoch(l_shipdate) as bigint) + (l_orderkey * 37 + l_linenumber * 11) % 86400 as timestamp,
    concat('0xa', cast(l_suppkey as varchar)) as maker, concat('0xb', cast(l_orderkey % 997 as varchar)) as taker,
    concat('0x', sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))) as transactionHash,
    l_orderkey * 8 + l_linenumber as ingest_seq from lineitem)),
mid AS (select max(ingest_seq) as m from sf where ingest_seq <= (select (min(ingest_seq) + max(ingest_seq)) // 2 from sf)),
mark AS (select timestamp, transactionHash, maker, taker from sf where ingest_seq = (select m from mid)),
first_match AS (select min(ingest_seq) as s from sf join mark using (timestamp, transactionHash, maker, taker))"""


@register("resume_after_marker", f"""WITH {MARK_SQL}
select ingest_seq, transactionHash from sf where ingest_seq > (select s from first_match)""")
def q_resume_after_marker(spark, sf):
    from fillbook.operators.resume import last_marker, resume_after
    f = X.fx_order_filled_keyed(spark, sf)
    lo_hi = f.agg(((F.min("ingest_seq") + F.max("ingest_seq")) / 2).cast("bigint")).scalar()
    written = f.where(F.col("ingest_seq") <= lo_hi)
    mark = last_marker(written, "ingest_seq")
    return resume_after(f, mark, "ingest_seq").select("ingest_seq", "transactionHash")


@register("last_marker", f"""WITH {MARK_SQL}
select timestamp, transactionHash, maker, taker from mark""")
def q_last_marker(spark, sf):
    from fillbook.operators.resume import last_marker
    f = X.fx_order_filled_keyed(spark, sf)
    lo_hi = f.agg(((F.min("ingest_seq") + F.max("ingest_seq")) / 2).cast("bigint")).scalar()
    return last_marker(f.where(F.col("ingest_seq") <= lo_hi), "ingest_seq")


# --- live-table operators ----------------------------------------------------

@register("stream_changes_since", f"""WITH {fx("fx_ticks")},
clock AS (select distinct market_id, timestamp as ts from fx_ticks),
ix AS (select market_id, ts, row_number() over (partition by market_id order by ts) - 1 as idx from clock)
select market_id, ts, idx from ix where idx > 900""")
def q_stream_changes_since(spark, sf):
    """Rows a consumer has not seen: index above the one it has committed."""
    from fillbook.streaming.live import changes_since, commit
    path = scratch_path(spark, "cursors")
    commit(spark, path, "chart", 900)
    commit(spark, path, "other", 1200)
    t = X.fx_ticks(spark, sf).select("market_id", F.col("timestamp").alias("ts"))
    ix = A.gapfree_index(A.master_clock(t, ["market_id"], "ts"), ["market_id"], "ts")
    return changes_since(ix, path, "chart")[0]


@register("stream_patch_last", f"""WITH {fx("fx_ticks")}, {BARS_SQL},
lastb AS (select * from (select *, row_number() over (partition by market_id order by bar_start desc) as rn
  from bars) where rn = 1),
patch AS (select market_id, bar_start, null::double as open, high * 2 as high, null::double as low,
  close + 1 as close from lastb)
select b.market_id, b.bar_start, coalesce(p.open, b.open) as open, coalesce(p.high, b.high) as high,
  coalesce(p.low, b.low) as low, coalesce(p.close, b.close) as close from lastb b join patch p using (market_id, bar_start)""")
def q_stream_patch_last(spark, sf):
    """Patch the latest bar of each market with a partial update (nulls keep the old value)."""
    from fillbook.streaming.live import patch_rows
    last = A.last_n_rows(_bars(spark, sf), ["market_id"], "bar_start", 1)
    patch = last.select("market_id", "bar_start", F.lit(None).cast("double").alias("open"),
                        (F.col("high") * 2).alias("high"), F.lit(None).cast("double").alias("low"),
                        (F.col("close") + 1).alias("close"))
    return patch_rows(last.select("market_id", "bar_start", "open", "high", "low", "close"),
                      patch, ["market_id", "bar_start"])

"""Raw log decode: random records written as logs and read back."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fillbook.functions import hexcodec as H
from fillbook.functions.labels import epoch_to_text
from fillbook.sources import chain as C

CONTRACT, TOPIC = "0x" + "5a" * 20, "0x" + "7c" * 32


def _word(n):
    return format(n, "064x")


def records(r, n):
    """Random fills: what a log says, before it is written as one."""
    return [dict(block=r.randrange(1, 500), index=i, maker=r.getrandbits(160), taker=r.getrandbits(160), side=r.randrange(2),
                 token=r.getrandbits(r.choice([8, 64, 250])), amounts=(r.getrandbits(62), r.getrandbits(40)),
                 hash=r.getrandbits(256), style=r.randrange(8)) for i in range(n)]


def as_log(x):
    """The event's fixed layout: four topics, then words; several spellings of numbers and case."""
    hexed = lambda n, width: (str.upper if x["style"] & 1 else str.lower)(format(n, f"0{width}x"))
    words = (x["side"], x["token"], *x["amounts"], 0, 0, 0)
    return (hex(x["block"]) if x["style"] & 2 else str(x["block"]), x["index"], ("0x" if x["style"] & 4 else "") + format(x["hash"], "064x"), CONTRACT,
            [TOPIC, "0x" + _word(1), "0x" + "0" * 24 + hexed(x["maker"], 40), "0x" + "0" * 24 + hexed(x["taker"], 40)],
            "0x" + "".join(map(_word, words)))


def as_fill(x):
    assets = ("0", str(x["token"])) if x["side"] == 0 else (str(x["token"]), "0")
    address = lambda n: "0x" + format(n, "040x")
    return (2 * x["block"], address(x["maker"]), assets[0], x["amounts"][0], address(x["taker"]), assets[1], x["amounts"][1], "0x" + format(x["hash"], "064x"))


def decode(spark, logs, blocks, head=10**9):
    return C.logs_to_fills(spark.createDataFrame(logs, C.RAW_LOG), spark.createDataFrame(blocks, C.RAW_BLOCK), CONTRACT, TOPIC, head=head)


HEADERS = [(n, 2 * n) for n in range(1, 500)]


def test_logs_read_back(spark):
    rows = records(random.Random(5), 200)
    logs = [as_log(x) for x in rows]
    strangers = [(*logs[0][:3], "0x" + "99" * 20, *logs[0][4:]), (*logs[1][:4], ["0x" + "33" * 32, *logs[1][4][1:]], logs[1][5])]
    got = decode(spark, logs + strangers, HEADERS).collect()
    assert sorted(map(tuple, got)) == sorted(map(as_fill, rows))


def test_held_back_blocks(spark):
    rows = [dict(x, block=b) for x, b in zip(records(random.Random(6), 3), (100, 180, 181), strict=True)]
    lg = spark.createDataFrame([as_log(x) for x in rows], C.RAW_LOG)
    kept = C.filter_reorg_buffer(lg, blocks=spark.createDataFrame([(150, 1), (200, 4)], C.RAW_BLOCK))
    assert sorted(x.block_number for x in kept.collect()) == [100, 180]


def test_a_missing_header_and_a_large_amount_are_errors(spark):
    one = records(random.Random(7), 1)[0]
    with pytest.raises(Exception, match="no header for block"):
        decode(spark, [as_log(one)], [(one["block"] + 1, 5)]).collect()
    with pytest.raises(Exception, match="above 63 bits"):
        decode(spark, [as_log(dict(one, amounts=(2**63 + 1, 1)))], HEADERS).collect()


def test_uint256_exact(spark):
    rnd = random.Random(7)
    vals = [0, 1, 10**9, 10**18, 10**18 - 1, 10**36, 10**77, 2**255, 2**256 - 1] + [2**k + d for k in (63, 64, 127, 128, 191, 192) for d in (-1, 0, 1)]
    vals += [rnd.getrandbits(rnd.randint(1, 256)) for _ in range(500)]
    df = spark.createDataFrame([(_word(v), str(v)) for v in vals] + [("F" * 64, str(2**256 - 1)), (None, None)], "w string, exp string").repartition(2)
    made = df.select("exp", H.uint256_decimal("w").alias("got"))
    assert made.where(~F.col("got").eqNullSafe(F.col("exp"))).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "lambda" not in plan


@pytest.mark.parametrize("word", ["", "ff", "0x" + "0" * 62, "g" * 64, "0" * 65])
def test_strange_words_are_errors(spark, word):
    with pytest.raises(Exception, match="not a 32-byte word"):
        spark.createDataFrame([(word,)], "w string").repartition(2).select(H.uint256_decimal("w")).collect()


def test_landed_logs_prune(spark, tmp_path):
    """The event filter reaches the scan, and other block ranges are not read."""
    rows = [dict(x, block=b) for x, b in zip(records(random.Random(9), 300), list(range(300)), strict=True)]
    logs = [as_log(x) for x in rows]
    strangers = [(*x[:3], "0x" + "99" * 20, *x[4:]) for x in logs[:40]] + [(*x[:4], ["0x" + "33" * 32, *x[4][1:]], x[5]) for x in logs[:40]]
    path = str(tmp_path / "logs")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    C.land_logs(spark.createDataFrame(logs + strangers, C.RAW_LOG), path, blocks_per_range=100)
    got = C.scan_logs(spark, path, CONTRACT.upper().replace("0X", "0x"), TOPIC, 110, 190, blocks_per_range=100)
    assert sorted(r.log_index for r in got.collect()) == [x["index"] for x in rows if 110 <= x["block"] <= 190]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(address,{CONTRACT})" in plan and f"EqualTo(topic0,{TOPIC})" in plan and "GreaterThanOrEqual(block" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*block_range#\d+L? >= 1[^\]]*block_range#\d+L? <= 1", plan)
    fills = C.logs_to_fills(C.scan_logs(spark, path, CONTRACT, TOPIC, blocks_per_range=100), spark.createDataFrame(HEADERS + [(0, 0)], C.RAW_BLOCK),
                            CONTRACT, TOPIC, head=10**9)
    assert sorted(map(tuple, fills.collect())) == sorted(map(as_fill, rows))


def test_hex_or_dec_int(spark):
    df = spark.createDataFrame([("0x10",), ("42",), ("123",)], "s string")
    assert [r[0] for r in df.select(H.hex_or_dec_int("s")).collect()] == [16, 42, 123]


def test_time_format(spark):
    df = spark.createDataFrame([(0,), (1_700_000_000,)], "t long")
    assert [r[0] for r in df.select(epoch_to_text("t")).collect()] == \
        ["1970-01-01 00:00:00", "2023-11-14 22:13:20"]


def test_a_large_landing_goes_in_portions(spark, tmp_path, monkeypatch):
    from fillbook import session as S
    from tests.test_streaming import _left, _shuffle_files, _writes
    rows = [dict(x, block=b) for x, b in zip(records(random.Random(10), 300), list(range(300)), strict=True)]
    logs = spark.createDataFrame([as_log(x) for x in rows] + [(None, *as_log(rows[0])[1:])], C.RAW_LOG)
    monkeypatch.setattr(S, "PORTION_ROWS", 120, raising=False)
    path, before = str(tmp_path / "logs"), _shuffle_files(spark)
    for mode in ("overwrite", "append", "ignore"):
        C.land_logs(logs, path, blocks_per_range=50, mode=mode)
    back = spark.read.schema(C.LANDED_LOG).parquet(path)
    assert len(_writes(path)) == 6 and not _left(spark, before)  # three portions, twice
    assert sorted((r.block, r.log_index, r.block_range) for r in back.where("block is not null").collect()) == \
        sorted(2 * [(x["block"], x["index"], x["block"] // 50) for x in rows])
    assert back.where("block is null").count() == 2
    C.land_logs(logs.limit(0), str(tmp_path / "none"))
    assert spark.read.schema(C.LANDED_LOG).parquet(str(tmp_path / "none")).count() == 0

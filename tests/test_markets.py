"""Market sources: landed JSON pages, union priority, supplement payload shapes."""

import json
import os
import tempfile

from fillbook.sources.markets import (load_markets, markets_from_pages, read_market_pages,
                                      supplement_rows, union_first_wins)


def test_pages_json_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="pages-")
    pages = [
        {"page_offset": 0, "data": [
            {"condition_id": "0xc41", "tokens": [{"token_id": "1"}, {"token_id": 2}], "question": "Rain tomorrow", "closed": True},
            {"condition_id": "", "tokens": [{"token_id": "9"}]},
            {"condition_id": None},
            {"condition_id": "0xc42"}]},
        {"page_offset": 1000, "data": [
            {"condition_id": "0xc41", "tokens": [{"token_id": "7"}], "question": "later copy"}]},
    ]
    with open(os.path.join(d, "p.json"), "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    m = {r.id: r for r in markets_from_pages(read_market_pages(spark, d)).collect()}
    assert set(m) == {"0xc41", "0xc42"}
    assert m["0xc41"].clobTokenIds == '["1", "2"]' and m["0xc41"].question == "Rain tomorrow"
    assert m["0xc42"].clobTokenIds == ""


def test_union_first_wins_priority(spark):
    a = spark.createDataFrame([("1", "a", True)], "id string, clobTokenIds string, closed boolean")
    b = spark.createDataFrame([("1", "b", "False"), ("2", "c", "True")],
                              "id string, clobTokenIds string, closed string")
    got = {r.id: r for r in union_first_wins([a, b]).collect()}
    assert got["1"].clobTokenIds == "a" and got["2"].clobTokenIds == "c"


def test_load_markets_requires_columns(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        load_markets([])
    with pytest.raises(KeyError):
        load_markets([spark.createDataFrame([("1",)], "id string")])


def test_supplement_shapes_and_last_wins(spark):
    item = lambda cid, closed: {"conditionId": cid, "id": 5, "clobTokenIds": '["1", "2"]',
                                "question": "q", "slug": "s", "closed": closed}
    payloads = [(0, json.dumps([item("0xa", "true"), item("0xa", "false")])),
                (1, json.dumps({"markets": [item(None, "true")]})),
                (2, json.dumps({"data": [item("0xc", "true")]})),
                (3, json.dumps({"other": []}))]
    df = spark.createDataFrame(payloads, "fetch_seq long, body string")
    got = {r.id: r.closed for r in supplement_rows(df).collect()}
    assert got == {"0xa": "false", "5": "true", "0xc": "true"}


def test_csv_first_row_per_id_wins(spark):
    """Python-csv dialect (doubled quotes, newline in a cell); duplicate id in
    one file: the first stored row wins; the supplement file loses."""
    from fillbook.sources.markets import read_markets_csv
    d = tempfile.mkdtemp(prefix="mk-")
    os.makedirs(f"{d}/main")
    os.makedirs(f"{d}/extra")
    with open(f"{d}/main/part-0.csv", "w") as f:
        f.write('id,clobTokenIds,question\n')
        f.write('m1,"[""1"", ""2""]","first,\nline two"\n')
        f.write('m1,"[""8"", ""9""]",second\n')
        f.write('m2,,blank tokens\n')
    with open(f"{d}/extra/part-0.csv", "w") as f:
        f.write('id,clobTokenIds,question\nm1,"[""5"", ""6""]",supplement\nm3,"[""7""]",only here\n')
    m = load_markets([read_markets_csv(spark, f"{d}/main"), read_markets_csv(spark, f"{d}/extra")])
    got = {r.id: (r.token1, r.token2, r.question) for r in m.collect()}
    assert got["m1"] == ("1", "2", "first,\nline two")
    assert got["m2"] == (None, None, "blank tokens")
    assert got["m3"] == ("7", None, "only here")
    lean = load_markets([read_markets_csv(spark, f"{d}/main")], lean=True)
    assert lean.columns == ["id", "token1", "token2"]


def test_export_markets_csv_roundtrip(spark):
    from fillbook.sources.markets import export_markets_csv, read_markets_csv
    df = spark.createDataFrame(
        [("m1", '["1", "2"]', 'say "hi"\nbye', True, ["a"]), ("m2", "", None, False, None)],
        "id string, clobTokenIds string, question string, closed boolean, tags array<string>")
    d = tempfile.mkdtemp(prefix="exp-")
    export_markets_csv(df, d)
    back = {r.id: r for r in read_markets_csv(spark, d, keep_order=False).collect()}
    assert back["m1"].closed == "True" and back["m2"].closed == "False"
    assert back["m1"].question == 'say "hi"\nbye' and back["m1"].tags == '["a"]'
    assert back["m2"].clobTokenIds is None or back["m2"].clobTokenIds == ""

"""Token cells and ids: tables of inputs and results, checked by queries."""

import json

from pyspark.sql import functions as F

from fillbook.functions.tokens import (flatten_cell, json_string_array, market_id_coalesce,
                                       python_json_layout, token_ids_from_struct, token_pair)

PAIRS = {
    '["17", "23"]': ("17", "23"), '["17"]': ("17", None), "[17, 23, 29]": ("17", "23"),
    "[]": (None, None), "": (None, None), '["", "23"]': (None, "23"), '[" 17 "]': ("17", None),
    "[17,,23]": ("17", None), '["a b"]': ("ab", None), '["17", null]': ("17", "null"), "[ ,23]": (None, "23"), "17,\t23\n": ("17", "23"),
    "17, 23": ("17", "23"), '["17", "23': ("17", "23"), "{": ("{", None), None: (None, None),
}


def test_token_pairs(spark):
    df = spark.createDataFrame([(k,) for k in PAIRS], "cell string")
    assert {x.cell: (x.a, x.b) for x in df.select("cell", *[c.alias(n) for c, n in zip(token_pair("cell"), "ab", strict=True)]).collect()} == PAIRS


def test_ids_of_structs_and_their_cell(spark):
    rows = [([("17",), (None,), ("23",)], ["17", "23"]), (None, []), ([(None,)], [])]
    df = spark.createDataFrame(rows, "tokens array<struct<token_id:string>>, ids array<string>")
    ids = token_ids_from_struct("tokens")
    assert df.where(~(ids == F.col("ids"))).count() == 0
    assert [x[0] for x in df.select(json_string_array(ids)).collect()] == ['["17", "23"]', "", ""]


def test_market_ids(spark):
    rows = [("c7", "9", "c7"), (None, "9", "9"), ("", "", ""), (None, None, ""), ("", "0", "0")]
    df = spark.createDataFrame(rows, "c string, i string, want string")
    assert df.where(market_id_coalesce("c", "i") != F.col("want")).count() == 0


VALUES = [{"a": 1, "b": [1, 2]}, {"s": 'x, y: "z"', "t": "a\\"}, [{"token_id": None, "outcome": "x"}], "", "\\", 'q"', "a\\\\\"b, c",
          {"deep": {"k": ["\\\"", ":,", None]}}, []]


def test_layout_equals_python(spark):
    df = spark.createDataFrame([(json.dumps(v, separators=(",", ":")), json.dumps(v)) for v in VALUES], "compact string, want string")
    assert df.where(python_json_layout("compact") != F.col("want")).count() == 0


def test_cells_of_any_size_keep_nulls(spark):
    tokens = [(None if i % 3 == 0 else str(i), 'say "hi", \\') for i in range(3000)]
    df = spark.createDataFrame([(tokens,), (None,)], "t array<struct<token_id:string,outcome:string>>")
    got = [x[0] for x in df.select(flatten_cell("t", "array")).collect()]
    assert got == [json.dumps([{"token_id": a, "outcome": b} for a, b in tokens]), ""]

"""Nested records: any depth, texts that look like objects."""

import json

from fillbook.operators.nested import nested_to_path_rows


def plain(value, path=()):
    if isinstance(value, dict):
        return [r for k, v in value.items() for r in plain(v, (*path, k))]
    text = value if isinstance(value, str) or value is None else json.dumps(value, separators=(",", ":"))
    return [(" - ".join(path), text)]


def test_any_depth(spark):
    deep = {"x": 1}
    for i in range(23):
        deep = {f"k{i}": deep, "n": i}
    values = [deep, {"a": {"b": {"c": {"d": 1}}}}, {"t": "{not an object", "u": {"v": "{}"}, "w": {}}, {"l": [1, {"m": 2}], "z": None, "f": True}, {}]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(99, None), (98, "broken {")], "id long, rec string")
    got = sorted((x.id, x.path, x.value or "") for x in nested_to_path_rows(df, ["id"], "rec").collect())
    assert got == sorted((i, p, t or "") for i, v in enumerate(values) for p, t in plain(v))

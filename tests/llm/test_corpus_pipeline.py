"""The corpus pipeline stage by stage against plain versions, and on odd tables."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from fillbook.llm import langid, pii, simhash
from fillbook.llm.common import prepare, table, write_read
from test_packing import check
from test_simhash import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark):
    prepare(spark)
    docs = table(spark, SF, "documents")
    kept = write_read(C.language(spark, docs, SF), "t")
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(langid.has_letter(x.text) for x in rows) and len(rows) >= 0.98 * docs.count()

    one = write_read(C.near_dups(spark, kept, SF), "t")
    comp = plain_components([simhash.fingerprint(x.text) for x in rows], [x.doc_id for x in rows])
    assert sorted(x.doc_id for x in one.collect()) == sorted(set(comp)) and one.columns == docs.columns

    masked = write_read(C.pii(spark, one, SF), "t")
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    want = {x.doc_id: pii.mask(x.text, pii.find_spans(x.text)) for x in one.collect()}
    assert {x.doc_id: x.text for x in masked.collect()} == want
    assert masked.where(F.length("text") != F.col("n_chars")).count() == 0

    mixed = write_read(C.mixing(spark, masked, SF), "t")
    assert mixed.columns == docs.columns
    times = Counter(x.doc_id for x in mixed.collect())
    assert max(times.values()) <= 3 and times.keys() <= want.keys()

    packed = C.packing(spark, mixed, SF).collect()
    assert check(packed, [(x.doc_id, x.text) for x in mixed.collect()]) < 0.02


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, None, None, None)],
    [(1, "the and of the with a text", "en", None, 5), (1, "the and of the with a text", "en", None, 5), (None, "der und die", None, "a", 1),
     (2, "", "en", "b", 0), (3, "12 34", "de", "b", 5), (4, "mail a@b.cc now " * 3000, "en", "b", 1)],
])
def test_odd_tables(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = C.run(spark, str(tmp_path)).collect()
    texts = {i for i, t, *_ in rows if t and any(map(str.isalpha, t))}
    assert {x.doc_id for x in got} <= texts
    assert bool(got) == bool(texts)

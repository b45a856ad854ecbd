"""Language ID and toxicity: held-out accuracy, edges, counterfactual penalty."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillbook.llm import langid as L
from fillbook.llm import toxicity as T
from fillbook.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def test_langid_held_out_accuracy_and_edges(spark):
    docs = table(spark, SF, "documents")
    out = L.held_out(F.col("doc_id"), 5, 0)
    model = L.LanguageModel.fit(docs, ~out, docs_per_lang=120)
    got = model.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where(out)
    total, right = got.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert right / total > 0.97
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "12 34 !", 1), (None, "the and of the with", 1), (5, "der und die " * 20000, 1)],
                                "doc_id long, text string, score int")
    rows = {x.doc_id: x for x in model.predict(odd).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0
    assert rows[5].lang_pred == "de" and rows[None].lang_pred == "en"
    assert sorted(str(x.doc_id) for x in model.accepted(odd).collect()) == ["5", "None"]
    assert model.predict(odd.limit(0)).count() == 0


def test_langid_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = L.LanguageModel.fit(docs, F.lit(True))
    assert [tuple(x) for x in model.predict(docs).collect()] == [(1, "und", 0.0)]
    assert model.accepted(docs).count() == 1


def test_pair_tables_equal_plain_convolution():
    r = np.random.default_rng(0)
    x, y = r.integers(0, L.ALPHABET, (70, L.WINDOW)).astype(np.uint8), r.integers(0, 3, 70)
    p = L.train(x, y, 3)
    plain = np.concatenate([c.max(axis=1) for c in L._responses(x, p)], 1) + p["b"]
    assert np.allclose(L.Scorer(p).logits(x), np.maximum(plain, 0) @ p["o"] + p["c"], atol=1e-3)


def test_toxicity_held_out_and_edges(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = T.ToxicityModel.fit(docs, labels, ~L.held_out(F.col("doc_id"), 4, 2))
    got = model.score(docs).join(labels, "doc_id").agg(
        F.sum(((F.col("score") >= T.THRESHOLD) & (F.col("toxic") == 1)).cast("int")), F.sum("toxic"),
        F.sum((F.col("score") >= T.THRESHOLD).cast("int"))).first()
    assert got[0] / got[1] > 0.8 and got[0] / got[2] > 0.9
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x", 0.5)], "doc_id long, text string, score double")
    rows = [x.score for x in model.score(odd).collect()]
    assert len(rows) == 3 and all(0 <= x < T.THRESHOLD for x in rows) and rows[0] == rows[1]
    none = T.ToxicityModel.fit(docs, labels.limit(0), F.lit(True))
    assert {x.score for x in none.score(odd).collect()} == {0.0}


def test_counterfactual_penalty_evens_identity_terms():
    """An identity term that stands in most toxic rows loses its weight."""
    r = np.random.default_rng(3)
    rows, y = [], []
    for _ in range(400):
        bad = r.random() < 0.5
        rows.append(([0] if bad else []) + ([1] if r.random() < (0.9 if bad else 0.1) else []))
        y.append(float(bad and r.random() < 0.9))
    pairs = [([1], [2]) for x in rows if 1 in x]
    free, _ = T.fit(rows, np.array(y), pairs, 3, cf_weight=0.0)
    held, _ = T.fit(rows, np.array(y), pairs, 3, cf_weight=5.0)
    assert abs(held[1] - held[2]) < 0.3 * abs(free[1] - free[2]) and held[0] > 1
    assert T.counterfactuals("No group here.") == []
    gone, come = T.counterfactuals("The women won. Fine.")[0]
    assert "women" in gone and come and "fine" not in gone


def _swapped_whole(text):
    """Counterfactuals by building all features of both texts."""
    groups, out = T.identity_groups(), []
    sentences = [set(T._WORD.findall(s)) for s in T._SENTENCE.split(text.lower())]
    for n, s in enumerate(sentences):
        for w in sorted(s & groups.keys()):
            others = groups[w]
            first = zlib.crc32(f"{w} {n}".encode()) % len(others)
            for i in range(min(T.SWAPS, len(others))):
                new = others[(first + i) % len(others)]
                swapped = [(x - {w}) | {new} if m == n else x for m, x in enumerate(sentences)]
                before, after = (T.features_of(set().union(*x)) for x in (sentences, swapped))
                out.append((before - after, after - before))
    return out


@pytest.mark.parametrize("seed", range(20))
def test_counterfactuals_equal_whole_swaps(seed):
    r = random.Random(seed)
    vocabulary = "women woman wombat men mention blind blindly young the of gay gayer frauen frau muslim".split()
    text = "".join(r.choice(vocabulary) + r.choice([" ", " ", ". ", "\n"]) for _ in range(60))
    assert T.counterfactuals(text) == _swapped_whole(text)


def test_long_text_full_of_terms_is_one_pass():
    import time
    began = time.time()
    pairs = T.counterfactuals("the women spoke. " * 60_000)
    assert len(pairs) == 180_000 and time.time() - began < 20


def test_toxicity_of_tables_without_rows_and_with_long_texts(spark):
    prepare(spark)
    schema = "doc_id long, text string"
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "you idiot. " * 20_000), (2, "the women met. " * 20_000), (3, None)], schema)
    model = T.ToxicityModel.fit(docs, labels, F.lit(True))
    scores = {r.doc_id: r.score for r in model.score(docs).collect()}
    assert scores[1] > scores[2] and 0 <= scores[3] <= 1
    assert model.score(docs.limit(0)).count() == 0
    assert [r.score for r in T.ToxicityModel.fit(docs.limit(0), labels, F.lit(True)).score(docs).collect()] == [0.0] * 3


def test_pairs_that_repeat_weigh_as_often():
    rows, y = [[0], [1], [0, 2], [2]], np.array([1.0, 0, 1, 0])
    one = T.fit(rows, y, [([0], [1])] * 3 + [([2], [])], 3)
    two = T.fit(rows, y, [([0], [1]), ([2], [])], 3, times=[3, 1])
    assert np.allclose(one[0], two[0]) and np.isclose(one[1], two[1])
    assert not np.allclose(one[0], T.fit(rows, y, [([0], [1])], 3, cf_weight=0.0)[0])


def test_alike_terms_are_those_of_equal_company():
    company = [("red", "<the", 8), ("red", ">car", 8), ("blue", "<the", 4), ("blue", ">car", 4), ("run", ">car", 1), ("run", "<to", 9)]
    assert T.alike_terms(company) == {"red": ("blue",), "blue": ("red",)}
    assert T.alike_terms(company, alike=0.0)["run"] == ("blue", "red") and T.alike_terms([]) == {}


def test_terms_found_in_the_sample_change_the_model(spark):
    """The given tables hold none of the fixed terms: the pairs come from found ones, and their penalty shows in the weights."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    learn = ~L.held_out(F.col("doc_id"), 4, 2)
    model, plain = (T.ToxicityModel.fit(docs, labels, learn, cf_weight=w) for w in (50.0, 0.0))
    assert model.pairs == plain.pairs > 0 and model.weights.keys() == plain.weights.keys() and model.groups == plain.groups
    found = model.groups.keys() - T.identity_groups().keys()
    assert found and not found & {"idiot", "moron", "scum", "trash", "stupid"}
    def change(m):
        gap = [(w, o) for w in sorted(found) for o in m.groups[w]]
        return sum((sum(m.weights[f] for f in T.features_of({w}) & m.weights.keys()) - sum(m.weights[f] for f in T.features_of({o}) & m.weights.keys())) ** 2 for w, o in gap)
    assert change(model) < change(plain)


def test_toxicity_tables_without_rows_or_classes(spark):
    docs = spark.createDataFrame([(1, "The red car. " * 20, "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, term string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, toxic int")
    for d, m in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        model = T.ToxicityModel.fit(d, m, F.lit(True))
        assert model.score(docs).count() == 3 and model.score(docs.limit(0)).count() == 0

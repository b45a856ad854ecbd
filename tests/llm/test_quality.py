"""Quality rules: counts against a plain version, verdict, edges."""
import random
import re
from collections import Counter


from fillbook.llm import quality as Q
from fillbook.llm.common import table


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_plain(spark):
    r = random.Random(4)
    parts = ["a", "b", "#x", "é|", "\n", "  ", "\t", "a b a b a b", "…", "漢", "\x1c", "c d e f g h\n", "-", "&"]
    texts = [None, "", " \n\t ", "a a a a a a", "a b c d e", "x\n\nx\n x"]
    texts += [" ".join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(150)]
    texts.append("same words come again and " * 4000)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {x.doc_id: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in Q.quality_rules(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t), repr(t)
    assert Q.quality_rules(df.limit(0)).count() == 0


def test_verdict_follows_labels(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    got = Q.quality_rules(d).join(d.select("doc_id", "quality"), "doc_id")
    assert got.where("quality = 0 and kept").count() == 0
    assert got.where("quality = 1 and not kept and not base_failed").count() == 0
    assert got.where("base_failed and kept").count() == 0


def test_rules_are_data(spark):
    df = spark.createDataFrame([(1, "the cat and the dog " * 3 + "end")], "doc_id long, text string")
    assert Q.quality_rules(df, rules=(("short", "n_words", "max", 100, "one"),)).first().kept is False
    plan = Q.quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan

"""SimHash: fingerprints, links and components against plain versions."""
import random
import re

import numpy as np
import pytest
import xxhash

from fillbook.llm import simhash as S
from fillbook.llm.components import components


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    root = [find(i) for i in range(len(fps))]
    return [min(ids[j] for j in range(len(fps)) if root[j] == root[i]) for i in range(len(fps))]


def test_fingerprint():
    r = random.Random(1)
    for n in (0, 1, 3, 4, 5, 30):
        t = " ".join(r.choice(["A", "bÉ", "c\x1c", "d\xa0e", "\n", "F"]) for _ in range(n))
        assert S.fingerprint(t) == plain_fingerprint(t)
    assert S.fingerprint(None) == 0


@pytest.mark.parametrize("block,segments", [(2048, 6), (8, 6), (8, 7)])
def test_links_lose_nothing(spark, block, segments):
    r = random.Random(block + segments)
    base = [r.getrandbits(64) for _ in range(60)]
    fps = {0}
    for b in base:
        fps.add(b)
        for _ in range(r.choice([0, 1, 30])):
            x = b
            for _ in range(r.randint(1, 6)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    roots = {int(np.int64(x.node).view(np.uint64)): int(np.int64(x.root).view(np.uint64))
             for x in components(S.near_links(df, segments=segments, block=block)).collect()}
    got, want = {}, {}
    for f, c in zip(fps, plain_components(fps, list(range(len(fps)))), strict=True):
        got.setdefault(roots.get(f, f), set()).add(f)
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_chain(spark):
    n = 50
    edges = [(i, i + 1) for i in range(n)] + [(500, 501), (501, 500), (7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 501: 500}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edges_of_the_table(spark):
    t = "one two three four five six"
    rows = [(1, None, 5), (2, "", 5), (3, t, 5), (3, t, 5), (4, t.upper(), 5), (None, t, 5), (None, "alone here", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted((x.doc_id is None, x.doc_id or 0, x.component_id or 0) for x in S.simhash_components(df).collect())
    assert got == [(False, 1, 1), (False, 2, 1), (False, 3, 3), (False, 3, 3), (False, 4, 3), (True, 0, 0), (True, 0, 3)]
    assert sorted(str(x.doc_id) for x in S.drop_near_duplicates(df).collect()) == ["1", "3", "None"]
    assert S.simhash_components(df.limit(0)).count() == 0


def test_one_row_of_each_component(spark):
    """Rows that share an id, or have none, stay or go by their own component."""
    r = random.Random(4)
    apart = [" ".join(f"w{r.randrange(10**6)}" for _ in range(30)) for _ in range(12)]
    rows = [(None, t, "a") for t in apart[:5]] + [(None, apart[0], "b"), (None, apart[0], None)]
    rows += [(3, apart[5], "a"), (7, apart[5].upper(), "a"), (7, apart[6], "a"), (7, apart[7], "a"), (None, apart[7], "a")]
    rows += [(8, apart[8], "b"), (8, apart[8], "a"), (8, apart[8], "a"), (9, None, "x"), (9, "x", None)]
    kept = []
    for n in (1, 2, 3):
        r.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        kept.append(sorted(map(str, S.drop_near_duplicates(df).collect())))
        got = [(x.doc_id, x.text) for x in S.drop_near_duplicates(df).collect()]
        want = [(None, t) for t in apart[:5]] + [(3, apart[5]), (7, apart[6]), (7, apart[7]), (8, apart[8]), (9, None), (9, "x")]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert kept[0] == kept[1] == kept[2]


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5, 6), (2, "A B C D E", 7, 8)], "doc_id long, text string, _key long, _key2 long")
    assert [tuple(r) for r in S.drop_near_duplicates(df).select("doc_id", "_key", "_key2").collect()] == [(1, 5, 6)]
